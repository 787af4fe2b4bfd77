"""Landing on a record key with state, and a mart of mergeable deltas (ST2).

``land_keyed`` lands every record once.  A stream's state store holds the keys of the last
``delay`` of event time (``dropDuplicatesWithinWatermark``), so no landed row is read again for
what comes in time.  The state is kept by RocksDB on the executors and in the query's checkpoint;
a lost executor reloads it.  That operator leaves out rows behind its watermark and never sees
those without a time, so the same query also passes on, beside its output, every row of the
micro-batch that lies at or before the last watermark there can have been (the greatest landed
time less ``delay``): a superset of what was left out.  Of these the ones whose key is not
landed are the late lane.  They are joined with the landed keys of their own days only, and
only their keys are moved.

The time is part of the key: a replayed record has the time of the first copy, so it is either
still in the state or late, however long after it arrives.  Of records of equal key and unequal
other columns one stays, whichever is handled first.  NULL keys equal each other.

A micro-batch overwrites a folder of its own (``batch=<id>/lane=<lane>``), so one that is
replayed after a lost driver adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.operators.ordering import join_null_safe
from lapforge.session import configure
from lapforge.sinks import table_exists
from lapforge.sinks.versions import store_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ON_TIME, LATE, BEHIND = "on_time", "late", "behind"
MARKS = "_marks"  # hidden from readers of the folder: one row per batch
STATE_BYTES = 64 << 20  # input bytes per state partition; each is a RocksDB of several MB of its own
LEAST_PARTITIONS = 8


def state_partitions(spark: SparkSession, in_dir: str) -> int:
    """Partitions of the state for the files that are there; the checkpoint keeps the first number."""
    folder, store = store_of(spark, in_dir)
    return max(LEAST_PARTITIONS, -(-store.getContentSummary(folder).getLength() // STATE_BYTES))


def read_landed(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """The landed rows with their ``batch``, ``lane`` and ``day``; empty before the first batch."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.LongType()),
                          T.StructField("lane", T.StringType()), T.StructField("day", T.DateType())])
    if not table_exists(spark, out_dir):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(out_dir).filter(F.col("lane").isin(ON_TIME, LATE))


def land_keyed(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema: T.StructType,
               key: Sequence[str], time: str, delay: str = "1 day", files_per_trigger: int = 256,
               deltas: tuple[Callable[[DataFrame], DataFrame], str] | None = None,
               partitions: int | None = None) -> None:
    """Land all files that are there once per (key, time), from where the last call stopped.

    ``partitions`` of the state are set by the first call for good; give a number where the
    first files are few and many more will come (default: by their bytes).
    ``deltas``: (aggregate of the landed rows of a batch, folder); its rows are written per
    batch for ``read_deltas``.  ``schema`` has no column ``batch``, ``lane`` or ``day``."""
    session = configure(spark.newSession())
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions or state_partitions(spark, in_dir)))
    keys = list(dict.fromkeys([*key, time]))

    def last_mark(s: SparkSession, batch_id: int):
        """The greatest time landed in earlier batches, less ``delay``; None before any."""
        if not table_exists(s, f"{out_dir}/{MARKS}"):
            return None
        marks = s.read.schema("mark timestamp, batch bigint").parquet(f"{out_dir}/{MARKS}")
        return marks.filter(F.col("batch") < batch_id).agg(
            (F.max("mark") - F.expr(f"INTERVAL {delay}")).alias("mark")).first()["mark"]

    def land(batch: DataFrame, batch_id: int) -> None:
        s, folder = batch.sparkSession, f"{out_dir}/batch={batch_id}"
        mark = last_mark(s, batch_id)
        behind = F.col(time).isNull() if mark is None else F.col(time).isNull() | (F.col(time) <= F.lit(mark))
        # the one run of the stateful plan: its output, and what may have been left out
        batch.filter((F.col("lane") == ON_TIME) | behind).withColumn("day", F.to_date(time)) \
            .write.mode("overwrite").partitionBy("lane", "day").parquet(folder)
        landed = read_landed(s, out_dir, schema)
        own = s.read.schema(landed.schema).option("basePath", out_dir).parquet(folder)
        late = own.filter(F.col("lane") == BEHIND)
        days = [r[0] for r in late.select("day").distinct().collect()]  # calendar days
        if days:
            here = F.col("day").isin([d for d in days if d is not None])
            if None in days:
                here = F.coalesce(here, F.lit(True))
            known = landed.filter(here).select(*keys)
            join_null_safe(late.dropDuplicates(keys), known, keys, "left_anti").drop("batch", "lane") \
                .write.mode("overwrite").partitionBy("day").parquet(f"{folder}/lane={LATE}")
            path, store = store_of(s, f"{folder}/lane={BEHIND}")
            store.delete(path, True)
        mine = read_landed(s, out_dir, schema).filter(F.col("batch") == batch_id)
        if deltas:
            deltas[0](mine.drop("batch", "lane", "day")).write.mode("overwrite") \
                .parquet(f"{deltas[1]}/batch={batch_id}")
        mine.filter(F.col("lane") == ON_TIME).agg(F.max(time).cast("timestamp").alias("mark")) \
            .write.mode("overwrite").parquet(f"{out_dir}/{MARKS}/batch={batch_id}")

    rows = session.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(in_dir)
    on_time = rows.filter(F.col(time).isNotNull()).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
    both = on_time.withColumn("lane", F.lit(ON_TIME)).unionByName(rows.withColumn("lane", F.lit(BEHIND)))
    (both.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def read_deltas(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The mart: the deltas of all batches, added up by ``merge``."""
    return merge(spark.read.parquet(path))
