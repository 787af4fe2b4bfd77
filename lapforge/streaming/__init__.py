"""Structured Streaming jobs.

ST1 lands arriving result files into the raw layer: a file stream with a
fixed schema whose micro-batches are de-duplicated on the record key and against
the landed rows, then appended (restartable after a lost executor or driver: a
replayed batch finds its rows landed).

ST2 refreshes the season-standings mart from each landed micro-batch with
``foreachBatch``: the seasons touched by the batch are recomputed from the
landed rows of those seasons (the raw layer is partitioned by season, so only
their folders are read) and replace those seasons in the mart
(``sinks.merge_mart``), so a replayed batch rewrites the same rows and changes
nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.operators.aggregates import count_if
from lapforge.operators.ordering import join_null_safe
from lapforge.sinks import merge_mart, table_exists

RAW_RESULT_SCHEMA = T.StructType([
    T.StructField("race_id", T.LongType()),
    T.StructField("season", T.IntegerType()),
    T.StructField("round", T.IntegerType()),
    T.StructField("circuit_id", T.LongType()),
    T.StructField("driver_id", T.LongType()),
    T.StructField("finish_position", T.IntegerType()),
    T.StructField("points", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("race_ts", T.TimestampType()),
])

RESULT_KEY = [f.name for f in RAW_RESULT_SCHEMA.fields]


def live_source(spark: SparkSession, in_dir: str, schema: T.StructType = RAW_RESULT_SCHEMA,
                files_per_trigger: int = 2) -> DataFrame:
    """Arriving parquet files as a stream (schema fixed, no inference)."""
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", files_per_trigger)
            .parquet(in_dir))


def land_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                key: Sequence[str] = tuple(RESULT_KEY), schema: T.StructType = RAW_RESULT_SCHEMA,
                files_per_trigger: int = 2) -> None:
    """ST1: land everything available now, dropping repeated records.

    Each micro-batch is de-duplicated on ``key`` and anti-joined (NULL matches NULL)
    with the landed rows of the seasons it touches, then appended.  A row is never
    dropped for being late, a repeat is recognised however late it comes, and a
    replayed batch adds nothing."""

    def land(batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(list(key))
        if table_exists(spark, out_dir):
            landed = spark.read.schema(schema).parquet(out_dir)
            seasons = [r[0] for r in batch.select("season").distinct().collect()]  # calendar years
            here = F.col("season").isin([s for s in seasons if s is not None])
            if None in seasons:
                here = F.coalesce(here, F.lit(True))
            fresh = join_null_safe(fresh, landed.where(here).select(*key), list(key), "left_anti")
        fresh.write.mode("append").partitionBy("season").parquet(out_dir)

    q = (live_source(spark, in_dir, schema, files_per_trigger).writeStream
         .foreachBatch(land)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def season_mart(raw: DataFrame) -> DataFrame:
    """Standings mart rows from landed results: points, races, wins per (season, driver)."""
    pos = F.col("finish_position")
    return raw.groupBy("season", "driver_id").agg(
        F.sum("points").cast("bigint").alias("points"),
        F.count(F.lit(1)).alias("races"),
        count_if(pos == 1).alias("wins"))


def refresh_mart_stream(spark: SparkSession, landed_dir: str, mart_dir: str,
                        checkpoint: str, files_per_trigger: int = 256) -> None:
    """ST2: every micro-batch of landed rows recomputes the seasons it touches."""

    def refresh(batch: DataFrame, batch_id: int) -> None:
        # touched seasons: one row per season, so the semi join is broadcast and
        # prunes the landed season folders (dynamic partition pruning)
        touched = F.broadcast(batch.select("season").distinct())
        landed = spark.read.schema(RAW_RESULT_SCHEMA).parquet(landed_dir)
        fresh = season_mart(landed.join(touched, "season", "left_semi"))
        merge_mart(spark, mart_dir, fresh, ["season", "driver_id"])

    q = (live_source(spark, landed_dir, files_per_trigger=files_per_trigger).writeStream
         .foreachBatch(refresh)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
