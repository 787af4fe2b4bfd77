"""Writers.

All writes are distributed DataFrame writes (no pandas hop).  Paths on a
cluster must be on shared storage; ``lapforge.session.scratch_path`` gives a
fresh folder under ``spark.checkpoint.dir`` for intermediate tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lapforge.operators.ordering import join_null_safe
from lapforge.session import ensure_checkpoint_dir
from lapforge.sinks import versions


def write_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                    fmt: str = "parquet") -> None:
    """Replace the table at ``path``; the new schema replaces the old one."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns missing on one side are NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """S7 on read: parquet files with different column sets under one folder, or the
    current version of a table of ``sinks.versions``."""
    if versions.current(spark, path)[0]:
        return versions.read_version(spark, path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def append_load(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append to a table (created when absent) and return the rows written.

    The count is an ``Observation`` of the same write job, not a second pass."""
    obs = Observation("append_load")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("append").format(fmt).save(path)
    return int(obs.get["rows"])


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the table's folder is there (asked of its file system, which raises on any failure)."""
    folder, store = versions.store_of(spark, path)
    return store.exists(folder)


class KeyCollision(ValueError):
    """The new rows hold the same merge key more than once (e.g. a driver who
    changed team mid-season under a (season, driver) key)."""


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise KeyCollision(f"duplicate merge key {dict(zip(keys, dup[0][:len(keys)]))}")


def merge_mart(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str],
               partition_col: str = "season", on_collision: str = "fail",
               sync_columns: bool = False) -> None:
    """Upsert ``new`` into the mart at ``path`` by ``keys`` (NULL matches NULL).

    Only the partitions (seasons, also the NULL one) present in ``new`` are written:
    old rows of those seasons whose key is not in ``new`` are kept, the rest replaced;
    new columns are added (NULL in untouched partitions).  With ``sync_columns`` columns
    that ``new`` lacks leave the mart, which rewrites all of it.  The merged rows are one
    new batch and become the current version by one rename (``sinks.versions``), so a
    lost driver never leaves half a mart; read it with ``read_evolved``.  The new rows are
    checkpointed, as they are computed once and used three times.  A repeated merge of the
    same rows changes nothing.
    """
    keys = list(keys)
    ensure_checkpoint_dir(spark)
    if on_collision == "keep_first":
        new = new.dropDuplicates(keys)
    new = new.checkpoint(eager=True)
    if on_collision == "fail":
        check_unique(new, keys)
    base = versions.current(spark, path)
    if not base[0]:
        versions.replace_partitions(spark, path, new, partition_col, base)
        return
    old = versions.read_version(spark, path)
    every = sync_columns and bool(set(old.columns) - set(new.columns))
    if every:
        old = old.select(*[c for c in new.columns if c in old.columns])
    else:  # one value per partition folder: a bounded list, and a filter that prunes folders
        values = [r[0] for r in new.select(partition_col).distinct().collect()]
        here = F.col(partition_col).isin([v for v in values if v is not None])
        if None in values:
            here = F.coalesce(here, F.lit(True))
        old = old.where(here)
    kept = join_null_safe(old, new.select(*keys).distinct(), keys, "left_anti")
    merged = kept.unionByName(new, allowMissingColumns=True)
    versions.replace_partitions(spark, path, merged, partition_col, base, every)


def land(df: DataFrame, path: str, partition_by: Sequence[str] = ("season",)) -> None:
    """Landing write partitioned for pruning (``season = x`` reads one folder)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Export as csv (with header), json or parquet.  CSV keeps values
    exactly (Spark's CSV writer trims outer spaces unless told not to)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        (w.option("header", True)
         .option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False)
         .csv(path))
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
