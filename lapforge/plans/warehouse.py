"""The warehouse layer: fact tables written once, read by every query.

The reference's platform lands raw tables, builds a star schema
(``fact_race_results``, ``fact_lap_times``) and serves the dashboards from it.
Here the same: ``build`` runs the one expensive join (lineitem x orders) and
the lap numbering once, writes both facts as parquet partitioned by season,
the season aggregate and the season dimension
(rebalanced on (season, driver) and sorted inside, so a season filter
prunes folders and a driver filter skips row groups), and every query scans them.

The tables go under the shared ``spark.checkpoint.dir`` (``scratch_path``);
they are durable, so a lost executor re-reads them instead of recomputing
the join.  One build per session, data directory and state of its files;
``invalidate`` forces a rebuild.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.session import scratch_path

_BUILT: dict[tuple, str] = {}
_LOCK = threading.Lock()

FACT_RESULTS = "fact_race_results"
FACT_LAPS = "fact_lap_times"
AGG_SEASON = "agg_season_points"
DIM_SEASONS = "dim_seasons"

INPUTS = ("lineitem", "orders", "supplier", "events")


def _state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time and bytes of a table's folder or file."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(jpath).getModificationTime(), fs.getContentSummary(jpath).getLength()


def _key(spark: SparkSession, base: str) -> tuple:
    """Application, data folder and the state of the inputs: a changed input is a new key."""
    base = base.rstrip("/")
    return (spark.sparkContext.applicationId, base,
            *(_state(spark, f"{base}/{t}.parquet") for t in INPUTS))


def _partitions(spark: SparkSession) -> int | None:
    conf = spark.conf.get("lapforge.warehouse.partitions", None)
    return int(conf) if conf else None


def write_fact(df: DataFrame, path: str, partitions: int | None = None,
               cluster: tuple[str, ...] = ("driver_id",), split: str = "race_id",
               rebalance: bool = True) -> None:
    """Write one folder per season, files sorted by (season, cluster..., split).

    ``REBALANCE`` hash-partitions on (season, cluster...) and lets AQE size the
    write tasks: a hot key (a driver holding a third of a season) is split
    into several tasks, small partitions are merged, and no sampling pass over
    the input is needed (a range repartition would first recompute the join to
    sample it).  The sort inside each file keeps row groups narrow on the
    driver key, so driver filters skip row groups.  ``partitions`` (from
    ``lapforge.warehouse.partitions``) sets the initial hash partition count.
    """
    keys = ["season", *cluster, split]
    if rebalance:
        hint_args = [*([partitions] if partitions else []), "season", *cluster]
        df = df.hint("rebalance", *hint_args).sortWithinPartitions(*keys)
    df.write.mode("overwrite").partitionBy("season").parquet(path)


def build(model) -> str:
    """Write the fact tables for ``model.base``; return the warehouse folder."""
    spark = model.spark
    path = scratch_path(spark, "warehouse")
    n = _partitions(spark)
    write_fact(model.raw_results(with_time=True), f"{path}/{FACT_RESULTS}", n)
    # the lap numbering already range-sorted the events by (season, driver,
    # time): its partitions are contiguous key ranges, so they are written as is
    write_fact(model.raw_laps(with_lap=True), f"{path}/{FACT_LAPS}", rebalance=False)
    facts = spark.read.parquet(f"{path}/{FACT_RESULTS}")
    model.stats_of(facts).write.parquet(f"{path}/{AGG_SEASON}")
    spark.read.parquet(f"{path}/{AGG_SEASON}").select(F.col("season").cast("int").alias("season_year")) \
        .distinct().coalesce(1).write.parquet(f"{path}/{DIM_SEASONS}")
    return path


def location(model) -> str:
    """Folder of the warehouse for this session and data directory (built on first use)."""
    key = _key(model.spark, model.base)
    with _LOCK:
        if key not in _BUILT:
            _BUILT[key] = build(model)
        return _BUILT[key]


def invalidate(spark: SparkSession, base: str) -> None:
    with _LOCK:
        key = _key(spark, base)
        _BUILT.pop(key, None)


def read_fact(model, name: str) -> DataFrame:
    """The stored fact; rebuilt once if its folder has gone (e.g. the shared
    folder was cleaned while the session lived)."""
    from pyspark.errors import AnalysisException
    try:
        return model.spark.read.parquet(f"{location(model)}/{name}")
    except AnalysisException:
        invalidate(model.spark, model.base)
        return model.spark.read.parquet(f"{location(model)}/{name}")


def season_filter(df: DataFrame, season: int | None) -> DataFrame:
    return df if season is None else df.filter(F.col("season") == season)
