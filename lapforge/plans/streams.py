"""Registered runs of the streaming jobs (ST1, ST2) over files derived from the
given tables; the check compares the final stored state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapforge.plans.model import SEASON, Model
from lapforge.session import scratch_path
from lapforge.sinks import read_evolved
from lapforge.streaming import (RAW_RESULT_SCHEMA, RESULT_KEY, land_stream,
                                refresh_mart_stream)
from lapforge.streaming.keyed import land_keyed, read_deltas, read_landed


def _stage_arrivals(m: Model, in_dir: str) -> None:
    """Result files as an exporter would drop them: the results by season in
    several files, then a replayed export of one season (repeated records)."""
    f = m.race_facts(with_time=True).select(*RESULT_KEY)
    f.write.mode("overwrite").parquet(in_dir)
    f.filter(F.col("season") == SEASON).write.mode("append").parquet(in_dir)


def _landed(m: Model) -> tuple[str, str]:
    spark = m.spark
    base = scratch_path(spark, "stream")
    in_dir, out_dir = f"{base}/incoming", f"{base}/raw"
    _stage_arrivals(m, in_dir)
    land_stream(spark, in_dir, out_dir, f"{base}/_ckpt_land", files_per_trigger=128)
    return base, out_dir


def land_stream_query(m: Model) -> DataFrame:
    """ST1: the raw layer after landing all available files once."""
    _, out_dir = _landed(m)
    return m.spark.read.schema(RAW_RESULT_SCHEMA).parquet(out_dir)


def refresh_mart_stream_query(m: Model) -> DataFrame:
    """ST2: the standings mart after refreshing from every landed micro-batch."""
    base, out_dir = _landed(m)
    mart = f"{base}/mart"
    refresh_mart_stream(m.spark, out_dir, mart, f"{base}/_ckpt_mart", files_per_trigger=1024)
    return read_evolved(m.spark, mart).select("season", "driver_id", "points", "races", "wins")


# ---- events landed by key, with a mart of deltas --------------------------------------

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
LATE_TYPE, REPLAYED_TYPE = "error", "purchase"


def stage_events(m: Model, in_dir: str) -> None:
    """Event files as a collector would drop them: one by one in order of time, the errors
    last (late), then the purchases once more (replayed)."""
    cols = EVENT_SCHEMA.fieldNames()
    e = m.table("events", *cols).withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.coalesce(F.col("event_type") == LATE_TYPE, F.lit(False))
    e.filter(~late).repartitionByRange("ts").write.parquet(in_dir)
    e.filter(late).write.mode("append").parquet(in_dir)
    e.filter(F.col("event_type") == REPLAYED_TYPE).write.mode("append").parquet(in_dir)


def user_delta(rows: DataFrame) -> DataFrame:
    """Per user: events, cents, first and last time; all of it adds up over batches."""
    cents = F.bround(F.col("value") * 100).cast("bigint")
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum(cents).alias("cents"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def merge_user_deltas(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("user_id").agg(
        F.sum("events").alias("events"), F.sum("cents").alias("cents"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def _land_events(m: Model) -> str:
    base = scratch_path(m.spark, "events")
    stage_events(m, f"{base}/incoming")
    land_keyed(m.spark, f"{base}/incoming", f"{base}/raw", f"{base}/_ckpt", EVENT_SCHEMA, ["event_id"], "ts",
               files_per_trigger=8, deltas=(user_delta, f"{base}/deltas"))
    return base


def land_events_query(m: Model) -> DataFrame:
    """ST1: every event landed once, late and replayed files included."""
    return read_landed(m.spark, f"{_land_events(m)}/raw", EVENT_SCHEMA).select(*EVENT_SCHEMA.fieldNames())


def user_mart_query(m: Model) -> DataFrame:
    """ST2: the mart of users, kept by the deltas of the landed batches."""
    return read_deltas(m.spark, f"{_land_events(m)}/deltas", merge_user_deltas)
