"""Pipeline and log analytics.

The functions take operational tables (a run log, run history, stage list, resource series,
an application log); the queries at the end apply W7 / O2, O6 and O7 to ``events``: a user is
a run and an event a step, hourly values per event type are the series, and an application
log is written from the events.  O5 (``table_inventory``) is in ``plans.quality``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapforge.functions import fmt_thousands, fmt_time
from lapforge.functions.units import count_number, duration_seconds, malformed
from lapforge.operators.aggregates import count_if
from lapforge.operators.carry import carry
from lapforge.operators.joins import scalar_row
from lapforge.plans.model import Model
from lapforge.session import scratch_path
from lapforge.sources.files import log_tail, read_lines


def layer_summary(log: DataFrame) -> DataFrame:
    """O1: rows, tables and failed loads per layer, with the raw-layer total
    (the rows actually ingested) on every row."""
    per = log.groupBy("layer").agg(
        F.sum("rows").cast("bigint").alias("rows"),
        F.count(F.lit(1)).alias("tables"),
        count_if(F.col("status") != "SUCCESS").alias("failures"))
    raw_total = scalar_row(log.filter(F.col("layer") == "raw").agg(
        F.sum("rows").cast("bigint").alias("rows")))["rows"]
    return per.withColumn("raw_rows_loaded", raw_total)


def step_gaps(log: DataFrame, run_key=None) -> DataFrame:
    """Seconds between successive steps of a run (first step NULL), with the step before.

    A run is one day of the log unless ``run_key`` is given.  The step before is carried
    over partition borders, so one run of any length spreads over many tasks."""
    runs = log.select("ts", "table", "layer", (run_key if run_key is not None else F.to_date("ts")).alias("run"))
    steps = carry(runs, ["run"], ["ts", "table"], {"prev_ts": "ts", "prev_table": "table"})
    gap = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("prev_ts").cast("timestamp"))) / 1e6
    return steps.select("run", "ts", "table", "layer", "prev_table", gap.alias("gap_sec"))


def mean_load_time(log: DataFrame, run_key=None, raw: str = "raw") -> DataFrame:
    """O2: mean gap between steps, and the mean over raw-layer steps only."""
    g = step_gaps(log, run_key)
    return g.agg(F.avg("gap_sec").alias("mean_gap_sec"),
                 F.avg(F.when(F.col("layer") == raw, F.col("gap_sec"))).alias("mean_raw_gap_sec"))


def run_history_summary(runs: DataFrame, *by: str) -> DataFrame:
    """O3: runs, success rate %, mean duration (s) and mean records of the runs that report
    them (a dash is no value), over all runs or per ``by``.  Texts that mean a value but cannot
    be read are left out of the means and counted (``bad_durations``, ``bad_records``)."""
    read = runs.withColumn("_lf_d", duration_seconds("duration")).withColumn("_lf_r", count_number("records"))
    status = F.col("status")
    return read.groupBy(*by).agg(
        F.count(F.lit(1)).alias("runs"),
        (F.lit(100.0) * count_if(status.contains("SUCCESS")) / F.count(F.lit(1))).alias("success_pct"),
        F.avg("_lf_d").alias("mean_duration_sec"),
        F.avg("_lf_r").alias("mean_records"),
        count_if(status.contains("FAILED")).alias("failed"),
        count_if(malformed("duration", F.col("_lf_d"))).alias("bad_durations"),
        count_if(malformed("records", F.col("_lf_r"))).alias("bad_records"))


def stage_totals(stages: DataFrame, *by: str) -> DataFrame:
    """Total stage seconds, records and tasks, and the slowest stage (of equally slow ones
    the last by name), over all stages or per ``by``."""
    read = stages.withColumn("_lf_d", duration_seconds("duration")).withColumn("_lf_r", count_number("records"))
    return read.groupBy(*by).agg(
        F.sum("_lf_d").cast("bigint").alias("total_sec"),
        F.sum("_lf_r").cast("bigint").alias("total_records"),
        F.sum("tasks").cast("bigint").alias("total_tasks"),
        F.max(F.struct("_lf_d", "job_name"))["job_name"].alias("slowest_stage"))


def resource_summary(series: DataFrame, metrics=("cpu", "mem", "net")) -> DataFrame:
    """Wide per-minute series to long (minute, metric, value); mean and (first) peak per metric."""
    each = F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in metrics))
    long = series.select("minute", F.explode(each).alias("r")).select("minute", "r.*")
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.max("value").alias("peak"),
                                      F.max_by("minute", F.struct("value", -F.col("minute"))).alias("peak_minute"))


# Fixed value: the log line layout ``asctime | levelname | message`` of
# Python's logging formatter, with its default asctime.
LOG_RECORD = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3}) \| ([A-Z]+) \| (.*)$"


def app_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per log record with the continuation lines (tracebacks)
    attached: file, line, asctime, level, message, detail, lines.

    Continuation lines belong to the closest record line above them in the
    same file; its number is carried over split and partition borders, so one
    huge log is not one task.  The lines of one record are gathered in line
    order (bounded by the traceback); lines above the first record are left out."""
    is_rec = F.regexp_like(F.col("text"), F.lit(LOG_RECORD))
    lines = carry(read_lines(spark, path), ["file"], ["line"], {"rec_line": "line"}, is_rec, own=True)
    head = F.max(F.when(F.col("line") == F.col("rec_line"), F.col("text")))
    more = F.array_sort(F.collect_list(F.when(F.col("line") != F.col("rec_line"), F.struct("line", "text"))))
    out = lines.filter(F.col("rec_line").isNotNull()).groupBy("file", "rec_line") \
        .agg(head.alias("_lf_h"), more.alias("_lf_l"))
    return out.select(
        "file", F.col("rec_line").alias("line"),
        *(F.regexp_extract("_lf_h", LOG_RECORD, i + 1).alias(c) for i, c in enumerate(("asctime", "level", "message"))),
        F.array_join(F.transform("_lf_l", lambda x: x["text"]), "\n").alias("detail"),
        (F.size("_lf_l") + 1).alias("lines"))


def level_counts(records: DataFrame) -> DataFrame:
    """Records per level."""
    return records.groupBy("level").agg(F.count(F.lit(1)).alias("records"))


# ---- registered queries over ``events`` ---------------------------------------------

METRICS = ("click", "error", "purchase", "view")


def event_steps(m: Model) -> DataFrame:
    """The events as a step log: ts, table (the event), layer (its type) and the user."""
    return m.table("events", "event_id", "ts", "user_id", "event_type").select(
        "ts", F.col("event_id").alias("table"), F.col("event_type").alias("layer"), "user_id")


def event_gaps(m: Model) -> DataFrame:
    """Every event of a user with the one before and the seconds between them."""
    return step_gaps(event_steps(m), F.col("user_id")).select(
        F.col("run").alias("user_id"), F.col("table").alias("event_id"), F.col("prev_table").alias("prev_event_id"), "gap_sec")


def event_mean_gap(m: Model) -> DataFrame:
    """O2: mean seconds between events over all users as one run, and before a purchase."""
    return mean_load_time(event_steps(m), F.lit(0), "purchase")


def event_series(m: Model) -> DataFrame:
    """Hourly sums of the values per event type, summed up per type."""
    hour = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).cast("bigint")
    cents = F.bround(F.col("value") * 100).cast("bigint")  # whole numbers add up alike in any order
    wide = m.table("events", "ts", "event_type", "value").groupBy(hour.alias("minute")).pivot("event_type", list(METRICS)) \
        .agg(F.sum(cents)).na.fill(0, list(METRICS))
    return resource_summary(wide, METRICS)


def write_event_log(m: Model) -> str:
    """The events as an application log, in order of event_id; an error has two more lines."""
    e = m.table("events", "event_id", "ts", "user_id", "event_type", "props") \
        .withColumn("stamp", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss,SSS"))
    error = F.col("event_type") == "error"
    head = F.concat_ws(" | ", "stamp", F.when(error, "ERROR").otherwise("INFO"), F.concat_ws(
        " ", "event_type", F.lit("of user"), "user_id", F.lit("event"), "event_id"))
    text = F.when(error, F.concat(head, F.lit("\nTraceback (most recent call last):\n  props "), F.coalesce("props", F.lit("")))) \
        .otherwise(head)
    path = scratch_path(m.spark, "event-log")
    e.select("event_id", text.alias("text")).repartitionByRange("event_id").sortWithinPartitions("event_id") \
        .select("text").write.text(path)
    return path


def event_log_records(m: Model) -> DataFrame:
    """The records of the log written from the events, continuation lines attached."""
    return app_log(m.spark, write_event_log(m)).select("asctime", "level", "message", "detail", "lines")


def event_log_tail(m: Model) -> DataFrame:
    """K6: the last 300 lines of that log."""
    return log_tail(m.spark, write_event_log(m), 300).select("text")


# ---- registered queries over ``orders`` and ``lineitem`` --------------------------------

def count_text(n, style) -> "F.Column":
    """A count as a report prints it: ``5.4K``, ``4,280,000`` or bare, by ``style`` 0, 1, 2."""
    return F.when(style == 0, F.concat(F.format_string("%d.%d", F.floor(n / 10), n % 10), F.lit("K"))) \
        .when(style == 1, fmt_thousands(n)).otherwise(n.cast("string"))


def duration_text(seconds, style) -> "F.Column":
    """Seconds as ``6m 32s``, ``6:32`` or ``1h 46m 32s``, by ``style`` 0, 1, 2."""
    return F.when(style == 0, F.format_string("%dm %ds", F.floor(seconds / 60), seconds % 60)) \
        .when(style == 1, F.format_string("%d:%02d", F.floor(seconds / 60), seconds % 60)) \
        .otherwise(F.format_string("%dh %dm %ds", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60))


def order_runs(m: Model) -> DataFrame:
    """Orders as a run history: an order is a run, its price in whole units the seconds it took,
    its customer's key the records; every seventh run reports a dash, every eleventh a text
    that cannot be read."""
    key = F.col("o_orderkey")
    seconds, records = F.floor("o_totalprice").cast("bigint"), F.col("o_custkey").cast("bigint")

    def told(text):
        return F.when(key % 7 == 0, F.lit("—")).when(key % 11 == 0, F.concat(text, F.lit(" (est.)"))).otherwise(text)

    return m.table("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate").select(
        key.alias("run_id"), F.col("o_orderdate").cast("timestamp").alias("triggered"),
        told(duration_text(seconds, key % 3)).alias("duration"), told(count_text(records, key % 3)).alias("records"),
        F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"))


def order_run_history(m: Model) -> DataFrame:
    """The run history per month, with the clock time of its earliest start in a day."""
    runs = order_runs(m).withColumn("month", F.date_format("triggered", "yyyy-MM"))
    clock = runs.groupBy("month").agg(F.min(fmt_time("triggered")).alias("earliest"))
    return run_history_summary(runs, "month").join(clock, "month")


def order_stage_totals(m: Model) -> DataFrame:
    """Shipping as stages per ship month: a line item is a stage named by its flags,
    its quantity the tasks, its price in whole units the seconds, its part's key the records."""
    seconds, records = F.floor("l_extendedprice").cast("bigint"), F.col("l_partkey").cast("bigint")
    style = F.col("l_linenumber") % 3
    stages = m.table("lineitem", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag",
                     "l_linestatus", "l_shipdate").select(
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), F.concat_ws("/", "l_returnflag", "l_linestatus").alias("job_name"),
        duration_text(seconds, style).alias("duration"), count_text(records, style).alias("records"),
        F.col("l_quantity").cast("int").alias("tasks"))
    return stage_totals(stages, "month")
