"""Run log, run history, stage list, resource series and app log analytics."""
from pyspark.sql import functions as F

from lapforge.plans import ops
from lapforge.sources import files


def _run_log(spark):
    rows = [("2024-01-15 08:00:01", "a.csv", "raw", 100, "SUCCESS"), ("2024-01-15 08:00:03", "b.csv", "raw", 20, "SUCCESS"),
            ("2024-01-15 08:00:38", "fact", "warehouse", 110, "FAILED"), ("2024-01-16 08:00:00", "c.csv", "raw", 3, "SUCCESS")]
    return spark.createDataFrame(rows, "t string, table string, layer string, rows bigint, status string") \
        .withColumn("ts", F.col("t").cast("timestamp"))


def test_layer_summary_raw_total(spark):
    rows = {r.layer: r for r in ops.layer_summary(_run_log(spark)).collect()}
    assert (rows["raw"].rows, rows["raw"].tables, rows["raw"].failures) == (123, 3, 0)
    assert rows["warehouse"].raw_rows_loaded == 123 and rows["warehouse"].failures == 1


def test_step_gaps(spark):
    g = ops.step_gaps(_run_log(spark)).orderBy("ts").collect()
    assert [r.gap_sec for r in g] == [None, 2, 35, None] and g[2].prev_table == "b.csv"  # a day is a run
    m = ops.mean_load_time(_run_log(spark)).first()
    assert m.mean_gap_sec == 18.5 and m.mean_raw_gap_sec == 2


def test_run_history(spark):
    runs = spark.createDataFrame(
        [("r1", "2024-03-01 06:00", "1m 30s", "2K", "SUCCESS"), ("r2", "2024-03-02 06:00", "2m 30s", "4K", "SUCCESS"),
         ("r3", "2024-03-03 06:00", "—", "—", "FAILED")],
        "run_id string, triggered string, duration string, records string, status string")
    r = ops.run_history_summary(runs).first()
    assert r.runs == 3 and r.failed == 1
    assert r.mean_duration_sec == 120 and r.mean_records == 3000


def test_stage_totals(spark):
    stages = spark.createDataFrame(
        [("Stage 1", "read", "COMPLETE", "0:10", "1K", 2), ("Stage 2", "join", "COMPLETE", "1:05", "2M", 3)],
        "stage string, job_name string, status string, duration string, records string, tasks int")
    r = ops.stage_totals(stages).first()
    assert r.total_sec == 75 and r.total_tasks == 5 and r.slowest_stage == "join"


def test_resource_summary(spark):
    series = spark.createDataFrame([(0, 5, 9, 1), (1, 7, 3, 8)], "minute int, cpu int, mem int, net int")
    rows = {r.metric: r for r in ops.resource_summary(series).collect()}
    assert rows["cpu"].peak == 7 and rows["cpu"].peak_minute == 1
    assert rows["mem"].peak == 9 and rows["net"].peak == 8


def test_app_log_records_and_tail(spark, tmp_dir):
    text = "\n".join([
        "2024-01-15 08:00:01,123 | INFO | started",
        "2024-01-15 08:00:02,001 | ERROR | ERROR IN page | boom",
        "Traceback (most recent call last):",
        '  File "x.py", line 1, in <module>',
        "ValueError: boom",
        "2024-01-15 08:00:03,500 | INFO | refreshed",
    ]) + "\n"
    path = f"{tmp_dir}/app.log"
    with open(path, "w") as fh:
        fh.write(text)
    recs = {r.line: r for r in ops.app_log(spark, path).collect()}
    assert set(recs) == {1, 2, 6}
    assert recs[2].level == "ERROR" and recs[2].lines == 4
    assert recs[2].detail.splitlines()[-1] == "ValueError: boom"
    counts = {r.level: r.records for r in ops.level_counts(ops.app_log(spark, path)).collect()}
    assert counts == {"INFO": 2, "ERROR": 1}
    tail = [r.text for r in files.log_tail(spark, path, 2).collect()]
    assert tail == ["ValueError: boom", "2024-01-15 08:00:03,500 | INFO | refreshed"]
