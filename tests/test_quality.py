"""Each check fails where a fault is planted (the test data itself is clean)."""
from pyspark.sql import functions as F

from lapforge.operators.quality import (ColumnSpec, foreign_key, greater_than, in_range,
                                        matches_map, not_null, run_checks, schema_check,
                                        unique_key)


def _facts(spark):
    rows = [
        (1, 10, 1, 25, 2000, 1),
        (1, 11, 2, 18, 2000, 1),
        (2, None, 3, 15, 2000, 2),     # NULL driver
        (2, 12, 25, 0, 1949, 2),       # position out of range, season out of range
        (3, 13, 4, 99, 2001, 77),      # points do not match, unknown constructor
        (3, 13, 4, 12, 2001, 1),       # duplicate (race, driver)
        (4, 14, None, 0, None, 2),     # NULL position, NULL season
    ]
    return spark.createDataFrame(rows, "race_id int, driver_id int, finish_position int, "
                                       "points int, season int, constructor_id int")


def test_row_checks_in_one_pass(spark):
    r = {row.check: row for row in run_checks(_facts(spark), [
        not_null("driver_id"), in_range("finish_position", 1, 20),
        matches_map("points", "finish_position"), in_range("season", 1950, 2024)],
        "facts").collect()}
    assert r["not_null:driver_id"].violations == 1
    assert r["in_range:finish_position[1,20]"].violations == 2
    assert r["matches_map:points~finish_position"].violations == 1
    assert r["in_range:season[1950,2024]"].violations == 2
    assert all(row.total == 7 for row in r.values())
    assert r["not_null:driver_id"].status == "fail"


def test_status_thresholds(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("t"))
    ok = run_checks(df, [greater_than("t", -1)], "x").first()
    warn = run_checks(df, [greater_than("t", 4)], "x").first()  # 5 of 1000 fail -> 99.5 %
    fail = run_checks(df, [greater_than("t", 60)], "x").first()
    assert (ok.status, warn.status, fail.status) == ("pass", "warn", "fail")
    assert warn.pass_pct == 99.5


def test_duplicate_keys(spark):
    r = unique_key(_facts(spark), ["race_id", "driver_id"]).first()
    assert (r.key_groups, r.dup_groups, r.dup_rows, r.status) == (6, 1, 2, "fail")


def test_foreign_key(spark):
    dim = spark.createDataFrame([(1,), (2,)], "constructor_id int")
    r = foreign_key(_facts(spark), "constructor_id", dim, "constructor_id", "fk").first()
    assert (r.violations, r.total) == (1, 7)


def test_schema_check(spark):
    df = spark.createDataFrame([("12", "a" * 40), ("x", "ok")], "season string, status string")
    rows = {r.column: r for r in schema_check(df, [ColumnSpec("season", "smallint"),
                                                   ColumnSpec("status", "string", 32),
                                                   ColumnSpec("missing", "int")]).collect()}
    assert rows["season"].bad_values == 1 and rows["season"].type_ok is False
    assert rows["status"].too_long == 1 and rows["status"].type_ok is True
    assert rows["missing"].present is False


def test_foreign_keys_in_one_scan(spark):
    from lapforge.operators.quality import foreign_keys
    teams = spark.createDataFrame([(1,), (2,), (2,)], "constructor_id int")
    drivers = spark.createDataFrame([(10,), (12,), (None,)], "driver_id int")
    checks = [("constructor_id", teams, "constructor_id", "team"), ("driver_id", drivers, "driver_id", "driver")]
    r = {row.check: (row.violations, row.total) for row in foreign_keys(_facts(spark), checks).collect()}
    assert r == {"team": (1, 7), "driver": (5, 7)}  # 11, NULL, 13 twice, 14
    none = {row.check: (row.violations, row.total) for row in foreign_keys(_facts(spark).limit(0), checks).collect()}
    assert none == {"team": (0, 0), "driver": (0, 0)}
