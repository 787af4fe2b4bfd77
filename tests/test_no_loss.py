"""Rows and values that must survive: large ids, NULL keys, late rows, NaN, far dates."""
import datetime
import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from lapforge.functions import fmt_num
from lapforge.operators.clean import clean_races
from lapforge.operators.ordering import sequence_number, tail
from lapforge.plans.storage import early
from lapforge.sinks import merge_mart, read_evolved
from lapforge.sources.files import log_tail
from lapforge.streaming import RAW_RESULT_SCHEMA, land_stream


def rows(df):
    return sorted(map(str, df.collect()))


def test_large_and_unparsable_race_ids_stay(spark):
    raw = spark.createDataFrame(
        [(str(3_000_000_000 + i), "2000", "1", "2000-01-01", "x") for i in range(4)]
        + [("a1", "2000", "1", "2000-01-01", "y"), ("b2", "2000", "1", "2000-01-01", "z"), (" a1 ", "2000", "1", "2000-01-01", "y")],
        "raceId string, year string, round string, date string, name string")
    out = clean_races(raw).collect()
    assert sorted(r.race_id for r in out if r.race_id) == [3_000_000_000 + i for i in range(4)]
    assert sorted(r.name for r in out if r.race_id is None) == ["y", "z"]


def test_late_files_land(spark, tmp_dir):
    for i, season in enumerate((2001, 1999, 1998, 1997)):
        spark.createDataFrame([(i, season, 1, 1, 1, 1, 25, None, datetime.datetime(season, 1, 1))],
                              RAW_RESULT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    for ck in ("a", "b"):  # the second run replays everything
        land_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/raw", f"{tmp_dir}/{ck}", files_per_trigger=1)
        assert spark.read.parquet(f"{tmp_dir}/raw").count() == 4


def test_merge_keeps_null_partition_and_null_keys(spark, tmp_dir):
    schema, path, keys = "season int, driver_id int, points bigint, wins bigint", f"{tmp_dir}/m", ["season", "driver_id"]
    merge_mart(spark, path, spark.createDataFrame([(None, 1, 5, 1), (2000, None, 6, 1), (2001, 3, 9, 0)], schema), keys)
    new = spark.createDataFrame([(None, 2, 7, 0), (2000, None, 8, 2)], schema)
    merge_mart(spark, path, new, keys)
    first = rows(read_evolved(spark, path).select("season", "driver_id", "points"))
    merge_mart(spark, path, new, keys)
    assert rows(read_evolved(spark, path).select("season", "driver_id", "points")) == first
    assert len(first) == 4
    merge_mart(spark, path, new.drop("wins"), keys, sync_columns=True)
    assert set(read_evolved(spark, path).columns) == {"season", "driver_id", "points"}
    assert rows(read_evolved(spark, path).select("season", "driver_id", "points")) == first


def test_numbers_equal_window_and_rows_pass_unchanged(spark):
    big = 2 ** 53
    data = [(big + k if k else None, float("nan") if k == 1 else (None if k == 2 else 1.0), big + k,
             datetime.datetime(9999, 12, 31) if k % 2 else None) for k in (0, 1, 2, 3, 1, 3) for _ in range(30)]
    df = spark.createDataFrame(data, "k bigint, v double, p bigint, t timestamp").repartition(5) \
        .withColumn("u", F.monotonically_increasing_id()).cache()
    for key, tie in (("k", "v"), ("v", "t"), ("t", "k")):
        got = sequence_number(df, [key], [tie, "u"], name="n", tie_cols=[tie], rank_name="r")
        w = Window.partitionBy(key)
        want = df.withColumn("n", F.row_number().over(w.orderBy(tie, "u")).cast("bigint")) \
            .withColumn("r", F.rank().over(w.orderBy(tie)).cast("bigint"))
        assert rows(got.select(want.columns)) == rows(want)


def test_null_number_text_and_null_season(spark):
    df = spark.createDataFrame([(None, None), (1.5, 1990), (2.0, 2005)], "x double, season int")
    assert {r[0] for r in df.select(fmt_num("x", 1)).collect()} == {None, "1.5", "2.0"}
    assert df.filter(early()).count() + df.filter(~early()).count() == 3


def test_tail_and_rotated_log(spark, tmp_dir):
    assert [r.id for r in tail(spark.range(10), [F.col("id")], 3).collect()] == [7, 8, 9]
    assert [r.id for r in tail(spark.range(10), ["id"], 3).collect()] == [7, 8, 9]
    for name, text, age in (("app.log.1", "old", 1000), ("app.log", "new", 10)):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(f"{text} 1\n{text} 2\n")
        stamp = datetime.datetime.now().timestamp() - age
        os.utime(f"{tmp_dir}/{name}", (stamp, stamp))
    assert [r.text for r in log_tail(spark, f"{tmp_dir}/app.log*", 2).collect()] == ["new 1", "new 2"]


def test_two_teams_are_two_rows(spark):
    from lapforge.plans.model import Model

    facts = spark.createDataFrame(
        [(2000, 7, 1, 1, 25), (2000, 7, 2, 2, 18), (2000, 7, 2, None, 0), (2000, 8, 1, 3, 15)],
        "season int, driver_id bigint, constructor_id int, finish_position int, points int")
    got = {(r.driver_id, r.constructor_id): (r.points, r.races, r.position_count, r.wins, r.podiums)
           for r in Model.stats_of(facts).collect()}
    assert got == {(7, 1): (25, 1, 1, 1, 1), (7, 2): (18, 2, 1, 0, 1), (8, 1): (15, 1, 1, 0, 1)}
