"""Hand-made rows for the traps of the reference (ties, rounding, NULLs, ...)."""
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lapforge import functions as LF
from lapforge.operators.aggregates import count_if, exact_quantiles, pivot_sum
from lapforge.operators.clean import clean_races, dedup_first
from lapforge.operators.joins import orphans, semi_topn, with_max
from lapforge.operators.ordering import rank_first, rank_min


def test_rank_first_vs_rank_min_on_ties(spark):
    df = spark.createDataFrame([(2000, "A", 10), (2000, "B", 10), (2000, "C", 5),
                                (2001, "A", 1)], "season int, code string, points int")
    first = rank_first(df, ["season"], [F.col("points").desc(), F.col("code")])
    mins = rank_min(df, ["season"], [F.col("points").desc(), F.col("code")], ["points"])
    assert {(r.code, r.season, r["rank"]) for r in first.collect()} == \
        {("A", 2000, 1), ("B", 2000, 2), ("C", 2000, 3), ("A", 2001, 1)}
    assert {(r.code, r.season, r["rank"]) for r in mins.collect()} == \
        {("A", 2000, 1), ("B", 2000, 1), ("C", 2000, 3), ("A", 2001, 1)}


def test_round_half_even_like_pandas(spark):
    vals = [0.25, 0.35, 2.5, 3.5, 1.05, 10.45, -2.5, 0.125]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(LF.round_even("v", 1)).collect()]
    want = list(pd.Series(vals).round(1))
    assert got == want


def test_std_of_one_is_null(spark):
    df = spark.createDataFrame([(1, 80.0), (2, 81.0), (2, 83.0)], "d int, t double")
    got = {r.d: r.s for r in df.groupBy("d").agg(F.stddev_samp("t").alias("s")).collect()}
    assert got[1] is None and got[2] == pytest.approx(1.4142135623730951)


def test_count_skips_null_count_star_does_not(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "pos int")
    r = df.agg(F.count("pos").alias("c"), F.count(F.lit(1)).alias("n"),
               count_if(F.col("pos") <= 3).alias("le3")).first()
    assert (r.c, r.n, r.le3) == (2, 3, 2)


def test_clean_points_and_points_map(spark):
    df = spark.createDataFrame([(1, 25), (10, 1), (11, 7), (None, 9), (3, 99)],
                               "pos int, pts int")
    got = [tuple(r) for r in df.select(LF.clean_points("pos", "pts"), LF.points_of("pos"),
                                       LF.points_map_lookup("pos")).collect()]
    assert got == [(25, 25, 25), (1, 1, 1), (0, 0, 0), (0, 0, 0), (99, 15, 15)]


def test_ansi_safe_parsing(spark):
    df = spark.createDataFrame([("12", "2024-02-30", " x "), ("abc", "2024-02-28", None)],
                               "n string, d string, s string")
    got = df.select(LF.to_int("n").alias("n"), LF.parse_date("d").alias("d"),
                    F.trim("s").alias("s")).collect()
    assert got[0].n == 12 and got[0].d is None and got[0].s == "x"
    assert got[1].n is None and str(got[1].d) == "2024-02-28"


def test_clean_races_dedup_trim_range(spark):
    raw = spark.createDataFrame([
        ("1", "2000", "3", "2000-03-12", "  Monaco "),
        ("1", "2000", "3", "2000-03-12", "  Monaco "),
        ("2", "1949", "1", "1949-05-01", "Old"),
        ("3", "bad", "1", "2001-01-01", "NoYear"),
        ("4", "2024", "x", "nope", "Late"),
    ], "raceId string, year string, round string, date string, name string")
    got = {r.race_id: r for r in clean_races(raw).collect()}
    assert set(got) == {1, 4}
    assert got[1].name == "Monaco" and str(got[1].race_date) == "2000-03-12"
    assert got[4]["round"] is None and got[4].race_date is None


def test_dedup_first_is_deterministic(spark):
    df = spark.createDataFrame([(1, 7, "b", 2), (1, 7, "a", 9), (2, 7, "c", 1)],
                               "race int, drv int, s string, v int")
    got = sorted(tuple(r) for r in dedup_first(df, ["race", "drv"]).collect())
    assert got == [(1, 7, "a", 9), (2, 7, "c", 1)]


def test_two_teams_give_two_career_rows(spark):
    from lapforge.plans.career import career_stats
    f = spark.createDataFrame([(1, "A", 1, 25), (1, "B", 2, 18), (1, "B", 1, 25)],
                              "driver_id int, team string, finish_position int, points int")
    rows = career_stats(f, ["driver_id", "team"]).collect()
    assert len(rows) == 2


def test_index_uses_global_max_and_zero_guard(spark):
    df = spark.createDataFrame([("a", 0, 50), ("b", 0, 100), ("c", 0, 10)],
                               "code string, wins int, points int")
    w = with_max(df, ["wins", "points"])
    got = {r.code: (r.wi, r.pi) for r in w.select(
        "code", (LF.safe_ratio("wins", "max_wins") * 100).alias("wi"),
        (LF.safe_ratio("points", "max_points") * 100).alias("pi")).collect()}
    assert got == {"a": (0.0, 50.0), "b": (0.0, 100.0), "c": (0.0, 10.0)}


def test_pivot_fills_absent_with_zero_and_row_sums(spark):
    df = spark.createDataFrame([("x", 2000, 5), ("x", 2001, 7), ("y", 2001, 1)],
                               "team string, season int, points int")
    p = {r.team: r for r in pivot_sum(df, ["team"], "season", "points", [2000, 2001]).collect()}
    assert p["y"]["2000"] == 0 and p["x"]["2000"] + p["x"]["2001"] == 12


def test_semi_and_anti(spark):
    f = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    d = spark.createDataFrame([(1,), (3,)], "k int")
    assert sorted(r.k for r in semi_topn(f, "k", d).collect()) == [1, 3]
    assert sorted((r.k for r in orphans(f, "k", d).collect()), key=str) == [2, None]


def test_exact_quantiles_linear(spark):
    df = spark.createDataFrame([(1, float(v)) for v in [1, 2, 3, 4]] + [(2, 5.0)],
                               "g int, v double")
    got = {r.g: (r.q1, r.med) for r in
           exact_quantiles(df, ["g"], "v", [0.25, 0.5], ["q1", "med"]).collect()}
    assert got == {1: (1.75, 2.5), 2: (5.0, 5.0)}


def test_text_parsers(spark):
    from lapforge.functions.units import count_number, duration_seconds, malformed
    d = {"6m 32s": 392, "0:42": 42, "1:18": 78, "1h 2m 3s": 3723, "1:02:03": 3723, " 10M5s ": 605, "1.5m": 90,
         "—": None, "": None, None: None, "6m 32": "bad", "x6m": "bad", "1:75": "bad", "m": "bad", "6m (est.)": "bad"}
    c = {"5.4M": 5_400_000, "150K": 150_000, "4,280,000": 4_280_000, "12": 12, "1,234.6": 1235, "2 k": 2000,
         "-": None, None: None, "5 4": "bad", "1,23": "bad", "5.4Q": "bad", "9" * 30: "bad", "-5": "bad"}
    for cases, parse in ((d, duration_seconds), (c, count_number)):
        df = spark.createDataFrame([(t,) for t in cases], "t string")
        value = parse("t")
        got = {r.t: "bad" if r.bad else r.v for r in df.select("t", value.alias("v"), malformed("t", value).alias("bad")).collect()}
        assert got == cases


def test_time_and_number_formats(spark):
    import datetime
    df = spark.createDataFrame([(datetime.datetime(2024, 1, 15, 8, 0, 1, 123456), 1234567.891)],
                               "ts timestamp, v double")
    r = df.select(LF.fmt_time("ts").alias("t"), LF.fmt_num("v", 3).alias("n"),
                  LF.fmt_thousands("v").alias("k"), LF.to_ms(F.lit(82.3456)).alias("ms")).first()
    assert (r.t, r.n, r.k, r.ms) == ("08:00:01.123", "1234567.891", "1,234,568", 82346)


def test_empty_season_kpis_one_row(spark):
    from lapforge.plans.model import Model
    from lapforge.plans.standings import season_kpis
    from lapforge.plans.teams import team_kpis
    m = Model(spark, "/root/testdata/sf0.001")
    k = season_kpis(m, 1990).collect()
    assert len(k) == 1 and k[0].champion is None and k[0].drivers == 0
    t = team_kpis(m, 1990).collect()
    assert len(t) == 1 and t[0].champion is None and t[0].teams == 0 and t[0].points_gap is None


def test_one_team_season_has_no_gap(spark):
    from pyspark.sql import functions as F

    from lapforge.operators.ordering import top_n_per_group
    t = spark.createDataFrame([(2000, 1, 30), (2001, 1, 10), (2001, 2, 12)],
                              "season int, constructor_id int, points int")
    top2 = top_n_per_group(t, ["season"], [F.col("points").desc(), F.col("constructor_id")], 2)
    gap = {r.season: r.gap for r in top2.groupBy("season").agg(
        (F.max(F.when(F.col("pos") == 1, F.col("points")))
         - F.max(F.when(F.col("pos") == 2, F.col("points")))).alias("gap")).collect()}
    assert gap == {2000: None, 2001: 2}


def test_rename_helpers_named_agg_and_tail(spark):
    from lapforge.operators.aggregates import named_agg
    from lapforge.operators.clean import rename, rename_all
    from lapforge.operators.ordering import tail
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", None)], "k string, v int")
    assert rename(df, {"v": "value", "zz": "ignored"}).columns == ["k", "value"]
    assert rename_all(df, ["Code", "Wins"]).columns == ["Code", "Wins"]
    got = {r.k: (r.s, r.c, r.n) for r in named_agg(
        df, ["k"], {"s": ("v", "sum"), "c": ("v", "count"), "n": ("v", "count_star")}).collect()}
    assert got == {"a": (4, 2, 2), "b": (None, 0, 1)}
    last = [r.v for r in tail(df.filter("v is not null"), ["v"], 1).collect()]
    assert last == [3]


def test_dedup_any_keeps_one_row_per_key(spark):
    from lapforge.operators.clean import dedup_any
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    rows = dedup_any(df, ["k"]).collect()
    assert sorted(r.k for r in rows) == [1, 2]


def test_approximate_options_close_to_exact(spark):
    import random

    from lapforge.operators.aggregates import distinct_count, distribution
    rnd = random.Random(5)
    df = spark.createDataFrame([(i % 3, rnd.random() * 100) for i in range(3000)],
                               "g int, v double")
    exact = {r.g: r for r in distribution(df, ["g"], "v").collect()}
    approx = {r.g: r for r in distribution(df, ["g"], "v", approx_accuracy=10000).collect()}
    for g in exact:
        assert abs(exact[g].median - approx[g].median) < 1.0
        assert exact[g].n == approx[g].n
    n = df.agg(distinct_count("v").alias("e"), distinct_count("v", 0.01).alias("a")).first()
    assert abs(n.a - n.e) / n.e < 0.05
