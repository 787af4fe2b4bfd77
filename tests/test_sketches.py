"""Merged sketches against the exact figures; NULLs, a hot key, groups without values."""
from pyspark.sql import functions as F

from lapforge.operators.sketches import rank_errors, read_sketches, roll_up, sketch

PROBS, NAMES = [0.1, 0.5, 0.9], ["p10", "p50", "p90"]


def test_merged_sketches_keep_their_bounds(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 4))
    df = spark.range(60_000).select(
        hot.alias("k"), (F.col("id") % 24).alias("part"), (F.xxhash64("id") % 5000).alias("user"),
        F.when(F.col("id") % 10 != 0, F.abs(F.xxhash64("id", F.lit(1))) % 100_000 / 7.0).alias("v"))
    read = read_sketches(roll_up(sketch(df, ["k", "part"], "v", "user"), ["k"]), ["k"], PROBS, NAMES).checkpoint()
    exact = {r.k: r for r in df.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("n"),
                                                 F.countDistinct("user").alias("users")).collect()}
    for r in read.collect():
        assert (r.rows, r["values"]) == (exact[r.k].rows, exact[r.k].n)
        assert abs(r.distinct - exact[r.k].users) <= 0.08 * exact[r.k].users
    errors = rank_errors(df, ["k"], "v", read, PROBS, NAMES).collect()
    assert len(errors) == 5 and all(r[c] <= 0.03 for r in errors for c in NAMES)


def test_small_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 7), ("a", 2, 2.0, 7), ("a", 2, 3.0, 8), ("b", 1, None, None), (None, 1, 5.0, 1)],
                               "k string, part int, v double, user int")
    got = {r.k: r for r in read_sketches(roll_up(sketch(df, ["k", "part"], "v", "user"), ["k"]), ["k"], PROBS, NAMES).collect()}
    assert (got["a"].rows, got["a"]["values"], got["a"].p50, got["a"].distinct) == (3, 3, 2.0, 2)
    assert (got["b"].rows, got["b"]["values"], got["b"].p50, got["b"].distinct) == (1, 0, None, 0)
    assert got[None].p90 == 5.0
    empty = read_sketches(roll_up(sketch(df.limit(0), ["k", "part"], "v", "user"), ["k"]), ["k"], PROBS, NAMES)
    assert empty.count() == 0
    assert rank_errors(df, ["k"], "v", read_sketches(sketch(df, ["k"], "v", "user"), ["k"], PROBS, NAMES), PROBS, NAMES).count() == 2
