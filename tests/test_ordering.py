"""The distributed row number / rank against Spark's window functions."""
import contextlib
import io
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lapforge.operators.ordering import (argmax_row, first_keys, rank_min, sequence_number,
                                         top_n_per_group)


def _data(spark, n=5000, hot=True):
    rnd = random.Random(7)
    rows = []
    for i in range(n):
        g = 0 if (hot and rnd.random() < 0.4) else rnd.randint(1, 30)  # one hot group
        rows.append((g, rnd.randint(0, 40), i))
    return spark.createDataFrame(rows, "g int, pts int, id int").repartition(6)


def test_sequence_number_equals_row_number(spark):
    df = _data(spark)
    got = sequence_number(df, ["g"], [F.col("pts").desc(), F.col("id")], name="rn")
    w = Window.partitionBy("g").orderBy(F.col("pts").desc(), F.col("id"))
    want = df.withColumn("rn", F.row_number().over(w))
    assert sorted(got.select("g", "id", "rn").collect()) == \
        sorted(want.select("g", "id", "rn").collect())


def test_rank_min_equals_rank(spark):
    df = _data(spark)
    got = rank_min(df, ["g"], [F.col("pts").desc(), F.col("id")], ["pts"], name="rk")
    w = Window.partitionBy("g").orderBy(F.col("pts").desc())
    want = df.withColumn("rk", F.rank().over(w))
    assert sorted(got.select("g", "id", "rk").collect()) == \
        sorted(want.select("g", "id", "rk").collect())


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_sequence_number_has_no_group_window(spark):
    """No window exchange on the group key: a hot group is never one task."""
    df = _data(spark, 20000)
    got = sequence_number(df, ["g"], [F.col("pts"), F.col("id")], name="rn")
    windows = [ln for ln in _plan(got).splitlines() if "Window [" in ln]
    # the only windows run over the per-partition table (ordered by partition)
    assert windows and all("_lf_part" in ln and "windowspecdefinition(g" not in ln
                           for ln in windows)


def test_range_sort_splits_hot_group(spark):
    """The global sort spreads one hot group over several range partitions."""
    df = _data(spark, 20000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tagged = df.orderBy("g", "pts", "id").withColumn("p", F.spark_partition_id())
        parts = tagged.filter("g = 0").select("p").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "g int, v int")
    got = sequence_number(df, ["g"], [F.col("v")], name="rn")
    assert {(r.g, r.v, r.rn) for r in got.collect()} == {(None, 1, 1), (None, 2, 2), (1, 3, 1)}


def test_top_n_per_group_and_argmax(spark):
    df = _data(spark)
    top = top_n_per_group(df, ["g"], [F.col("pts").desc(), F.col("id")], 2)
    assert top.groupBy("g").count().agg(F.max("count")).first()[0] == 2
    best = argmax_row(df, ["g"], [-F.col("pts"), F.col("id")], ["id", "pts"])
    firsts = top.filter("pos = 1").select("g", "id", "pts")
    assert sorted(best.collect()) == sorted(firsts.collect())


def test_first_keys_is_key_order(spark):
    df = spark.createDataFrame([(5,), (3,), (9,), (3,), (1,), (7,), (2,)], "k int")
    assert [r.k for r in first_keys(df, "k", 3).collect()] == [1, 2, 3]


def test_row_number_across_many_small_batches(spark):
    """Runs spanning Arrow batches and partitions keep counting."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = _data(spark, 3000)
        got = sequence_number(df, ["g"], [F.col("id")], name="rn")
        w = Window.partitionBy("g").orderBy("id")
        want = df.withColumn("rn", F.row_number().over(w))
        assert sorted(got.select("g", "id", "rn").collect()) == \
            sorted(want.select("g", "id", "rn").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_row_number_two_keys_with_nulls(spark):
    rows = [(None if i % 5 == 0 else i % 3, None if i % 7 == 0 else i % 2, i) for i in range(400)]
    df = spark.createDataFrame(rows, "a int, b int, id int").repartition(5)
    got = sequence_number(df, ["a", "b"], [F.col("id").desc()], name="rn")
    w = Window.partitionBy("a", "b").orderBy(F.col("id").desc())
    want = df.withColumn("rn", F.row_number().over(w))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())


def test_rank_when_tie_runs_span_partitions_and_batches(spark):
    rnd = random.Random(3)
    rows = [(0 if rnd.random() < 0.6 else rnd.randint(1, 4), rnd.randint(0, 2), i)
            for i in range(12000)]
    df = spark.createDataFrame(rows, "g int, pts int, id int").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        got = rank_min(df, ["g"], [F.col("pts").desc(), F.col("id")], ["pts"], name="rk")
        seq = sequence_number(df, ["g"], [F.col("pts").desc(), F.col("id")], name="rn",
                              tie_cols=["pts"], rank_name="rk")
        w = Window.partitionBy("g").orderBy(F.col("pts").desc())
        want = df.withColumn("rk", F.rank().over(w)).withColumn(
            "rn", F.row_number().over(Window.partitionBy("g").orderBy(F.col("pts").desc(),
                                                                      F.col("id"))))
        assert sorted(got.select("id", "rk").collect()) == \
            sorted(want.select("id", "rk").collect())
        assert sorted(seq.select("id", "rn", "rk").collect()) == \
            sorted(want.select("id", "rn", "rk").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
