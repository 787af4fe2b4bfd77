"""Values carried along an order, against windows of DuckDB and plain loops."""
import random

from pyspark.sql import functions as F

from lapforge.operators.carry import carry
from lapforge.plans import ops
from lapforge.sources.files import read_lines


def test_carry_equals_loops(spark):
    rng = random.Random(5)
    for hot, parts in ((0.4, 7), (0.95, 5), (0.0, 8)):
        rows = [(rng.choice([None, "hot"]) if rng.random() < hot else rng.choice([None, "a", "b", "c"]), i,
                 rng.choice([None, i]), rng.random() < 0.1) for i in range(600)]
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.createDataFrame(rng.sample(rows, len(rows)), "k string, o int, v int, m boolean").repartition(parts)
        lag = {r.o: (r.pv, r.po) for r in carry(df, ["k"], ["o"], {"pv": "v", "po": "o"}).collect()}
        fill = {r.o: (r.head, r.seen) for r in carry(df, ["k"], ["o"], {"head": "o", "seen": "v"}, F.col("m"), own=True).collect()}
        whole = {r.o: r.po for r in carry(df, [], ["o"], {"po": "o"}).collect()}
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        before, marked = {}, {}
        for k, o, v, m in rows:
            assert lag[o] == before.get(k, (None, None))
            if m:
                marked[k] = (o, v)
            assert fill[o] == marked.get(k, (None, None))
            before[k] = (v, o)
            assert whole[o] == (o - 1 if o else None)
        assert len(lag) == len(fill) == len(rows)
    assert carry(df.limit(0), ["k"], ["o"], {"pv": "v"}).count() == 0


def test_one_log_file_over_many_splits(spark, tmp_dir):
    lines = []
    for i in range(2000):
        lines.append(f"2024-01-15 08:00:01,123 | {'ERROR' if i % 3 == 0 else 'INFO'} | record {i}")
        lines += [f"  frame {i} {j}" for j in range(i % 7 if i % 3 == 0 else 0)]
    with open(f"{tmp_dir}/one.log", "w") as fh:
        fh.write("lost line\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert spark.read.text(f"{tmp_dir}/one.log").rdd.getNumPartitions() > 4
        got = sorted(read_lines(spark, f"{tmp_dir}/one.log").select("line", "text").collect())
        assert [(r.line, r.text) for r in got] == list(enumerate(["lost line", *lines], 1))
        records = ops.app_log(spark, f"{tmp_dir}/one.log").orderBy("line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(records) == 2000
    for i, r in enumerate(records):
        assert r.message == f"record {i}"
        assert r.detail.split("\n") == ([f"  frame {i} {j}" for j in range(i % 7)] if i % 3 == 0 and i % 7 else [""])
