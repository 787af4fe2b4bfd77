"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.llm.common import Write, written


def components(edges: DataFrame, write: Write = written) -> DataFrame:
    """node, label (smallest node of its component) of every node that has an edge.

    ``edges`` holds long columns ``a`` and ``b``.  Every round is two aggregations
    (with map-side minima, so a hub is no hot group) and two joins; rounds stop when
    the edge set no longer changes, after about log n of them.  Each round is two
    tables that ``write`` makes.
    """
    now = write(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = write(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .distinct(), "large-stars")  # read three times below
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a")
        now = write(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .unionByName(root.select("a", F.col("m").alias("b"))).distinct(), "edges")
