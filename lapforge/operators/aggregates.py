"""Aggregation building blocks.

Every aggregate here is a Spark ``groupBy().agg`` (partial aggregation on the
map side, so a hot key costs one row per map task in the shuffle).  The exact
quantiles are computed from exact positions inside each group
(``sequence_number``) instead of the ``percentile`` aggregate, whose buffer
holds every distinct value of a group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.operators.joins import scalar_row
from lapforge.operators.ordering import join_null_safe, sequence_number


def count_if(pred) -> "F.Column":
    """A3: rows where ``pred`` is true (NULL counts as false)."""
    return F.count_if(F.coalesce(pred, F.lit(False)))


def named_agg(df: DataFrame, keys: Sequence[str], spec: dict[str, tuple[str, str]]) -> DataFrame:
    """A4: ``{"out": (column, fn)}`` with fn in sum/count/avg/min/max/count_star."""
    fns = {"sum": F.sum, "count": F.count, "avg": F.avg, "mean": F.avg, "min": F.min,
           "max": F.max, "nunique": F.countDistinct, "std": F.stddev_samp}
    aggs = []
    for out, (col, fn) in spec.items():
        if fn == "count_star":
            aggs.append(F.count(F.lit(1)).alias(out))
        else:
            aggs.append(fns[fn](F.col(col)).alias(out))
    return df.groupBy(*keys).agg(*aggs)


def distinct_count(col: str, approx_rsd: float | None = None) -> "F.Column":
    """A10: distinct non-NULL values; ``approx_rsd`` switches to HyperLogLog++
    (fixed-size sketch, relative standard deviation ``approx_rsd``)."""
    return F.approx_count_distinct(col, approx_rsd) if approx_rsd else F.countDistinct(col)


def mean_of(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Mean of several columns per key (NULLs skipped)."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in cols])


def pivot_sum(df: DataFrame, index: Sequence[str], column: str, value: str,
              values: Sequence) -> DataFrame:
    """``index`` x ``column`` sums with the column values given up front
    (one aggregate, no distinct-discovery job); absent cells are 0."""
    names = [str(v) for v in values]
    p = df.groupBy(*index).pivot(column, list(values)).agg(F.sum(value))
    p = p.na.fill(0, names)
    return p.select(*index, *[F.col(f"`{n}`").cast("bigint").alias(n) for n in names])


def share(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Value / total over the frame; the total is a scalar subquery."""
    total = scalar_row(df.agg(F.sum(value).alias("total")))["total"]
    return df.withColumn(name, F.try_divide(F.col(value), total))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Exact quantiles with linear interpolation (``quantile_cont``) per group.

    Positions come from a distributed row number; for each probability the two
    neighbouring order statistics are picked with a conditional aggregate.
    NULL values are ignored.
    """
    keys = list(keys)
    v = df.filter(F.col(value).isNotNull()).select(*keys, value)
    seq = sequence_number(v, keys, [F.col(value)], name="_lf_i")  # 1-based
    counts = seq.groupBy(*keys).agg(F.count(F.lit(1)).alias("_lf_n"))
    s = join_null_safe(seq, counts, keys)
    aggs = []
    for p, nm in zip(probs, names):
        h = (F.col("_lf_n") - 1) * F.lit(float(p))  # 0-based fractional position
        lo = F.floor(h) + 1
        hi = F.ceil(h) + 1
        frac = h - F.floor(h)
        lo_v = F.max(F.when(F.col("_lf_i") == lo, F.col(value)))
        hi_v = F.max(F.when(F.col("_lf_i") == hi, F.col(value)))
        fr = F.max(frac)
        aggs.append((lo_v + (hi_v - lo_v) * fr).alias(nm))
    return s.groupBy(*keys).agg(*aggs)


def distribution(df: DataFrame, keys: Sequence[str], value: str,
                 approx_accuracy: int | None = None) -> DataFrame:
    """Per group count, min, quartiles, max and mean (the box/violin data).

    Exact by default.  With ``approx_accuracy`` the quartiles come from
    ``percentile_approx`` in the same aggregate (bounded sketch per group,
    relative rank error 1 / accuracy) - a single pass for very large tables."""
    keys = list(keys)
    base = [F.count(value).alias("n"), F.min(value).alias("min"), F.avg(value).alias("mean"),
            F.max(value).alias("max")]
    if approx_accuracy:
        q = F.percentile_approx(value, [0.25, 0.5, 0.75], approx_accuracy)
        return df.groupBy(*keys).agg(*base, q.alias("_lf_q")).select(
            *keys, "n", "min", "mean", "max", F.col("_lf_q")[0].alias("q1"),
            F.col("_lf_q")[1].alias("median"), F.col("_lf_q")[2].alias("q3"))
    stats = df.groupBy(*keys).agg(*base)
    q = exact_quantiles(df, keys, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    return join_null_safe(stats, q, keys, "left")


def histogram(df: DataFrame, keys: Sequence[str], value: str, bins: int) -> DataFrame:
    """Equal-width histogram per group between the global min and max.

    The bounds are one scalar subquery (J6); the bucket is
    ``least(bins, floor((v - lo) / (hi - lo) * bins) + 1)`` (top edge in the
    last bucket)."""
    b = df.filter(F.col(value).isNotNull())
    bounds = scalar_row(b.agg(F.min(value).alias("lo"), F.max(value).alias("hi")))
    lo, hi = bounds["lo"], bounds["hi"]
    bucket = F.least(F.lit(bins),
                     F.floor(F.coalesce(F.try_divide(F.col(value) - lo, hi - lo),
                                        F.lit(0.0)) * F.lit(float(bins))) + 1).cast("int")
    return b.groupBy(*keys, bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("laps"))
