"""Mergeable sketches of a fact (SURVEY's scale option for A10 and A15).

Per key of a mart a quantile sketch (KLL) and a distinct sketch (HyperLogLog) of fixed size are
stored as binary columns.  A reader merges those of the keys it wants, so quartiles and distinct
counts of any roll-up come from the mart and the fact is not read or sorted again.  Both are
partial aggregates, so a hot key costs one sketch per map task.  The exact operators of
``aggregates`` stay the default; this is for tables whose sort is too dear.

Bounds (from the sketches' own theory; ``rank_errors`` measures the first): with ``KLL_K`` 200
the rank of a quantile is off by 1.65 % at most, 99 times of 100; with ``HLL_LG`` 12 a distinct
count has a standard error of 1.6 %.  Small groups (under ``KLL_K`` values, a few hundred
distinct ones) are exact or nearly so.  NULL values are left out of both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.operators.ordering import join_null_safe

KLL_K, HLL_LG = 200, 12


def sketch(df: DataFrame, keys: Sequence[str], value: str, distinct: str) -> DataFrame:
    """Per ``keys`` the sketches ``quantiles`` of ``value`` and ``distincts`` of ``distinct``, and the ``rows``."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("quantiles"),
        F.hll_sketch_agg(distinct, F.lit(HLL_LG)).alias("distincts"))


def roll_up(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of a coarser key, merged from those of a finer one."""
    return sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.kll_merge_agg_double("quantiles", F.lit(KLL_K)).alias("quantiles"),
        F.hll_union_agg("distincts").alias("distincts"))


def read_sketches(sketches: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """``keys``, ``rows``, ``values`` (not NULL), the quantiles by ``names`` (NULL without
    values; a value of the data, not interpolated) and the estimated ``distinct`` count."""
    n = F.kll_sketch_get_n_double("quantiles")
    return sketches.select(
        *keys, "rows", n.alias("values"),
        *(F.when(n > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p)))).alias(c) for p, c in zip(probs, names)),
        F.hll_sketch_estimate("distincts").alias("distinct"))


def rank_errors(df: DataFrame, keys: Sequence[str], value: str, estimates: DataFrame,
                probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Per key how far each estimate's rank in the data is from its probability (0 where the
    probability lies among the ranks of values equal to it): one pass over the fact, no sort."""
    keys = list(keys)
    both = join_null_safe(df.select(*keys, F.col(value).alias("_lf_v")).filter(F.col("_lf_v").isNotNull()),
                          estimates.select(*keys, *names), keys)
    n = F.count(F.lit(1))
    errors = []
    for p, c in zip(probs, names):
        below, upto = F.count_if(F.col("_lf_v") < F.col(c)) / n, F.count_if(F.col("_lf_v") <= F.col(c)) / n
        errors.append(F.greatest(F.lit(0.0), below - F.lit(float(p)), F.lit(float(p)) - upto).alias(c))
    return both.groupBy(*keys).agg(*errors)
