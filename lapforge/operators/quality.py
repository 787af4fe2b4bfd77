"""Data-quality checks.

Row-level checks of one table are evaluated together in a single aggregate
pass and unpivoted into one row per check:
(check, violations, total, pass_pct, status).  Thresholds are ours (the
reference shows only literal cells): pass when nothing is violated, warn at or
above ``WARN_PCT`` percent passing, fail below.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapforge.functions import points_of

WARN_PCT = 99.0


@dataclass(frozen=True)
class Check:
    name: str
    violation: Column  # true where the row breaks the rule


def not_null(col: str) -> Check:
    """D1."""
    return Check(f"not_null:{col}", F.col(col).isNull())


def in_range(col: str, lo, hi) -> Check:
    """Inclusive range; NULL is a violation."""
    return Check(f"in_range:{col}[{lo},{hi}]",
                 ~F.coalesce(F.col(col).between(lo, hi), F.lit(False)))


def matches_map(points: str, position: str) -> Check:
    """D3: points equal the points of the position (NULL-safe)."""
    return Check(f"matches_map:{points}~{position}",
                 ~F.col(points).eqNullSafe(points_of(F.col(position))))


def greater_than(col: str, bound) -> Check:
    """Strictly above ``bound``; NULL is a violation."""
    return Check(f"greater_than:{col}>{bound}",
                 ~F.coalesce(F.col(col) > F.lit(bound), F.lit(False)))


def status_of(violations: Column, pass_pct: Column) -> Column:
    return (F.when(violations == 0, F.lit("pass"))
            .when(pass_pct >= F.lit(WARN_PCT), F.lit("warn"))
            .otherwise(F.lit("fail")))


def _finish(df: DataFrame) -> DataFrame:
    pass_pct = F.try_divide((F.col("total") - F.col("violations")) * F.lit(100.0), F.col("total"))
    return df.withColumn("pass_pct", pass_pct) \
        .withColumn("status", status_of(F.col("violations"), F.col("pass_pct")))


def run_checks(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """All ``checks`` over ``df`` in one aggregate pass, one output row per check."""
    aggs = [F.count(F.lit(1)).alias("total")]
    aggs += [F.count_if(c.violation).alias(f"_lf_c{i}") for i, c in enumerate(checks)]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(c.name).alias("check"), F.col(f"_lf_c{i}").alias("violations"))
        for i, c in enumerate(checks)]))
    long = wide.select(F.lit(table).alias("table"), "total", rows.alias("_lf_r"))
    return _finish(long.select("table", "_lf_r.check", "_lf_r.violations", "total"))


def unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups, groups with more than one row and the rows in them."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_lf_n"))
    return g.agg(
        F.count(F.lit(1)).alias("key_groups"),
        F.count_if(F.col("_lf_n") > 1).alias("dup_groups"),
        F.coalesce(F.sum(F.when(F.col("_lf_n") > 1, F.col("_lf_n"))), F.lit(0))
        .cast("bigint").alias("dup_rows"),
    ).withColumn("status", F.when(F.col("dup_groups") == 0, "pass").otherwise("fail"))


def foreign_keys(df: DataFrame, keys: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Per (column, dimension, its key, name) the fact rows whose key is missing from the
    dimension (NULL keys included), one row per name.

    One scan of the fact answers all of them: its keys meet the distinct keys of each
    dimension, which the planner broadcasts when their measured size is under the threshold
    (else sort-merge, where AQE splits a hot key), and one aggregate counts the misses."""
    hits = df.select(*dict.fromkeys(c for c, *_ in keys))
    for i, (col, dim, key, _) in enumerate(keys):
        known = dim.select(F.col(key).alias(f"_lf_k{i}")).distinct().withColumn(f"_lf_h{i}", F.lit(True))
        hits = hits.join(known, F.col(col) == F.col(f"_lf_k{i}"), "left").drop(f"_lf_k{i}")
    wide = hits.agg(F.count(F.lit(1)).alias("total"),
                    *(F.count_if(F.col(f"_lf_h{i}").isNull()).alias(f"_lf_v{i}") for i in range(len(keys))))
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"_lf_v{i}").alias("violations"))
                               for i, (*_, name) in enumerate(keys)]))
    return _finish(wide.select("total", rows.alias("_lf_r")).select("_lf_r.check", "_lf_r.violations", "total"))


def foreign_key(df: DataFrame, col: str, dim: DataFrame, key: str, name: str) -> DataFrame:
    """D7 for one key."""
    return foreign_keys(df, [(col, dim, key, name)])


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str  # Spark SQL type name, e.g. "int", "smallint", "float", "string"
    max_len: int | None = None


def schema_check(df: DataFrame, spec: Sequence[ColumnSpec]) -> DataFrame:
    """Declared vs actual type per column, plus values that do not fit the
    declared type (``try_cast`` NULL where the source is not NULL) and strings
    over the declared length; all value checks in one aggregate pass."""
    spark = df.sparkSession
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = []
    for i, c in enumerate(spec):
        if c.name not in actual:
            continue
        src = F.col(c.name)
        bad = src.isNotNull() & src.try_cast(c.type).isNull()
        aggs.append(F.count_if(bad).alias(f"_lf_b{i}"))
        too_long = (F.length(src.cast("string")) > c.max_len) if c.max_len else F.lit(False)
        aggs.append(F.count_if(too_long).alias(f"_lf_l{i}"))
    wide = df.agg(*aggs) if aggs else spark.range(1).select()
    rows = []
    for i, c in enumerate(spec):
        present = c.name in actual
        rows.append(F.struct(
            F.lit(c.name).alias("column"), F.lit(c.type).alias("declared"),
            F.lit(actual.get(c.name)).cast("string").alias("actual"),
            F.lit(present).alias("present"),
            F.lit(present and actual.get(c.name) == c.type).alias("type_ok"),
            (F.col(f"_lf_b{i}") if present else F.lit(None).cast("bigint")).alias("bad_values"),
            (F.col(f"_lf_l{i}") if present else F.lit(None).cast("bigint")).alias("too_long")))
    return wide.select(F.explode(F.array(*rows)).alias("_lf_r")).select("_lf_r.*")
