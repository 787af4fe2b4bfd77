"""Join building blocks.

Broadcasts are explicit only for frames whose size is bounded by construction
(top-n key lists, the per-partition offset table, the calendar-year season
dimension); one-row aggregates are scalar subqueries.  Every other dimension join is left to the
planner, whose broadcast decision is a size check (file statistics, then the
measured shuffle size under AQE against ``spark.sql.autoBroadcastJoinThreshold``);
above it the join stays sort-merge and AQE splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Equi-join on one key; the result keeps one key column."""
    return df.join(dim, key, how)


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str]], how: str = "inner") -> DataFrame:
    """Fact joined to each (dim, key) in turn."""
    out = fact
    for dim, key in dims:
        out = out.join(dim, key, how)
    return out


def semi_topn(df: DataFrame, key: str, top_keys: DataFrame) -> DataFrame:
    """Rows whose key is in ``top_keys`` (a top-n list: n rows, broadcast)."""
    return df.join(F.broadcast(top_keys.select(key)), key, "left_semi")


def orphans(fact: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key has no match in the dimension (NULL keys are orphans too)."""
    dk = dim_key or key
    keys = dim.select(F.col(dk).alias("_lf_k")).distinct()
    return fact.join(keys, fact[key] == keys["_lf_k"], "left_anti")


def scalar_row(one_row: DataFrame):
    """A one-row, one-struct-column frame as a scalar subquery Column (its
    fields are read with ``["name"]``); Spark runs it once and inlines the value."""
    return one_row.select(F.struct(*one_row.columns).alias("_lf_s")).scalar()


def with_max(df: DataFrame, cols: Sequence[str], prefix: str = "max_") -> DataFrame:
    """Every row next to the global maxima of ``cols`` (a scalar subquery over
    one aggregate; no join, no unpartitioned window)."""
    mx = scalar_row(df.agg(*[F.max(c).alias(c) for c in cols]))
    return df.select("*", *[mx[c].alias(prefix + c) for c in cols])
