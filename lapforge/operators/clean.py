"""Projection, cleaning and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapforge.functions import parse_date, to_int


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map (unknown names ignored)."""
    return df.withColumnsRenamed(dict(mapping))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position."""
    return df.toDF(*names)


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P13 as in the reference: one row per key, which one is unspecified."""
    return df.dropDuplicates(list(keys))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """P13 / Q27, deterministic: per key the first row under ``order`` (default:
    all other columns ascending).

    ``min(struct(order..., rest...))`` is a partial aggregate, so one row per key leaves
    each map task, whatever the key's size.  A struct with texts in it is no hash buffer:
    each map task sorts its own rows by key first (a sort aggregate, which spills).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order else rest
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_lf_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in tail])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_lf_row"))
    picked = {**{c: F.col(f"_lf_row._lf_o{i}") for i, c in enumerate(order)},
              **{c: F.col(f"_lf_row.{c}") for c in tail}}
    return agg.select(*[F.col(c) if c in keys else picked[c].alias(c) for c in df.columns])


def clean_races(raw: DataFrame, lo: int = 1950, hi: int = 2024) -> DataFrame:
    """Q18: typed, trimmed, de-duplicated races inside [lo, hi] seasons.

    Input columns are strings: raceId, year, round, date (yyyy-MM-dd), name.
    Unparsable numbers and dates become NULL (ANSI-safe casts); a NULL season is
    dropped by the inclusive range filter.  Ids are 64-bit; races whose id does not
    parse are told apart by its text.
    """
    text = F.trim(F.col("raceId"))
    number = text.try_cast("bigint")
    typed = raw.select(
        F.coalesce(number.cast("string"), text).alias("_lf_id"),
        number.alias("race_id"),
        to_int("year").alias("season"),
        to_int("round").alias("round"),
        parse_date("date").alias("race_date"),
        F.trim(F.col("name")).alias("name"),
    )
    # The reference keeps an arbitrary row per raceId; we keep the first by the
    # remaining columns so re-runs give the same table.
    return dedup_first(typed, ["_lf_id"]).drop("_lf_id").filter(F.col("season").between(lo, hi))
