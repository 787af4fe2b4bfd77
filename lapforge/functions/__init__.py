"""Column -> Column helpers.

All are built-in Spark expressions, so they stay inside whole-stage codegen;
none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: championship points for finishing
# positions 1..10; every other position scores 0.
POINTS_BY_POSITION = [25, 18, 15, 12, 10, 8, 6, 4, 2, 1]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_even(c, places: int = 0) -> Column:
    """Half-to-even rounding (pandas/numpy ``round``), not Spark's half-up."""
    return F.bround(_c(c), places)


def pct(a, b) -> Column:
    """a / b * 100; NULL when b is 0 (ANSI-safe)."""
    return F.try_divide(_c(a), _c(b)) * F.lit(100.0)


def safe_ratio(a, b, default: float = 0.0) -> Column:
    """a / b, or ``default`` when b is 0 or NULL."""
    return F.coalesce(F.try_divide(_c(a), _c(b)), F.lit(default))


def clamp(c, lo, hi) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(c)))


def trunc_int(c) -> Column:
    """Truncating cast toward zero (Python ``int()``)."""
    return _c(c).cast("int")


def to_int(c) -> Column:
    """String to integer; unparsable text gives NULL instead of an ANSI error."""
    return F.trim(_c(c)).try_cast("int")


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """String to date; unparsable text gives NULL (``try_to_timestamp``)."""
    return F.try_to_timestamp(F.trim(_c(c)), F.lit(fmt)).cast("date")


def full_name(a, b) -> Column:
    """``a || ' ' || b``: NULL if either side is NULL (unlike concat_ws)."""
    return F.concat(_c(a), F.lit(" "), _c(b))


def points_of(position) -> Column:
    """Points for a finishing position; positions outside 1..10 and NULL score 0."""
    pos = _c(position)
    table = F.array(*[F.lit(p) for p in POINTS_BY_POSITION])
    in_table = pos.between(1, len(POINTS_BY_POSITION))
    return F.when(in_table, F.element_at(table, pos.cast("int"))).otherwise(F.lit(0))


def points_map_lookup(position) -> Column:
    """The same lookup written as a 10-key map (missing key -> NULL -> 0)."""
    m = F.create_map(*[x for i, p in enumerate(POINTS_BY_POSITION, start=1)
                       for x in (F.lit(i), F.lit(p))])
    return F.coalesce(F.try_element_at(m, _c(position).cast("int")), F.lit(0))


def clean_points(position, points) -> Column:
    """Keep the row's own points when position is 1..10, else 0 (NULL -> 0)."""
    return F.when(_c(position).isin(list(range(1, 11))), _c(points)).otherwise(F.lit(0))


def fmt_num(c, places: int = 3) -> Column:
    return F.when(_c(c).isNotNull(), F.format_string(f"%.{places}f", _c(c)))


def fmt_thousands(c) -> Column:
    return F.format_number(_c(c), 0)


def fmt_time(c) -> Column:
    """Timestamp to ``HH:mm:ss.SSS``."""
    return F.date_format(_c(c), "HH:mm:ss.SSS")


def to_ms(seconds) -> Column:
    """Seconds to whole milliseconds, half-to-even."""
    return F.bround(_c(seconds) * F.lit(1000.0), 0).cast("bigint")
