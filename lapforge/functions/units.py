"""Texts of numbers with units: ``6m 32s``, ``0:42``, ``5.4M``, ``4,280,000``.

A text is a run of parts, each a number and a unit of a given table (a single part where the
table has a number without unit); its value is the sum of number x factor.  ``m:ss`` and ``h:mm:ss`` count as parts in 60s.  A text that is nothing but
such parts has a value; NULL, blank text and a dash are no value; any other text is malformed
and goes to the reject lane, so it is counted and never read as part of a number.  All of it is
built-in functions, inside the plan of the query.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units of the texts and what they stand for.
SECONDS = {"h": 3600, "m": 60, "s": 1}
COUNTS = {"": 1, "k": 1_000, "m": 1_000_000, "b": 1_000_000_000}
DASHES = ("-", "–", "—")

_NUMBER = r"[0-9]{1,15}(?:\.[0-9]{1,9})?"
_CLOCK = r"^(?:([0-9]{1,6}):([0-5][0-9])|([0-9]{1,10})):([0-5][0-9])$"
_THOUSANDS = r"^[0-9]{1,3}(?:,[0-9]{3})+(?![0-9])"


def plain(text) -> Column:
    """Trimmed, lower-cased; thousands separators taken out where they stand by threes."""
    t = F.lower(F.trim(F.col(text) if isinstance(text, str) else text))
    return F.when(F.regexp_like(t, F.lit(_THOUSANDS)), F.replace(t, F.lit(","), F.lit(""))).otherwise(t)


def is_blank(text) -> Column:
    """No value is meant: NULL, blank or a dash."""
    t = plain(text)
    return t.isNull() | t.isin("", *DASHES)


def unit_value(text, units: Mapping[str, float]) -> Column:
    """The value of ``text`` as a double; NULL where it is blank or malformed."""
    t = plain(text)
    unit = "(" + "|".join(sorted((u for u in units), key=len, reverse=True)) + ")"
    part = f"({_NUMBER})\\s*{unit}"
    factors = F.create_map(*(F.lit(x) for u, f in units.items() for x in (u, float(f))))
    numbers, names = F.regexp_extract_all(t, F.lit(part), 1), F.regexp_extract_all(t, F.lit(part), 2)
    terms = F.zip_with(numbers, names, lambda n, u: n.cast("double") * F.element_at(factors, u))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    whole = f"^{part}$" if "" in units else f"^{part}(?:\\s*{part})*$"
    return F.when(F.regexp_like(t, F.lit(whole)), total)


def duration_seconds(text) -> Column:
    """``1h 2m 3s``, ``6m 32s``, ``0:42`` or ``1:02:03`` in seconds."""
    t = plain(text)
    hours, minutes, short, seconds = (F.regexp_extract(t, _CLOCK, i + 1) for i in range(4))
    clock = F.when(short != "", short.try_cast("double")).otherwise(
        hours.try_cast("double") * 60 + minutes.try_cast("double")) * 60 + seconds.try_cast("double")
    return F.when(F.regexp_like(t, F.lit(_CLOCK)), clock).otherwise(unit_value(t, SECONDS))


def count_number(text) -> Column:
    """``5.4M``, ``150K`` or ``4,280,000`` as a whole number (half to even)."""
    return F.bround(unit_value(text, COUNTS), 0).cast("bigint")


def malformed(text, value: Column) -> Column:
    """The reject lane: a text that means a value and has none."""
    return ~is_blank(text) & value.isNull()
