"""Output typing shared by all registered queries.

Integral columns become bigint, fractional ones double rounded half-to-even to
6 places (summation order differs between engines), dates and timestamps
ISO text.  The SQL oracle applies the same rule to its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACS = (T.FloatType, T.DoubleType, T.DecimalType)


def finalize(df: DataFrame, places: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, _INTS):
            c = c.cast("bigint")
        elif isinstance(t, _FRACS):
            c = F.bround(c.cast("double"), places)
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.BooleanType):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(*cols)
