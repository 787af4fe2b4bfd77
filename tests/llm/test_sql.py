"""Operators that SQL can express, against DuckDB on the given tables."""
import pytest

from lapforge.llm.queries import ORACLE, QUERIES
from tools.oracle_check import duck

SF = "/root/testdata/sf0.001"


def plain(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", list(ORACLE))
def test_equals_sql(spark, name):
    out = QUERIES[name](spark, SF)
    columns = sorted(out.columns)
    want = duck(SF).execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert plain(out.select(columns).collect()) == plain(want)
