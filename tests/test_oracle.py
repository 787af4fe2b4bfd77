"""Every registered query against its SQL oracle (DuckDB) on the same parquet.

Runs at sf0.001 by default; set LAPFORGE_ORACLE_SF_DIR for another scale."""
import os

import pytest

from tools.oracle_check import compare, duck

SF_DIR = os.environ.get("LAPFORGE_ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def report(spark):
    return compare(spark, SF_DIR, con=duck(SF_DIR))


def names():
    from lapforge.plans.catalog import QUERIES
    return list(QUERIES)


@pytest.mark.parametrize("name", names())
def test_query_matches_oracle(report, name):
    r = report[name]
    assert r.get("ok") is not False, r
    assert r["spark_rows"] >= 0


def test_every_query_has_sql():
    from lapforge.plans.catalog import ORACLE, QUERIES
    assert set(ORACLE) == set(QUERIES)
