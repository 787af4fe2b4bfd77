"""Run registered queries on Spark and their SQL oracle on DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Compares column names, row counts and the sorted multiset of rows (columns
sorted by name), as the verify step does.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(round(v, 6)))
    return (1, repr(v))


_SPARK_KIND = {"bigint": "int64", "double": "float64", "string": "str"}
_DUCK_KIND = {"BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "str"}


def kinds_match(spark_schema, duck_description) -> bool:
    """Column name -> type kind on both sides (bigint/BIGINT, double/DOUBLE,
    string/VARCHAR); anything else counts as a mismatch."""
    s = {f.name: _SPARK_KIND.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_schema.fields}
    d = {c[0]: _DUCK_KIND.get(str(c[1]).upper(), str(c[1])) for c in duck_description}
    return s == d


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records), sorted(cols)


def compare(spark, sf_dir, names=None, con=None):
    from lapforge.plans.catalog import ORACLE, QUERIES
    con = con or duck(sf_dir)
    report = {}
    for name in names or list(QUERIES):
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            s_rows = [tuple(r) for r in df.collect()]
            s_cols = df.columns
            s_schema = df.schema
        except Exception as e:  # report, keep going
            report[name] = {"ok": False, "error": f"spark: {type(e).__name__}: {e}"[:800]}
            continue
        entry = {"spark_rows": len(s_rows), "sec": round(time.time() - t0, 2)}
        sql = ORACLE.get(name)
        if sql is None:
            entry["ok"] = None
            report[name] = entry
            continue
        try:
            res = con.execute(sql)
            d_cols = [c[0] for c in res.description]
            d_rows = res.fetchall()
        except Exception as e:
            entry.update(ok=False, error=f"duckdb: {e}"[:800])
            report[name] = entry
            continue
        a, ac = rows_of(s_cols, s_rows)
        b, bc = rows_of(d_cols, d_rows)
        entry["oracle_rows"] = len(b)
        entry["types_ok"] = kinds_match(s_schema, res.description)
        entry["ok"] = (a == b and ac == bc and entry["types_ok"])
        if not entry["ok"]:
            entry["cols"] = [ac, bc]
            diff_a = [r for r in a if r not in set(b)][:3]
            diff_b = [r for r in b if r not in set(a)][:3]
            entry["only_spark"] = diff_a
            entry["only_oracle"] = diff_b
        report[name] = entry
    return report


if __name__ == "__main__":
    from lapforge.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    rep = compare(spark, sf, names)
    for k, v in rep.items():
        print(k, json.dumps(v, default=str)[:1500])
    bad = [k for k, v in rep.items() if v.get("ok") is False]
    print("FAILED:", bad)
