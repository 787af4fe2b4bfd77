"""Physical-plan summary of every registered query (from ``explain()``).

Usage: python tools/plan_report.py [sf_dir]
Per query: shuffles, broadcasts, windows with their partition keys, scans with
pushed / partition filters, and any cartesian or nested-loop join.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


_WINDOW = re.compile(r"Window \[.*?\], \[(.*?)\], \[")


def summarize(text: str) -> dict:
    lines = text.splitlines()
    windows = []
    for ln in lines:
        if "Window [" in ln:
            m = _WINDOW.search(ln)
            keys = m.group(1) if m else "?"
            windows.append(re.sub(r"#\d+L?", "", keys) or "(none)")
    return {
        "shuffles": sum("Exchange hashpartitioning" in ln or "Exchange rangepartitioning" in ln
                        or "Exchange RoundRobin" in ln for ln in lines),
        "single_partition": sum("Exchange SinglePartition" in ln for ln in lines),
        "broadcasts": sum("BroadcastExchange" in ln for ln in lines),
        "windows": windows,
        "cartesian": sum("CartesianProduct" in ln or "BroadcastNestedLoopJoin" in ln
                         for ln in lines),
        "expand": sum(ln.strip().startswith(("Expand", "+- Expand", ":- Expand"))
                      or "Expand [" in ln for ln in lines),
        "python": sum("MapInPandas" in ln or "ArrowEvalPython" in ln or "BatchEvalPython" in ln
                      for ln in lines),
    }


def report(spark, sf_dir, names=None):
    from lapforge.plans.catalog import QUERIES
    out = {}
    for name in names or list(QUERIES):
        out[name] = summarize(plan_text(QUERIES[name](spark, sf_dir)))
    return out


if __name__ == "__main__":
    from lapforge.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session()
    for k, v in report(spark, sf, sys.argv[2:] or None).items():
        print(f"{k:26s} {v}")
