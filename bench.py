"""Benchmark: all queries of the reference's operators on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query runs once to warm up, then ``BENCH_RUNS`` times; a run builds the
query (including any pinned sort it needs) and executes the whole plan into
Spark's ``noop`` sink, so nothing is collected to the driver.  The reported
time per query is the median; ``value`` is the sum of the medians.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from lapforge.plans.catalog import QUERIES
    from lapforge.session import build_session

    spark = build_session(master=f"local[{cpus}]")
    names = only or list(QUERIES)
    times: dict[str, float] = {}
    # The warehouse build (the lineitem x orders join and the lap numbering,
    # written once) is timed on its own; the queries then read the facts.
    from lapforge.plans import warehouse
    from lapforge.plans.model import Model

    def build_once() -> float:
        warehouse.invalidate(spark, sf_dir)
        t0 = time.perf_counter()
        warehouse.location(Model(spark, sf_dir))
        return time.perf_counter() - t0

    failed: dict[str, str] = {}
    try:
        build_once()  # warm-up
        times["build_warehouse"] = round(statistics.median(build_once() for _ in range(runs)), 3)
    except Exception as e:  # keep measuring the rest; report the failure
        failed["build_warehouse"] = f"{type(e).__name__}: {e}"[:300]
    for name in names:
        fn = QUERIES[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            once()  # warm-up
            times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        except Exception as e:
            failed[name] = f"{type(e).__name__}: {e}"[:300]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        **({"failed": failed} if failed else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
