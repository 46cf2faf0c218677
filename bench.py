"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}.

Each query is fully executed with the ``noop`` sink (no driver collect);
the first pass warms the JVM, the reported time is the best of
``$BENCH_REPEAT`` (default 2) further runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "products_main",
    "price_summary",
    "products_analysis",
    "filter_ladder",
    "field_coverage",
    "numeric_profile",
    "join_coverage",
    "alignment_counters",
    "brand_concentration",
    "nutrition_structure",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE

    from larder.registry import REGISTRY
    from larder.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="larder-bench")
    times: dict[str, float] = {}
    for name in names:
        fn = REGISTRY[name]
        fn(spark, sf_dir).write.mode("overwrite").format("noop").save()  # warm
        best = None
        for _ in range(max(1, repeat)):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.mode("overwrite").format("noop").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
