"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion through the ``noop`` sink (full execution, no
collect to the driver); queries that write (staging, ingest) include their writes.
Each query is timed BENCH_REPEAT times (default 2) from plan construction to the
end of execution, and the best run is reported: run-to-run noise on a shared
machine is large, and the best run is the warm steady state.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["rolling_turnover", "monthly_headcount", "headcount_orders", "stage_employees", "stage_terminations",
            "fct_terminations", "latest_per_key", "dq_suite", "stage_parquet", "ingest_stream",
            "run_history"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from attrix.session import get_session
    from attrix.plans.registry import QUERIES

    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus, app_name="attrix-bench")
    # warm-up pass on the small tables (JIT, class loading, codegen caches) — not timed;
    # the timed numbers are warm runs, like the baseline's datum
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    for name in HEADLINE:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    times = {}
    for name in HEADLINE:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            el = time.perf_counter() - t0
            best = el if best is None else min(best, el)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_headline_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else None, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
