"""Benchmark the headline queries.

Runs each query to completion with the `noop` sink (full execution, nothing
collected) twice: a cold run (first compilation of its plan) and a warm run.
The metric is the total of the warm runs (steady state, as a long-running job
sees it); the cold times are reported next to it.  Prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "cold": {...}, "sf": ...}

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list; default the headline set, "all" for every key).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["mark_orders", "sku_split_sales", "final_result", "daily_order_count", "pareto_pick",
            "select_two_store", "purchase_lifecycle", "purchase_wide", "ingest_order_lines"]


def main() -> int:
    from pickbay.registry import queries
    from pickbay.session import get_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    qs = queries()
    names = sorted(qs) if wanted == "all" else ([w for w in wanted.split(",") if w] or HEADLINE)

    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 8))
    # untimed warm-up, one query per family: JVM JIT, Python workers, footers
    for warm in ("assortment_flags", "purchase_header", "daily_order_count"):
        qs[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times, cold, errors = {}, {}, {}
    for name in names:
        for run in (cold, times):
            t0 = time.perf_counter()
            try:
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                run[name] = round(time.perf_counter() - t0, 3)
            except Exception as e:  # keep measuring the rest; report the failure
                run[name] = None
                errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_warm_total_sec" if not wanted else "queries_warm_total_sec",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(t for t in cold.values() if t is not None), 3),
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
