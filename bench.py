"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
    BENCH_RUNS (default 3 timed runs after one warm-up; median reported).

Each query is fully evaluated with the ``noop`` sink (no driver collect), so
the time is the plan's own work including any target writes it performs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["flattened_observations", "location_summary", "patient_summary", "upsert_orders",
            "extract_incremental", "progress_rollup", "history_page", "stream_upsert"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from sluice.catalog import all_queries
    from sluice.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus), driver_memory="8g")
    qs = all_queries()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        fn = qs[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        rows[name] = fn(spark, sf_dir).count()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rows": rows, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
