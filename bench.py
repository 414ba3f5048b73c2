"""Benchmark every registered query of the library; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2), BENCH_SHUFFLE_PARTITIONS (default 2 x cpus; AQE
coalesces). Each query is forced to full execution with the
``noop`` sink (no collect to the driver); the value per query is the
median of warm runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import build_session
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=partitions,
                          app_name="tidemark-bench", extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    for name in QUERIES:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
        print(f"{name:28s} {times[name]:.3f}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir.rstrip("/"))
    print(json.dumps({
        "metric": "queries_total_median_sec",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
