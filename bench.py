"""Time the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints one JSON line.
Each query is forced to completion with a no-op write (full evaluation, no
result collection); the reported time is the median of ``$BENCH_REPEATS``
warm runs after one warm-up run of the whole set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quincena.plans.catalog import QUERIES  # noqa: E402
from quincena.session import build_session  # noqa: E402

HEADLINE = [
    "bronze_enriched", "snapshot_latest", "gold_position", "gold_employee", "scd2_history",
    "inactive_employees", "dim_position", "report_clean", "pending_reports", "mon_run_table",
    "page_options", "scd2_stream",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, int(cpus) * 2),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "4g")})
    for name in HEADLINE:
        run_once(spark, name, sf_dir)
    times = {}
    for name in HEADLINE:
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(repeats)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
