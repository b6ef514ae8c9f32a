"""Time the headline countlens queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (timed runs per query after one warm-up pass over all
queries, interleaved, default 5).
Each run executes the full plan into Spark's ``noop`` sink, so every row is
computed but nothing is collected to the driver. The reported time of a
query is the median of its timed runs; ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from countlens.plans import testbed  # noqa: E402
from countlens.plans.testbed import QUERIES  # noqa: E402
from countlens.session import build_session  # noqa: E402

HEADLINE = [
    "top_n_by_day",
    "top_n_by_month",
    "decline_report",
    "growth_report",
    "top_n_by_day_events",
    "top_n_by_day_from_text",
    "sensor_counts_data_tests",
    "check_unique",
    "reformat_datetime",
    "ingest_counts_csv",
]

# Jobs that land files and write tables: run once each, on fresh folders and
# tables, without a warm-up pass (their figures are not in ``value``).
JOBS = {
    "stored_mart": testbed.build_test_mart,
    "incremental_mart": testbed.build_incremental_mart,
    "incremental_late_rows": lambda spark, sf_dir: QUERIES["incremental_late_rows"](spark, sf_dir).count(),
}


def run_once(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="countlens-bench",
        shuffle_partitions=cpus,
        extra_conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")},
    )
    # The first pass pays for compiling code, reading footers and warming the JVM.
    cold = {name: round(run_once(spark, name, sf_dir), 4) for name in HEADLINE}
    samples = {name: [] for name in HEADLINE}
    for _ in range(runs):  # interleaved, so drift hits every query alike
        for name in HEADLINE:
            samples[name].append(run_once(spark, name, sf_dir))
    jobs = {}
    for name, job in JOBS.items():
        t0 = time.perf_counter()
        job(spark, sf_dir)
        jobs[name] = round(time.perf_counter() - t0, 4)
    timings = {name: round(statistics.median(s), 4) for name, s in samples.items()}
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "cold": cold,
                "jobs": jobs,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
