"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS (default 3,
the median counts, after one warm-up) set the run. Every query is executed whole, into Spark's
no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame

from wattlake.functions.rules import valid_only
from wattlake.operators.windows import tumble
from wattlake.plans.catalog import queries
from wattlake.session import local_session
from wattlake.sources import adapters

HEADLINE = [
    "validate_codes", "valid_readings", "upsert_latest", "meter_range_scan",
    "tumbling_time", "tumbling_count", "tumbling_hybrid", "contiguous_windows",
    "sliding_analysis", "anomalies",
    "meter_metrics", "merge_meter_metrics", "energy_report", "flat_summary", "by_collector",
    "dashboard_kpis", "meter_table", "top_meters", "periodic_report",
    "distribution_stats", "compare_runs", "kafka_rows", "map_envelopes", "stream_envelopes",
]


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def median_seconds(work, runs: int) -> float:
    work()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "wattlake-bench")
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    seconds = {}
    for name in HEADLINE:
        repeats = 1 if name.startswith("stream_") else runs
        seconds[name] = median_seconds(lambda: run(known[name](spark, sf_dir)), repeats)

    # The workload of the published ratio: validate, filter, 30-second tumbling windows.
    def workload() -> None:
        run(tumble(valid_only(adapters.readings(spark, sf_dir)), "30 seconds"))

    rows = adapters.events(spark, sf_dir).count()
    workload_seconds = median_seconds(workload, runs)
    result = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("sf", 1)[-1],
        "cpus": cpus,
        "spark": spark.version,
        "workload_rows": rows,
        "workload_rows_per_sec": round(rows / workload_seconds),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
