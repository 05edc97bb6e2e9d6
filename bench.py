"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_ROWS    also run the whole batch job on this many made-up CSV rows, the workload
BENCH_ONLY    comma-separated query names
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from txflow.plans.batch import run_batch
from txflow.plans.catalogue import catalogue
from txflow.sinks.scratch import scratch_dir
from txflow.sources.synthetic import synthesize_range

HEADLINE = [
    "region_stats",
    "category_stats",
    "time_stats",
    "user_stats",
    "clean_report",
    "featured_transactions",
    "featured_parquet_roundtrip",
    "run_metrics",
    "window_totals",
    "window_latency_percentiles",
    "window_top_region",
    "window_stats",
    "overall_stats",
    "event_time_windows",
    "fraud_spikes",
    "backlog_depth",
    "dedup_events",
    "partitioned_write",
    "consumer_metrics",
    "stream_window_sink",
]
RUNS = 2


def _session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _timed(action) -> float:
    begun = time.monotonic()
    action()
    return round(time.monotonic() - begun, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_ROWS", "10000000"))
    only = os.environ.get("BENCH_ONLY")
    spark = _session(cpus)
    queries = catalogue()
    seconds: dict[str, float] = {}
    for name in only.split(",") if only else HEADLINE:
        run = lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = min(_timed(run) for _ in range(RUNS))
    report = {
        "metric": "sum of best-of-2 query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    if rows:
        source, out = scratch_dir(spark, "bench-csv"), scratch_dir(spark, "bench-out")
        synthesize_range(spark, rows).write.mode("overwrite").option("header", True).csv(source)
        metrics = run_batch(spark, source, out)
        total = metrics["total_runtime_seconds"]
        report["batch_job"] = {
            "rows": rows,
            "seconds": total,
            "rows_per_second": round(rows / total),
            "steps": metrics["steps"],
        }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
