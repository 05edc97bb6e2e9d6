"""The batch job: CSV to features, summaries and run metrics."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import SparkSession

from txflow.operators.cleaning import clean_transactions
from txflow.operators.features import engineer_features
from txflow.operators.summaries import SHARED_CELLS, sales_cells
from txflow.sinks.tables import preview, write_featured, write_metrics, write_summary
from txflow.sinks.versions import publish
from txflow.sources.transactions import count_while_running, scan_transactions


def run_batch(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    partitions: int | None = None,
    show: bool = False,
) -> dict[str, Any]:
    """Write featured transactions, the four summaries and the run's metrics.

    The input is read once.  Two narrow scans of the featured table just written add up
    sales cells, and the summaries come from those.  Written tables take the place of a
    cache: a lost executor costs no more than its own tasks.
    """
    start = time.monotonic()
    steps: dict[str, float] = {}

    raw, loaded = count_while_running(scan_transactions(spark, input_path, partitions), "loaded")
    clean, kept = count_while_running(clean_transactions(raw), "kept")
    featured_path = f"{output_path}/featured_transactions"
    write_featured(engineer_features(clean), featured_path)
    steps["featured_transactions"] = round(time.monotonic() - start, 2)

    featured = spark.read.parquet(featured_path)
    for cells_name, (keys, finishers) in SHARED_CELLS.items():
        begun = time.monotonic()
        cells_path = f"{output_path}/sales_cells/{cells_name}"
        sales_cells(featured, keys).write.mode("overwrite").parquet(cells_path)
        steps[cells_name] = round(time.monotonic() - begun, 2)
        cells = spark.read.parquet(cells_path)
        for name, finish in finishers.items():
            begun = time.monotonic()
            write_summary(finish(cells), f"{output_path}/{name}")
            steps[name] = round(time.monotonic() - begun, 2)

    if show:
        preview(spark, f"{output_path}/region_stats")
        preview(spark, f"{output_path}/category_stats")

    rows, rows_clean = loaded.get["rows"], kept.get["rows"]
    metrics = {
        "num_workers": spark.sparkContext.defaultParallelism,
        "num_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "steps": steps,
        "row_count": rows,
        "clean_row_count": rows_clean,
        "removed_row_count": rows - rows_clean,
        "total_runtime_seconds": round(time.monotonic() - start, 2),
    }
    write_metrics(spark, metrics, f"{output_path}/run_metrics")
    return metrics


def publish_batch(
    spark: SparkSession, input_path: str, output_path: str, partitions: int | None = None, show: bool = False
) -> dict[str, Any]:
    """``run_batch`` into a version of its own; ``sinks.versions.current`` names the last whole one,
    so that a reader never meets outputs of two runs, or half of one."""
    return publish(spark, output_path, lambda folder: run_batch(spark, input_path, folder, partitions, show))
