"""The windows of a recorded stream, read as a bounded table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from txflow.operators.windows import finish_windows, label_cells, latency_cells, overall_from_cells, stamp_events
from txflow.schemas import RECORDED_EVENT_SCHEMA
from txflow.sources.events import scan_events, with_clock

#: What the windows need of an event.
_NEEDED = ["event_id", "event_us", "arrival_us", "region", "product_category", "total", "is_fraud"]


def run_replay(spark: SparkSession, input_path: str, output_path: str, size: float = 5.0) -> None:
    """Replay JSON lines that carry their arrival time: window results and overall statistics.

    Three passes would parse the lines three times: for the first event, the label cells and
    the latency cells.  So they are parsed once into a table of the seven fields that windows
    """
    events = with_clock(scan_events(spark, input_path, RECORDED_EVENT_SCHEMA)).select(*_NEEDED)
    events.write.mode("overwrite").parquet(f"{output_path}/events")
    stamped = stamp_events(spark.read.parquet(f"{output_path}/events"), size)
    tables = []
    for name, cells in (("labels", label_cells(stamped)), ("latencies", latency_cells(stamped))):
        cells.write.mode("overwrite").parquet(f"{output_path}/cells/{name}")
        tables.append(spark.read.parquet(f"{output_path}/cells/{name}"))
    finish_windows(*tables, size).write.mode("overwrite").json(f"{output_path}/window_results")
    overall_from_cells(*tables, size).write.mode("overwrite").json(f"{output_path}/consumer_metrics")
