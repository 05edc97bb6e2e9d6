"""Windows of a live stream.

Each micro-batch is added up to counted cells (see ``operators.windows``), which are stored
under the batch's number.  Cells of different batches add up, so nothing is ever too late: a
row for a window that was reported already goes to its cells, and the window is reported again.
A window is due when the arrival clock has passed its end; only batches that make one due, or
touch a reported one, finish anything, and they read only the parts of the cell table that hold
open or touched windows (see ``streaming.cells``): a batch costs the same at any age of the stream.

Each micro-batch overwrites its own folders, so a batch that runs again after a failure leaves
no duplicates.  There is no state in memory: what was seen before is in the cells' manifest.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txflow.functions.money import money_sum
from txflow.functions.timing import size_micros, window_index
from txflow.operators.windows import (
    RESULT_COLUMNS,
    before_grace,
    finish_windows,
    label_cells,
    latency_cells,
    own_time,
    stamp_events,
)
from txflow.schemas import MICROS
from txflow.streaming import cells

def with_arrival_ts(events: DataFrame) -> DataFrame:
    return events.withColumn("arrival_ts", F.timestamp_micros("arrival_us"))


def _closed(seen: int | None, size: float, delay: float) -> Column:
    """The window ended ``delay`` seconds or more before the last arrival."""
    if seen is None:
        return F.lit(False)
    return (F.col("window_id") + 1) * size_micros(size) <= seen - round(delay * MICROS)


def _first_open(seen: int | None, size: float, delay: float) -> int | None:
    """The first window that had not ended ``delay`` seconds before the last arrival."""
    return None if seen is None else (seen - round(delay * MICROS)) // size_micros(size)


#: A batch's windows are told by ranges, so many at most.
_PAGES = 256


def start(
    events: DataFrame,
    output_path: str,
    checkpoint: str,
    size: float,
    delay: float = 0.0,
    poll: str | None = None,
) -> StreamingQuery:
    """Start the window stream: everything there is if ``poll`` is None, else for ever.

    ``delay`` holds reports back by so many seconds of the arrival clock, which saves reporting
    a window again for each straggler; it drops nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = cells.latest(spark, output_path, before=batch_id)
        folder = cells.batch_folder(batch_id)
        stamped = stamp_events(batch, size, replay=False).persist(StorageLevel.DISK_ONLY)
        try:
            for name, added in (("labels", label_cells(stamped)), ("latencies", latency_cells(stamped))):
                added.write.mode("overwrite").parquet(cells.path_of(output_path, name, folder))
        finally:
            stamped.unpersist()
        own = spark.read.schema(cells.TABLES["labels"]).parquet(cells.path_of(output_path, "labels", folder))
        low, high, last = own.agg(F.min("window_id"), F.max("window_id"), F.max("last_us")).first()
        if low is None:
            cells.publish(spark, output_path, replace(table, batch_id=batch_id, opened=0))
            return
        before, seen = table.seen, last if table.seen is None else max(table.seen, last)
        page = (high - low) // _PAGES + 1
        pages = own.agg(F.collect_set(F.floor(F.col("window_id") / page))).first()[0]
        new = cells.Part(folder, 0, low, high)
        needed = cells.holding(table.parts, _first_open(before, size, delay), pages, page)
        _finish(spark, output_path, needed, new, before, seen, size, delay)
        parts = cells.compacted(spark, output_path, [*table.parts, new], batch_id)
        cells.publish(spark, output_path, cells.Manifest(batch_id, seen, parts, len(needed) + 1))

    writer = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if poll is None else {"processingTime": poll}
    return writer.trigger(**trigger).start()


def _finish(
    spark: SparkSession,
    output_path: str,
    needed: list[cells.Part],
    new: cells.Part,
    before: int | None,
    seen: int,
    size: float,
    delay: float,
) -> None:
    """Report the windows that a batch closed, and closed ones that it touched, from the parts that
    hold them: those ``needed`` of before, and the batch's own ``new`` one."""
    windows = [cells.read(spark, output_path, p, "labels").select("window_id") for p in (needed, [new])]
    opened = windows[0].where(~_closed(before, size, delay)).unionByName(windows[1])
    due = opened.where(_closed(seen, size, delay)).distinct()
    lowest = due.agg(F.min("window_id")).first()[0]
    if lowest is None:
        return
    # Bounds on the window let the scan skip the cells of older ones.
    whole = [
        cells.read(spark, output_path, [*needed, new], name).where(F.col("window_id") >= lowest).join(due, "window_id", "left_semi")
        for name in cells.TABLES
    ]
    finish_windows(*whole, size).write.mode("overwrite").json(f"{output_path}/results/{new.folder}")


def run(
    events: DataFrame,
    output_path: str,
    checkpoint: str,
    size: float,
    duration: float | None = None,
    poll: str = "100 milliseconds",
    delay: float = 0.0,
) -> None:
    """Run for ``duration`` seconds, or until all input there is has been read."""
    query = start(events, output_path, checkpoint, size, delay, None if duration is None else poll)
    query.awaitTermination(duration)
    query.stop()


def flush(spark: SparkSession, output_path: str, size: float, delay: float = 0.0) -> None:
    """Report the windows of a stopped stream that are still open, from their cells.

    When the stream goes on, it reports those windows itself, and ``read_results`` prefers
    that.  A stream that never had input has nothing open.
    """
    table = cells.latest(spark, output_path)
    if table.seen is not None:
        still = ~_closed(table.seen, size, delay)
        parts = cells.holding(table.parts, _first_open(table.seen, size, delay), [], 1)
        labels, latencies = (cells.read(spark, output_path, parts, name) for name in cells.TABLES)
        finish_windows(labels.where(still), latencies.where(still), size).write.mode("overwrite").json(
            f"{output_path}/open_results"
        )


_RESULT_SCHEMA = (
    "window_id bigint, window_start double, window_end double, duration_seconds double, event_count bigint, "
    "throughput_per_second double, total_revenue double, fraud_count bigint, fraud_rate_pct double, "
    "latency_p50_ms double, latency_p95_ms double, latency_p99_ms double, latency_max_ms double, "
    "late_events bigint, top_region string, top_category string"
)


def read_results(spark: SparkSession, output_path: str, flushed: bool = False) -> DataFrame:
    """Reported windows, each as it was reported last; with ``flushed`` also those reported by
    ``flush``."""

    def read(folder: str) -> DataFrame:
        schema = _RESULT_SCHEMA + ", batch_id bigint"
        try:
            return spark.read.schema(schema).json(f"{output_path}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)  # nothing reported yet

    row = F.max_by(F.struct(*RESULT_COLUMNS), "batch_id").alias("row")
    closed = read("results").groupBy("window_id").agg(row).select("row.*")
    if not flushed:
        return closed
    opened = read("open_results").select(*RESULT_COLUMNS)
    return closed.unionByName(opened.join(closed.select("window_id"), "window_id", "left_anti"))


def read_cells(spark: SparkSession, output_path: str, size: float, delay: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Label and latency cells of the closed windows, from which overall statistics can be
    added up."""
    table = cells.latest(spark, output_path)
    labels, latencies = (cells.read(spark, output_path, table.parts, name) for name in cells.TABLES)
    closed = _closed(table.seen, size, delay)
    return labels.where(closed), latencies.where(closed)


def _window_id(size: float) -> Column:
    return window_index(F.unix_micros("window.start"), size).alias("window_id")


# --- other streams -----------------------------------------------------------


def event_time_totals(events: DataFrame, size: float, grace: float = 2.0) -> DataFrame:
    """Count and revenue by the events' own windows.  An event that arrives more than ``grace``
    seconds after its window's end is discarded, by the same rule as in
    ``operators.windows.event_time_windows`` and so however batches are cut.

    The watermark then only closes windows: with arrivals in order, and no event ahead of its
    arrival, it drops none of what is left.
    """
    window = F.window("event_ts", f"{size_micros(size)} microseconds")
    return (
        events.filter(before_grace(window_index(own_time(), size), size, grace))
        .withColumn("event_ts", F.timestamp_micros(own_time()))
        .withWatermark("event_ts", f"{round(grace * 1000)} milliseconds")
        .groupBy(window.alias("window"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            money_sum(F.coalesce(F.col("total"), F.lit(0.0))).alias("total_revenue"),
            F.count_if(F.coalesce(F.col("is_fraud"), F.lit(False))).alias("fraud_count"),
        )
        .select(_window_id(size), "event_count", "total_revenue", "fraud_count")
    )


def append_to(rows: DataFrame, path: str, checkpoint: str) -> None:
    """Append all there is to a Parquet table, each row exactly once over any restarts."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.start().awaitTermination()
