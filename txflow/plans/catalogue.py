"""One query per operator, over the test tables.

Each takes the session and the folder of the tables and reads them whole.  Queries about
files first write the tables' rows in the format in question to a scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txflow.functions.timing import micros_to_seconds
from txflow.operators import cleaning, delivery, summaries, windows
from txflow.operators.features import FEATURE_NAMES, engineer_features
from txflow.plans.batch import run_batch
from txflow.plans.replay import run_replay
from txflow.schemas import RECORDED_EVENT_SCHEMA
from txflow.sinks import tables
from txflow.sinks.scratch import scratch_dir
from txflow.sources import events as event_source
from txflow.sources import star
from txflow.sources import transactions as transaction_source
from txflow.streaming import windows as window_stream

Query = Callable[[SparkSession, str], DataFrame]

HOUR = 3600.0
CHECKPOINT = 499


# --- inputs ------------------------------------------------------------------


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer_features(cleaning.clean_transactions(star.transactions(spark, sf_dir)))


def _stamped(spark: SparkSession, sf_dir: str, size: float = HOUR) -> DataFrame:
    return windows.stamp_events(star.timed_events(spark, sf_dir), size)


def _csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_dir(spark, "transactions-csv")
    star.transactions(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
    return path


def _jsonl(spark: SparkSession, lines: DataFrame) -> str:
    path = scratch_dir(spark, "events-jsonl")
    lines.select("value").write.mode("overwrite").text(path)
    return path


def _recorded(spark: SparkSession, path: str) -> DataFrame:
    return event_source.with_clock(event_source.scan_events(spark, path, RECORDED_EVENT_SCHEMA))


def _recorded_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    return event_source.with_clock(event_source.stream_events(spark, path, RECORDED_EVENT_SCHEMA, files_per_batch))


def _one_row(spark: SparkSession, name: str, value: int) -> DataFrame:
    return spark.range(1).select(F.lit(value).cast("long").alias(name))


# --- scans -------------------------------------------------------------------


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_source.scan_transactions(spark, _csv(spark, sf_dir))


def repartition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_source.scan_transactions(spark, _csv(spark, sf_dir), partitions=spark.sparkContext.defaultParallelism)


def load_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, seen = transaction_source.count_while_running(
        transaction_source.scan_transactions(spark, _csv(spark, sf_dir)), "loaded"
    )
    rows.write.mode("overwrite").parquet(scratch_dir(spark, "loaded"))
    return _one_row(spark, "row_count", seen.get["rows"])


def jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recorded(spark, _jsonl(spark, star.event_lines(spark, sf_dir)))


def stream_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _jsonl(spark, star.damaged_lines(spark, sf_dir))
    out, checkpoint = scratch_dir(spark, "events"), scratch_dir(spark, "checkpoint")
    window_stream.append_to(_recorded_stream(spark, source), out, checkpoint)
    return spark.read.parquet(out)


def tail_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as ``stream_jsonl`` has them, from the source for files that grow."""
    source = _jsonl(spark, star.damaged_lines(spark, sf_dir))
    out, checkpoint = scratch_dir(spark, "events"), scratch_dir(spark, "checkpoint")
    events = event_source.with_clock(event_source.tail_events(spark, source, RECORDED_EVENT_SCHEMA))
    window_stream.append_to(events, out, checkpoint)
    return spark.read.parquet(out)


def corrupt_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = event_source.scan_lines(spark, _jsonl(spark, star.damaged_lines(spark, sf_dir)))
    sides = event_source.split_lines(lines, RECORDED_EVENT_SCHEMA)
    return sides.select("is_corrupt", "event_id", "region", "total")


def corrupt_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return error_rate(spark, sf_dir).select("lines", "corrupt_lines")


def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = event_source.scan_lines(spark, _jsonl(spark, star.damaged_lines(spark, sf_dir)))
    return event_source.line_quality(lines, RECORDED_EVENT_SCHEMA)


# --- cleaning ----------------------------------------------------------------


def clean_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_missing(star.transactions(spark, sf_dir))


def clean_fraud_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.parse_fraud_flag(star.transactions(spark, sf_dir))


def _rule_query(rule: str) -> Query:
    return lambda spark, sf_dir: cleaning.keep_where(star.transactions(spark, sf_dir), rule)


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_transactions(star.transactions(spark, sf_dir))


def clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_report(star.transactions(spark, sf_dir))


# --- features and summaries --------------------------------------------------


def _shown(name: str) -> Column:
    """``log_total`` to six digits: engines differ in the last bit of a logarithm."""
    return F.round(name, 6).alias(name) if name == "log_total" else F.col(name)


def featured_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _featured(spark, sf_dir)
    return rows.select(*[_shown(c) for c in rows.columns])


def _feature_query(name: str) -> Query:
    return lambda spark, sf_dir: _featured(spark, sf_dir).select("transaction_id", "user_id", _shown(name))


def _summary_query(name: str) -> Query:
    return lambda spark, sf_dir: summaries.SUMMARIES[name](_featured(spark, sf_dir))


def _summary_roundtrip(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        summary = summaries.SUMMARIES[name](_featured(spark, sf_dir))
        path = scratch_dir(spark, name)
        tables.write_summary(summary, path)
        return tables.read_summary(spark, path, summary.schema)

    return query


def featured_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "featured")
    tables.write_featured(_featured(spark, sf_dir), path)
    rows = spark.read.parquet(path)
    return rows.select(*[_shown(c) for c in rows.columns])


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row counts of the metrics that a whole batch run leaves behind."""
    out = scratch_dir(spark, "batch")
    run_batch(spark, _csv(spark, sf_dir), out)
    return spark.read.json(f"{out}/run_metrics").select("row_count", "clean_row_count", "removed_row_count")


# --- windows -----------------------------------------------------------------


def window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = windows.assign_window(star.timed_events(spark, sf_dir), HOUR)
    bounded = windows.with_bounds(assigned.withColumn("window_id", F.col("event_window_id")), HOUR)
    return bounded.select("event_id", "window_id", "window_start", "window_end")


def arrival_window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.assign_open_window(star.timed_events(spark, sf_dir), HOUR).select("event_id", "window_id")


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_late_counts(_stamped(spark, sf_dir))


def event_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    latency = windows.event_latency(star.timed_events(spark, sf_dir))
    return latency.select("event_id", micros_to_seconds(F.col("latency_us")).alias("latency_seconds"))


def window_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_totals(_stamped(spark, sf_dir), HOUR)


def window_latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_latency_percentiles(_stamped(spark, sf_dir))


def window_top_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_top(_stamped(spark, sf_dir), "region", "top_region")


def window_top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_top(_stamped(spark, sf_dir), "product_category", "top_category")


def window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_stats(_stamped(spark, sf_dir), HOUR)


def overall_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.overall_stats(_stamped(spark, sf_dir, 5.0), 5.0)


def consumer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "replay")
    run_replay(spark, _jsonl(spark, star.event_lines(spark, sf_dir)), out, 5.0)
    return spark.read.json(f"{out}/consumer_metrics")


def _window_run(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    # Dealt at random over files: most batches bring rows of windows reported before.
    source = _jsonl(spark, star.damaged_lines(spark, sf_dir).repartition(3))
    out, checkpoint = scratch_dir(spark, "windows"), scratch_dir(spark, "checkpoint")
    window_stream.run(_recorded_stream(spark, source, files_per_batch=1), out, checkpoint, HOUR)
    return out, checkpoint


def stream_window_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _window_run(spark, sf_dir)
    return window_stream.read_results(spark, out)


def stream_final_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _window_run(spark, sf_dir)
    window_stream.flush(spark, out, HOUR)
    return window_stream.read_results(spark, out, flushed=True)


def resume_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.resume_after(star.timed_events(spark, sf_dir), CHECKPOINT)


def resume_after_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.resume_first(star.timed_events(spark, sf_dir), CHECKPOINT)


def arrival_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.arrival_rate(star.timed_events(spark, sf_dir))


def arrival_rate_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.arrival_rate_overall(star.timed_events(spark, sf_dir))


# --- documented extensions ---------------------------------------------------


def event_time_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.event_time_windows(star.timed_events(spark, sf_dir), HOUR)


def stream_event_time_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _jsonl(spark, star.damaged_lines(spark, sf_dir))
    out, checkpoint = scratch_dir(spark, "event-time"), scratch_dir(spark, "checkpoint")
    totals = window_stream.event_time_totals(_recorded_stream(spark, source), HOUR)
    window_stream.append_to(totals, out, checkpoint)
    return spark.read.parquet(out)


def late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = windows.late_events(_stamped(spark, sf_dir))
    return late.select("event_id", "event_window_id", "window_id")


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which every third is delivered again a second later."""
    events = star.timed_events(spark, sf_dir)
    again = events.filter(F.col("event_id") % 3 == 0).withColumn("arrival_us", F.col("arrival_us") + 1_000_000)
    return delivery.drop_replays(events.unionByName(again))


def backlog_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.backlog_depth(star.timed_events(spark, sf_dir), alert=3)


def fraud_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.fraud_spikes(window_totals(spark, sf_dir))


def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "events-by-date")
    tables.write_by_date(star.timed_events(spark, sf_dir), path)
    return spark.read.parquet(path)


def catalogue() -> dict[str, Query]:
    named: list[Query] = [
        csv_scan,
        repartition_scan,
        load_row_count,
        jsonl_scan,
        stream_jsonl,
        tail_jsonl,
        corrupt_split,
        corrupt_count,
        error_rate,
        clean_dropna,
        clean_fraud_flag,
        clean_transactions,
        clean_report,
        featured_transactions,
        featured_parquet_roundtrip,
        run_metrics,
        window_assign,
        arrival_window_assign,
        late_events,
        event_latency,
        window_totals,
        window_latency_percentiles,
        window_top_region,
        window_top_category,
        window_stats,
        overall_stats,
        consumer_metrics,
        stream_window_sink,
        stream_final_flush,
        resume_after,
        resume_after_limit,
        arrival_rate,
        arrival_rate_overall,
        event_time_windows,
        stream_event_time_windows,
        late_side_output,
        dedup_events,
        backlog_depth,
        fraud_spikes,
        partitioned_write,
    ]
    queries = {query.__name__: query for query in named}
    for key, rule in {
        "clean_amount": "amount",
        "clean_quantity": "quantity",
        "clean_total": "total",
        "clean_hour": "hour_of_day",
        "clean_day": "day_of_week",
    }.items():
        queries[key] = _rule_query(rule)
    for name in FEATURE_NAMES:
        queries[f"feature_{name}"] = _feature_query(name)
    for name in summaries.SUMMARIES:
        queries[name] = _summary_query(name)
        queries[f"{name.removesuffix('_stats')}_csv_roundtrip"] = _summary_roundtrip(name)
    return queries
