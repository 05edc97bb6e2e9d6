"""Resuming, replays and load of an event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txflow.functions.timing import micros_to_seconds, size_micros, window_index
from txflow.operators.ranks import running_total
from txflow.operators.windows import own_time
from txflow.schemas import BACKLOG_ALERT, MICROS, NO_EVENT_ID, REPORT_SECONDS


def resume_after(events: DataFrame, last_processed: int) -> DataFrame:
    """Events after a checkpoint, which names the last event that *was* processed.
    An event without id counts as -1, so any checkpoint skips it."""
    return events.filter(F.coalesce("event_id", F.lit(NO_EVENT_ID)) > last_processed)


def resume_first(events: DataFrame, last_processed: int, n: int = 200) -> DataFrame:
    """The first ``n`` of them: a top-k, not a sort of the whole stream."""
    return resume_after(events, last_processed).orderBy("event_id").limit(n)


def drop_replays(events: DataFrame) -> DataFrame:
    """Each event once, as it arrived first; of copies that arrived together the smallest row.
    Events without id cannot be told apart and are all kept.  One shuffle and one sort after it."""
    rest = [c for c in events.columns if c not in ("arrival_us", "event_id")]
    first = Window.partitionBy("event_id", "unnamed").orderBy("arrival_us", *rest)
    # Events without id are spread by their content, so that they need not meet.
    spread = F.when(F.col("event_id").isNull(), F.xxhash64("arrival_us", *rest))
    return (
        events.withColumn("unnamed", spread)
        .withColumn("copy", F.row_number().over(first))
        .filter("copy = 1 or event_id is null")
        .select("arrival_us", *[c for c in events.columns if c != "arrival_us"])
    )


def drop_replays_in_stream(events: DataFrame, within: str = "1 hour") -> DataFrame:
    """The same for a stream with an ``arrival_ts`` column; remembers ids for ``within``."""
    timed = events.withWatermark("arrival_ts", within)
    identified = timed.filter(F.col("event_id").isNotNull()).dropDuplicatesWithinWatermark(["event_id"])
    return identified.unionByName(timed.filter(F.col("event_id").isNull()))


def arrival_rate(events: DataFrame, seconds: float = REPORT_SECONDS) -> DataFrame:
    """Events per second in each report interval that has any."""
    start = F.col("interval_id") * size_micros(seconds)
    return (
        events.groupBy(window_index(own_time(), seconds).alias("interval_id"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            micros_to_seconds(start).alias("interval_start"),
            "events",
            (F.col("events") / F.lit(float(seconds))).alias("rate_per_second"),
        )
    )


def arrival_rate_overall(events: DataFrame) -> DataFrame:
    """Number of events, seconds from first to last and the mean rate (0 for no time)."""
    return events.agg(
        F.count(F.lit(1)).alias("events_produced"),
        micros_to_seconds(F.max(own_time()) - F.min(own_time())).alias("total_time"),
    ).withColumn(
        "avg_rate",
        F.when(F.col("total_time") > 0, F.col("events_produced") / F.col("total_time")).otherwise(0.0),
    )


def backlog_depth(events: DataFrame, seconds: float = REPORT_SECONDS, alert: int = BACKLOG_ALERT) -> DataFrame:
    """Events produced but not yet arrived at the end of each interval in which either
    happens.  Changes are added up per interval first; the running sum goes block by block."""
    changes = F.array(
        F.struct(window_index(own_time(), seconds).alias("interval_id"), F.lit(1).alias("change")),
        F.struct(window_index(F.col("arrival_us"), seconds).alias("interval_id"), F.lit(-1).alias("change")),
    )
    per_interval = events.select(F.inline(changes)).groupBy("interval_id").agg(F.sum("change").alias("change"))
    return running_total(per_interval, "interval_id", "change", bits=12).select(
        micros_to_seconds((F.col("interval_id") + 1) * size_micros(seconds)).alias("interval_end"),
        F.col("running").alias("depth"),
        (F.col("running") > alert).alias("alert"),
    )


def with_event_date(events: DataFrame) -> DataFrame:
    """``year, month, day`` of the event's own time, in UTC: the partition columns."""
    # Whole days rounded down, also before 1970.
    micros = F.lit(86_400 * MICROS).cast("long")
    day = F.date_from_unix_date(F.call_function("div", own_time() - F.pmod(own_time(), micros), micros).cast("int"))
    return events.withColumns({"year": F.year(day), "month": F.month(day), "day": F.day(day)})


_HISTORY = 12
_BLOCK = 1024


def fraud_spikes(totals: DataFrame, sigmas: float = 3.0, least: int = 5) -> DataFrame:
    """Windows whose fraud rate is above mean + ``sigmas`` deviations of the twelve
    windows before.  ``least`` of those must have had events.

    Windows are ordered in blocks of ids.  The last twelve ids of a block are copied into
    the next one as history, so that no task needs the whole sequence.
    """
    block = F.call_function("div", F.col("window_id"), F.lit(_BLOCK))
    later = F.call_function("div", F.col("window_id") + _HISTORY, F.lit(_BLOCK))
    placed = totals.select("window_id", "event_count", "fraud_rate_pct").withColumn(
        "block", F.explode(F.array_distinct(F.array(block, later)))
    )
    before = Window.partitionBy("block").orderBy("window_id").rangeBetween(-_HISTORY, -1)
    rate: Column = F.col("fraud_rate_pct")
    bar = F.col("mean_before") + sigmas * F.col("deviation_before")
    return (
        placed.withColumns(
            {
                "windows_before": F.count(F.lit(1)).over(before),
                "mean_before": F.avg(rate).over(before),
                "deviation_before": F.stddev_pop(rate).over(before),
            }
        )
        .filter(F.col("block") == block)
        # A rounded difference, so that a rate equal to a flat history is no spike.
        .withColumn("is_spike", (F.col("windows_before") >= least) & (F.round(rate - bar, 9) > 0))
        .select(
            "window_id",
            "event_count",
            "fraud_rate_pct",
            "windows_before",
            F.round("mean_before", 6).alias("mean_before"),
            F.round("deviation_before", 6).alias("deviation_before"),
            F.coalesce("is_spike", F.lit(False)).alias("is_spike"),
        )
    )
