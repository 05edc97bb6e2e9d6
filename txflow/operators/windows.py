"""Tumbling windows over events.

Events carry ``event_id, event_us, arrival_us, region, product_category, total,
is_fraud``.  Windows follow the arrival clock: an event joins the window that is open
when it arrives, and is late when its own time belongs to an earlier one.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.functions.money import aliased_parts, money_total, parts_of, split_amount, sum_parts
from txflow.functions.timing import micros_to_seconds, size_micros, window_index
from txflow.operators.ranks import approximate_percentiles, exact_percentiles, required
from txflow.schemas import LATENCY_RANKS, MICROS, NO_EVENT_ID, UNKNOWN


def own_time() -> Column:
    """Event time; an event without one happened when it arrived."""
    return F.coalesce("event_us", "arrival_us")


def event_latency(events: DataFrame) -> DataFrame:
    """``latency_us``: arrival minus event time, 0 if the event carries no time."""
    return events.withColumn("latency_us", F.col("arrival_us") - own_time())


def _placed(window: Column) -> Column:
    """A window id, stated never to be null, as every event arrives; an event without any
    time ends the job.  Joins on it would otherwise push null checks, with the whole
    computation of the id, down to the scan."""
    return required(window, T.LongType(), "the time of an event")


def assign_window(events: DataFrame, size: float) -> DataFrame:
    """``event_window_id``: the window of the event's own time."""
    return events.withColumn("event_window_id", _placed(window_index(own_time(), size)))


def assign_open_window(events: DataFrame, size: float, replay: bool = True) -> DataFrame:
    """``window_id``: the window that is open when the event arrives.

    A replay of a whole recorded stream starts in the window of its first event's own
    time and moves on with the arrival clock, never back.  That first event is exactly one
    row: the one of lowest arrival, then id, then content; of rows equal in all fields any
    one.  Two small jobs find it up front: the lowest arrival and id, from two columns, and
    what the rows that have them hold, which is a point lookup.  The plan itself then has one
    scan of the columns it needs.  A live stream (``replay=False``) has no first event.
    """
    arrival_window = _placed(window_index(F.col("arrival_us"), size))
    timed = assign_window(events, size)
    if not replay:
        return timed.withColumn("window_id", arrival_window)
    lowest = events.agg(F.min(F.struct("arrival_us", _event_id().alias("event_id"))).alias("row")).first()["row"]
    if lowest is None or lowest.arrival_us is None:
        return timed.withColumn("window_id", arrival_window)
    heads = (F.col("arrival_us") == lowest.arrival_us) & _has_id(lowest.event_id)
    content = F.xxhash64(*events.columns)
    ends = timed.filter(heads).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(content, "event_window_id")).alias("first")).first()
    start = ends["first"].event_window_id
    later = _placed(F.greatest(F.lit(start), arrival_window))
    heads = F.coalesce(heads, F.lit(False))
    if ends["n"] == 1:
        return timed.withColumn("window_id", _placed(F.when(heads, F.lit(start)).otherwise(later)))
    by_content = Window.partitionBy("arrival_us").orderBy(content)
    copies = timed.filter(heads).withColumn("copy", F.row_number().over(by_content))
    first = copies.withColumn("window_id", _placed(F.when(F.col("copy") == 1, F.lit(start)).otherwise(later))).drop("copy")
    return timed.filter(~heads).withColumn("window_id", later).unionByName(first)


def mark_late(events: DataFrame) -> DataFrame:
    """``is_late``: the event belongs to a window before the open one.  It is kept."""
    return events.withColumn("is_late", F.col("event_window_id") < F.col("window_id"))


def stamp_events(events: DataFrame, size: float, replay: bool = True) -> DataFrame:
    """Latency, both windows and lateness; no shuffle."""
    return mark_late(assign_open_window(event_latency(events), size, replay))


def late_events(stamped: DataFrame) -> DataFrame:
    return stamped.filter("is_late")


def with_bounds(windows: DataFrame, size: float) -> DataFrame:
    """Start, end and length of each window in seconds."""
    start = F.col("window_id") * size_micros(size)
    return windows.withColumns(
        {
            "window_start": micros_to_seconds(start),
            "window_end": micros_to_seconds(start + size_micros(size)),
            "duration_seconds": F.lit(float(size)),
        }
    )


def _event_id() -> Column:
    return F.coalesce("event_id", F.lit(NO_EVENT_ID))


def _has_id(event_id: int) -> Column:
    """The event has this id, in a form that scans can skip by."""
    own = F.col("event_id") == event_id
    return own | F.col("event_id").isNull() if event_id == NO_EVENT_ID else own


def first_seen() -> Column:
    """Arrival and id as one number, which orders like the pair.  A struct would turn the hash
    aggregates below into sorts of all events.  Arrivals up to year 170,000 fit; a later one is
    an error."""
    return (F.col("arrival_us").cast("decimal(19,0)") * Decimal(1 << 64) + _event_id().cast("decimal(19,0)")).cast("decimal(38,0)")


def _frequency() -> Column:
    """Orders counted labels, the top one lowest: the most events, then the label seen first.
    (Negating a decimal of more than 34 digits would round it.)"""
    return F.struct((-F.col("events")).alias("fewer"), "first_seen")


def _label(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(UNKNOWN))


# --- cells: the mergeable form of a window ----------------------------------
#
# A window is kept as two kinds of counted cells: label cells, one per region and category,
# and latency cells, one per distinct latency, which only count.  Cells add up, so the same
# ones serve a batch aggregate, the micro-batches of a stream and a table that outlives it;
# and no cell grows with the data.

LABEL_KEY = ["region", "product_category"]


def result_latency() -> Column:
    """Latency rounded to the 10 microseconds results are given in.  Rounding keeps the
    order, so it may come before ranking, where it makes far fewer distinct values."""
    return F.round("latency_us", -1)


def label_cells(stamped: DataFrame) -> DataFrame:
    """Per window, region and category: events, revenue, fraud, lateness, first and last seen."""
    amount = split_amount(F.coalesce(F.col("total"), F.lit(0.0)))
    return stamped.groupBy("window_id", *[_label(c).alias(c) for c in LABEL_KEY]).agg(
        F.count(F.lit(1)).alias("events"),
        *aliased_parts(sum_parts(amount), "total"),
        F.count_if(F.coalesce(F.col("is_fraud"), F.lit(False))).alias("fraud"),
        F.count_if("is_late").alias("late"),
        F.min(first_seen()).alias("first_seen"),
        F.max("arrival_us").alias("last_us"),
    )


def latency_cells(stamped: DataFrame) -> DataFrame:
    """Per window and latency: the number of events."""
    rounded = stamped.select("window_id", result_latency().alias("latency_us"))
    return rounded.groupBy("window_id", "latency_us").agg(F.count(F.lit(1)).alias("events"))


def merge_label_cells(labels: DataFrame) -> DataFrame:
    """Cells stored in several parts as one each."""
    return labels.groupBy("window_id", *LABEL_KEY).agg(
        F.sum("events").alias("events"),
        *aliased_parts(sum_parts(parts_of("total")), "total"),
        F.sum("fraud").alias("fraud"),
        F.sum("late").alias("late"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_us").alias("last_us"),
    )


def merge_latency_cells(latencies: DataFrame) -> DataFrame:
    """Cells stored in several parts as one each."""
    return latencies.groupBy("window_id", "latency_us").agg(F.sum("events").alias("events"))


def cell_totals(labels: DataFrame, size: float) -> DataFrame:
    """Per window: counts, revenue, fraud, lateness, top region and top category.

    Of equally frequent labels the one that was seen first wins: lowest arrival, then lowest
    id of that arrival.  Cells of one window may be stored in several parts.
    """
    by_label = labels.groupingSets(
        [[F.col("window_id"), F.col("region")], [F.col("window_id"), F.col("product_category")]],
        "window_id",
        *LABEL_KEY,
    ).agg(
        (F.grouping("region") == 0).alias("of_region"),
        F.sum("events").alias("events"),
        *aliased_parts(sum_parts(parts_of("total")), "total"),
        F.sum("fraud").alias("fraud"),
        F.sum("late").alias("late"),
        F.min("first_seen").alias("first_seen"),
    )
    once = F.col("of_region")
    sums = sum_parts({part: F.when(once, column) for part, column in parts_of("total").items()})
    totals = by_label.groupBy("window_id").agg(
        F.sum(F.when(once, F.col("events"))).alias("event_count"),
        money_total(sums).alias("total_revenue"),
        F.sum(F.when(once, F.col("fraud"))).alias("fraud_count"),
        F.sum(F.when(once, F.col("late"))).alias("late_events"),
        F.min_by("region", F.when(once, _frequency())).alias("top_region"),
        F.min_by("product_category", F.when(~once, _frequency())).alias("top_category"),
    )
    return _with_rates(totals, size)


def _with_rates(totals: DataFrame, size: float) -> DataFrame:
    return totals.withColumns(
        {
            "throughput_per_second": F.col("event_count") / F.lit(float(size)),
            "fraud_rate_pct": F.round(F.col("fraud_count") / F.col("event_count") * 100, 4),
        }
    )


_RANKED = {**LATENCY_RANKS, "max": 1.0}


def _latency_ms(percentiles: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return percentiles.select(
        *keys, *[(F.col(name) / F.lit(1000.0)).alias(f"{prefix}_{name}_ms") for name in _RANKED]
    )


def cell_percentiles(latencies: DataFrame) -> DataFrame:
    """Per window: exact p50, p95, p99 and maximum latency in milliseconds."""
    ranked = exact_percentiles(merge_latency_cells(latencies), ["window_id"], "latency_us", _RANKED, weight="events")
    return _latency_ms(ranked, "latency", ["window_id"])


RESULT_COLUMNS = [
    "window_id",
    "window_start",
    "window_end",
    "duration_seconds",
    "event_count",
    "throughput_per_second",
    "total_revenue",
    "fraud_count",
    "fraud_rate_pct",
    "latency_p50_ms",
    "latency_p95_ms",
    "latency_p99_ms",
    "latency_max_ms",
    "late_events",
    "top_region",
    "top_category",
]


def finish_windows(labels: DataFrame, latencies: DataFrame, size: float) -> DataFrame:
    """The result rows of the windows whose cells these tables hold whole."""
    joined = cell_totals(labels, size).join(cell_percentiles(latencies), "window_id")
    return with_bounds(joined, size).select(*RESULT_COLUMNS)


def window_stats(stamped: DataFrame, size: float) -> DataFrame:
    """One result row per non-empty window, the last, partial one included."""
    return finish_windows(label_cells(stamped), latency_cells(stamped), size)


# --- single measures, each from only the columns it needs -------------------


def window_totals(stamped: DataFrame, size: float) -> DataFrame:
    amount = F.coalesce(F.col("total"), F.lit(0.0))
    totals = stamped.groupBy("window_id").agg(
        F.count(F.lit(1)).alias("event_count"),
        money_total(sum_parts(split_amount(amount))).alias("total_revenue"),
        F.count_if(F.coalesce(F.col("is_fraud"), F.lit(False))).alias("fraud_count"),
    )
    return with_bounds(_with_rates(totals, size), size)


def window_late_counts(stamped: DataFrame) -> DataFrame:
    return stamped.groupBy("window_id").agg(F.count_if("is_late").alias("late_events"))


def window_latency_percentiles(stamped: DataFrame) -> DataFrame:
    rounded = stamped.select("window_id", result_latency().alias("latency_us"))
    ranked = exact_percentiles(rounded, ["window_id"], "latency_us", _RANKED)
    return _latency_ms(ranked, "latency", ["window_id"])


def window_latency_percentiles_approximate(stamped: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """The same with ranks that may be off by ``1 / accuracy`` of a window's events; a sketch
    per window takes the place of a row per distinct latency."""
    rounded = stamped.select("window_id", result_latency().alias("latency_us"))
    return _latency_ms(approximate_percentiles(rounded, ["window_id"], "latency_us", _RANKED, accuracy), "latency", ["window_id"])


def window_top(stamped: DataFrame, column: str, alias: str) -> DataFrame:
    """Per window, the most frequent value of ``column``; of equals, the one seen first."""
    return (
        stamped.groupBy("window_id", _label(column).alias("label"))
        .agg(F.count(F.lit(1)).alias("events"), F.min(first_seen()).alias("first_seen"))
        .groupBy("window_id")
        .agg(F.min_by("label", _frequency()).alias(alias))
    )


def _overall(counts: DataFrame, latencies: DataFrame, size: float, weight: str | None) -> DataFrame:
    ranked = _latency_ms(exact_percentiles(latencies, [], "latency_us", _RANKED, weight), "overall_latency", [])
    # The mean of per-window throughput is all events over all windows over the size.
    mean = F.col("total_events") / F.col("total_windows") / F.lit(float(size))
    return (
        counts.filter("total_events > 0")
        .withColumn("ranked", ranked.select(F.struct("*")).scalar())
        .select("total_events", "total_windows", "ranked.*", F.round(mean, 2).alias("avg_throughput_per_second"))
    )


def overall_stats(stamped: DataFrame, size: float) -> DataFrame:
    """One row over all events and windows; none if there are no events."""
    per_window = stamped.groupBy("window_id").agg(F.count(F.lit(1)).alias("events"))
    counts = per_window.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"), F.count(F.lit(1)).alias("total_windows")
    )
    return _overall(counts, stamped.select(result_latency().alias("latency_us")), size, None)


def overall_from_cells(labels: DataFrame, latencies: DataFrame, size: float) -> DataFrame:
    """The same row from the cells of all windows."""
    per_window = labels.groupBy("window_id").agg(F.sum("events").alias("events"))
    counts = per_window.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"), F.count(F.lit(1)).alias("total_windows")
    )
    by_latency = latencies.groupBy("latency_us").agg(F.sum("events").alias("events"))
    return _overall(counts, by_latency, size, "events")


def before_grace(window: Column, size: float, grace: float) -> Column:
    """The event arrives no later than ``grace`` seconds after the window's end."""
    return F.col("arrival_us") < (window + 1) * size_micros(size) + round(grace * MICROS)


def event_time_windows(events: DataFrame, size: float, grace: float = 2.0) -> DataFrame:
    """Totals by the event's own window; events that arrive more than ``grace`` seconds
    after their window's end are discarded."""
    own = assign_window(events, size).withColumn("window_id", F.col("event_window_id"))
    return window_totals(own.filter(before_grace(F.col("window_id"), size, grace)), size)
