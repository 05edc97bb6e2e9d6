"""Window operators against a plain, event-by-event computation."""

import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tests.compare import spark_rows
from txflow.operators import windows as W
from txflow.operators.delivery import (
    backlog_depth,
    drop_replays,
    fraud_spikes,
    resume_after,
    resume_first,
    with_event_date,
)
from txflow.operators.ranks import exact_percentiles

SCHEMA = (
    "event_id long, event_us long, arrival_us long, region string, product_category string, "
    "total double, is_fraud boolean"
)
SIZE = 5.0
SIZE_US = 5_000_000


def random_stream(seed, n=120):
    """Events in arrival order; some fields missing, some events late, some gaps."""
    rng = random.Random(seed)
    now, rows = 1_700_000_000_000_000 + rng.randint(0, SIZE_US), []
    for i in range(n):
        now += rng.choice([0, 1_000, 400_000, 2_000_000, 17_000_000])
        event = now - rng.choice([0, 3, 70_005, 900_000, 6_000_000, 40_000_000])
        rows.append(
            (
                i,
                rng.choice([event, event, event, None]),
                now,
                rng.choice(["N", "S", "E", None]),
                rng.choice(["Food", "Toys", None]),
                rng.choice([None, rng.randint(1, 10**6) / 100]),
                rng.choice([True, False, None]),
            )
        )
    return rows


def half_up(value, digits):
    step = Decimal(1).scaleb(-digits)
    return float(Decimal(value).quantize(step, ROUND_HALF_UP))


def stepwise(rows):
    """Follow the stream one event at a time with a single open window."""
    open_id, windows = None, {}
    for event_id, event_us, arrival, region, category, total, fraud in rows:
        own = arrival if event_us is None else event_us
        if open_id is None:
            open_id = own // SIZE_US
        elif arrival // SIZE_US > open_id:
            open_id = arrival // SIZE_US
        w = windows.setdefault(open_id, {"lat": [], "cents": 0, "fraud": 0, "late": 0, "r": Counter(), "c": Counter()})
        w["lat"].append(arrival - own)
        w["cents"] += round((total or 0) * 100)
        w["fraud"] += bool(fraud)
        w["late"] += own // SIZE_US < open_id
        w["r"][region or "Unknown"] += 1
        w["c"][category or "Unknown"] += 1
    return windows


def rank(values, p):
    return sorted(values)[min(int(p * len(values)), len(values) - 1)]


def ms(us):
    return half_up(Decimal(us) / 1000, 2)


def expected_rows(rows):
    result = []
    for wid, w in stepwise(rows).items():
        n = len(w["lat"])
        result.append(
            {
                "window_id": wid,
                "window_start": wid * SIZE,
                "window_end": (wid + 1) * SIZE,
                "duration_seconds": SIZE,
                "event_count": n,
                "throughput_per_second": n / SIZE,
                "total_revenue": w["cents"] / 100,
                "fraud_count": w["fraud"],
                "fraud_rate_pct": half_up(Decimal(w["fraud"]) / n * 100, 4),
                "latency_p50_ms": ms(rank(w["lat"], 0.50)),
                "latency_p95_ms": ms(rank(w["lat"], 0.95)),
                "latency_p99_ms": ms(rank(w["lat"], 0.99)),
                "latency_max_ms": ms(max(w["lat"])),
                "late_events": w["late"],
                # A Counter keeps first-seen order and max() takes the first of equals.
                "top_region": max(w["r"], key=w["r"].get),
                "top_category": max(w["c"], key=w["c"].get),
            }
        )
    return sorted(result, key=lambda r: r["window_id"])


def shuffled(spark, rows, seed=1):
    rows = list(rows)
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_window_stats_equal_the_stepwise_rule(spark, seed):
    rows = random_stream(seed)
    stats = W.window_stats(W.stamp_events(shuffled(spark, rows), SIZE), SIZE)
    assert stats.columns == W.RESULT_COLUMNS
    assert [r.asDict() for r in stats.orderBy("window_id").collect()] == expected_rows(rows)


def test_single_measures_agree_with_window_stats(spark):
    stamped = W.stamp_events(shuffled(spark, random_stream(4)), SIZE)
    stats = W.window_stats(stamped, SIZE)
    for part in (
        W.window_totals(stamped, SIZE),
        W.window_late_counts(stamped),
        W.window_latency_percentiles(stamped),
        W.window_top(stamped, "region", "top_region"),
        W.window_top(stamped, "product_category", "top_category"),
    ):
        assert spark_rows(part) == spark_rows(stats.select(part.columns))


def test_old_replay_leaves_one_event_in_its_own_window(spark):
    day = 86_400_000_000
    rows = [(i, 1_000_000 + i, day + i, "N", "Food", 1.0, False) for i in range(6)]
    result = W.window_stats(W.stamp_events(shuffled(spark, rows), SIZE), SIZE).orderBy("window_id").collect()
    assert [(r.window_id, r.event_count, r.late_events) for r in result] == [(0, 1, 0), (day // SIZE_US, 5, 5)]


def test_live_windows_have_no_first_event_rule(spark):
    rows = [(i, 1_000_000 + i, 86_400_000_000 + i, "N", "Food", 1.0, False) for i in range(6)]
    result = W.window_stats(W.stamp_events(shuffled(spark, rows), SIZE, replay=False), SIZE).collect()
    assert [(r.event_count, r.late_events) for r in result] == [(6, 6)]


def test_empty_windows_are_not_reported(spark):
    rows = [(0, 0, 0, "N", "Food", 1.0, False), (1, 20_000_000, 20_000_000, "N", "Food", 1.0, False)]
    result = W.window_stats(W.stamp_events(shuffled(spark, rows), SIZE), SIZE).collect()
    assert sorted(r.window_id for r in result) == [0, 4]


def test_overall_stats(spark):
    rows = random_stream(6, 200)
    latencies = [a - (a if e is None else e) for _, e, a, *_ in rows]
    stamped = W.stamp_events(shuffled(spark, rows), SIZE)
    windows = stepwise(rows)
    expected = {
        "total_events": len(rows),
        "total_windows": len(windows),
        "overall_latency_p50_ms": ms(rank(latencies, 0.50)),
        "overall_latency_p95_ms": ms(rank(latencies, 0.95)),
        "overall_latency_p99_ms": ms(rank(latencies, 0.99)),
        "overall_latency_max_ms": ms(max(latencies)),
        "avg_throughput_per_second": half_up(Decimal(len(rows)) / len(windows) / 5, 2),
    }
    assert W.overall_stats(stamped, SIZE).first().asDict() == expected
    assert W.overall_from_cells(W.label_cells(stamped), W.latency_cells(stamped), SIZE).first().asDict() == expected


def test_no_events_give_no_rows(spark):
    stamped = W.stamp_events(spark.createDataFrame([], SCHEMA), SIZE)
    assert W.window_stats(stamped, SIZE).collect() == []
    assert W.overall_stats(stamped, SIZE).collect() == []


def test_results_do_not_depend_on_partitioning(spark):
    rows = random_stream(8)
    one, many = spark.createDataFrame(rows, SCHEMA).coalesce(1), shuffled(spark, rows, 9).repartition(11)
    results = [spark_rows(W.window_stats(W.stamp_events(df, SIZE), SIZE)) for df in (one, many)]
    assert results[0] == results[1]


def test_negative_latency_and_times_before_the_epoch(spark):
    rows = [(0, 7_000_005, 7_000_000, "N", "Food", 1.0, False), (1, -6_000_000, 7_000_001, "N", "Food", -2.5, False)]
    row = W.window_stats(W.stamp_events(shuffled(spark, rows), SIZE), SIZE).first()
    assert (row.window_id, row.total_revenue, row.latency_p50_ms, row.late_events) == (1, -1.5, 13000.0, 1)
    only = W.window_stats(W.stamp_events(shuffled(spark, rows[:1]), SIZE), SIZE).first()
    assert only.latency_max_ms == -0.01


def test_event_time_windows_discard_what_comes_after_the_grace(spark):
    rows = [
        (0, 1_000_000, 1_000_000, "N", "Food", 1.0, False),
        (1, 4_900_000, 6_999_999, "N", "Food", 1.0, False),
        (2, 4_900_000, 7_000_000, "N", "Food", 1.0, False),
        (3, 5_000_000, 7_000_000, "N", "Food", 1.0, True),
    ]
    result = W.event_time_windows(shuffled(spark, rows), SIZE).orderBy("window_id").collect()
    assert [(r.window_id, r.event_count, r.fraud_count) for r in result] == [(0, 2, 0), (1, 1, 1)]


def test_resume_names_the_last_processed_event(spark):
    events = spark.createDataFrame([(i, i) for i in (None, -1, 0, 1, 2, 3, 4)], "event_id long, x long")
    assert sorted(r.event_id for r in resume_after(events, 1).collect()) == [2, 3, 4]
    assert sorted(r.event_id for r in resume_first(events, 1, 2).collect()) == [2, 3]
    # Both parts together are the whole stream: nothing is lost at the checkpoint.
    assert resume_after(events, 1).count() + events.filter("coalesce(event_id, -1) <= 1").count() == 7


def test_replays_are_dropped_but_events_without_id_are_not(spark):
    rows = [(1, 20, "b"), (1, 10, "a"), (2, 30, "c"), (None, 5, "x"), (None, 5, "x")]
    df = spark.createDataFrame(rows, "event_id long, arrival_us long, region string")
    kept = drop_replays(df)
    assert kept.columns == ["arrival_us", "event_id", "region"]
    assert sorted(tuple(r) for r in kept.filter("event_id is not null").collect()) == [(10, 1, "a"), (30, 2, "c")]
    assert kept.filter("event_id is null").count() == 2


def test_backlog(spark):
    second = 1_000_000
    rows = [(i, 0, 21 * second, "N", "Food", 1.0, False) for i in range(4)]
    rows += [(9, 6 * second, 7 * second, "N", "Food", 1.0, False)]
    result = backlog_depth(shuffled(spark, rows), 5, alert=3).orderBy("interval_end").collect()
    assert [tuple(r) for r in result] == [(5.0, 4, True), (10.0, 4, True), (25.0, 0, False)]


def test_fraud_spikes_equal_brute_force_across_blocks(spark):
    rng = random.Random(12)
    totals = {w: (10, float(rng.choice([0, 0, 1, 2, 50]))) for w in range(900, 2300) if rng.random() < 0.8}
    df = spark.createDataFrame([(w, n, r) for w, (n, r) in totals.items()], "window_id long, event_count long, fraud_rate_pct double")
    got = {r.window_id: (r.windows_before, r.is_spike) for r in fraud_spikes(df.repartition(4)).collect()}
    expected = {}
    for w, (_, r) in totals.items():
        before = [totals[v][1] for v in range(w - 12, w) if v in totals]
        mean = sum(before) / len(before) if before else 0
        deviation = (sum((x - mean) ** 2 for x in before) / len(before)) ** 0.5 if before else 0
        expected[w] = (len(before), len(before) >= 5 and r - mean - 3 * deviation > 1e-9)
    assert got == expected
    assert any(spike for _, spike in expected.values())


def test_flat_history_is_no_spike(spark):
    df = spark.createDataFrame([(w, 3, 33.3333) for w in range(30)], "window_id long, event_count long, fraud_rate_pct double")
    assert fraud_spikes(df).filter("is_spike").count() == 0


def test_window_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        W.assign_window(shuffled(spark, random_stream(1, 2)), 0)


def test_fractional_window_size(spark):
    df = spark.createDataFrame([(2_400_000,), (2_500_000,)], "event_us long").withColumn("arrival_us", F.col("event_us"))
    assert [r.event_window_id for r in W.assign_window(df, 2.5).collect()] == [0, 1]


def test_exactly_one_event_is_first(spark):
    """Three events without id arrive together first: one joins its own window."""
    rows = [(None, 1_000_000, 21_000_000, "N", "Food", 1.0, False)] * 3 + [(7, None, 22_000_000, "N", "Food", 1.0, False)]
    placed = W.stamp_events(spark.createDataFrame(rows, SCHEMA).repartition(3), SIZE)
    counts = {r.window_id: r["count"] for r in placed.groupBy("window_id").count().collect()}
    assert counts == {0: 1, 4: 3}


def test_of_equal_labels_the_pair_of_arrival_and_id_decides(spark):
    rows = [(5, None, 1_000_000, "A", "A"), (1, None, 2_000_000, "A", "A"), (3, None, 1_000_000, "B", "B"), (9, None, 2_000_000, "B", "B")]
    events = spark.createDataFrame([(*r, 1.0, False) for r in rows], SCHEMA)
    stamped = W.stamp_events(events, SIZE)
    assert W.window_top(stamped, "region", "top").first().top == "B"
    stats = W.window_stats(stamped, SIZE).first()
    assert (stats.top_region, stats.top_category) == ("B", "B")


def test_events_without_any_time_and_null_keys_are_errors(spark):
    events = spark.createDataFrame([(1, None, None, "N", "Food", 1.0, False)], SCHEMA)
    with pytest.raises(Exception, match="time of an event is null"):
        W.window_totals(W.stamp_events(events, SIZE, replay=False), SIZE).collect()
    rows = spark.createDataFrame([(None, 5), (1, 7)], "k long, v long")
    with pytest.raises(Exception, match="k is null"):
        exact_percentiles(rows, ["k"], "v", {"p50": 0.5}).collect()


def test_dates_before_1970(spark):
    events = spark.createDataFrame([(1, -1, 5), (2, 0, 5), (3, -86_400_000_001, 5)], "event_id long, event_us long, arrival_us long")
    days = [(r.year, r.month, r.day) for r in with_event_date(events).orderBy("event_id").collect()]
    assert days == [(1969, 12, 31), (1970, 1, 1), (1969, 12, 30)]


def test_approximate_percentiles_are_close(spark):
    events = [(i, (i * 7919 % 5000) * 1000, 10_000_000, "N", "Food", 1.0, False) for i in range(5000)]
    stamped = W.stamp_events(spark.createDataFrame(events, SCHEMA), SIZE, replay=False)
    exact, close = W.window_latency_percentiles(stamped).first(), W.window_latency_percentiles_approximate(stamped).first()
    for name in exact.asDict():
        assert abs(exact[name] - close[name]) <= 2
    assert exact.latency_max_ms == close.latency_max_ms
