import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.compare import spark_rows
from txflow.operators.cleaning import clean_transactions
from txflow.operators.delivery import with_event_date
from txflow.operators.features import engineer_features
from txflow.operators.summaries import SUMMARIES
from txflow.plans.batch import run_batch
from txflow.plans.replay import run_replay
from txflow.sinks import tables
from txflow.sinks.scratch import scratch_dir
from txflow.sources.synthetic import synthesize_range


def data_files(path):
    return sorted(p for p in Path(path).rglob("part-*"))


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("batch")
    rows = synthesize_range(spark, 4000).withColumn("amount", F.when(F.col("transaction_id") % 10 != 0, F.col("amount")))
    rows.write.option("header", True).csv(str(folder / "in"))
    return folder, rows, run_batch(spark, str(folder / "in"), str(folder / "out"), show=True)


def test_batch_outputs(spark, batch):
    folder, rows, _ = batch
    featured = engineer_features(clean_transactions(rows))
    written = spark.read.parquet(str(folder / "out" / "featured_transactions"))
    assert spark_rows(written) == spark_rows(featured)
    for name, summarize in SUMMARIES.items():
        expected = summarize(featured)
        path = str(folder / "out" / name)
        assert spark_rows(tables.read_summary(spark, path, expected.schema)) == spark_rows(expected)


def test_batch_metrics(spark, batch):
    folder, _, metrics = batch
    assert (metrics["row_count"], metrics["clean_row_count"], metrics["removed_row_count"]) == (4000, 3600, 400)
    (written,) = data_files(folder / "out" / "run_metrics")
    assert json.loads(written.read_text()) == metrics
    assert set(metrics["steps"]) == {"featured_transactions", "by_region_and_time", "by_user_and_category", *SUMMARIES}


def test_batch_overwrites(spark, batch):
    folder, _, first = batch
    again = run_batch(spark, str(folder / "in"), str(folder / "out"), partitions=3)
    assert again["row_count"] == first["row_count"]
    assert spark.read.parquet(str(folder / "out" / "featured_transactions")).count() == first["clean_row_count"]


def test_small_summary_is_one_sorted_file(spark, tmp_path):
    featured = engineer_features(clean_transactions(synthesize_range(spark, 4000)))
    tables.write_summary(SUMMARIES["region_stats"](featured), str(tmp_path / "s"))
    (part,) = data_files(tmp_path / "s")
    header, *lines = part.read_text().splitlines()
    assert header.startswith("region,transaction_count,")
    revenue = [float(line.split(",")[3]) for line in lines]
    assert len(revenue) == 5 and revenue == sorted(revenue, reverse=True)


def test_date_partitions(spark, tmp_path):
    day = 86_400_000_000
    events = spark.range(3000).select(
        F.col("id").alias("event_id"),
        # Two thirds of all events fall on one day.
        (F.when(F.col("id") % 3 != 0, 19_700 * day).otherwise((19_000 + F.col("id") % 5) * day) + F.col("id")).alias("event_us"),
        F.lit(0).cast("long").alias("arrival_us"),
    )
    path = str(tmp_path / "by-date")
    tables.write_by_date(events, path)
    stored = spark.read.parquet(path)
    assert spark_rows(stored.select(*events.columns)) == spark_rows(events)
    assert spark_rows(stored) == spark_rows(with_event_date(events))
    one_day = stored.filter("year = 2023 and month = 12 and day = 9")
    assert one_day.count() == 2000
    assert "PartitionFilters: [isnotnull(year" in one_day._jdf.queryExecution().executedPlan().toString()
    assert len(data_files(path)) <= 12


def test_replay_job(spark, tmp_path):
    lines = [json.dumps({"event_id": i, "timestamp": 100.0 + i, "arrival": 100.5 + i, "total": 1.25}) for i in range(20)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join([*lines, "{broken"]))
    run_replay(spark, str(tmp_path / "in"), str(tmp_path / "out"), 5.0)
    windows = spark.read.json(str(tmp_path / "out" / "window_results")).orderBy("window_id").collect()
    assert [(w.window_id, w.event_count, w.total_revenue) for w in windows] == [(i, 5, 6.25) for i in range(20, 24)]
    assert [w.latency_p99_ms for w in windows] == [500.0] * 4
    overall = spark.read.json(str(tmp_path / "out" / "consumer_metrics")).first()
    assert (overall.total_events, overall.total_windows, overall.avg_throughput_per_second) == (20, 4, 1.0)


class FakeSession:
    def __init__(self, master, shared):
        self.sparkContext = type("C", (), {"master": master})
        self.conf = type("F", (), {"get": staticmethod(lambda key, default: shared)})


def test_scratch_folders(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one.startswith(shared) and one != two
    assert Path(scratch_dir(FakeSession("local[2]", None), "x")).is_dir()
    with pytest.raises(ValueError):
        scratch_dir(FakeSession("yarn", None), "x")
