"""Outputs that are published as a whole."""

import pytest
from pyspark.sql import functions as F

from txflow.plans import batch as B
from txflow.sinks import versions
from txflow.sources.synthetic import synthesize_range


def counts(spark, folder):
    """(rows of the featured table, rows the summaries were made of, rows the metrics tell)"""
    featured = spark.read.parquet(f"{folder}/featured_transactions").count()
    told = spark.read.option("header", True).csv(f"{folder}/region_stats")
    summed = told.agg(F.sum(F.col("transaction_count").cast("long"))).first()[0]
    return featured, summed, spark.read.json(f"{folder}/run_metrics").first().clean_row_count


def test_a_reader_always_sees_one_whole_run(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    for n in (500, 900):
        synthesize_range(spark, n).write.option("header", True).csv(str(tmp_path / f"in{n}"))
    assert versions.current(spark, out) is None
    B.publish_batch(spark, str(tmp_path / "in500"), out)
    first = versions.current(spark, out)
    assert counts(spark, first) == (500, 500, 500)

    # Between any two outputs of the second run, readers see the first one whole.
    seen, write = [], B.write_summary

    def watched(*args):
        seen.append((versions.current(spark, out), counts(spark, versions.current(spark, out))))
        write(*args)

    monkeypatch.setattr(B, "write_summary", watched)
    B.publish_batch(spark, str(tmp_path / "in900"), out)
    assert len(seen) == 4 and set(seen) == {(first, (500, 500, 500))}
    assert counts(spark, versions.current(spark, out)) == (900, 900, 900)
    # Who began with the first version can finish.
    assert counts(spark, first) == (500, 500, 500)


def test_a_run_that_fails_leaves_the_last_version(spark, tmp_path):
    out = str(tmp_path / "out")

    def write(n):
        def run(folder):
            spark.range(n).write.parquet(f"{folder}/t")
            if n == 3:
                raise RuntimeError("lost")
            return n

        return run

    assert versions.publish(spark, out, write(2)) == 2
    before = versions.current(spark, out)
    with pytest.raises(RuntimeError, match="lost"):
        versions.publish(spark, out, write(3))
    assert versions.current(spark, out) == before and spark.read.parquet(f"{before}/t").count() == 2
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 1
    for n in (4, 5, 6, 7, 8):
        versions.publish(spark, out, write(n), keep=2)
    kept = [p for p in (tmp_path / "out" / "versions").iterdir() if not p.name.startswith(".")]
    assert len(kept) == 3 and spark.read.parquet(f"{versions.current(spark, out)}/t").count() == 8
