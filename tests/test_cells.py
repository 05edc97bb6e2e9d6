"""The cell table of a stream: what batches open, merges, failures, clean-up."""

import random
import time

import pytest

from tests.compare import spark_rows
from tests.test_streaming import as_line, dirs, feed, in_batch, recorded  # noqa: F401
from tests.test_windows import SIZE
from txflow.streaming import cells
from txflow.streaming import windows as S


def test_what_a_batch_opens_stays_flat_over_many():
    rng = random.Random(1)
    parts, opened, rewritten = [], [], 0
    for batch in range(500):
        low = batch * 2 + rng.choice([0, 0, 1])
        straggler = rng.randrange(max(1, low)) if batch % 50 == 49 else None
        touched = [low, low + 1, low + 2] + ([straggler] if straggler is not None else [])
        if straggler is None:
            opened.append(len(cells.holding(parts, low, touched, 1)))
        parts = [*parts, cells.Part(cells.batch_folder(batch), 0, min(touched), max(touched))]
        while own := cells.full_level(parts):
            rewritten += len(own) ** own[0].level
            parts = [p for p in parts if p not in own] + [cells.merged_part(own, batch)]
        assert len(parts) <= 7 * 4
    assert max(opened[250:]) <= max(opened[:100]) + 1 <= 12
    assert len({p.folder for p in parts}) == len(parts)


def steady(n, step=2_500_000):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        at = 1_000_000_000 + i * step
        rows.append((i, at - rng.choice([0, 10, 900]), at, rng.choice(["N", "S"]), rng.choice(["Food", "Toys"]), i / 8, i % 5 == 0))
    return rows


def test_merged_cells_give_the_same_windows(spark, feed, dirs, monkeypatch):  # noqa: F811
    out, checkpoint = dirs
    monkeypatch.setattr(cells, "FANOUT", 3)
    monkeypatch.setattr(cells, "KEPT", 2)
    rows = steady(44)
    rows[30] = (30, None, rows[2][2], "S", "Toys", 2.5, True)  # reaches a window reported long before
    for cut in range(0, 44, 4):
        feed.add([as_line(r) for r in rows[cut : cut + 4]])
        time.sleep(0.05)
    S.run(recorded(spark, feed, files_per_batch=1), out, checkpoint, SIZE)
    table = cells.latest(spark, out)
    assert table.batch_id == 10 and max(p.level for p in table.parts) == 2 and len(table.parts) <= 4
    assert table.opened <= 4
    S.flush(spark, out, SIZE)
    assert spark_rows(S.read_results(spark, out, flushed=True)) == in_batch(spark, rows)
    # Folders that no kept manifest names are gone, those that one names are there.
    there = {p.name for p in (feed.path.parent / "out" / "cells" / "labels").iterdir() if not p.name.startswith((".", "_"))}
    assert len(there) <= 2 * 3 and {p.folder for p in table.parts if p.level == 0} <= there
    assert len(list((feed.path.parent / "out" / "manifests").glob("[0-9]*.json"))) == 2


@pytest.mark.parametrize("at", ["compacted", "publish"])
def test_a_batch_that_fails_late_runs_again(spark, feed, dirs, monkeypatch, at):  # noqa: F811
    out, checkpoint = dirs
    monkeypatch.setattr(cells, "FANOUT", 2)
    rows = steady(16)
    for cut in range(0, 16, 4):
        feed.add([as_line(r) for r in rows[cut : cut + 4]])
        time.sleep(0.05)
    good, calls = getattr(cells, at), []

    def fails(*args, **kwargs):
        done = good(*args, **kwargs)
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return done

    monkeypatch.setattr(cells, at, fails)
    with pytest.raises(Exception, match="lost"):
        S.run(recorded(spark, feed, files_per_batch=1), out, checkpoint, SIZE)
    S.run(recorded(spark, feed, files_per_batch=1), out, checkpoint, SIZE)
    S.flush(spark, out, SIZE)
    assert spark_rows(S.read_results(spark, out, flushed=True)) == in_batch(spark, rows)


def test_cells_read_while_the_stream_goes_on_are_those_of_one_batch(spark, feed, dirs, monkeypatch):  # noqa: F811
    out, checkpoint = dirs
    monkeypatch.setattr(cells, "FANOUT", 2)
    rows = steady(24)
    feed.add([as_line(r) for r in rows[:8]])
    S.run(recorded(spark, feed), out, checkpoint, SIZE)
    labels, _ = S.read_cells(spark, out, SIZE)
    before = sorted(labels.select("window_id", "events").collect())
    for cut in (8, 16):
        feed.add([as_line(r) for r in rows[cut : cut + 8]])
        S.run(recorded(spark, feed), out, checkpoint, SIZE)
    assert sorted(labels.select("window_id", "events").collect()) == before
