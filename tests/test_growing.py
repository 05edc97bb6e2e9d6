"""Files that are appended to while a stream reads them."""

import json
import random

import pytest

from txflow.schemas import RECORDED_EVENT_SCHEMA
from txflow.sources import growing
from txflow.sources.events import tail_events, tail_lines
from txflow.streaming import windows as S


def lines_read(spark, path, out, checkpoint, **options):
    S.append_to(tail_lines(spark, str(path), **options), str(out), str(checkpoint))
    return [r.value for r in spark.read.parquet(str(out)).collect()]


def append(path, data):
    with open(path, "ab") as file:
        file.write(data)


def test_a_growing_file_gives_each_line_once(spark, tmp_path):
    path, out, checkpoint = tmp_path / "live.jsonl", tmp_path / "out", tmp_path / "checkpoint"
    append(path, b"one\ntwo\r\n\n  \nthr")
    assert sorted(lines_read(spark, path, out, checkpoint)) == ["one", "two"]
    # Nothing new: the cut line still waits.
    assert sorted(lines_read(spark, path, out, checkpoint)) == ["one", "two"]
    append(path, b"ee\nfo")
    assert sorted(lines_read(spark, path, out, checkpoint)) == ["one", "three", "two"]
    append(path, "ur é\n\xff".encode() + b"\xff\nfive\n")
    want = ["five", "four é", "one", "three", "two", "ÿ\ufffd"]
    assert sorted(lines_read(spark, path, out, checkpoint)) == sorted(want)


def test_ranges_cut_lines_anywhere(tmp_path, monkeypatch):
    rng = random.Random(2)
    lines = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 5, 40]))).encode() for _ in range(200)]
    data = b"\n".join(lines) + b"\nrest"
    path = tmp_path / "f"
    path.write_bytes(data)
    monkeypatch.setattr(growing, "_BLOCK", 7)
    for size in (1, 2, 3, 10, 1000):
        reader = growing.GrowingLinesReader(str(path), size)
        end = reader.latestOffset()
        assert end == {"f": len(data) - 4}
        for first in (0, len(lines[0]) + 1):
            ranges = reader.partitions({"f": first}, end)
            got = [x for r in ranges for some in growing.lines_of(r) for x in some]
            assert got == (lines if not first else lines[1:])


def test_a_folder_of_growing_files(spark, tmp_path):
    path, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint"
    path.mkdir()
    append(path / "a", b"a1\na2\n")
    append(path / "_SUCCESS", b"no\n")
    append(path / ".b.crc", b"no\n")
    assert sorted(lines_read(spark, path, out, checkpoint, range_bytes=2)) == ["a1", "a2"]
    append(path / "b", b"b1\n")
    append(path / "a", b"a3\n")
    assert sorted(lines_read(spark, path, out, checkpoint, range_bytes=2)) == ["a1", "a2", "a3", "b1"]
    assert growing.GrowingLinesReader(str(tmp_path / "none"), 9).latestOffset() == {}


def test_a_file_that_shrinks_is_an_error(spark, tmp_path):
    path = tmp_path / "f"
    path.write_bytes(b"one\ntwo\n")
    assert lines_read(spark, path, tmp_path / "out", tmp_path / "checkpoint")
    path.write_bytes(b"one\n")
    with pytest.raises(Exception, match="shorter than it was"):
        lines_read(spark, path, tmp_path / "out", tmp_path / "checkpoint")


def test_a_live_file_feeds_events(spark, tmp_path):
    path, out, checkpoint = tmp_path / "live", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    events = [{"event_id": i, "region": "North", "arrival": float(i)} for i in range(30)]
    for i in range(0, 30, 10):
        # The last line of each part is cut.
        text = "".join(json.dumps(e) + "\n" for e in events[i : i + 10])
        append(path, text[:-5].encode())
        S.append_to(tail_events(spark, str(path), RECORDED_EVENT_SCHEMA), out, checkpoint)
        assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == list(range(i + 9))
        append(path, text[-5:].encode())
