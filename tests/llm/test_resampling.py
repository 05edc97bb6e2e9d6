"""Importance resampling against a plain computation."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LONG, TEXTS, edge, empty, frame
from txflow.llm import resampling
from txflow.llm.ordering import numbered

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    w = WORD.findall((text or "").translate(UPPER))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def plain(docs, target, buckets=10_000, percent=25, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text):
                counts[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, text in docs:
        own = [gain[bucket(f)] for f in features(text)]
        weight = math.floor(sum(own) / len(own)) if own else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((r for r in out if r[1] >= 2 * least - 1), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = fit[: len(fit) * percent // 100]
    rest = list(out)
    for r in drawn:
        rest.remove(r)
    return sorted([(*r, k + 1) for k, r in enumerate(drawn)] + [(*r, None) for r in rest], key=repr)


def sample(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Über", "É", "x1", "don't"]
    return [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 19, 20, 21, 60])))) for i in range(n)]


@pytest.mark.parametrize("error", [0.002, 1e-9, 2.0])
def test_draw_equals_plain_computation(spark, error):
    docs = sample(300, 1)
    # Copies of one row share its score and its id.
    docs += [(7, " ".join(["same"] * 25))] * 40 + [(None, " ".join(["none"] * 25))] * 40
    target = [t for _, t in sample(30, 2)]
    marked = spark.createDataFrame([(t, "x") for t in target], "text string, rank string")
    rows = resampling.resample(frame(spark, docs), marked, error=error).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == plain(docs, target)


def test_a_bracket_that_misses_is_widened(spark):
    pool = spark.createDataFrame([(i % 7, i, i) for i in range(5000)], "score long, doc_id long, tie long").repartition(3)
    order = sorted(((i % 7, i) for i in range(5000)), key=lambda r: (-r[0], r[1]))
    for k in (1, 2, 714, 2500, 4999, 5000):
        for error in (1e-12, 0.01):
            cut = resampling.find_cut(pool, 5000, k, error)
            assert (cut.score, cut.doc_id) == order[k - 1]


def test_rows_are_numbered_across_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"), F.lit("n").alias("n")).repartition(7)
    rows = numbered(df, [F.col("v").desc()], "numbered").collect()
    assert sorted((r.number, r.v) for r in rows) == [(i + 1, 999 - i) for i in range(1000)]


def test_pieces_of_a_long_text_make_the_same_features():
    whole = np.concatenate(list(resampling.feature_buckets(LONG)))
    for piece in (1, 50, 4096):
        parts = np.concatenate(list(resampling.feature_buckets(LONG, piece=piece)))
        assert np.array_equal(np.sort(parts), np.sort(whole))
    assert len(whole) == 2 * 60_000 * 1 - 1 == len(features(LONG))


def test_edge_rows(spark):
    rows = resampling.resample(edge(spark), edge(spark)).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == plain(TEXTS, [t for _, t in TEXTS])
    assert sorted((tuple(r) for r in resampling.resample(edge(spark), empty(spark)).collect()), key=repr) == plain(TEXTS, [])
    assert resampling.resample(empty(spark), edge(spark)).collect() == []
    everything = resampling.resample(edge(spark), edge(spark), percent=100, least_words=0).collect()
    assert sum(r["rank"] is not None for r in everything) == sum(bool(features(t)) for _, t in TEXTS)
