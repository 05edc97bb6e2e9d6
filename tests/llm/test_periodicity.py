"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import pytest

from tests.llm.cases import TEXTS, edge, empty, frame
from txflow.llm import periodicity, queries


def plain_runs(words, least=12):
    """Every stretch of equal words at each distance, by its smallest period."""
    spans = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                spans.setdefault((i, j + q), q)  # the smallest distance comes first
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in spans.items() if e - s >= max(least, 2 * q)), key=lambda r: (r[0], r[2]))


def plain(text, least=12):
    words = (text or "").encode().split()
    runs = plain_runs(words, least)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return len(words), runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


@pytest.mark.parametrize("least", [2, 4, 5, 12])
def test_runs_of_random_words(least):
    rng = random.Random(least)
    for _ in range(400):
        words = []
        for _ in range(rng.randint(0, 6)):
            base = [rng.choice("abc"[: rng.randint(1, 3)]) for _ in range(rng.randint(1, 9))]
            words += base * rng.randint(1, 4) + base[: rng.randint(0, len(base))]
        assert periodicity.runs_of(words, least) == plain_runs(words, least), words


def test_runs_of_long_periods_and_fibonacci_words():
    rng = random.Random(3)
    base = [f"w{rng.randrange(60)}" for _ in range(700)]
    words = ["x"] + base * 2 + base[:100] + ["y"] * 30 + base[:200] * 3
    assert periodicity.runs_of(words) == plain_runs(words)
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    assert periodicity.runs_of(list(b)) == plain_runs(list(b))
    assert periodicity.runs_of(["z"] * 5000) == [(0, 5000, 1)]


def test_only_stretches_with_repeats_reach_the_automaton():
    line = [f"l{i}" for i in range(20)]
    unique = [f"u{i}" for i in range(400)]
    words = line + unique[:200] + line + unique[200:] + ["a", "b"] * 9
    import numpy as np

    codes = np.fromiter(map(hash, words), np.int64, len(words))
    assert periodicity._stretches(codes, 6) == [(len(words) - 18, len(words))]
    assert periodicity.runs_of(words) == [(len(words) - 18, 18, 2)]


def test_runs_of_rows(spark):
    short = [(i, t) for i, t in TEXTS if len(t or "") < 5000]
    texts = short + [(1, "one two " * 9 + "end"), (1, "one two " * 9 + "end"), (2, "É " * 12), (3, "a b c d e f " * 2), (4, "a " * 11)]
    rows = periodicity.find_runs(frame(spark, texts)).collect()
    want = [(i, *plain(t)) for i, t in texts]
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len(periodicity.find_runs(edge(spark)).collect()) == len(TEXTS)
    assert periodicity.find_runs(empty(spark)).collect() == []


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    docs = [(i, " ".join(f"v{rng.randrange(30)}" for _ in range(rng.choice([0, 1, 5, 40, 120])))) for i in range(150)]
    docs += [(i, t) for i, t in TEXTS if i is None or not t or len(t) < 5000]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in docs:
        words = (text or "").encode().split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        _, runs, kept = plain(b" ".join(words).decode())
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        told = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(runs), *longest, sha(told), sha(kept)))
    rows = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert sorted((tuple(r[c] for c in names) for r in rows), key=repr) == sorted(want, key=repr)
    assert any(w[1] for w in want) and any(not w[1] for w in want)
