"""Removal of later copies against a table of all windows."""

import random

import pytest

from tests.llm.cases import TEXTS, edge, empty, frame
from txflow.llm import suffixes


def plain(docs, window=100):
    """(id, bytes, kept, spans) with rows of one id and text as one document."""
    distinct = sorted(dict.fromkeys((i is None, i or 0, t or "") for i, t in docs))
    seen, out = set(), {}
    for no_id, i, text in distinct:
        data = text.encode()
        covered = bytearray(len(data) + 1)
        until = 0
        for s in range(len(data) - window + 1):
            w = data[s : s + window]
            if w in seen:
                for b in range(max(s, until), s + window):
                    covered[b] = 1
                until = s + window
            seen.add(w)
        spans, start = [], None
        for b in range(len(data) + 1):
            if covered[b] and start is None:
                start = b
            if not covered[b] and start is not None:
                spans.append((start, b))
                start = None
        out[no_id, i, text] = (len(data), bytes(x for x, c in zip(data, covered, strict=False) if not c), spans)
    return sorted(((i, *out[i is None, i or 0, t or ""]) for i, t in docs), key=repr)


def found(spark, docs):
    rows = suffixes.remove_later_copies(frame(spark, docs)).collect()
    return sorted(((r.doc_id, r.n_bytes, bytes(r.kept), [(s.start, s.end) for s in r.spans]) for r in rows), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_copies_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(suffixes, "_AREA", 4096)
    rng = random.Random(seed)
    letters = "abcdefghijklmnop é"
    passages = ["".join(rng.choice(letters) for _ in range(rng.choice([60, 99, 100, 101, 140, 300, 700]))) for _ in range(25)]
    docs = []
    for i in range(150):
        text = ""
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.6:
                piece = list(rng.choice(passages))
                for _ in range(rng.choice([0, 0, 0, 1, 2])):
                    piece[rng.randrange(len(piece))] = rng.choice("XYZ")
                text += "".join(piece[rng.choice([0, 0, 7, 40]) :])
            elif kind < 0.7:
                text += rng.choice(["ab", "z", "xyx", "=" * 3]) * rng.randint(1, 130)
            else:
                text += "".join(rng.choice(letters) for _ in range(rng.randint(1, 150)))
        docs.append((i * 7 % 151, text))
    docs += [docs[3], docs[3], (docs[4][0], docs[5][1] + "other"), (None, docs[6][1]), (None, docs[6][1]), (None, docs[7][1] + "!")]
    ties = {}
    for i, t in docs:
        ties.setdefault(i, set()).add(t)
    got = found(spark, docs)
    if all(len(t) == 1 for i, t in ties.items() if i is not None):
        assert got == plain(docs)
    # Texts of one id come in the order of their hashes: two orders are possible for those.
    alone = {i for i, t in ties.items() if len(t) == 1}
    single = [d for d in docs if d[0] in alone]
    assert found(spark, single) == plain(single)
    assert sum(len(g[3]) for g in got) > 100


def test_near_copies_in_large_groups(spark):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefgh ") for _ in range(900))
    docs = []
    for i in range(120):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3])):
            text[rng.randrange(len(text))] = rng.choice("JKLMNO")
        docs.append((i, "".join(text)))
    assert found(spark, docs) == plain(docs)


def test_names_follow_the_order_across_ranges(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0, 1, 1, 1, 2, 5]), i) for i in range(400)] + [(1, 7)] * 5
    df = spark.createDataFrame(rows, "k long, t long").repartition(5)
    got = suffixes.sort_and_name(df, ["k"], ["t"], ["k", "t"], "names").collect()
    names = {}
    for r in got:
        names.setdefault(r.k, set()).add(r.name)
    assert all(len(n) == 1 for n in names.values())
    assert [k for k, _ in sorted(names.items(), key=lambda x: min(x[1]))] == sorted(names)
    least = {k: min(t for kk, t in rows if kk == k) for k, _ in rows}
    assert sorted((r.k, r.t, r.later) for r in got) == sorted((k, t, t != least[k]) for k, t in rows)


def test_edge_rows(spark):
    assert found(spark, TEXTS) == plain(TEXTS)
    assert len(suffixes.remove_later_copies(edge(spark)).collect()) == len(TEXTS)
    assert suffixes.remove_later_copies(empty(spark)).collect() == []
    twice = suffixes.remove_later_copies(frame(spark, [(1, "q" * 100_000), (2, "q" * 250_000), (3, "q" * 99)])).collect()
    assert {(r.doc_id, len(r.kept)) for r in twice} == {(1, 1), (2, 0), (3, 99)}


def test_kept_bytes_may_cut_characters(spark):
    text = "é" * 49 + "a"  # 99 bytes
    (a, b) = sorted(suffixes.remove_later_copies(frame(spark, [(1, text + "éx"), (2, text + "èx")])).collect(), key=lambda r: r.doc_id)
    assert bytes(b.kept) == b"\xa8x" and b.n_bytes == 102 and bytes(a.kept).decode() == text + "éx"
