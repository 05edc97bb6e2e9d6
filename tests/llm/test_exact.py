"""Operators with exact results against plain computations."""

import hashlib
import random
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import LONG, TEXTS, edge, empty, frame
from txflow.llm import chat, common, components, decontamination, fingerprints, jaccard, substrings


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- fingerprints -------------------------------------------------------------


def lanes_of(text):
    xxhash = pytest.importorskip("xxhash")
    lanes = [0] * (5 + fingerprints.SIGNS)
    for paragraph in text.split("\n"):
        words = paragraph.encode().split()
        if not words:
            continue
        lanes[0] += len(words)
        for j, seed in enumerate(fingerprints.SEEDS):
            h = xxhash.xxh64(paragraph.encode(), seed=42).intdigest()
            lanes[1 + j] += xxhash.xxh64(seed.to_bytes(4, "little"), seed=h).intdigest() & 0xFFFFFFFF
        for i in range(len(words)):
            h = 42
            for w in words[i : i + 3]:
                h = xxhash.xxh64(w, seed=h).intdigest()
            lanes[5 + (h & 63)] += -1 if h >> 63 else 1
    return [x % (1 << 32) for x in lanes]


def test_fingerprints_equal_the_plain_sums(spark):
    ordered = sorted(((-1 if i is None else i), t or "") for i, t in TEXTS)[::-1]
    want = []
    for k, (i, t) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        want.append((i, len(t), sha(edited), lanes_of(t), lanes_of(edited), lanes_of(after)))
    for buckets in (1, 4, 300):
        got = [
            (-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.lanes, r.edited_lanes, r.next_lanes)
            for r in fingerprints.edited_fingerprints(edge(spark), buckets).collect()
        ]
        assert sorted(got) == sorted(want)


def test_fingerprints_add_up_in_any_order(spark):
    texts = [(1, "a b c\nd e f g"), (2, "d e f g\n\na b c"), (3, "a b c"), (4, "d e f g")]
    rows = fingerprints.fingerprint_documents(frame(spark, texts))
    lanes = {r.doc_id: r.lanes for r in rows.collect()}
    assert lanes[1] == lanes[2] != lanes[3]
    both = spark.createDataFrame([(lanes[1], lanes[3], lanes[4])], "a array<long>, b array<long>, c array<long>")
    row = both.select(
        fingerprints.combine(F.col("b"), F.col("c")).alias("sum"),
        fingerprints.combine(F.col("a"), F.col("c"), -1).alias("rest"),
        fingerprints.likeness(F.col("a"), F.col("a")).alias("one"),
        fingerprints.likeness(F.col("b"), F.col("c")).alias("low"),
    ).first()
    assert row["sum"] == lanes[1] and row.rest == lanes[3] and row.one == 1.0 and 0 <= row.low <= 0.6


def test_fingerprints_of_no_rows_and_of_one(spark):
    assert fingerprints.edited_fingerprints(empty(spark)).collect() == []
    (row,) = fingerprints.edited_fingerprints(frame(spark, [(5, "abc def")])).collect()
    assert row.edited_sha256 == sha("abc d" + "ab") and row.next_lanes == row.lanes


# --- repeated passages ----------------------------------------------------------


def without_repeats(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        hit = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                hit.update(range(i, i + window))
        out.append((len(w), len(hit), b" ".join(x for i, x in enumerate(w) if i not in hit).decode()))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    shared = [[rng.choice("abcdefgh") * 2 for _ in range(rng.randint(5, 30))] for _ in range(6)]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += rng.choice([rng.choice(shared), [f"u{rng.random()}" for _ in range(9)], [rng.choice("xy")] * rng.randint(1, 14)])
            if words and rng.random() < 0.5:
                words[rng.randrange(len(words))] = f"e{rng.random()}"
        texts.append(" ".join(words))
    texts += [texts[0], texts[1], texts[1]]
    got = substrings.remove_repeats(frame(spark, list(enumerate(texts))), window=9, seed=3).collect()
    want = without_repeats(texts, 9)
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, sum(s.end - s.start for s in r.spans), r.kept) == want[r.doc_id]


def test_repeats_of_edge_rows(spark):
    got = substrings.remove_repeats(edge(spark), window=9, seed=3, carry=("source", "n_chars"))
    assert got.columns[-2:] == ["source", "n_chars"]
    found = Counter((r.doc_id, r.n_words, r.kept) for r in got.collect())
    want = zip(TEXTS, without_repeats([t for _, t in TEXTS], 9), strict=True)
    assert found == Counter((i, n, kept) for (i, _), (n, _, kept) in want)
    assert substrings.remove_repeats(empty(spark)).collect() == []


def test_rows_without_ids_are_told_apart_by_their_whole_texts(spark):
    # These two texts agree in the lower 24 bits of their hash.
    def tag(text):
        return pytest.importorskip("xxhash").xxh64(text.encode(), seed=42).intdigest() & 0xFFFFFF

    first, met = None, {}
    for i in range(200_000):
        # Long ones of 40 words, short ones of five.
        text = " ".join(f"{'l' if i % 2 else 's'}{i}w{k}" for k in range(40 if i % 2 else 5))
        other = met.setdefault(tag(text), text)
        if len(other.split()) != len(text.split()):
            first = [other, text]
            break
    assert first
    texts = [*first, *(f"n{i} " * 3 + "shared " * (i % 40) for i in range(3000))]
    rows = substrings.remove_repeats(frame(spark, [(None, t) for t in texts])).collect()
    want = without_repeats(texts, 35)
    assert Counter((r.n_words, r.kept) for r in rows) == Counter((n, kept) for n, _, kept in want)
    assert {t for t in first} <= {r.kept for r in rows}


def test_repeats_across_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(substrings, "_PIECE_WORDS", 50)
    monkeypatch.setattr(substrings, "_PIECE_BYTES", 64)
    monkeypatch.setattr(substrings, "_CACHE", {})
    texts = [LONG[:9000] + " " + "z" * 300, "start " + LONG[2000:4000] + " end"]
    h = [substrings._bite([t])[0] for t in texts]
    assert set(h[0].tolist()) & set(h[1].tolist())
    monkeypatch.undo()
    got = {r.doc_id: r.kept for r in substrings.remove_repeats(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(2)] == [k for _, _, k in without_repeats(texts, 35)]


def test_only_anchors_of_several_kinds_of_stretches_are_counted_by_kind(spark, monkeypatch):
    tables = []

    def stored(df, name, write=substrings.stored):
        out = write(df, name)
        tables.append((name, out.count()))
        return out

    monkeypatch.setattr(substrings, "stored", stored)
    copies = [" ".join(f"c{i}" for i in range(60))] * 5
    # These share their first words, up to different ones: some anchors have several kinds of stretches.
    part = [" ".join([*(f"p{i}" for i in range(n)), *(f"q{n}x{i}" for i in range(40))]) for n in range(40, 70, 3)]
    for texts, counted in ((copies, False), (copies + part, True)):
        tables.clear()
        rows = substrings.remove_repeats(frame(spark, list(enumerate(texts)))).collect()
        want = without_repeats(texts, 35)
        assert {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.spans), r.kept) for r in rows} == dict(enumerate(want))
        names = [name for name, _ in tables]
        assert len(names) == len(set(names)) == 6
        assert (dict(tables)["kinds"] > 0) == counted


def test_equal_stretches_in_a_row_are_one_row(spark, monkeypatch):
    tables = []

    def stored(df, name, write=substrings.stored):
        out = write(df, name)
        tables.append((name, out.count()))
        return out

    monkeypatch.setattr(substrings, "stored", stored)
    texts = ["x1 x2 " + "ha " * (300 + i) + f"end{i} " * (i % 3) for i in range(8)]
    texts += [f"b{i} " + "to be or not " * 90 + f"e{i}" for i in range(3)]
    # Once in the table, but each of their windows many times; and half a run alone.
    texts += ["- " * 36, "tick tock " * 200, "un " * 34, "deux " * 35, "two rows " * 17 + "two"]
    # One kind of stretch as witness of windows elsewhere.
    texts += [" ".join(f"w{i}" for i in range(20)) + " ha" * 34 + " z", "ha " * 33 + "q " * 40]
    texts += [texts[0]]
    rows = substrings.remove_repeats(frame(spark, list(enumerate(texts)))).collect()
    want = without_repeats(texts, 35)
    assert {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.spans), r.kept) for r in rows} == dict(enumerate(want))
    # 3,600 windows in runs, but few rows for each text.
    assert dict(tables)["met-stretches"] <= dict(tables)["stretches"] < 30 * len(texts)
    tables.clear()
    # Longer than a piece.
    (row,) = substrings.remove_repeats(frame(spark, [(1, "ha " * 300_000)])).collect()
    assert (row.n_words, row.kept, [(s.start, s.end) for s in row.spans]) == (300_000, "", [(0, 300_000)])
    assert dict(tables)["met-stretches"] == 2


# --- Jaccard join -----------------------------------------------------------------


def sets_of(texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for t in texts:
        w = (t or "").translate(lower).encode().split()
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def classes(ids, sets):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            x = len(sets[a] & sets[b])
            if ids[a] == ids[b] or x and 100 * x >= 80 * (len(sets[a]) + len(sets[b]) - x):
                i, j = find(ids[a]), find(ids[b])
                up[max(i, j)] = min(i, j)
    return {i: find(i) for i in ids}


def test_jaccard_classes_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAVES", 16)  # groups go to several trees
    monkeypatch.setattr(jaccard, "LARGE", 12)
    rng = random.Random(5)
    texts = []
    for size in (60, 25, 5, 1, 1, 2):
        base = [f"b{rng.randrange(400)}" for _ in range(rng.randint(30, 90))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                words[rng.randrange(len(words))] = rng.choice(["New", f"e{rng.random()}"])
            texts.append(" ".join(words))
    line = "the same common line of nine words for all"
    texts += [f"{line} {i} {i + 1} {i + 2}" for i in range(20)] + ["Same Few words", "same few WORDS", "É a b c d", "é a b c d"]
    texts += [None, "", " "]
    ids = list(range(10, 10 + len(texts)))
    rng.shuffle(ids)
    rows = jaccard.link_documents(frame(spark, list(zip(ids, texts, strict=True)))).collect()
    sets = sets_of(texts)
    assert {r.doc_id: r.n_shingles for r in rows} == {i: len(s) for i, s in zip(ids, sets, strict=True)}
    want = classes(ids, sets)
    assert len(set(want.values())) < len(ids) - 40
    assert {r.doc_id: r.component_id for r in rows} == want


def test_jaccard_of_edge_rows(spark):
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard.link_documents(edge(spark)).collect())
    sizes = {(i or -1): len(s) for (i, _), s in zip(TEXTS, sets_of([t for _, t in TEXTS]), strict=True)}
    assert got == sorted(((i or -1), sizes[i or -1], i) for i, _ in TEXTS)
    assert jaccard.link_documents(empty(spark)).collect() == []
    # Two texts under one id tie their copies together.
    rows = jaccard.link_documents(frame(spark, [(4, "p q r s t u"), (4, "k l m n o"), (9, "k l m n o"), (2, "p q r s t u")]))
    assert {r.component_id for r in rows.collect()} == {2}


def test_trees_leave_no_possible_pair_out():
    import numpy as np

    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 3000, np.int64).astype(np.uint64)
    base = rng.choice(pool, 120, replace=False)
    sets = []
    for _ in range(150):
        own = np.where(rng.random(120) < rng.choice([0.02, 0.08, 0.3]), rng.choice(pool, 120), base)
        sets.append(np.unique(own[: rng.integers(20, 121)]))
    bits = [jaccard.bitmap(s, jaccard.width_of(len(s))) for s in sets]
    found = {tuple(sorted(p)) for p in jaccard.candidates(np.array([len(s) for s in sets]), bits, 80)}
    linked = {(i, j) for j in range(150) for i in range(j) if jaccard._linked(sets[i], sets[j], 80)}
    assert linked and linked <= found and len(found) < 150 * 149 / 2


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 200)] + [(rng.randrange(300, 900), rng.randrange(300, 900)) for _ in range(250)]
    links += [(950, 950), (5, 4), (None, 3)]
    up = {i: i for pair in links for i in pair if i is not None}
    for _ in range(1000):
        moved = False
        for a, b in links:
            if a is not None and b is not None and up[a] != up[b]:
                up[a] = up[b] = min(up[a], up[b])
                moved = True
        if not moved:
            break
    got = {r.doc_id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: c for i, c in up.items() if i != 950}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- chat ---------------------------------------------------------------------------

TURNS = [
    (1, 0, "system", "be [kind] \\l"),
    (1, 1, "user", "</s>[INST] ok [/INST]"),
    (1, 2, "assistant", "x</>[user]y</>"),
    (1, 3, "assistant", None),
    (2, 0, "user", "plain"),
    (2, 0, "user", "plain"),
    (2, 1, "assistant", "also plain 漢字 \\ and ] too"),
    (3, None, None, ""),
    (4, 1, "odd]role<", "a" * 200_000),
    (None, 1, "user", "lost"),
    (None, 2, "assistant", "lost too"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*t, "f", 1) for t in TURNS], "conv_id long, turn long, role string, text string, formatted string, turns int")
    done = chat.format_conversations(rows.repartition(3)).withColumn("loss", chat.under_mask(F.col("formatted"), F.col("loss_mask")))
    got = done.collect()
    assert len(got) == 6 and all(r.round_trip for r in got)
    by = {r.conv_id: r for r in got if r.conv_id is not None}
    assert by[2].formatted == "<s>[user]plain</>[user]plain</>[assistant]also plain 漢字 \\ and ] too</></s>"
    assert by[2].loss == "also plain 漢字 \\ and ] too"
    assert by[1].loss == "x</>[user]y</>" and [t.text for t in by[1].recovered][1] == "</s>[INST] ok [/INST]"
    assert sorted(r.loss for r in got if r.conv_id is None) == ["", "lost too"]
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(none).collect() == []


def test_kept_texts_make_no_escape_where_they_meet(spark):
    texts = ["C:\\dir\\", "and", "[x]\\", "so", "\\", "long", "<\\", "right"]
    rows = [(1, i, "assistant", t) for i, t in enumerate(texts)]
    done = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    (row,) = done.withColumn("loss", chat.under_mask(F.col("formatted"), F.col("loss_mask"))).collect()
    assert row.round_trip and row.loss == "".join(texts)


# --- benchmark ------------------------------------------------------------------------


def test_benchmark_edges_and_blocks(spark):
    item = " ".join(f"Item{i}" for i in range(20))
    items = [(1, item), (1, item), (2, "Short ITEM"), (3, "É one"), (4, None), (5, "..."), (None, "null id item"), (6, item)]
    benchmark = spark.createDataFrame([(*i, "w", 1) for i in items], "item_id long, text string, words string, n int")
    docs = [
        (10, "x " + " ".join(item.upper().split()[2:16]) + " y"),
        (11, "short, item; short item"),
        (12, "é one É ONE"),
        (13, "the null-id item"),
        (14, " ".join(item.split()[:12])),
        *TEXTS,
    ]
    for block in (3, 100_000):
        found = decontamination.find_benchmark(frame(spark, docs), benchmark, block=block).collect()
        got = {(r.doc_id, r.n_words, r.n_hit, tuple(sorted(i or 0 for i in r.items))) for r in found}
        assert {g for g in got if g[0] in range(10, 15)} == {
            (10, 16, 14, (1, 6)),
            (11, 4, 4, (2,)),
            (12, 4, 2, (3,)),
            (13, 4, 3, (0,)),
            (14, 12, 0, ()),
        }
        assert len(found) == 14  # the repeated row counts once
        assert all(r.n_hit == 0 for r in found if r.doc_id is None or r.doc_id < 10)
    assert decontamination.find_benchmark(empty(spark), benchmark).collect() == []
    clean = decontamination.find_benchmark(frame(spark, docs), benchmark.limit(0)).collect()
    assert len(clean) == 14 and all(r.n_hit == 0 and r.items == [] for r in clean)


def test_jaccard_compares_groups_of_the_same_members_once(spark, monkeypatch):
    """Pairs that share a passage but are not linked meet in many shingles; each pair is dealt to one tree."""
    texts = []
    for k in range(12):
        passage = [f"p{k}x{i}" for i in range(40)]
        texts += [" ".join(passage + [f"{side}{k}x{i}" for i in range(20)]) for side in "ab"]
    ids = list(range(10, 10 + len(texts)))
    dealt = []

    def seen(f, key):
        def run(rows, *rest):
            dealt.extend((r[key], r.doc_id) for r in rows.select(key, "doc_id").collect())
            return f(rows, *rest)

        return run

    monkeypatch.setattr(jaccard, "_home_links", seen(jaccard._home_links, "key"))
    monkeypatch.setattr(jaccard, "_unit_candidates", seen(jaccard._unit_candidates, "task"))
    rows = jaccard.link_documents(frame(spark, list(zip(ids, texts, strict=True)))).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: i for i in ids}
    groups = {}
    for key, i in dealt:
        groups.setdefault(key, []).append(i)
    members = [tuple(sorted(g)) for g in groups.values()]
    assert members and len(members) == len(set(members))


def test_jaccard_passes_on_only_documents_that_may_be_linked(spark, monkeypatch):
    """Exact copies are one document; documents of unlike sizes that share a passage have no pair to compare."""
    texts = [" ".join(f"c{k}x{i}" for i in range(60)) for k in range(4) for _ in range(5)]
    for k in range(6):
        passage = [f"p{k}x{i}" for i in range(30)]
        texts += [" ".join(passage + [f"{k}s{n}x{i}" for i in range(n)]) for n in (10, 40, 90)]
    near = [f"n{i}" for i in range(100)]
    texts += [" ".join(near), " ".join([*near[:-1], "other"])]
    ids = list(range(10, 10 + len(texts)))
    tables = {}

    def seen(df, name):
        tables[name] = common.stored(df, name)
        return tables[name]

    monkeypatch.setattr(jaccard, "stored", seen)
    monkeypatch.setattr(jaccard, "discard", lambda *tables: None)
    rows = jaccard.link_documents(frame(spark, list(zip(ids, texts, strict=True)))).collect()
    assert {r.doc_id: r.component_id for r in rows} == classes(ids, sets_of(texts)) | {i: ids[k // 5 * 5] for k, i in enumerate(ids[:20])}
    assert {r.doc_id for r in tables["signatures"].collect()} == {r.doc_id for r in tables["met"].collect()} == set(ids[-2:])


def test_jaccard_ships_each_text_once_in_a_step(spark, monkeypatch):
    rng, texts = random.Random(8), []
    for k in range(4):  # copies with a changed word each meet in groups of unlike members
        for _ in range(8):
            words = [f"w{k}x{i}" for i in range(80)]
            words[rng.randrange(80)] = f"e{rng.random()}"
            texts.append(" ".join(words))
    ids, dealt = list(range(10, 10 + len(texts))), []

    def seen(rows, *rest):
        dealt.append(sorted(r.doc_id for r in rows.select("doc_id").collect()))
        return home_links(rows, *rest)

    home_links = jaccard._home_links
    monkeypatch.setattr(jaccard, "_home_links", seen)
    rows = jaccard.link_documents(frame(spark, list(zip(ids, texts, strict=True)))).collect()
    assert {r.doc_id: r.component_id for r in rows} == classes(ids, sets_of(texts))
    assert dealt[0] and all(len(step) == len(set(step)) for step in dealt)


def test_members_that_may_be_linked_equal_brute_force():
    import numpy as np

    rng = np.random.default_rng(4)
    for turn in range(200):
        m = int(rng.integers(1, 180))
        token = np.sort(rng.integers(-20, rng.choice([-19, -16, 20]), m))
        doc, n = rng.permutation(m), rng.integers(1, rng.choice([5, 60, 1000]), m)
        left = n - np.minimum(n - 1, (n * rng.random(m) * 0.2).astype(int))
        percent = int(rng.choice([50, 80, 99]))
        need = np.array([[jaccard.needed(a, b, percent) for b in n.tolist()] for a in n.tolist()]) if turn < 40 else -(-percent * (n[:, None] + n) // (100 + percent))
        pair = (need <= np.minimum(left[:, None], left)) & (token[:, None] == token) & ~np.eye(m, dtype=bool)
        assert (jaccard._may_be_linked(token, doc, n << 32 | left, percent) == pair.any(1)).all()


def test_groups_that_batches_cut_are_whole_or_in_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "ROWS", 16)
    rng = random.Random(6)
    members = {t: sorted(rng.sample(range(500), m)) for t, m in enumerate([1, 3, 16, 2, 40, 17, 1, 1, 9, 60, 2, 100])}
    rows = [(t, d) for t, ds in members.items() for d in ds for _ in range(rng.choice([1, 1, 1, 2]))]
    shape = 100 << 32 | 100
    for size in (1, 3, 7, 20, 1000):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in p]), pa.array([r[1] for r in p]), pa.array([shape] * len(p))], ["token", "doc_id", "shape"]) for p in parts]
        got, whole = {}, []
        for batch in jaccard._possible_groups(batches, 80):
            for r in batch.to_pylist():
                got.setdefault(r["token"], []).extend(r["docs"])
                whole += [r["token"]] * (r["m"] > 0)
                assert r["m"] in (0, len(r["docs"]))
        assert got == {t: ds for t, ds in members.items() if len(ds) > 1}
        assert len(whole) == len(set(whole)) and not {4, 9, 11} & set(whole) and {1, 3, 8, 10} <= set(whole)
    one = pa.RecordBatch.from_arrays([pa.array([0, 0, 2, 2, 3]), pa.array([5, 5, 6, 6, 6]), pa.array([7, 8, 1, 2, 3]), pa.array([[1], [2], [3, 4], [3, 4], [3, 4, 9]])], schema=jaccard._GROUP)
    both = [tuple(r.values()) for b in jaccard._first_of_alike([one.slice(0, 3), one.slice(3)]) for r in b.to_pylist()]
    assert both == [(7, 1), (8, 2), (1, 3), (1, 4), (3, 3), (3, 4), (3, 9)]


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        top = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in top for f in Path(d).rglob("shuffle_*.data")}

    key = common.SHUFFLES_GO
    own, before = spark.conf.get(key, None), files()
    out = common.stored(spark.range(20_000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "sevens")
    for _ in range(100):  # executors remove them on their own time
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    assert out.count() == 7 and spark.conf.get(key, None) == own
