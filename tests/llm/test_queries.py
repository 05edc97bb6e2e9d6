"""Queries against their SQL twins, and the pipeline's decisions."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import connect, duckdb_rows, kinds, spark_rows
from tests.llm.cases import TEXTS
from txflow.llm import decontamination, jaccard, mixing, oracles, queries
from txflow.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracles.oracles()))
def test_query_matches_sql(spark, name):
    columns, rows = spark_rows(queries.queries()[name](spark, SF_DIR))
    expected_columns, expected = duckdb_rows(connect(SF_DIR), oracles.oracles()[name])
    assert (columns, rows) == (expected_columns, expected)
    assert rows and kinds(rows) == kinds(expected)


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == [*range(1, 14)]


def test_native_queries_run_no_python(spark):
    for name in ("op1_fingerprints", "op7_chat_formatting", "op9_decontamination"):
        plan = queries.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_pipeline_keeps_what_its_stages_decide(spark):
    docs = table(spark, SF_DIR, "documents").cache()
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, kept[-1], SF_DIR).cache()
        assert out.columns == docs.columns, name
        kept.append(out)
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    known = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    rejected = [known[i] for i in ids[0] - ids[1] if i in known]
    assert rejected and sum(rejected) <= 0.1 * len(rejected)
    linked = jaccard.link_documents(kept[1]).collect()
    assert ids[2] == {r.component_id for r in linked} and kept[2].count() == len(ids[2])
    assert ids[3] == ids[2]
    wrong = kept[3].where(F.col("n_chars") != F.length("text")).count()
    assert wrong == 0
    found = decontamination.find_benchmark(kept[3], table(spark, SF_DIR, "benchmark")).collect()
    assert ids[4] == {r.doc_id for r in found if not (r.n_hit and 20 * r.n_hit >= r.n_words)}
    last = corpus_pipeline.mix_to_targets(spark, kept[4], SF_DIR).collect()
    assert {r.doc_id for r in last} == ids[4] and all(r.rate >= 0 for r in last)


def classes_of(docs):
    """Of each class of linked ids the smallest, by sets of five-word shingles."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, text in docs.items():
        w = text.translate(lower).encode().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    up = {i: i for i in docs}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in docs:
        for b in docs:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                i, j = sorted((find(a), find(b)))
                up[j] = i
    return {find(i) for i in docs}


def without_repeats(docs, window=35):
    words = {i: t.encode().split() for i, t in docs.items()}
    seen = Counter(tuple(w[k : k + window]) for w in words.values() for k in range(len(w) - window + 1))
    kept = {}
    for i, w in words.items():
        hit = {x for k in range(len(w) - window + 1) if seen[tuple(w[k : k + window])] > 1 for x in range(k, k + window)}
        kept[i] = b" ".join(x for k, x in enumerate(w) if k not in hit).decode()
    return kept


def is_contaminated(text, items):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(lower))
    w, hit = find(text), set()
    for item in items:
        own = find(item or "")
        size = min(13, len(own))
        windows = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if size else set()
        hit |= {x for k in range(len(w) - size + 1) if size and tuple(w[k : k + size]) in windows for x in range(k, k + size)}
    return bool(hit) and 20 * len(hit) >= len(w)


def test_run_equals_plain_python(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, SF_DIR, "documents").collect()}
    scores = {r.doc_id: r.score for r in queries.op10_quality(spark, SF_DIR).collect()}
    left = {i: t for i, t in docs.items() if scores[i] >= 0.3}
    assert 0 < len(left) < len(docs)
    first = classes_of(left)
    left = without_repeats({i: left[i] for i in first})
    items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
    left = {i: t for i, t in left.items() if not is_contaminated(t, items)}
    assert len(left) < len(first) < len(docs)
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(t.encode().split()) for i, t in left.items()}
    # The rates are the least-squares optimum for what was left: no step that keeps them at least zero gains.
    last = spark.createDataFrame(list(left.items()), "doc_id long, text string")
    domains = sorted(mixing.TARGETS)
    model = mixing.fit(last, table(spark, SF_DIR, "labels"), domains)
    p = {r.doc_id: r.posteriors for r in mixing.predict(last, model).collect()}
    w = np.array([r.n_tokens for r in rows], float) / sum(r.n_tokens for r in rows)
    rate, p = np.array([r.rate for r in rows]), np.array([p[r.doc_id] for r in rows])
    assert all(r.domain == domains[int(np.argmax(x))] for r, x in zip(rows, p, strict=True))
    slope = p @ ((w * rate) @ p - np.array([mixing.TARGETS[d] for d in domains])) + mixing.PULL * (rate - 1)
    own = w > 0
    assert np.abs(slope[own & (rate > 0)]).max() < 1e-5 and slope[own & (rate == 0)].min(initial=0) > -1e-5


def test_stages_take_edge_rows_and_clashing_columns(spark):
    extra = "score double, tag long, kept string, n_words long, spans string, done string, h1 long, carried string, text_hash long, y int"
    names = [x.split()[0] for x in extra.split(", ")]
    values = (0.125, 7, "k", 8, "s", "d", 9, "c", 10, 11)
    rows = [(i, t, "en", "src", None if t is None else len(t), *values) for i, t in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + extra).repartition(3)
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and all(tuple(r[c] for c in names) == values for r in got), name
        assert {r.doc_id for r in got} <= {i for i, _ in TEXTS}
        if name == "n-gram Jaccard join":
            assert len(got) == len(TEXTS) - 1  # one row is there twice
        elif name == "substring dedup":
            assert len(got) == len(TEXTS)
    last = corpus_pipeline.mix_to_targets(spark, docs, SF_DIR).collect()
    assert len(last) == len(TEXTS) and all(r.rate >= 0 for r in last)


def test_unrelated_texts_under_one_id_all_stay(spark):
    rows = [(1, "a b c d e f", "x"), (1, "u v w x y z", "x"), (1, "u v w x y z", "a"), (2, "u v w x y z", "x")]
    docs = spark.createDataFrame([(i, t, "en", s, 11) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id, r.text, r.source) for r in got) == [(1, "a b c d e f", "x"), (1, "u v w x y z", "a")]


def test_pipeline_takes_rows_without_ids_and_repeats(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "x"), (None, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    one = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in one) == [(0, ""), (0, "x"), (1, "a b c d e f"), (3, "")]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).collect() == []
