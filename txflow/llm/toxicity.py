"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are the beginnings of lower-cased words, all those of a bounded labelled sample. The
examples' vectors are filed in a block-max inverted index: rare terms, which weigh most, are walked
first; for common ones each block of like examples has the greatest weight of the term in it. What was
walked and these maxima bound the cosines in a block, which is only opened if they can reach
the nearest found so far.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import labelled_sample, stored, texts_in_bites

#: Bound of the fitted part: labelled rows.
EXAMPLES = 6000
NEIGHBOURS, BLOCK = 15, 32
#: Documents that are compared at once; a term is common in more than this part of the examples.
TOGETHER, COMMON = 128, 8
#: A word's terms are its beginnings of these lengths, or the word itself where it is no longer. Whole
#: words and more lengths found no more of the held-out rows.
SHORT, LONG = 4, 6
#: Beginnings of words whose terms a task remembers.
REMEMBERED = 1 << 17
#: ASCII but letters parts words.
_PARTS = bytes(i if i >= 0x80 or chr(i).isalpha() else 0x20 for i in range(256))


def _words(text: str | None) -> list[str]:
    return (text or "").lower().encode("utf-8", "replace").translate(_PARTS).decode().split()


def _terms(text: str | None) -> Counter:
    """The terms of a text and how often each occurs."""
    words = _words(text)
    found = Counter([w if len(w) <= SHORT else w[:SHORT] + "-" for w in words])
    found.update([w if len(w) <= LONG else w[:LONG] + "-" for w in words if len(w) > SHORT])
    return found


def _vocabulary(sample: DataFrame) -> list[str]:
    """All terms of the labelled sample."""

    def run(batches):
        for _, texts in texts_in_bites(batches, "text"):
            found = {t for text in texts for t in _terms(text)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["term"])

    terms = sample.select("text").mapInArrow(run, "term string").distinct()
    return sorted(terms.toArrow().column(0).to_pylist())


class _Places(dict):
    """Places of terms in a vocabulary by how a word begins, one letter more than the long term: words that
    begin alike have the same terms, which are made and looked up once. A value is the short term's
    place plus one, times 2**32, plus the same of the long one; 0 stands for none."""

    def __init__(self, at: dict[str, int]):
        self.at = at

    def __missing__(self, word: str) -> int:
        short = self.at.get(word if len(word) <= SHORT else word[:SHORT] + "-", -1) + 1
        long = self.at.get(word if len(word) <= LONG else word[:LONG] + "-", -1) + 1 if len(word) > SHORT else 0
        found = self[word] = short << 32 | long
        return found

    def counted(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The places of a text's terms in the vocabulary, in order, and how often each occurs."""
        if len(self) > REMEMBERED:
            self.clear()
        both = np.array([self[w[: LONG + 1]] for w in _words(text)], np.int64)
        places = np.concatenate([both >> 32, both & 0xFFFFFFFF])
        return np.unique(places[places > 0] - 1, return_counts=True)


def _vectors(docs: DataFrame, vocabulary) -> DataFrame:
    """``docs`` without text, with terms and counts of the (broadcast) vocabulary's terms."""
    rest = [c for c in docs.columns if c != "text"]
    schema = T.StructType(
        [*docs.select(*rest).schema.fields, *T.StructType.fromDDL("terms array<int>, counts array<int>").fields]
    )

    def run(batches):
        places = _Places({t: i for i, t in enumerate(vocabulary.value)})
        for part, texts in texts_in_bites(batches, "text"):
            found = [places.counted(text) for text in texts]
            ends = pa.array(np.cumsum([0, *(len(t) for t, _ in found)]), pa.int32())
            kept = [part.column(i) for i, c in enumerate(part.schema.names) if c != "text"]
            kept += [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int32())) for x in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(kept, names=schema.names)

    return docs.select(*rest, "text").mapInArrow(run, schema)


def _document_counts(vectors: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """How many of ``vectors`` have each of ``size`` terms, and their number."""

    def run(batches):
        # The last count is that of the documents.
        counts = np.zeros(size + 1, np.int64)
        for batch in batches:
            found = batch.column(0)
            counts[:-1] += np.bincount(found.flatten().to_numpy(), minlength=size)
            counts[-1] += len(found)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(counts[own], pa.int64())], ["term", "n"])

    counted = vectors.select("terms").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size + 1, np.int64)
    counts[counted["term"].to_numpy()] = counted["n"].to_numpy()
    return counts[:-1].astype(np.float64), int(counts[-1])


def _likeness_order(term: np.ndarray, weight: np.ndarray, first: np.ndarray, terms: int, block: int) -> np.ndarray:
    """An order in which like examples are neighbours: halves along the direction in which they
    differ most, again and again down to a block."""
    n = len(first) - 1
    row = np.repeat(np.arange(n), np.diff(first))
    todo, out = [np.arange(n)], []
    rng = np.random.default_rng(5)
    while todo:
        own = todo.pop()
        if len(own) <= block:
            out.append(own)
            continue
        local = np.full(n, -1)
        local[own] = np.arange(len(own))
        inside = local[row] >= 0
        r, t, w = local[row[inside]], term[inside], weight[inside]
        mean = np.bincount(t, w, terms) / len(own)
        side = rng.standard_normal(len(own))
        for _ in range(6):
            direction = np.bincount(t, w * side[r], terms) - mean * side.sum()
            side = np.bincount(r, w * direction[t], len(own)) - mean @ direction
            side /= np.sqrt(side @ side) or 1.0
        order = own[np.argsort(side, kind="stable")]
        # Whole blocks go to either side.
        half = (len(own) + block) // (2 * block) * block
        todo += [order[half:], order[:half]]
    return np.concatenate(out)


class Index:
    """Unit TF-IDF vectors of the labelled examples as a block-max inverted index."""

    def __init__(self, rows: list, df: np.ndarray, n: int, block: int = BLOCK):
        self.made_of, self.block = (rows, df, n, block), block
        self.idf = np.log((1 + n) / (1 + df)) + 1e-3
        self.prior = (sum(r.y for r in rows) + 0.5) / (len(rows) + 1)
        bare = [r.y for r in rows if not len(r.terms)]
        #: For texts without a term of the vocabulary: what such examples are.
        self.bare = (sum(bare) + self.prior) / (len(bare) + 1)
        rows = sorted((r for r in rows if len(r.terms)), key=lambda r: r.doc_id)
        self.y = np.zeros(0)
        if not rows:
            return
        weighed = [self.weigh(r.terms, r.counts) for r in rows]
        term, weight = (np.concatenate([x[k] for x in weighed]) for k in (0, 1))
        first = np.concatenate([[0], np.cumsum([len(x[0]) for x in weighed])])
        order = _likeness_order(term, weight, first, len(df), block)
        self.ids = np.array([rows[i].doc_id for i in order], np.int64)
        self.y = np.array([rows[i].y for i in order], np.float64)
        term = np.concatenate([weighed[i][0] for i in order])
        weight = np.concatenate([weighed[i][1] for i in order])
        example = np.repeat(np.arange(len(order)), np.diff(first)[order])
        self.blocks = -(-len(order) // block)
        # Terms of more than an eighth of the examples have a row with all weights, block by block.
        common = np.flatnonzero(COMMON * np.bincount(term, minlength=len(df)) > len(order))
        self.row = np.full(len(df), -1)
        self.row[common] = np.arange(len(common))
        full = self.row[term] >= 0
        rows = np.zeros((len(common), self.blocks * block))
        rows[self.row[term[full]], example[full]] = weight[full]
        self.rows = np.ascontiguousarray(rows.reshape(len(common), self.blocks, block).transpose(1, 0, 2))
        self.row_most = self.rows.max(2, initial=0.0).T
        # Others have postings.
        by_term = np.lexsort((example[~full], term[~full]))
        self.example, self.weight = example[~full][by_term], weight[~full][by_term]
        self.first = np.searchsorted(term[~full][by_term], np.arange(len(df) + 1))

    def __reduce__(self):
        """Executors get the packed counts and build the index from them."""
        rows, df, n, block = self.made_of
        lists = [np.concatenate([np.zeros(0, np.int32), *[getattr(r, k) for r in rows]]) for k in ("terms", "counts")]
        sizes = np.array([len(r.terms) for r in rows], np.int64)
        packed = zlib.compress(pickle.dumps(([(r.doc_id, r.y) for r in rows], sizes, np.diff(lists[0], prepend=0), lists[1], df)), 1)
        return _unpacked, (packed, n, block)

    def weigh(self, terms, counts) -> tuple[np.ndarray, np.ndarray]:
        t = np.asarray(terms, np.int64)
        w = (1 + np.log(np.asarray(counts, np.float64))) * self.idf[t]
        return t, w / np.sqrt(w @ w)

    def cosines(self, queries: list, k: int, but: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each of ``queries`` (terms, counts): its cosine with the examples, exact in the blocks that
        were opened, and too low in others, whose examples are not among the ``k`` nearest; a cosine that
        those have at least; and which blocks were opened. Examples with the ids ``but`` get -1."""
        m, width = len(queries), self.blocks * self.block
        weighed = [self.weigh(*q) for q in queries]
        t, w = (np.concatenate([x[i] for x in weighed]) for i in (0, 1))
        of = np.repeat(np.arange(m), [len(x[0]) for x in weighed])
        row = self.row[t]
        common = row >= 0
        dense = np.zeros((m, self.rows.shape[1]))
        dense[of[common], row[common]] = w[common]
        t, w, of = t[~common], w[~common], of[~common]
        ends = np.searchsorted(of, np.arange(m + 1))
        sums = np.zeros((m, self.blocks, self.block))
        for i, (low, high) in enumerate(zip(ends, ends[1:], strict=False)):
            first = self.first[t[low:high]]
            n = self.first[t[low:high] + 1] - first
            at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
            if len(at):
                walked = np.bincount(self.example[at], self.weight[at] * np.repeat(w[low:high], n), width)
                sums[i] = walked.reshape(self.blocks, self.block)
        # The rare terms' part is exact; the others add at most their maxima in the block.
        bounds = sums.max(2) + dense @ self.row_most
        opened = np.zeros((m, self.blocks), bool)

        def open_(new: np.ndarray) -> None:
            for b in np.flatnonzero(new.any(0)):
                own = np.flatnonzero(new[:, b])
                sums[own, b] += dense[own] @ self.rows[b]
            for i, name in enumerate(but or ()):
                sums[i].ravel()[np.flatnonzero(self.ids == name)] = -1.0
            opened[new] = True

        # First the blocks of the highest bounds, then those that can still reach the k-th best.
        most = min(self.blocks, -(-4 * k // self.block))
        best = np.argpartition(-bounds, most - 1, 1)[:, :most]
        first = np.zeros_like(opened)
        np.put_along_axis(first, best, True, 1)
        open_(first & (bounds > 1e-12))
        least = np.zeros(m)
        if most * self.block > k:
            near = np.take_along_axis(sums, best[:, :, None], 1).reshape(m, -1)
            least = np.maximum(np.partition(near, -k, 1)[:, -k], 0.0)
        open_((bounds >= np.maximum(least - 1e-9, 1e-12)[:, None]) & ~opened)
        return sums.reshape(m, width), least, opened

    def nearest(self, queries: list, k: int = NEIGHBOURS, but: list | None = None, opened: list | None = None) -> list:
        """For each of ``queries`` (terms, counts) the ``k`` examples of highest cosine, exactly, best first;
        equal ones by position. Examples with the ids ``but`` are left out. ``opened`` is told the
        share of blocks that were read."""
        sums, least, read = self.cosines(queries, k, but)
        if opened is not None:
            opened.extend(read.mean(1))
        found = []
        for own, low in zip(sums, least, strict=True):
            near = np.flatnonzero((own >= low - 1e-9) & (own > 0))
            cosine = np.round(own[near], 12)
            best = np.lexsort((near, -cosine))[:k]
            found.append([(float(cosine[i]), int(near[i])) for i in best if cosine[i] > 0])
        return found

    def vote(self, near: list[tuple[float, int]]) -> tuple[float, list[tuple[int, float]]]:
        """Vote and evidence (ids and cosines of the three nearest examples)."""
        if not near:
            return self.prior, []
        # Weights fall with the distance 1 - cosine; the prior counts as a tenth of a full vote.
        weight = np.array([1 / (0.05 + 1 - min(1.0, s)) for s, _ in near])
        y = self.y[[i for _, i in near]]
        score = (weight @ y + 2 * self.prior) / (weight.sum() + 2)
        return float(min(1.0, max(0.0, score))), [(int(self.ids[i]), s) for s, i in near[:3]]

    def votes(self, queries: list, but: list | None = None) -> Iterator[tuple[float, list[tuple[int, float]]]]:
        """Votes and evidence of ``queries`` (terms, counts), some at a time."""
        for low in range(0, len(queries), TOGETHER):
            some = queries[low : low + TOGETHER]
            own = [i for i, (t, _) in enumerate(some) if len(t)] if len(self.y) else []
            near = self.nearest([some[i] for i in own], but=[but[low + i] for i in own] if but else None) if own else []
            votes = dict(zip(own, map(self.vote, near), strict=True))
            yield from (votes.get(i, (self.bare, [])) for i in range(len(some)))


def _unpacked(packed: bytes, n: int, block: int) -> Index:
    labelled, sizes, steps, counts, df = pickle.loads(zlib.decompress(packed))
    cuts = np.cumsum(sizes)[:-1]
    lists = zip(labelled, np.split(np.cumsum(steps), cuts), np.split(counts, cuts), strict=True) if labelled else ()
    return Index([SimpleNamespace(doc_id=i, y=y, terms=t, counts=c) for (i, y), t, c in lists], df, n, block)


def least_vote(votes: np.ndarray, y: np.ndarray) -> float:
    """The vote from which on a text counts as labelled 1: it best parts examples judged by
    the others (highest harmonic mean of precision and recall), half-way to the next lower."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-votes, kind="stable")
    v, hits = votes[order], np.cumsum(y[order])
    last = np.flatnonzero(np.append(v[1:] < v[:-1], True))
    best = last[np.argmax(2 * hits[last] / (last + 1 + y.sum()))]
    return float((v[best] + v[best + 1]) / 2 if best + 1 < len(v) else v[best])


def moved(vote: float, least: float) -> float:
    """The vote as a score: ``least`` becomes 0.5; order and ends stay."""
    up, down = vote * (1 - least), (1 - vote) * least
    return up / (up + down) if up + down > 0 else 0.5


def score_documents(docs: DataFrame, labels: DataFrame, label: str = "toxic", examples: int = EXAMPLES) -> DataFrame:
    """doc_id, score and evidence (ids and cosines of labelled examples) of each row of
    ``docs`` (doc_id, text; other columns ignored).

    At most ``examples`` labelled rows that are not held out are learnt from, by all of their
    terms; document counts cover all documents. Label 1 is rare, so scores are set by the
    examples' own votes on each other: 0.5 is where these part best. Null and empty texts, and
    texts without a term of the examples, score what such examples do; without labelled rows
    all score 0.5. Repeated rows stay. Texts are read once, to write the terms they share with the
    examples; these are counted, then scored.
    """
    context = docs.sparkSession.sparkContext
    base = docs.select("doc_id", "text")
    sample = stored(labelled_sample(docs, labels, F.col(label).cast("int"), examples), "toxic-sample")
    sample = sample.select("doc_id", "y", "text")
    vocabulary = context.broadcast(_vocabulary(sample))
    vectors = stored(_vectors(base, vocabulary), "toxic-terms")
    df, n = _document_counts(vectors, len(vocabulary.value))
    marked = stored(_vectors(sample, vocabulary), "toxic-vectors")
    found = marked.toArrow()
    lists = [[x.values.to_numpy() for x in found[c]] for c in ("terms", "counts")]
    rows = [SimpleNamespace(doc_id=i, y=y, terms=t, counts=c) for i, y, t, c in zip(
        found["doc_id"].to_pylist(), found["y"].to_pylist(), *lists, strict=True)]
    shared = context.broadcast(Index(rows, df, n))

    def queries(batch):
        t, c = (batch.column(batch.schema.get_field_index(x)) for x in ("terms", "counts"))
        return [(t[k].values.to_numpy(), c[k].values.to_numpy()) for k in range(len(batch))]

    def judge(batches):
        for part in batches:
            own = [v for v, _ in shared.value.votes(queries(part), part.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.float64()), part.column(1)], ["vote", "y"])

    judged = marked.select("doc_id", "y", "terms", "counts").mapInArrow(judge, "vote double, y int").toArrow()
    least = least_vote(judged["vote"].to_numpy(), judged["y"].to_numpy())
    schema = T.StructType(
        [docs.schema["doc_id"], *T.StructType.fromDDL("score double, evidence array<struct<doc_id:long,cosine:double>>").fields]
    )

    def run(batches):
        for part in batches:
            out = list(shared.value.votes(queries(part)))
            ends = np.cumsum([0, *(len(e) for _, e in out)])
            ids, cosines = (pa.array([x[k] for _, e in out for x in e], t) for k, t in ((0, pa.int64()), (1, pa.float64())))
            evidence = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([ids, cosines], names=["doc_id", "cosine"]))
            scores = pa.array([moved(v, least) for v, _ in out], pa.float64())
            yield pa.RecordBatch.from_arrays([part.column(0), scores, evidence], names=schema.names)

    return vectors.mapInArrow(run, schema)
