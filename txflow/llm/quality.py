"""Quality by votes of the nearest labelled documents in a latent semantic space.

A text's terms are trigrams of character classes (letters by case, digits, spaces, line ends,
punctuation in 26 classes) and words that repeat the word before them or the one before that;
which words they are plays no part.
TF-IDF vectors of a bounded labelled sample are reduced by a truncated SVD; the labelled
latent vectors are broadcast, and each document takes exact cosine products with all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import labelled_sample, texts_in_bites

#: Bounds of the fitted part: labelled rows, terms and latent dimensions. The terms are those most of the
#: labelled rows have; a sample with fewer keeps them all (the test tables' has 242 of them).
EXAMPLES, TERMS, RANK = 3000, 2048, 48
NEIGHBOURS, SHARPNESS = 25, 16
CLASSES = 32
#: One more term for each kind of repeated word.
SPACE = CLASSES**3 + 2

_CLASS = np.full(256, 1, np.uint16)  # letters beyond ASCII count as lower case
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[9, 11, 12, 32]] = 4
_CLASS[[10, 13]] = 5
for _i, _c in enumerate(c for c in range(33, 127) if not chr(c).isalnum()):
    _CLASS[_c] = 6 + _i % (CLASSES - 6)


def term_counts(text: str | None, piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a text and how often each occurs, in pieces for long texts."""
    data = (text or "").encode("utf-8", "surrogatepass")
    total = np.zeros(SPACE, np.int64) if len(data) > piece else None
    terms, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start in range(0, max(0, len(data) - 2), piece):
        c = _CLASS[np.frombuffer(data, np.uint8, min(piece + 2, len(data) - start), start)]
        grams = (c[:-2] << 10) | (c[1:-1] << 5) | c[2:]
        found = np.bincount(grams, minlength=0)
        if total is not None:
            total[: len(found)] += found
        else:
            terms = np.flatnonzero(found)
            counts = found[terms]
    if total is not None:
        terms = np.flatnonzero(total)
        counts = total[terms]
    words = data.split()
    again = sum(map(bytes.__eq__, words, words[1:])), sum(map(bytes.__eq__, words, words[2:]))
    again = [n * len(data) // max(1, len(words)) for n in again]  # in bytes, like the trigrams
    extra = [i for i in (0, 1) if again[i]]
    return (
        np.concatenate([terms, CLASSES**3 + np.array(extra, np.int64)]),
        np.concatenate([counts, np.array([again[i] for i in extra], np.int64)]),
    )


def _sample_terms(rows: DataFrame) -> list:
    """Labels and sparse term counts of the sample; texts stay on the executors."""

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            found = [term_counts(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(1),
                    pa.array([t.astype(np.int32).tobytes() for t, _ in found], pa.binary()),
                    pa.array([c.astype(np.int32).tobytes() for _, c in found], pa.binary()),
                ],
                ["y", "terms", "counts"],
            )

    return rows.select("text", "y").mapInArrow(run, "y int, terms binary, counts binary").collect()


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents. What is
    shuffled and collected is bounded by the fixed term space."""

    def run(batches):
        df, n = np.zeros(SPACE + 1, np.int64), 0
        for _, texts in texts_in_bites(batches, "text"):
            for text in texts:
                df[term_counts(text)[0]] += 1
                n += 1
        df[SPACE] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["term", "n"])

    found = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(SPACE + 1, np.int64)
    for row in found:
        df[row.term] = row.n
    return df[:SPACE], int(df[SPACE])


class Model:
    """Labelled latent vectors, the projection into their space, and the prior."""

    def __init__(self, rows: list, df: np.ndarray, n: int, terms: int = TERMS, rank: int = RANK):
        rows = sorted(rows, key=lambda r: (r.terms, r.counts, r.y))  # the same at each run
        self.labels = np.array([r.y for r in rows], np.float64)
        self.prior = float(self.labels.mean()) if len(rows) else 0.5
        sparse = [(np.frombuffer(r.terms, np.int32), np.frombuffer(r.counts, np.int32)) for r in rows]
        support = np.zeros(SPACE, np.int64)
        for t, _ in sparse:
            support[t] += 1
        top = np.argsort(-support, kind="stable")[:terms]
        self.terms = np.sort(top[support[top] > 0])
        self.column = np.full(SPACE, -1, np.int32)
        self.column[self.terms] = np.arange(len(self.terms))
        self.idf = np.log((1 + n) / (1 + df[self.terms])) + 0.05
        x = np.stack([self.weigh(t, c) for t, c in sparse]) if rows else np.zeros((0, len(self.terms)))
        values, vectors = np.linalg.eigh(x.T @ x) if len(self.terms) else (np.zeros(0), np.zeros((0, 0)))
        keep = np.argsort(-values)[:rank]
        self.project = np.ascontiguousarray(vectors[:, keep], np.float32)
        self.examples = self._unit(x.astype(np.float32) @ self.project)

    def weigh(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The unit TF-IDF vector of a text: roots of the term shares times idf."""
        out = np.zeros(len(self.terms))
        at = self.column[terms]
        inside = at >= 0
        out[at[inside]] = np.sqrt(counts[inside] / max(1, counts.sum()))
        out *= self.idf
        norm = np.sqrt(out @ out)
        return out / norm if norm else out

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        norm = np.sqrt((x * x).sum(1, keepdims=True))
        return np.divide(x, norm, out=np.zeros_like(x), where=norm > 1e-9)

    def score(self, texts: list, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the nearest examples, weighted by a power of their cosine;
        the prior counts as half a neighbour at full likeness."""
        if not len(self.examples):
            return np.full(len(texts), self.prior)
        out = np.empty(len(texts))
        k = min(neighbours, len(self.examples))
        for start in range(0, len(texts), 256):
            block = [self.weigh(*term_counts(t)) for t in texts[start : start + 256]]
            likeness = self._unit(np.stack(block).astype(np.float32) @ self.project) @ self.examples.T
            near = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(likeness, near, 1), 0).astype(np.float64) ** SHARPNESS
            votes = (weight * self.labels[near]).sum(1)
            out[start : start + 256] = (votes + 0.5 * self.prior) / (weight.sum(1) + 0.5)
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", examples: int = EXAMPLES) -> Model:
    """Learn from at most ``examples`` labelled rows that are not held out; idf counts cover
    all documents. Without labelled rows every text gets 0.5."""
    rows = _sample_terms(labelled_sample(docs, labels, F.col(label).cast("int"), examples))
    return Model(rows, *document_frequencies(docs))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (text; other columns kept, an own ``score`` replaced) with ``score``.

    Null and empty texts have no terms and get the prior, the share of label 1 in the sample.
    Ties among neighbours at the edge are broken by the order of the sample, which is fixed.
    Repeated rows stay. One pass without a shuffle; the model's size is bounded.
    """
    docs = docs.drop("score")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            scores = pa.array(shared.value.score(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*part.columns, scores], names=schema.names)

    return docs.mapInArrow(run, schema)
