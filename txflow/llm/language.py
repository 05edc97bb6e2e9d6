"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to ``ORDER`` bytes counts what follows them. A
byte costs what an arithmetic coder would spend on it: in the longest known context minus
log2 of its share, or the context's escape cost plus its cost in the next shorter one. The
statistics are frozen, so the cost depends on context and byte alone and is tabulated; a
text's language is the one that codes the whole text shortest.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import texts_in_bites

ORDER = 3
#: Labelled documents that the trees are grown from, at most.
EXAMPLES = 4000
_LETTER = re.compile(r"[^\W\d_]")


def _codes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Each byte and the three bytes before it as one number; texts begin after spaces."""
    b = np.frombuffer(b"   " + data, np.uint8).astype(np.int64)
    return b[3:], (b[:-3] << 16) | (b[1:-2] << 8) | b[2:-1]


def _grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each byte follows each three bytes, by language."""

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            langs = part.column(1).to_pylist()
            by: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(langs, texts, strict=True):
                if text:
                    last, context = _codes(text.encode("utf-8", "surrogatepass"))
                    by.setdefault(lang, []).append((context << 8) | last)
            for lang, found in by.items():
                grams, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(n, pa.int64())],
                    ["lang", "gram", "n"],
                )

    counted = docs.select("text", "lang").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Sparse costs in bits of all languages, by order. Each byte that any language has seen
    after a context has one row with its whole cost in each language; each context has one row
    with the languages' escape costs, for bytes that none has seen there. Nothing is cut."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        self.langs = sorted({lang for lang, _, _ in counts})
        at = {lang: i for i, lang in enumerate(self.langs)}
        k = len(self.langs)
        lang = np.array([at[x] for x, _, _ in counts], np.int64)
        gram = np.array([g for _, g, _ in counts], np.int64)
        n = np.array([c for _, _, c in counts], np.float64)
        # Order 0 rests on a byte that may be any of 256.
        seen = np.zeros((256, k))
        np.add.at(seen, (gram & 255, lang), n)
        total, kinds = seen.sum(0), (seen > 0).sum(0)
        self.base = -np.log2((seen + kinds / 256) / (total + kinds))
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for order in range(1, ORDER + 1):
            grams, inverse = np.unique(gram & ((1 << (8 * order + 8)) - 1), return_inverse=True)
            seen = np.zeros((len(grams), k))
            np.add.at(seen, (inverse, lang), n)
            contexts, own = np.unique(grams >> 8, return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), k))
            np.add.at(total, own, seen)
            np.add.at(kinds, own, seen > 0)
            escape = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0)
            cost = self._costs(grams, order - 1) + escape[own]
            there = seen > 0
            cost[there] = -np.log2(seen[there] / (total + kinds)[own][there])
            self.levels.append((grams, cost.astype(np.float32), contexts, escape.astype(np.float32)))

    def _costs(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Cost of each gram's last byte after the ``order`` bytes before it, by language."""
        out = np.zeros((len(grams), len(self.langs)))
        left = np.arange(len(grams))
        for o in range(order, 0, -1):
            known, cost, contexts, escape = self.levels[o - 1]
            own = grams[left] & ((1 << (8 * o + 8)) - 1)
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hit = known[at] == own
            out[left[hit]] += cost[at[hit]]
            left, own = left[~hit], own[~hit] >> 8
            at = np.minimum(np.searchsorted(contexts, own), len(contexts) - 1)
            hit = contexts[at] == own
            out[left[hit]] += escape[at[hit]]
        out[left] += self.base[grams[left] & 255]
        return out

    def bits(self, data: bytes, piece: int = 1 << 18) -> np.ndarray:
        """Code length of a text in each language."""
        total = np.zeros(len(self.langs))
        for start in range(0, len(data), piece):
            last, context = _codes(data[max(0, start - 3) : start + piece])
            skip = min(start, 3)
            total += self._costs((context[skip:] << 8) | last[skip:], ORDER).sum(0)
        return total


def fit(docs: DataFrame, examples: int = EXAMPLES) -> Model | None:
    """Grow the trees from at most ``examples`` rows of ``docs`` (doc_id, text, lang), those
    whose ids hash lowest; null ids, texts and languages teach nothing. None without rows.
    What reaches the driver are distinct four-byte sequences of the sample."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    sample = rows.join(F.broadcast(chosen), "doc_id")
    counts = [(r.lang, r.gram, r.n) for r in _grams(sample).collect()]
    return Model(counts) if counts else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (text; other columns kept, but lang_pred, score and bits replaced) with
    lang_pred, score and bits (the code length of the text in each language).

    ``und`` with score 0 and no bits for texts that are null, have no letter, or if there is
    no model. The score is the posterior of the language at equal priors; ties go to the first
    language in order. One pass without a shuffle, in pieces for long texts.
    """
    docs = docs.drop("lang_pred", "score", "bits")
    added = T.StructType.fromDDL("lang_pred string, score double, bits map<string,double>")
    schema = T.StructType(docs.schema.fields + added.fields)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        frozen = shared.value
        for part, texts in texts_in_bites(batches, "text"):
            found = []
            for text in texts:
                if frozen is None or not text or not _LETTER.search(text):
                    found.append(("und", 0.0, None))
                    continue
                bits = frozen.bits(text.encode("utf-8", "surrogatepass"))
                best = int(bits.argmin())
                score = 1.0 / np.exp2(np.maximum(bits[best] - bits, -1000.0)).sum()
                found.append((frozen.langs[best], float(score), list(zip(frozen.langs, bits.tolist(), strict=True))))
            pred, score, bits = zip(*found, strict=True)
            columns = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(list(part.columns) + columns, names=schema.names)

    return docs.mapInArrow(run, schema)
