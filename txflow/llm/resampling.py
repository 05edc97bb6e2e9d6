"""Importance resampling towards the benchmark's distribution.

Words and pairs of words fall into hashed buckets. A bucket's gain is the log ratio of its
shares in the target and in the corpus; a text weighs the mean gain of its features, looked up in
one array. Adding Gumbel noise to the weights makes the highest scores a sample without
replacement. A quantile sketch brackets the score that cuts the drawn share off; exact counts
outside the bracket confirm it or widen it, and only rows inside are sorted to find the cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import stored, texts_in_bites
from txflow.llm.ordering import numbered

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 25, 20, 7
#: Half of the first bracket, as a share of the rows.
ERROR = 0.002

#: What separates words becomes a space, A-Z becomes a-z; other bytes stay.
_FOLD = bytes(
    i + 32 if 0x41 <= i <= 0x5A else i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256)
)
_PIECE = 1 << 20


def feature_buckets(text: str | None, buckets: int = BUCKETS, piece: int = _PIECE) -> Iterator[np.ndarray]:
    """The bucket of each word and each pair of words of a text, a piece of the text at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    start, last = 0, None
    while start < len(data):
        end = data.find(b" ", start + piece)
        end = len(data) if end < 0 else end
        words = data[start:end].split()
        start = end
        if not words:
            continue
        one = list(map(crc32, words))
        firsts = one[:-1] if last is None else [last, *one[:-1]]
        two = map(crc32, words[1:] if last is None else words, map(crc32, repeat(b" "), firsts))
        last = one[-1]
        yield np.array([*one, *two], np.uint32) % buckets


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows of ``texts`` (text) fall into each bucket."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for _, some in texts_in_bites(batches, "text"):
            for text in some:
                for found in feature_buckets(text, buckets):
                    counts += np.bincount(found, minlength=buckets)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(counts[own], pa.int64())], ["bucket", "n"])

    found = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares, rounded down."""
    n, more, less = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * float(more + n) / (float(s + 1) * float(less + n))))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighed(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_features and weight of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches):
        gain = shared.value
        for part, texts in texts_in_bites(batches, "text"):
            sizes, weights = [], []
            for text in texts:
                size = total = 0
                for found in feature_buckets(text, len(gain)):
                    size += len(found)
                    total += int(gain[found].sum())
                sizes.append(size)
                weights.append(total // size if size else 0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())], ["doc_id", "n_features", "weight"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variate that hangs on the seed and the id (null: empty), rounded down."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


#: Highest scores first, then smaller ids, rows without an id last; ``tie`` parts repeated rows.
ORDER = ("score", "doc_id", "tie")


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]


def _up_to(cut) -> Column:
    """Rows that stand no later in the order than the row ``cut``."""
    same = F.col("doc_id").eqNullSafe(F.lit(cut.doc_id)) & (F.col("tie") <= cut.tie)
    before = F.col("doc_id").isNotNull() if cut.doc_id is None else F.col("doc_id") < cut.doc_id
    return (F.col("score") > cut.score) | ((F.col("score") == cut.score) & F.coalesce(before | same, F.lit(False)))


def find_cut(pool: DataFrame, n: int, k: int, error: float = ERROR):
    """The ``k``-th of the ``n`` rows of ``pool`` (score, doc_id, tie) in the order, 1 <= k <= n."""
    share = 1 - k / n
    while True:
        ends = [max(0.0, share - error), min(1.0, share + error)]
        sketch = F.percentile_approx("score", ends, min(100_000, math.ceil(4 / error)))
        low, high = pool.agg(sketch.alias("q")).first()["q"]
        if error >= 1:
            low, high = pool.agg(F.min("score"), F.max("score")).first()
        inside = F.col("score").between(low, high)
        above, within = pool.agg(F.count_if(F.col("score") > high), F.count_if(inside)).first()
        if above < k <= above + within:
            break
        error *= 8
    some = numbered(pool.where(inside).select(*ORDER), _order(), "bracket")
    return some.where(F.col("number") == k - above).first()


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    error: float = ERROR,
) -> DataFrame:
    """Draw ``percent`` of the rows of ``docs`` (doc_id, text) that have at least ``least_words`` words,
    by likeness to ``target`` (text); other columns of both are ignored.

    Returns each row's doc_id, n_features, weight, score and rank among the drawn (null: not
    drawn). Null and empty texts have no features and weigh 0; they count in no bucket. Rows
    without an id share the noise of an empty id and come last among equal scores. Repeated rows
    are drawn one by one, in an order that only they could tell apart. Without rows in ``docs`` there are
    none; an empty target is a uniform one. Texts are read twice, once to count and once to weigh.
    """
    docs = docs.select("doc_id", "text")
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = weighed(docs, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    rows = stored(scored.withColumn("tie", F.monotonically_increasing_id()), "scored")
    # With n words a text has 2 n - 1 features.
    fit = F.col("n_features") >= max(1, 2 * least_words - 1)
    n = rows.where(fit).count()
    k = n * percent // 100
    result = ["doc_id", "n_features", "weight", "score", "rank"]
    if not k:
        return rows.withColumn("rank", F.lit(None).cast("long")).select(*result)
    cut = find_cut(rows.where(fit).select(*ORDER), n, k, error)
    drawn = fit & _up_to(cut)
    ranked = numbered(rows.where(drawn), _order(), "drawn", "rank").withColumn("rank", F.col("rank").cast("long"))
    rest = rows.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*result).unionByName(rest.select(*result))
