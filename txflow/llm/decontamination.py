"""Benchmark passages in documents: prefix-filtered set join on words (native).

A window of an item occurs in a document only where its rarest word does. So each window
is filed under that one word, its prefix in the order of rarity; a document word meets the
windows of its own file only, and the meeting is checked word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txflow.llm.common import LOWER, UPPER, stored

WINDOW = 13
#: Windows or words of the benchmark that are broadcast at once; more go block by block.
BLOCK = 100_000
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and characters beyond ASCII."""
    lowered = lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER))
    return F.transform(F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEPARATORS), ""), lowered)


def _blocks(rows: DataFrame, key: str, name: str, most: int) -> list[DataFrame]:
    """``rows`` written once and dealt by ``key`` into parts of about ``most`` rows, each small
    enough to be broadcast."""
    kept = stored(rows, name)
    parts = max(1, -(-kept.count() // most))
    return [kept.where(F.pmod(F.xxhash64(key), F.lit(parts)) == i) if parts > 1 else kept for i in range(parts)]


def _windows(items: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """(anchor, offset, window, item_id): each window of each item under its rarest word.
    An item of fewer words than ``size`` is one window."""
    rarity = (
        items.select("item_id", F.posexplode("words").alias("pos", "word"))
        .join(counts, "word", "left")
        .groupBy("item_id")
        .agg(
            F.array_sort(
                F.collect_set(F.struct("pos", F.coalesce("n", F.lit(0)).alias("n"), "word"))
            ).alias("tokens")
        )
    )
    n = F.size("tokens")
    length = F.least(F.lit(size), n)
    rarest = F.array_min(
        F.transform(F.slice("tokens", F.col("start") + 1, length), lambda t: F.struct(t.n, t.word, t.pos))
    )
    return (
        rarity.select("item_id", "tokens", F.explode(F.sequence(F.lit(0), n - length)).alias("start"))
        .withColumn("rarest", rarest)
        .select(
            F.col("rarest.word").alias("anchor"),
            (F.col("rarest.pos") - F.col("start")).alias("offset"),
            F.array_join(F.transform(F.slice("tokens", F.col("start") + 1, length), lambda t: t.word), " ").alias("window"),
            length.alias("length"),
            "item_id",
        )
    )


def find_benchmark(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """For each document the benchmark items that occur in it and the words they cover.

    Returns doc_id, text_hash (xxhash64 of the text), n_words, n_hit (words inside any
    occurrence of a window), items (ids of the items with occurring windows) and spans (the
    sorted starts and lengths, in words, of the occurrences).

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are
    ignored. A null text has no words. Rows with the same id and text are one document and
    give one row; items of one id count together; null ids are ids like others. Items without
    words occur nowhere; without items nothing is hit; no documents give no rows.

    Rarity is counted over all documents, only for words of the benchmark. The filed windows
    are broadcast in blocks of at most about ``BLOCK``: a benchmark larger than that costs one
    more pass over the documents for each block. Every document word meets only its own file,
    and only matches are shuffled.
    """
    items = benchmark.select(
        F.xxhash64("item_id", "text").alias("item_key"), "item_id", words(F.col("text")).alias("words")
    )
    items = items.where(F.size("words") > 0).dropDuplicates(["item_id", "item_key"])
    # Windows stay within one text, also where several texts share an id.
    keyed = items.select(F.struct("item_id", "item_key").alias("item_id"), "words")
    vocabulary = items.select(F.explode("words").alias("word")).distinct()
    spoken = docs.select(F.explode(words(F.col("text"))).alias("word"))
    counts = reduce(
        DataFrame.unionByName,
        [
            spoken.join(F.broadcast(part), "word").groupBy("word").agg(F.count("*").alias("n"))
            for part in _blocks(vocabulary, "word", "benchmark-words", block)
        ],
    )
    filed = _windows(keyed, counts, size).withColumn("item_id", F.col("item_id.item_id"))
    start = F.col("pos") - F.col("offset")
    occurs = F.coalesce(
        (start >= 0)
        & (start + F.col("length") <= F.col("n_words"))
        & (F.array_join(F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("length")), " ") == F.col("window")),
        F.lit(False),
    )
    told = (
        docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words(F.col("text")).alias("words"))
        .withColumn("n_words", F.size("words"))
        .select("doc_id", "text_hash", "n_words", "words", F.posexplode_outer("words").alias("pos", "word"))
    )
    met = reduce(
        DataFrame.unionByName,
        [
            told.join(F.broadcast(part), F.col("word") == F.col("anchor"), "left" if i == 0 else "inner")
            # The first word keeps a document without matches in the result.
            .where(occurs | (F.coalesce("pos", F.lit(0)) == 0))
            .select(
                "doc_id",
                "text_hash",
                "n_words",
                F.when(occurs, F.struct(start.alias("start"), F.col("length").alias("length"))).alias("span"),
                F.when(occurs, F.struct("item_id")).alias("item"),
            )
            for i, part in enumerate(_blocks(filed, "anchor", "benchmark-windows", block))
        ],
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("hit")),
        lambda acc, s: F.struct(
            F.greatest(acc.end, s.start + s.length).alias("end"),
            (acc.hit + F.greatest(F.lit(0), s.start + s.length - F.greatest(acc.end, s.start))).alias("hit"),
        ),
        lambda acc: acc.hit,
    )
    return (
        met.groupBy("doc_id", "text_hash", "n_words")
        .agg(F.array_sort(F.collect_set("span")).alias("spans"), F.collect_set("item").alias("items"))
        .select(
            "doc_id",
            "text_hash",
            F.col("n_words").cast("long").alias("n_words"),
            covered.cast("long").alias("n_hit"),
            F.transform("items", lambda i: i.item_id).alias("items"),
            "spans",
        )
    )


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
