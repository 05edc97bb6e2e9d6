"""Repeated passages by seed and extend.

Words are hashed, and of every ``window`` consecutive words the smallest hash of ``seed``
words is its anchor (winnowing): equal windows have equal anchors at equal offsets. Windows
in a row with one anchor are a stretch. Equal stretches in a row, as of one word repeated,
are one row with their number. Documents meet on anchors that occur twice; there
each stretch is extended both ways as far as its windows go:

1. stretches with the same words are repeated as a whole, however many copies there are;
2. where an anchor has several kinds of stretches, they may agree in part: the windows of one
   witness of each kind and of each single stretch are compared one by one.

The union of repeated windows is the cover by maximal repeats of at least ``window`` words.
No pair of occurrences is ever formed: groups are counted, and counts are joined back.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import discard, stored, texts_in_bites

WINDOW, SEED = 35, 8
_N_BITS = 6  # a stretch has at most WINDOW - SEED + 1 windows
_TIMES_BITS = 20  # at most _PIECE_WORDS equal stretches are in a row

_ONE = np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Roller:
    """Hashes of stretches of values from prefix sums of values times powers, modulo 2**64."""

    def __init__(self, base: int, n: int):
        self.up = _powers(base, n)
        self.down = _powers(pow(base, -1, 1 << 64), n)

    def sums(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((sums[end] - sums[start]) * self.down[start])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


_PIECE_BYTES, _PIECE_WORDS = 1 << 20, 1 << 18


class _Cache(dict):
    """What a process makes for itself; tasks get it empty."""

    def __reduce__(self):
        return _Cache, ()


_CACHE = _Cache()


def _tools():
    """Tables of the hashes; made once in each process."""
    if not _CACHE:
        values = np.random.default_rng(7).integers(1, 1 << 63, 256, np.int64).astype(np.uint64)
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        _CACHE["t"] = (
            values * np.uint64(2) + _ONE,
            space,
            _Roller(0x2545F4914F6CDD1D, 2 * _PIECE_BYTES),
            _Roller(0xD1342543DE82EF95, 2 * _PIECE_WORDS),
            _Roller(0xAF251AF3B0F025B5, 2 * _PIECE_WORDS),
        )
    return _CACHE["t"]


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the bytes start, and their hashes; in pieces for long texts."""
    values, space, rolled, _, _ = _tools()
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = ~space[data]
    edge = np.diff(word)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE_BYTES, "right")))
        low, high = starts[at], ends[to - 1]
        if high - low <= 2 * _PIECE_BYTES - 1:
            sums = rolled.sums(values[data[low:high]])
            s, e = starts[at:to] - low, ends[at:to] - low
            hashes[at:to] = rolled.of(sums, s, e) ^ (e - s).astype(np.uint64)
        else:  # one word longer than a piece
            total = np.zeros(1, np.uint64)
            for i in range(low, high, _PIECE_BYTES):
                part = values[data[i : min(i + _PIECE_BYTES, high)]]
                total = _mix(total + rolled.sums(part)[-1:])
            hashes[at] = total[0]
        at = to
    return starts, _mix(hashes)


def _anchors(h: np.ndarray, doc: np.ndarray, window: int, seed: int):
    """Stretches of the words ``h`` of the documents ``doc``: (index of the first window,
    number of windows, hash of the anchor, hash of all words of the stretch)."""
    _, _, _, rolled, wide = _tools()
    if len(h) < window:
        return tuple(np.zeros(0, np.int64) for _ in range(2)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    sums, long_sums = rolled.sums(h), wide.sums(h)
    i = np.arange(len(h) - seed + 1)
    gram = rolled.of(sums, i, i + seed)
    span, size = 1, window - seed + 1
    best = i
    while span * 2 <= size:
        left, right = best[:-span], best[span:]
        best = np.where(gram[right] <= gram[left], right, left)
        span *= 2
    if span < size:
        left, right = best[: len(gram) - size + 1], best[size - span :][: len(gram) - size + 1]
        best = np.where(gram[right] <= gram[left], right, left)
    n = len(h) - window + 1
    best = best[:n]
    whole = doc[:n] == doc[window - 1 :]
    change = np.ones(n, bool)
    change[1:] = (best[1:] != best[:-1]) | ~whole[:-1] | ~whole[1:]
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, n))
    keep = whole[first]
    first, count = first[keep], count[keep]
    anchor = best[first]
    words = wide.of(long_sums, first, first + count + window - 1)
    shape = (count.astype(np.uint64) << np.uint64(32)) | (anchor - first).astype(np.uint64)
    return first, count, gram[anchor], _mix(words ^ _mix(shape))


def _bite(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, the text each word is of, and each text's first word."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])])
    starts, h = _word_hashes(data)
    doc = np.searchsorted(begin, starts, "right") - 1
    return h, doc, np.searchsorted(starts, begin)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _times() -> Column:
    """How many equal stretches a row is."""
    return F.shiftright("place", _N_BITS).bitwiseAND((1 << _TIMES_BITS) - 1)


def _stretches(docs: DataFrame, window: int, seed: int) -> DataFrame:
    """(doc_id, tag, seed, words, place): all stretches, equal ones in a row of one document as one row.
    ``place`` packs the first window, the number of stretches and the number of windows of each."""
    columns = ["doc_id", "tag", "seed", "words", "place"]

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            h, doc, at = _bite(texts)
            for low in range(0, max(1, len(h) - window + 1), _PIECE_WORDS):
                high = min(len(h), low + _PIECE_WORDS + window - 1)
                first, count, anchor, words = _anchors(h[low:high], doc[low:high], window, seed)
                if not len(first):
                    continue
                new = np.ones(len(first), bool)
                # Hashes of the words have the number of windows and the anchor's place in them, too.
                new[1:] = (words[1:] != words[:-1]) | (doc[low + first[1:]] != doc[low + first[:-1]])
                row = np.flatnonzero(new)
                times = np.diff(np.append(row, len(first)))
                first, count, anchor, words = first[row], count[row], anchor[row], words[row]
                of = doc[low + first]
                place = ((((low + first - at[of]) << _TIMES_BITS) | times) << _N_BITS) | count
                own = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), part.column(1).take(own), _signed(anchor), _signed(words), pa.array(place, pa.int64())], columns
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "tag", "text").mapInArrow(run, f"doc_id {kind}, tag long, seed long, words long, place long")


def _spans(covered: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))


def _covered(n: int, first: np.ndarray, count: np.ndarray, window: int) -> np.ndarray:
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, first + count + window - 1, -1)
    return np.cumsum(depth)[:n] > 0


def _kept(words: list[bytes], covered: np.ndarray) -> str:
    return b" ".join(compress(words, (~covered).tolist())).decode("utf-8", "surrogatepass")


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_ANSWER = "n_words long, kept string, spans array<struct<start:int,end:int>>"


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, seed: int = SEED, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Remove every word inside a window of ``window`` words that occurs twice or more.

    ``docs`` needs doc_id and text; of the other columns those in ``carry`` are passed on, whose
    names must not be among the result's. Returns doc_id, tag (the text's 64-bit hash), n_words, kept
    (the remaining words joined by one space) and spans (removed runs of words, start and end).
    One row per input row.

    Words are runs without ASCII white space. A null text has no words. Texts shorter than a
    window lose nothing. Repeated rows are occurrences like others, so both lose everything;
    rows of one id with different texts are told apart by their text. Null ids are ids like
    others. Windows overlapping their own copies ("a a a ...") count. No rows give no rows.
    Windows are judged on the input. Equality of words, and of texts under one id, is that of
    their 64-bit hashes; that of stretches and windows is that of two hashes of their words'.
    """
    base = docs.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"),
        F.coalesce("text", F.lit("")).alias("text"),
        *carry,
    )
    places = stored(_stretches(base, window, seed), "stretches")
    # Counts are written before they are joined back: so a hot anchor's join is one of two plain
    # shuffles, which Spark splits at run time.
    twice = stored(
        places.groupBy("seed")
        .agg(F.sum(_times()).alias("n"), (F.min("words") != F.max("words")).alias("several"))
        .where("n > 1")
        .select("seed", "several"),
        "anchors-met",
    )
    met = stored(places.join(twice, "seed"), "met-stretches")
    discard(places, twice)
    # An anchor with one kind of stretch is settled here, without counting that kind.
    alike = met.where("not several").select("doc_id", "tag", "place", F.lit(True).alias("whole"), F.lit(False).alias("shown"))
    mixed = met.where("several").drop("several")
    kinds = stored(
        mixed.groupBy("seed", "words").agg((F.sum(_times()) > 1).alias("whole"), F.min(F.struct("doc_id", "tag", "place")).alias("witness")), "kinds"
    )
    judged = alike.unionByName(
        mixed.join(kinds, ["seed", "words"])
        .withColumn("shown", ~F.col("whole") | F.struct("doc_id", "tag", "place").eqNullSafe(F.col("witness")))
        .select("doc_id", "tag", "place", "whole", "shown")
    )
    by_doc = judged.groupBy("doc_id", "tag").agg(
        F.collect_list(F.struct("place", "whole", "shown")).alias("stretches")
    )
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tag"] == b["tag"])
    joined = base.join(by_doc, same(base, by_doc), "left").select(
        base["doc_id"], base["tag"], "text", "stretches", *carry
    )
    kind = docs.schema["doc_id"].dataType.simpleString()

    def extend(batches):
        _, _, _, rolled, wide = _tools()
        for part, texts in texts_in_bites(batches, "text"):
            lists = part.column(3)
            offsets = lists.offsets.to_numpy()
            place, whole, shown = (lists.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            n_words, kept, spans, rest, done, starts, hashes, more = [], [], [], [], [], [], [], []
            for i, text in enumerate(texts):
                data = text.encode("utf-8", "surrogatepass")
                words = data.split()
                n_words.append(len(words))
                own = slice(offsets[i], offsets[i + 1]) if valid[i] else slice(0, 0)
                p, w, s = place[own], whole[own].astype(bool), shown[own].astype(bool)
                first, count = p >> _TIMES_BITS + _N_BITS, p & ((1 << _N_BITS) - 1)
                times = (p >> _N_BITS) & ((1 << _TIMES_BITS) - 1)
                # Of equal stretches in a row the first shows the windows of all.
                at = np.zeros(0, np.int64)
                if s.any():
                    at = np.repeat(first[s], count[s]) + np.concatenate([np.arange(c) for c in count[s]])
                is_open = bool((~w).any())
                if len(at):
                    _, h = _word_hashes(np.frombuffer(data, np.uint8))
                    a, b = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
                    for low in range(0, len(h), _PIECE_WORDS):
                        inside = (at >= low) & (at < low + _PIECE_WORDS)
                        if inside.any():
                            piece = h[low : low + _PIECE_WORDS + window]
                            j = at[inside] - low
                            a[inside] = rolled.of(rolled.sums(piece), j, j + window)
                            b[inside] = wide.of(wide.sums(piece), j, j + window)
                    # Windows of wholly repeated stretches are only witnesses for others.
                    at = np.where(np.repeat(w[s], count[s]), -1 - at, at)
                    starts.append(at.astype(np.int32))
                    hashes.append(a.view(np.int64))
                    more.append(b.view(np.int64))
                else:
                    starts.append(at.astype(np.int32))
                    hashes.append(at)
                    more.append(at)
                covered = _covered(len(words), first[w], (times * count)[w], window)
                if is_open:
                    kept.append(None)
                    spans.append(None)
                    rest.append(text)
                    done.append(_spans(covered))
                else:
                    kept.append(_kept(words, covered))
                    spans.append([{"start": x, "end": y} for x, y in _spans(covered)])
                    rest.append(None)
                    done.append(None)
            flat = [[{"start": x, "end": y} for x, y in d] if d is not None else None for d in done]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    part.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(spans, _SPANS),
                    pa.array(rest, pa.string()),
                    pa.array(flat, _SPANS),
                    pa.array(starts, pa.list_(pa.int32())),
                    pa.array(hashes, pa.list_(pa.int64())),
                    pa.array(more, pa.list_(pa.int64())),
                    *part.columns[4:],
                ],
                names=list(extended.names),
            )

    extended = T.StructType.fromDDL(
        f"doc_id {kind}, tag long, {_ANSWER}, text string, done array<struct<start:int,end:int>>, "
        "starts array<int>, h1 array<long>, h2 array<long>"
    )
    extended = T.StructType([*extended.fields, *[docs.schema[c] for c in carry]])
    part = stored(joined.mapInArrow(extend, extended), "extended")
    discard(met, kinds)
    windows = (
        part.where(F.size("starts") > 0)
        .select("doc_id", "tag", F.explode(F.arrays_zip("starts", "h1", "h2")).alias("w"))
        .select("doc_id", "tag", "w.starts", "w.h1", "w.h2")
    )
    again = stored(windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "windows-met")
    hits = (
        windows.where("starts >= 0").join(again, ["h1", "h2"]).groupBy("doc_id", "tag").agg(F.collect_list("starts").alias("hits"))
    )
    open_docs = part.where(F.col("text").isNotNull()).select("doc_id", "tag", "n_words", "text", "done", *carry)
    ended = open_docs.join(hits, same(open_docs, hits), "left").select(
        open_docs["doc_id"], open_docs["tag"], "n_words", "text", "done", "hits", *carry
    )
    answer = T.StructType.fromDDL(f"doc_id {kind}, tag long, {_ANSWER}")
    answer = T.StructType([*answer.fields, *[docs.schema[c] for c in carry]])

    def finish(batches):
        for part, texts in texts_in_bites(batches, "text"):
            kept, spans = [], []
            for text, done, hits in zip(texts, part.column(4).to_pylist(), part.column(5).to_pylist(), strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                first = np.array(hits or [], np.int64)
                covered = _covered(len(words), first, np.ones(len(first), np.int64), window)
                for d in done:
                    covered[d["start"] : d["end"]] = True
                kept.append(_kept(words, covered))
                spans.append([{"start": x, "end": y} for x, y in _spans(covered)])
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:3], pa.array(kept, pa.string()), pa.array(spans, _SPANS), *part.columns[6:]],
                names=answer.names,
            )

    closed = part.where(F.col("text").isNull()).select(*answer.names)
    return closed.unionByName(ended.mapInArrow(finish, answer))
