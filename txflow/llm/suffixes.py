"""Repeated byte strings by difference-cover suffix sorting.

Every ``WINDOW`` bytes of a text are the beginning of one suffix; suffixes that begin alike are
neighbours in suffix order, where the earliest of them is kept. Sorting needs a row for each
suffix, so exact steps first leave out those whose neighbours are known without it:

1. Winnowing gives equal windows the same anchor at the same distance. Windows in a row with
   one anchor are a stretch; stretches whose anchor occurs once have no neighbours.
2. Stretches with the same bytes are copies as a whole: the first one stands for them.
3. First stretches of one anchor with different bytes are cut into pieces of up to ``PIECE``
   windows, by distance to the anchor, and steps 1 and 2 are done for these.

What is left goes through the difference cover modulo 3, of distances to the anchor:

4. Sampled suffixes, those of distance 1 and 2, are cut into triples of letters (``LETTER`` bytes
   each); all triples are sorted, and a triple's name is its place in that order.
5. Recursion on the names: the strings of three names are sorted, which tells the
   sampled suffixes apart up to 9 letters, one byte less than a window.
6. The remaining suffixes are merged in by their first byte and the name of the suffix after it,
   the sampled ones by their name and their last byte; neighbours with equal prefixes are copies.

Groups are counted or sorted, with ties cut at any row, and never gathered in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import discard, stored, texts_in_bites

LETTER, PIECE = 11, 8
#: Nine letters and one more byte.
WINDOW = 9 * LETTER + 1
_GRAM = 32
#: No byte of UTF-8.
_END = 0xFF
#: Windows of an area that is hashed at once; powers there are, which 1,000 strings of a stretch need too.
_AREA, _POWERS, _POS_BITS = 1 << 17, 1 << 18, 20
_KEY = ["doc_id", "tie"]


class _Cache(dict):
    """What a process makes for itself; tasks get it empty."""

    def __reduce__(self):
        return _Cache, ()


_CACHE = _Cache()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _tables():
    """Two independent random values for each byte, and powers of an odd number and of its inverse."""
    if not _CACHE:
        values = np.random.default_rng(13).integers(1, 1 << 63, (2, 256), np.int64).astype(np.uint64) * np.uint64(2)
        base, n = 0x5851F42D4C957F2D, _POWERS
        powers = []
        for b in (base, pow(base, -1, 1 << 64)):
            power = np.full(n, b, np.uint64)
            power[0] = 1
            powers.append(np.multiply.accumulate(power))
        _CACHE["t"] = (values + np.uint64(1), *powers)
    return _CACHE["t"]


class _Hashes:
    """Hashes of all stretches of some bytes, by one of two independent functions."""

    def __init__(self, data: np.ndarray, function: int):
        values, up, self.down = _tables()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[function][data] * up[: len(data)], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        down = self.down[: len(self.sums)][start]
        return _mix((self.sums[end] - self.sums[start]) * down)


def _stretches(data: np.ndarray):
    """Stretches of the windows of ``data`` without an end of text inside: first window, number of
    windows, place of the anchor, hash of the anchor, and the bytes' other hashes."""
    n = len(data) - WINDOW + 1
    hashes = _Hashes(data, 0)
    m = len(data) - _GRAM + 1
    gram = hashes.of(slice(0, m), slice(_GRAM, len(data) + 1))
    last = np.uint64((1 << _POS_BITS) - 1)
    # The rightmost of the smallest: equal windows agree on it.
    key = (gram & ~last) | (last - np.arange(m, dtype=np.uint64))
    span, size = 1, WINDOW - _GRAM + 1
    while span * 2 <= size:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < size:
        key = np.minimum(key[: m - size + 1], key[size - span :][: m - size + 1])
    ends = np.concatenate([[0], np.cumsum(data == _END)])
    whole = ends[WINDOW:] == ends[:n]
    change = np.ones(n, bool)
    change[1:] = (key[1:] != key[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, n))
    first, count = first[whole[first]], count[whole[first]]
    anchor = (last - (key[first] & last)).astype(np.int64)
    return first, count, anchor, gram[anchor]


def _areas(texts: list):
    """The bytes of some texts in pieces that overlap by a window: (where it starts among all
    bytes, bytes), and where each text starts."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])])
    data = np.frombuffer(bytes([_END]).join(coded) + bytes([_END]), np.uint8)
    areas = ((low, data[low : low + _AREA + WINDOW - 1]) for low in range(0, len(data) - WINDOW + 1, _AREA))
    return begin, areas


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def packed(start, count, lead):
    """A stretch in one number: its first window, number of windows, distance to the anchor."""
    return (start << 14) | (count << 7) | lead


def _seeds(docs: DataFrame) -> DataFrame:
    """(seed): the anchor of each stretch."""

    def run(batches):
        for _, texts in texts_in_bites(batches, "text"):
            for _, data in _areas(texts)[1]:
                yield pa.RecordBatch.from_arrays([_signed(_stretches(data)[3])], ["seed"])

    return docs.select("text").mapInArrow(run, "seed long")


def _places(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, seed, content, place): each stretch, ``content`` hashing its bytes."""
    names = [*_KEY, "seed", "content", "place"]

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            begin, areas = _areas(texts)
            for low, data in areas:
                first, count, anchor, seed = _stretches(data)
                words = _Hashes(data, 1).of(first, first + count + WINDOW - 1)
                content = _mix(words ^ _mix(packed(seed, count.astype(np.uint64), (anchor - first).astype(np.uint64))))
                of = np.searchsorted(begin, low + first, "right") - 1
                place = packed(low + first - begin[of], count, anchor - first)
                own = pa.array(of)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(own), part.column(1).take(own), _signed(seed), _signed(content), pa.array(place, pa.int64())], names
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*_KEY, "text").mapInArrow(run, f"doc_id {kind}, tie long, seed long, content long, place long")


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tie"] == b["tie"])


def _collapse(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (seed, content, doc_id, tie, of, place) that are copies of an earlier one as a whole,
    and the first ones where a seed has several contents."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), *_KEY, "place", "of")
    kinds = stored(rows.groupBy("seed", "content").agg(F.count("*").alias("n"), F.min(order).alias("first")), f"{name}-kinds")
    several = stored(kinds.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), f"{name}-seeds")
    shown = stored(kinds.join(several, "seed").select("first.doc_id", "first.tie", "first.of", "first.place"), f"{name}-first")
    copied = kinds.where("n > 1").select("seed", "content", "first")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), *_KEY, "place", "of")
    later = rows.join(copied, ["seed", "content"]).where(own != F.col("first")).select(*_KEY, "place")
    later = stored(later, f"{name}-later")
    discard(kinds, several)
    return later, shown


def _with_texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, tie, of, string): the bytes of each stretch in ``places`` (doc_id, tie, place)."""
    listed = places.groupBy(*_KEY).agg(F.collect_list("place").alias("places"))
    joined = docs.join(listed, _same(docs, listed)).select(docs["doc_id"], docs["tie"], "text", "places")
    names = [*_KEY, "of", "string"]

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            column = part.column(3)
            rows, strings = [], []
            for i, text in enumerate(texts):
                data = text.encode("utf-8", "surrogatepass")
                for place in column[i].values.to_pylist():
                    start = place >> 14
                    rows.append(i)
                    strings.append((place, data[start : start + ((place >> 7) & 127) + WINDOW - 1]))
            own = pa.array(rows, pa.int64())
            of, string = (pa.array([s[k] for s in strings], t) for k, t in ((0, pa.int64()), (1, pa.binary())))
            yield pa.RecordBatch.from_arrays([part.column(0).take(own), part.column(1).take(own), of, string], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, tie long, of long, string binary")


def _cut(strings: DataFrame) -> DataFrame:
    """(seed, content, doc_id, tie, of, place): the pieces of stretches, ``seed`` hashing the bytes that all
    windows at such distances to the anchor share."""
    names = ["seed", "content", *_KEY, "of", "place"]

    def run(batches):
        for batch in batches:
            for low in range(0, len(batch), 1000):
                part = batch.slice(low, 1000)
                texts = part.column(3).to_pylist()
                data = np.frombuffer(b"".join(texts), np.uint8)
                begin = np.cumsum([0, *map(len, texts)])[:-1]
                of = part.column(2).to_numpy()
                start, count, lead = of >> 14, (of >> 7) & 127, of & 127
                near, far = (lead - count + 1) // PIECE, lead // PIECE
                n = far - near + 1
                row = np.repeat(np.arange(len(part)), n)
                block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + near[row]
                # Distances to the anchor fall from window to window.
                most = np.minimum(lead[row], block * PIECE + PIECE - 1)
                least = np.maximum((lead - count + 1)[row], block * PIECE)
                first, size = lead[row] - most, most - least + 1
                at = begin[row]
                shared = at + lead[row] - block * PIECE
                seed = _mix(_Hashes(data, 0).of(shared, shared + WINDOW - PIECE + 1) ^ _mix(block.astype(np.uint64)))
                words = _Hashes(data, 1).of(at + first, at + first + size + WINDOW - 1)
                content = _mix(words ^ _mix(packed(seed, size.astype(np.uint64), (most - block * PIECE).astype(np.uint64))))
                own = pa.array(row)
                place = packed(start[row] + first, size, most)
                yield pa.RecordBatch.from_arrays(
                    [_signed(seed), _signed(content), *(part.column(i).take(own) for i in range(3)), pa.array(place, pa.int64())], names
                )

    kind = strings.schema["doc_id"].dataType.simpleString()
    return strings.mapInArrow(run, f"seed long, content long, doc_id {kind}, tie long, of long, place long")


def _differs(now: pa.Array, before: pa.Array) -> np.ndarray:
    either = pc.xor(pc.is_null(now), pc.is_null(before))
    return pc.or_(pc.fill_null(pc.not_equal(now, before), False), either).to_numpy(zero_copy_only=False)


def sort_and_name(df: DataFrame, keys: list[str], ties: list[str], keep: list[str], name: str) -> DataFrame:
    """``keep`` of each row, with ``name``: where the rows with its ``keys`` begin in the order of all
    rows, and ``later``: whether it differs from the first of them in ``ties``.

    Ranges are sorted side by side and neighbours compared; a range that begins with the keys
    its predecessor ends with takes over that name. Only the outer rows of the ranges are
    looked at in one place.
    """
    spark = df.sparkSession
    order = [F.col(c).asc_nulls_last() for c in (*keys, *ties)]
    ordered = df.select(*dict.fromkeys([*keep, *keys, *ties])).repartitionByRange(
        int(spark.conf.get("spark.sql.shuffle.partitions")), *order
    )
    kept = T.StructType([df.schema[c] for c in keep])
    schema = T.StructType([*kept.fields, *T.StructType.fromDDL("later boolean, part int, head long, edge binary").fields])

    def run(batches):
        part = TaskContext.get().partitionId()
        done, head, changes, before, waiting = 0, 0, 0, None, None

        def told(batch, edges):
            names = [f.name for f in schema.fields]
            return pa.RecordBatch.from_arrays([*batch, pa.array(edges, pa.binary())], names=names)

        def edge(values):
            return repr(values).encode()

        for batch in batches:
            if not len(batch):
                continue
            column = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            new = np.zeros(len(batch), bool)
            other = np.zeros(len(batch), bool)
            for c, x in column.items():
                if c in keys or c in ties:
                    changed = _differs(x, pa.concat_arrays([x.slice(0, 1) if before is None else before[c], x.slice(0, len(x) - 1)]))
                    (new if c in keys else other)[:] |= changed
            if before is None:
                new[0] = True
            at = np.arange(done, done + len(batch))
            heads = np.maximum.accumulate(np.where(new, at, head))
            count = changes + np.cumsum(other & ~new)
            # Changes of the ties since the head of the same keys.
            at_head = np.maximum.accumulate(np.where(new, count, -1))
            later = count > np.where(at_head < 0, 0, at_head)
            edges = [None] * len(batch)
            if before is None:
                edges[0] = edge([column[k][0].as_py() for k in keys])
            if waiting:
                yield told(*waiting)
            waiting = ([*(column[c] for c in keep), pa.array(later), pa.array(np.full(len(batch), part), pa.int32()), pa.array(heads, pa.int64())], edges)
            before = {c: x.slice(len(x) - 1, 1) for c, x in column.items()}
            done, head = done + len(batch), int(heads[-1])
            changes = int(count[-1] - max(at_head[-1], 0))
        if waiting:
            waiting[1][-1] = edge([before[k][0].as_py() for k in keys])
            yield told(*waiting)

    rows = stored(ordered.sortWithinPartitions(*order).mapInArrow(run, schema), name)
    outer: dict[int, list] = {}
    for r in rows.where("edge is not null").select("part", "head", "edge").collect():
        outer.setdefault(r.part, []).append((r.head, r.edge))
    taken, last = [], None
    for part, ends in sorted(outer.items()):
        ends = sorted(ends)
        begins = part << 33
        if last and last[1] == ends[0][1]:
            begins = last[0]
            taken.append((part, begins))
        last = (begins if ends[-1][0] == 0 else (part << 33) | ends[-1][0], ends[-1][1])
    over = F.broadcast(spark.createDataFrame(taken, "part int, begins long"))
    joined = rows.join(over, "part", "left")
    goes_on = (F.col("head") == 0) & F.col("begins").isNotNull()
    own = F.shiftleft(F.col("part").cast("long"), 33).bitwiseOR(F.col("head"))
    return joined.select(*keep, F.when(goes_on, F.col("begins")).otherwise(own).alias("name"), (F.col("later") | goes_on).alias("later"))


def _windows(strings: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, tie, start, sampled, byte, after, triples): the windows in ``places`` (doc_id, tie, of, place).

    ``after`` is the sampled suffix that tells the window apart together with ``byte``: its own start
    or the next one. ``triples`` are there once for each such suffix of a string.
    """
    listed = places.groupBy(*_KEY, "of").agg(F.collect_list("place").alias("places"))
    joined = strings.join(listed, _same(strings, listed) & (strings["of"] == listed["of"])).select(
        strings["doc_id"], strings["tie"], strings["of"], "string", "places"
    )
    names = [*_KEY, "start", "sampled", "byte", "after", "triples"]
    size = 3 * LETTER

    def run(batches):
        for batch in batches:
            rows, start, sampled, byte, after, triples = [], [], [], [], [], []
            for i, (of, string, own) in enumerate(zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)):
                base, seen = of >> 14, set()
                for place in own:
                    for k in range((place >> 7) & 127):
                        at = (place >> 14) + k - base
                        cover = ((place & 127) - k) % 3 != 0
                        x = at if cover else at + 1
                        rows.append(i)
                        start.append(base + at)
                        sampled.append(cover)
                        byte.append(string[at + WINDOW - 1] if cover else string[at])
                        after.append(base + x)
                        triples.append(None if x in seen else [string[y : y + size] for y in (x, x + size, x + 2 * size)])
                        seen.add(x)
            own = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(own), batch.column(1).take(own), pa.array(start, pa.int64()), pa.array(sampled, pa.bool_())]
            columns += [pa.array(byte, pa.int64()), pa.array(after, pa.int64()), pa.array(triples, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = strings.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        run, f"doc_id {kind}, tie long, start long, sampled boolean, byte long, after long, triples array<binary>"
    )


def _later_windows(strings: DataFrame, places: DataFrame) -> DataFrame:
    """(doc_id, tie, place): the windows in ``places`` that an earlier one equals, by suffix sorting."""
    windows = stored(_windows(strings, places), "suffix-windows")
    triples = windows.where("triples is not null").select(*_KEY, "after", F.posexplode("triples").alias("slot", "triple"))
    named = sort_and_name(triples, ["triple"], [*_KEY, "after", "slot"], [*_KEY, "after", "slot"], "suffix-triples")
    slots = [F.max(F.when(F.col("slot") == i, F.col("name"))).alias(f"n{i}") for i in range(3)]
    three = named.groupBy(*_KEY, "after").agg(*slots)
    ranks = stored(sort_and_name(three, ["n0", "n1", "n2"], [*_KEY, "after"], [*_KEY, "after"], "suffix-names").drop("later"), "suffix-ranks")
    joined = windows.join(ranks, _same(windows, ranks) & (windows["after"] == ranks["after"])).select(
        windows["doc_id"],
        windows["tie"],
        "start",
        "sampled",
        F.when(F.col("sampled"), F.col("name")).otherwise(F.col("byte")).alias("a"),
        F.when(F.col("sampled"), F.col("byte")).otherwise(F.col("name")).alias("b"),
    )
    merged = sort_and_name(joined, ["sampled", "a", "b"], [*_KEY, "start"], [*_KEY, "start"], "suffix-order")
    later = stored(
        merged.where("later").select(*_KEY, packed_column(F.col("start")).alias("place")), "suffix-later"
    )
    discard(windows, ranks)
    return later


def packed_column(start: Column) -> Column:
    """One window as a stretch of its own."""
    return F.shiftleft(start, 14).bitwiseOR(F.lit(1 << 7))


def remove_later_copies(docs: DataFrame) -> DataFrame:
    """Remove every byte covered by ``WINDOW`` bytes that also start earlier: in a document with a
    smaller id, or before in the same one.

    ``docs`` needs doc_id and text; other columns are ignored. Returns doc_id, n_bytes, kept (the
    remaining bytes, which may cut characters apart) and spans (removed runs of bytes, start and
    end). One row per input row. A null text is empty; one shorter than a window loses nothing.
    Rows without an id come last. Texts under one id are ordered by their hash; rows with the same id and
    text are one document and lose the same. Strings that overlap their own copy count. No
    rows give no rows. Windows are judged on the input. Equality of stretches is that of two
    independent 64-bit hashes, of single windows that of bytes.
    """
    base = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    twice = stored(_seeds(base).groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed"), "suffix-seeds")
    met = stored(_places(base).join(twice, "seed").withColumn("of", F.col("place")), "suffix-met")
    discard(twice)
    copies, first = _collapse(met, "suffix-stretches")
    discard(met)
    strings = stored(_with_texts(base, first), "suffix-strings")
    pieces = stored(_cut(strings), "suffix-pieces")
    piece_copies, first_pieces = _collapse(pieces, "suffix-pieces")
    discard(first, pieces)
    windows = _later_windows(strings, first_pieces)
    discard(strings, first_pieces)
    gone = copies.unionByName(piece_copies).unionByName(windows).groupBy(*_KEY).agg(F.collect_list("place").alias("places"))
    joined = base.join(gone, _same(base, gone), "left").select(base["doc_id"], "text", "places")
    kind = docs.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = ["doc_id", "n_bytes", "kept", "spans"]

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            sizes, kept, spans = [], [], []
            for text, places in zip(texts, part.column(2), strict=True):
                data = text.encode("utf-8", "surrogatepass")
                sizes.append(len(data))
                own = places.values.to_numpy() if places.is_valid else np.zeros(0, np.int64)
                if not len(own):
                    kept.append(data)
                    spans.append([])
                    continue
                depth = np.zeros(len(data) + 1, np.int64)
                start = own >> 14
                np.add.at(depth, start, 1)
                np.add.at(depth, start + ((own >> 7) & 127) + WINDOW - 1, -1)
                covered = np.cumsum(depth[:-1]) > 0
                kept.append(np.frombuffer(data, np.uint8)[~covered].tobytes())
                turns = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
                spans.append([{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()])
            columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, span_type)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")
