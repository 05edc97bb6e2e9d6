"""Documents linked by the Jaccard likeness of their word shingles, by signature trees.

Every link shares one of the rarest fifth of each document's shingles (its prefix), so the
shingles of the prefixes deal the documents into groups, and no link crosses all groups. In a
group, a signature tree holds the documents' token bitmaps, combined by OR towards the root,
with the range of set sizes; the tree is joined with itself from the root down, and a pair of
nodes is left as soon as the overlap it could still hold is too small.

1. Groups of one shingle each document is sure to visit (its *home*) find most links, checked
   on the whole sets; documents that are linked already are not compared again.
2. What is left are groups in which several components meet. Large groups with common members
   are compared once. Their trees work on stored bitmaps; the few pairs that survive are
   checked on the whole sets.

Before both, a group loses the members that can be linked to no other one in it, by the sizes
of the sets and by how many shingles are left from the shared one on: the first shingle that two
linked sets share leaves room for all of their overlap. Most groups met by chance end there.
Groups with the same members are compared once, whichever shingles and steps they come from.

Step 2 covers all prefixes, so no link is lost; step 1 only keeps it small.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txflow.llm.common import discard, stored, texts_in_bites
from txflow.llm.components import components
from txflow.llm.substrings import _mix, _tools, _word_hashes

WORDS, PERCENT = 5, 80
#: Shingles that a task counts together, how often one has to occur among them to be told, and
#: how many of the most frequent ones rank behind all others, by frequency.
COUNTED, TOLD, FREQUENT = 1 << 22, 4, 1 << 20
#: Documents in one tree, and members from which groups of one shingle count as large.
LEAVES, LARGE, FANOUT = 256, 64, 8
#: Rows that are looked through at once for members of groups, and the largest group that members may leave.
ROWS = 1 << 17
#: Bits that tell by an id's hash which documents' texts are needed.
SLOTS = 1 << 23
#: Groups that each document visits first.
HOMES = 2

_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[ord("A") : ord("Z") + 1] += 32


def shingle_sets(texts: list, words: int = WORDS) -> list[np.ndarray]:
    """For each text the distinct hashes of its shingles, sorted; one of all words if they are
    fewer than ``words``. The texts are hashed together."""
    coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(coded) + b"\n", np.uint8)
    starts, h = _word_hashes(_LOWERED[data])
    at = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(c) + 1 for c in coded])])).tolist()
    whole = _rolled(h, words)
    out = []
    for low, high in zip(at, at[1:], strict=False):
        n = high - low
        out.append(_distinct(whole[low : high - words + 1]) if n >= words else _rolled(h[low:high], n) if n else h[:0])
    return out


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    new = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h[new]


def _rolled(h: np.ndarray, size: int, piece: int = 1 << 18) -> np.ndarray:
    """Hash of each run of ``size`` words; runs across texts are left to the caller."""
    _, _, _, rolled, _ = _tools()
    found = [h[:0]]
    for low in range(0, len(h) - size + 1, piece):
        part = h[low : low + piece + size - 1]
        i = np.arange(len(part) - size + 1)
        found.append(rolled.of(rolled.sums(part), i, i + size))
    return _mix(np.concatenate(found) ^ np.uint64(size))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    return shingle_sets([text], words)[0]


def needed(a: int, b: int, percent: int = PERCENT) -> int:
    """The overlap from which sets of these sizes are linked."""
    return -(-percent * (a + b) // (100 + percent))


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    least = needed(len(a), len(b), percent)
    if min(len(a), len(b)) < least:
        return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= least


# --- signature trees -----------------------------------------------------------


def width_of(n: int) -> int:
    """Bits of a document's bitmap: four for each shingle, a power of two, 256 to 65536."""
    return 1 << min(16, max(8, (4 * n - 1).bit_length()))


def bitmap(tokens: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width // 64, np.uint64)
    at = tokens & np.uint64(width - 1)
    np.bitwise_or.at(bits, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    return bits


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    while len(bits) * 64 > width:
        half = len(bits) // 2
        bits = bits[:half] | bits[half:]
    return bits


class Tree:
    """A signature tree over documents of similar width, in order of size."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, percent: int):
        self.percent = percent
        #: More shingles than bits set: so many may share a bit with another.
        excess = sizes - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.levels = [(bits, sizes, sizes, excess)]
        while len(self.levels[-1][1]) > 1:
            bits, low, high, excess = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits, cut, 0),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.maximum.reduceat(excess, cut),
                )
            )

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaves i < j that may be linked, level by level from the root with itself."""
        top = len(self.levels) - 1
        yield from self._down(top, np.zeros(1, np.int64), np.zeros(1, np.int64))

    def _down(self, level: int, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        bits, low, high, excess = self.levels[level]
        most = np.bitwise_count(bits[a] & bits[b]).sum(1).astype(np.int64) + np.minimum(excess[a], excess[b])
        # No overlap exceeds the smaller set, and it has to reach what the smallest sets need.
        most = np.minimum(most, np.minimum(high[a], high[b]))
        least = np.maximum(
            -(-self.percent * (low[a] + low[b]) // (100 + self.percent)), -(-self.percent * np.maximum(low[a], low[b]) // 100)
        )
        good = most >= least
        a, b = a[good], b[good]
        if level == 0:
            if len(a):
                yield a, b
            return
        n = len(self.levels[level - 1][1])
        steps = np.arange(FANOUT)
        for at in range(0, len(a), 512):
            x = (a[at : at + 512, None] * FANOUT + steps)[:, :, None]
            y = (b[at : at + 512, None] * FANOUT + steps)[:, None, :]
            x, y = np.broadcast_arrays(x, y)
            x, y = x.ravel(), y.ravel()
            keep = (x < n) & (y < n) & ((x < y) if level == 1 else (x <= y))
            if keep.any():
                yield from self._down(level - 1, x[keep], y[keep])


def candidates(sizes: np.ndarray, bits: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of documents that may be linked. Linked sets differ by a quarter in size at most,
    so only documents of one width and the next are compared, on the narrower one."""
    widths = np.array([len(b) * 64 for b in bits])
    for width in np.unique(widths):
        at = np.flatnonzero((widths == width) | (widths == 2 * width))
        at = at[np.lexsort((widths[at], sizes[at]))]
        tree = Tree(sizes[at], np.stack([fold(bits[i], int(width)) for i in at]), percent)
        narrow = widths[at] == width
        for a, b in tree.pairs():
            keep = narrow[a] | narrow[b]
            yield from zip(at[a[keep]].tolist(), at[b[keep]].tolist(), strict=True)


class _Sets:
    """Union-find over the documents of a group."""

    def __init__(self, names: list):
        first: dict = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(names)]

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


# --- steps --------------------------------------------------------------------


def _counted(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, set_hash) of each row, set size and hash of the set; besides, without these,
    (token, times) of shingles that are frequent.

    The latter only order shingles, and any order is right; so a task tells a shingle only if it
    occurs ``TOLD`` times among ``COUNTED`` others.
    """
    out = T.StructType.fromDDL("doc_id long, n long, set_hash long, token long, times long")

    def run(batches):
        held, n = [], 0
        for part, texts in texts_in_bites(batches, "text"):
            sets = shingle_sets(texts, words)
            sizes = [len(s) for s in sets]
            hashes = [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(hashes, pa.int64()), none, none], out.names)
            held += sets
            n += sum(sizes)
            if n >= COUNTED:
                yield told(held)
                held, n = [], 0
        if held:
            yield told(held)

    def told(held):
        found, n = np.unique(np.concatenate(held), return_counts=True)
        often = n >= TOLD
        none = pa.nulls(int(often.sum()), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(found[often].view(np.int64)), pa.array(n[often], pa.int64())], out.names)

    return docs.select("doc_id", "text").mapInArrow(run, out)


def _frequent(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ``FREQUENT`` most frequent shingles, sorted, and the binary logarithm of how often they occur."""
    counts = counted.where("times is not null").groupBy("token").agg(F.sum("times").alias("n"))
    rows = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    token = rows.column("token").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], np.log2(np.maximum(1, rows.column("n").to_numpy()[order])).astype(np.uint8)


def _prefixes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], words: int, percent: int) -> DataFrame:
    """(doc_id, n, prefix) of each row with words: set size, its rarest shingles from the rarest on."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        known, often = shared.value
        # Most shingles are not among the known ones, as few bits of them tell.
        low = np.uint64((1 << min(24, max(8, (16 * len(known)).bit_length()))) - 1)
        maybe = np.zeros(int(low) + 1, bool)
        maybe[known & low] = True
        for part, texts in texts_in_bites(batches, "text"):
            sets = shingle_sets(texts, words)
            whole = np.concatenate(sets)
            rank = np.zeros(len(whole), np.uint8)
            at = np.flatnonzero(maybe[whole & low])
            if len(at):
                place = np.minimum(np.searchsorted(known, whole[at]), len(known) - 1)
                rank[at] = np.where(known[place] == whole[at], often[place], 0)
            start, prefixes = 0, []
            for s in sets:
                keep = len(s) - -(-percent * len(s) // 100) + 1
                own = rank[start : start + len(s)]
                start += len(s)
                rarest = s[np.argsort(own, kind="stable")[:keep]] if own.any() else s[:keep]
                prefixes.append(rarest.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                ["doc_id", "n", "prefix"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, prefix array<long>").where("n > 0")


def _gathered(batches) -> Iterator[np.ndarray]:
    """The columns of the batches, all integers, as rows of arrays of about ``ROWS`` columns."""
    held, n = [], 0
    for batch in batches:
        held.append(np.stack([c.to_numpy() for c in batch.columns]))
        n += batch.num_rows
        if n >= ROWS:
            yield np.concatenate(held, 1)
            held, n = [], 0
    if n:
        yield np.concatenate(held, 1)


def _may_be_linked(token: np.ndarray, doc: np.ndarray, shape: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of the groups have a partner that the sizes of both sets and what is left of them allow."""
    n, left = shape >> 32, shape & ((1 << 32) - 1)
    # A pair may be linked if neither set's size exceeds what the other one's size and rest reach.
    reach = left * (100 + percent) // percent - n
    start = np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)])
    size = np.diff(np.append(start, len(token)))
    good = np.zeros(len(token), bool)
    a, step = np.flatnonzero(np.repeat(size <= LARGE, size)), 0
    while len(a):
        step += 1
        a = a[: np.searchsorted(a, len(token) - step)]
        a = a[token[a] == token[a + step]]
        b = a + step
        pair = (n[a] <= reach[b]) & (n[b] <= reach[a]) & (doc[a] != doc[b])
        good[a[pair]] = good[b[pair]] = True
    for at, m in zip(start[size > LARGE].tolist(), size[size > LARGE].tolist(), strict=True):
        good[at : at + m] = _reached(n[at : at + m], reach[at : at + m])
    return good


def _reached(n: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Which members of one group have another one with n <= its reach and reach >= its n."""
    order = np.argsort(n, kind="stable")
    n, reach = n[order], reach[order]
    tops = [reach]  # the greatest reach of 1, 2, 4... members from each one on
    while (span := 1 << len(tops)) <= len(n):
        tops.append(np.maximum(tops[-1][: -span // 2], tops[-1][span // 2 :]))

    def top(low, high):
        """The greatest reach of the members from low to high, without high; -1 if there are none."""
        out = np.full(len(n), -1, np.int64)
        some = np.flatnonzero(high > low)
        level = np.frexp((high - low)[some])[1] - 1
        for k in np.unique(level):
            at = some[level == k]
            out[at] = np.maximum(tops[k][low[at]], tops[k][high[at] - (1 << int(k))])
        return out

    own, most = np.arange(len(n)), np.searchsorted(n, reach, "right")
    good = np.maximum(top(np.zeros(len(n), np.int64), np.minimum(own, most)), top(own + 1, most)) >= n
    out = np.empty(len(n), bool)
    out[order] = good
    return out


_GROUP = pa.schema([("m", pa.int64()), ("members", pa.int64()), ("token", pa.int64()), ("docs", pa.list_(pa.int64()))])


def _group_rows(rows: np.ndarray, in_pieces: bool) -> pa.RecordBatch:
    """Groups of the rows (token, doc_id, shape), or pieces of groups that are not told as a whole."""
    new = np.ones(rows.shape[1], bool)
    new[1:] = rows[0, 1:] != rows[0, :-1]
    if in_pieces:
        new[::4096] = True
    at = np.flatnonzero(new)
    m = np.diff(np.append(at, len(new)))
    members = np.add.reduceat(_mix(rows[1].view(np.uint64)), at).view(np.int64) if len(at) else at
    docs = pa.ListArray.from_arrays(pa.array(np.append(at, len(new)), pa.int32()), pa.array(rows[1]))
    return pa.RecordBatch.from_arrays([pa.array(0 * m if in_pieces else m), pa.array(members), pa.array(rows[0][at]), docs], schema=_GROUP)


def _possible_groups(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """``_groups`` of batches that are sorted by token and doc_id."""
    rest, large, last = np.zeros((3, 0), np.int64), None, None
    for more in itertools.chain(_gathered(batches), [None]):
        rows = rest if more is None else np.concatenate([rest, more], 1)
        # The last group may go on, unless nothing comes.
        cut = rows.shape[1] if more is None else int(np.searchsorted(rows[0], rows[0, -1]))
        rest = rows[:, cut:]
        if rest.shape[1] > ROWS or rest.shape[1] and rest[0, 0] == large:
            cut, rest = rows.shape[1], rest[:, :0]
        rows = rows[:, :cut]
        if not cut:
            continue
        start = np.flatnonzero(np.append(True, rows[0, 1:] != rows[0, :-1]))
        size = np.diff(np.append(start, cut))
        wide = np.repeat((size > ROWS) | (rows[0, start] == large), size)
        large = rows[0, -1] if wide[-1] else None
        good = wide.copy()
        good[~wide] = _may_be_linked(*rows[:, ~wide], percent)
        # A document that comes under a shingle with several sets is one member, if any of them is.
        once = np.append(last != (rows[0, 0], rows[1, 0]), (rows[:2, 1:] != rows[:2, :-1]).any(0))
        first = np.flatnonzero(once)
        if len(first):
            good[first] = np.logical_or.reduceat(good, first)
        last = (rows[0, -1], rows[1, -1])
        yield _group_rows(rows[:, good & once & ~wide], False)
        yield _group_rows(rows[:, good & once & wide], True)


def _groups(tokens: DataFrame, percent: int) -> DataFrame:
    """(m, members, token, docs) of the groups of ``tokens`` (token, doc_id, shape): number of members,
    hash of them, and their ids in order. Members without a partner that they may be linked to are
    left out. Groups with more than ``ROWS`` rows keep all, and come in pieces; their m is 0.
    ``shape`` is the set's size and, in the lower 32 bits, how many shingles it has from this one on."""
    dealt = tokens.repartition("token").sortWithinPartitions("token", "doc_id")
    return dealt.mapInArrow(lambda batches: _possible_groups(batches, percent), "m long, members long, token long, docs array<long>")


def _first_of_alike(batches) -> Iterator[pa.RecordBatch]:
    """``_once`` of batches that are sorted by members and m."""
    last = None
    for batch in batches:
        m, members = (batch.column(i).to_numpy() for i in range(2))
        if not len(m):
            continue
        new = np.append(last != (m[0], members[0]), (m[1:] != m[:-1]) | (members[1:] != members[:-1])) | (m == 0)
        last = (m[-1], members[-1])
        kept = batch.filter(pa.array(new))
        docs = kept.column(3)
        token = np.repeat(kept.column(2).to_numpy(), docs.value_lengths().to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(token), docs.flatten()], ["token", "doc_id"])


def _once(groups: DataFrame) -> DataFrame:
    """(token, doc_id) of ``_groups``; of those with the same members one, unless they are in pieces."""
    dealt = groups.repartition("members").sortWithinPartitions("members", "m", "token")
    return dealt.mapInArrow(_first_of_alike, "token long, doc_id long")


def _by_group(batches, columns: int) -> Iterator[tuple]:
    """Rows of one group after the other, from batches sorted by the first column."""
    rest: list[tuple] = []
    key = None
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(columns)), strict=True):
            if row[0] != key and rest:
                yield tuple(zip(*rest, strict=True))
                rest = []
            key = row[0]
            rest.append(row)
    if rest:
        yield tuple(zip(*rest, strict=True))


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _home_links(grouped: DataFrame, words: int, percent: int) -> DataFrame:
    """Links inside the groups of ``grouped`` (key, doc_id, component, text), enough of them to
    join what can be joined; each group has about ``LEAVES`` rows at most."""

    def run(batches):
        for _, ids, comps, texts in _by_group(batches, 4):
            if len(ids) < 2:
                continue
            sets = shingle_sets(list(texts), words)
            known, found = _Sets(list(comps)), []
            sizes = np.array([len(s) for s in sets])
            if len(ids) == 2:
                order = [(0, 1)]
            else:
                order = candidates(sizes, [bitmap(s, width_of(len(s))) for s in sets], percent)
            for i, j in order:
                if known.find(i) != known.find(j) and _linked(sets[i], sets[j], percent):
                    known.join(i, j)
                    found.append((ids[i], ids[j]))
            if found:
                yield _pair_batch(found)

    return grouped.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long")


def _unit_candidates(units: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that the bitmaps of ``units`` (task, doc_id, component,
    side, n, bits) can't tell from linked ones. In a task with both sides only pairs across count."""

    def run(batches):
        out: list[tuple[int, int]] = []
        for _, ids, comps, sides, sizes, bits in _by_group(batches, 6):
            if len(set(comps)) < 2:
                continue
            mixed = len(set(sides)) > 1
            maps = [np.frombuffer(b, np.uint64) for b in bits]
            for i, j in candidates(np.array(sizes), maps, percent):
                if comps[i] != comps[j] and not (mixed and sides[i] == sides[j]):
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
            if len(out) > 10_000:
                yield _pair_batch(sorted(set(out)))
                out = []
        yield _pair_batch(sorted(set(out)))

    return units.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that are linked. Each text goes once to every pair it is in."""

    def run(batches):
        known: dict[str, np.ndarray] = {}
        for pair, ids, found in _by_group(batches, 3):
            a, b = pair[0]["a"], pair[0]["b"]
            if len(known) > 2000:
                known.clear()
            sets = [known[t] if t in known else known.setdefault(t, shingles(t, words)) for t in found]
            if any(_linked(x, y, percent) for x, i in zip(sets, ids, strict=True) if i == a for y, j in zip(sets, ids, strict=True) if j == b):
                yield _pair_batch([(a, b)])

    sides = pairs.select(F.struct("a", "b").alias("pair"), F.explode(F.array("a", "b")).alias("doc_id"))
    rows = sides.join(texts, "doc_id").select("pair", "doc_id", "text")
    return rows.repartition("pair").sortWithinPartitions("pair").mapInArrow(run, "a long, b long")


def _signatures(base: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, bits, text) of the documents of ``ids``, and of few others: rows are chosen where they
    are read, by ``SLOTS`` bits, so that no text is shuffled for it."""
    sign = T.StructType.fromDDL("doc_id long, n long, bits binary, text string")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).alias("slot")
    taken = np.zeros(SLOTS, bool)
    taken[ids.select(slot).distinct().toArrow().column("slot").to_numpy()] = True
    shared = base.sparkSession.sparkContext.broadcast(np.packbits(taken))

    def run(batches):
        taken = np.unpackbits(shared.value).astype(bool)
        chosen = (batch.filter(pa.array(taken[batch.column(2).to_numpy()])) for batch in batches)
        for part, texts in texts_in_bites(chosen, "text"):
            own = shingle_sets(texts, words)
            bits = [bitmap(s, width_of(len(s))).tobytes() for s in own]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in own], pa.int64()), pa.array(bits, pa.binary()), part.column(1)],
                names=sign.names,
            )

    return base.where("doc_id is not null").select("doc_id", "text", slot).mapInArrow(run, sign)


#: What tells groups with different members apart.
_ALIKE = ("m", "members", "first")


def _mixed_groups(rows: DataFrame) -> DataFrame:
    """(m, members, first, token) of the groups of ``rows`` (token, doc_id, component) in which several
    components meet: number, hash and smallest of their ids. One of those with the same members."""
    groups = rows.groupBy("token").agg(
        F.count("*").alias("m"),
        F.bit_xor(F.xxhash64("doc_id")).alias("members"),
        F.min("doc_id").alias("first"),
        F.min("component").alias("c"),
        F.max("component").alias("d"),
    )
    return groups.where("c <> d").groupBy(*_ALIKE).agg(F.min("token").alias("token"))


def _with_component(rows: DataFrame, found: DataFrame) -> DataFrame:
    return rows.join(found, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))


def link_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) of each row.

    ``docs`` needs doc_id (an integer) and text; other columns are ignored. Two documents are
    linked when 100 times the size of their sets' intersection is at least ``percent`` times
    that of their union. Null texts and texts without words have empty sets and no links; a
    text with fewer than ``words`` words is one shingle. Repeated rows stay; rows that share
    an id are one document with several texts and so one component. Rows without an id cannot
    be named by links: their component is null. No rows give no rows. Sets are compared by
    64-bit hashes of their shingles.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = stored(_counted(base, words), "sets")
    sets = counted.where("times is null").select("doc_id", "n", "set_hash")
    whole = sets.where("n > 0 and doc_id is not null")
    # Equal sets: one of them stands for all.
    stands = stored(whole.groupBy("set_hash", "n").agg(F.min("doc_id").alias("doc_id")), "stands")
    prefixes = _prefixes(base.where("doc_id is not null"), _frequent(counted), words, percent)
    prefixes = prefixes.join(stands.select("doc_id").distinct(), "doc_id", "left_semi")
    tokens = prefixes.select("doc_id", "n", F.posexplode("prefix").alias("before", "token")).select(
        "token", "doc_id", F.shiftleft("n", 32).bitwiseOR(F.col("n") - F.col("before")).alias("shape")
    )
    groups = stored(_groups(tokens, percent), "groups-met")
    met = stored(_once(groups), "met")
    discard(groups)
    homes = met.groupBy("doc_id").agg(
        *[F.min(F.struct(F.xxhash64("token", F.lit(r)).alias("h"), "token")).alias(f"home{r}") for r in range(HOMES)]
    )
    homes = stored(homes.select("doc_id", *[F.col(f"home{r}.token").alias(f"home{r}") for r in range(HOMES)]), "homes")
    texts = stored(_signatures(base, homes, words), "signatures")
    # Rows that share an id with another set tie the two sets' components together.
    several = whole.groupBy("doc_id").agg(F.min("set_hash").alias("s"), F.max("set_hash").alias("t")).where("s <> t").select("doc_id")
    tied = (
        whole.join(several, "doc_id")
        .join(stands.withColumnRenamed("doc_id", "stand"), ["set_hash", "n"])
        .select(F.col("doc_id").alias("a"), F.col("stand").alias("b"))
    )
    links = stored(tied, "tied")
    found = components(links)
    # Groups that went to one tree: all their links are found.
    settled = None
    # One home at a time: a step shuffles each text by its id and by its home, and no more.
    for r in range(HOMES):
        keyed = _with_component(homes.select("doc_id", F.col(f"home{r}").alias("token")), found)
        groups = _mixed_groups(keyed)
        if settled is not None:
            groups = groups.join(settled, [*_ALIKE], "left_anti")
        groups = stored(groups, "home-groups")
        whole_ones = groups.where(F.col("m") <= LEAVES).select(*_ALIKE)
        settled = whole_ones if settled is None else settled.unionByName(whole_ones)
        groups = groups.select("token", "first", F.ceil(F.col("m") / LEAVES).cast("int").alias("parts"))
        dealt = keyed.join(groups, "token").select(
            "doc_id",
            "component",
            "token",
            # A large group goes to several trees, with one document in common.
            F.explode(
                F.when(F.col("doc_id") == F.col("first"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
                    F.array(F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
                )
            ).alias("part"),
        )
        rows = dealt.join(texts.select("doc_id", "text"), "doc_id")
        key = F.xxhash64("token", "part").alias("key")
        more = _home_links(rows.select(key, "doc_id", "component", "text"), words, percent)
        links = stored(links.unionByName(more), "home-links")
        found = components(links)
    found = stored(found, "found")
    # What several components still share.
    meets = stored(_with_component(met, found), "meets")
    groups = _mixed_groups(meets).join(settled, [*_ALIKE], "left_anti").select("token", "first", "m")
    shared = stored(meets.join(groups, "token").select("token", "first", "m", "doc_id", "component"), "shared")
    big = shared.where(F.col("m") >= LARGE)
    unit = components(big.select(F.col("first").alias("a"), F.col("doc_id").alias("b"))).withColumnRenamed("component", "unit")
    units = (
        shared.where(F.col("m") < LARGE)
        .select(F.col("token").alias("unit"), F.lit(False).alias("large"), "doc_id", "component")
        .unionByName(big.join(unit, "doc_id").select("unit", F.lit(True).alias("large"), "doc_id", "component").distinct())
    )
    units = stored(units, "units")
    # In each unit the largest component against the rest, and the rest among themselves.
    weight = units.groupBy("unit", "large", "component").agg(F.count("*").alias("m"))
    major = weight.groupBy("unit", "large").agg(
        F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("total")
    )
    parts = lambda n: F.greatest(F.lit(1), F.ceil(n / LEAVES)).cast("int")
    sized = units.join(
        major.select(
            "unit",
            "large",
            F.col("top.component").alias("top"),
            parts(F.col("top.m")).alias("k"),
            parts(F.col("total") - F.col("top.m")).alias("q"),
        ),
        ["unit", "large"],
    )
    pick = lambda n: F.pmod(F.xxhash64("doc_id"), n).cast("int")
    upto = lambda n: F.sequence(F.lit(0), n - 1)
    own = pick(F.col("q"))
    tasks = F.when(
        F.col("component") == F.col("top"), F.transform(upto(F.col("q")), lambda j: F.struct(F.lit(0).alias("kind"), pick(F.col("k")).alias("x"), j.alias("y")))
    ).otherwise(
        F.concat(
            F.transform(upto(F.col("k")), lambda i: F.struct(F.lit(0).alias("kind"), i.alias("x"), own.alias("y"))),
            F.transform(upto(F.col("q")), lambda j: F.struct(F.lit(1).alias("kind"), F.least(j, own).alias("x"), F.greatest(j, own).alias("y"))),
        )
    )
    side = F.when(F.col("task.kind") == 0, (F.col("component") == F.col("top")).cast("int")).otherwise(
        F.when(F.col("task.x") == F.col("task.y"), 0).otherwise((own == F.col("task.x")).cast("int"))
    )
    dealt = (
        sized.withColumn("task", F.explode(tasks))
        .select("doc_id", "component", side.alias("side"), F.xxhash64("unit", "large", "task.kind", "task.x", "task.y").alias("task"))
        .join(texts.select("doc_id", "n", "bits"), "doc_id")
        .select("task", "doc_id", "component", "side", "n", "bits")
    )
    pairs = stored(_unit_candidates(dealt, percent).distinct(), "candidates")
    last = _verified(pairs, texts.select("doc_id", "text"), words, percent)
    found = stored(components(links.unionByName(last)), "components")
    discard(texts, met, meets, shared, units, pairs)
    joined = (
        sets.select("doc_id", "n", "set_hash")
        .join(stands.withColumnRenamed("doc_id", "stand"), ["set_hash", "n"], "left")
        .withColumn("stand", F.when(F.col("n") > 0, F.coalesce("stand", "doc_id")).otherwise(F.col("doc_id")))
        .join(found.withColumnRenamed("doc_id", "stand"), "stand", "left")
    )
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "stand")).alias("component_id"),
    )
