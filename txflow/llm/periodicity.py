"""Periodic runs of words by a suffix automaton and recolouring accesses.

A run is a stretch of words with a smallest period that no neighbouring word extends. Word by
word, the path from the current prefix's state to the root of the suffix-link tree is accessed and
takes the current end as the colour of its last occurrence. The pieces of the path that had one
colour before tell the previous ends: where the distance to the new end is at most the longest
string of the piece, that string and its copy make a square, and the piece's length says how
far to the left its period goes. Squares of one start and period are one run.

As in link-cut trees a piece hangs together at its top, and an access cuts and joins pieces, which
are few when added up over all words. The tree is known before the first access, so the pieces of a heavy path are
kept in one stack in place of a splay tree.

Only words of short strings that occur again in the same stretch get into the automaton: a run has no others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txflow.llm.common import texts_in_bites, words_of

#: A run has at least so many words.
LEAST = 12


def _automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """Longest string and suffix link of each state, and the states of the prefixes."""
    length, link, steps = [0], [-1], [{}]
    ends, last = [], 0
    for word in words:
        state = len(length)
        length.append(length[last] + 1)
        link.append(0)
        steps.append({})
        at, last = last, state
        while at >= 0 and word not in steps[at]:
            steps[at][word] = state
            at = link[at]
        if at >= 0:
            to = steps[at][word]
            if length[to] != length[at] + 1:
                copy = len(length)
                length.append(length[at] + 1)
                link.append(link[to])
                steps.append(steps[to].copy())
                while at >= 0 and steps[at].get(word) == to:
                    steps[at][word] = copy
                    at = link[at]
                link[to] = to = copy
            link[state] = to
        ends.append(state)
    return length, link, ends


def _heads(length: list[int], link: list[int]) -> list[int]:
    """The top state of the heavy path of each state."""
    downwards = np.argsort(np.array(length), kind="stable").tolist()
    size, heavy, head = [1] * len(link), [-1] * len(link), list(range(len(link)))
    for state in reversed(downwards[1:]):
        above = link[state]
        size[above] += size[state]
        if heavy[above] < 0 or size[state] > size[heavy[above]]:
            heavy[above] = state
    for state in downwards[1:]:
        if heavy[link[state]] == state:
            head[state] = head[link[state]]
    return head


def squares(words: list) -> dict[tuple[int, int], int]:
    """(period, start) of the runs of at least two periods, with the number of their last word."""
    length, link, ends = _automaton(words)
    head = _heads(length, link)
    # Pieces of each heavy path, as (longest string, last end); the highest is the last.
    pieces: dict[int, list[tuple[int, int]]] = {}
    found: dict[tuple[int, int], int] = {}
    for end, state in enumerate(ends):
        below = -1
        while state > 0:
            top, depth = head[state], length[state]
            stack = pieces.setdefault(top, [])
            highest = stack[-1][1] if stack else below
            while stack:
                low, before = stack[-1]
                common = min(low, depth)
                # A piece that goes on below was judged there, at its whole length.
                if before != below and end - before <= common:
                    found[end - before, before - common + 1] = end
                if low > depth:
                    break
                stack.pop()
                if low == depth:
                    break
            stack.append((depth, end))
            below = highest
            state = link[top]
    return found


def _stretches(codes: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Stretches of words, start and end, each covered by strings of ``size`` words that occur twice
    in it. A run of 2 * ``size`` words or more lies in one of them."""
    todo, done = [(0, len(codes))], []
    while todo:
        low, high = todo.pop()
        if high - low < 2 * size:
            continue
        own = codes[low:high]
        gram = own[: len(own) - size + 1].copy()
        for i in range(1, size):
            gram *= np.int64(0x5851F42D4C957F2D)
            gram += own[i : len(own) - size + 1 + i]
        order = np.sort(gram)
        again = order[1:][order[1:] == order[:-1]]
        if not len(again):
            continue
        first = np.flatnonzero(np.isin(gram, again))
        new = np.flatnonzero(np.diff(first, prepend=-size - 1) > size)
        starts, lasts = first[new], first[np.append(new[1:], len(first)) - 1] + size
        parts = [(low + int(a), low + int(b)) for a, b in zip(starts, lasts, strict=True)]
        if parts == [(low, high)]:
            done += parts
        else:
            todo += parts
    return done


def runs_of(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of at least ``least`` words and two periods, in order."""
    if len(words) < least:
        return []
    codes = np.fromiter(map(hash, words), np.int64, len(words))
    found = []
    for low, high in _stretches(codes, max(1, least // 2)):
        for (period, start), end in squares(words[low:high]).items():
            if end - start + 1 >= least:
                found.append((low + start, end - start + 1, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The periodic runs of each row of ``docs`` (doc_id, text; other columns ignored).

    Words are runs without ASCII white space. Returns doc_id, n_words, runs (start, length and
    period of each, by start, then period) and collapsed: the words but those that a run
    contains after its first period, joined by one space. Null, empty and short texts have no
    runs; rows may repeat, each is judged alone. A document is one task's work: its words are
    held at once, and about half a kilobyte for each word in periodic stretches.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def run(batches):
        for part, texts in texts_in_bites(batches, "text"):
            sizes, runs, collapsed = [], [], []
            for text in texts:
                words = words_of(text)
                own = runs_of(words, least)
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                if own:
                    depth = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in own:
                        depth[start + period] += 1
                        depth[start + length] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                collapsed.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(runs, run_type), pa.array(collapsed, pa.string())], names
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
