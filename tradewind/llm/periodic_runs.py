"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q, at least
``least`` and at least 2 q words long, that no neighbouring word extends.

Method, per text: words are appended to a suffix automaton one after the other.
Its suffix links form a tree in which the path from the newest state to the root
holds every suffix of what has been read.  The tree is kept as a link-cut tree
whose preferred paths are the stretches of states with one last end position.
Appending word i accesses the new state: the walk to the root meets the path's
segments, each with the last end position e of its suffixes and the length m of
its longest, and recolours them all with i.  If the distance d = i - e is at most
m, the last d + m words repeat with period d and hold a square; d is then their
smallest period, and they reach as far left as that period goes.  A run shows up
so at each end position from its second period on, always with the same start,
and the last of them is its end.  A walk costs O(log n) amortised.

Before that, stretches that hold no run are set aside: in a run, every word lies
in a gram of ``least // 2`` words that occurs twice within the run.  Words outside
all grams that recur in their stretch end a stretch, until none is left out any
more; only stretches of ``least`` words or more are appended, each to an automaton
of its own.  (Equal grams have equal hashes, so no run is lost.)

Every text is one row of a narrow Arrow map: no shuffle, and a lost executor
costs its own tasks only.  Memory is that of one text's words and states.

Defined results: words are runs of bytes other than blank and 0x09-0x0D; NULL and
empty texts have no words, no runs and an empty collapsed text; repeated rows each
get a result; an empty table gives an empty result; columns other than key and
text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words that a run has at least.
LEAST = 12

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
Run = tuple[int, int, int]


class LastOccurrences:
    """Suffix automaton of a growing sequence; each appended item reports its squares."""

    def __init__(self) -> None:
        # States of the automaton; state 0 is the empty word.
        self.length, self.link, self.next = [0], [-1], [{}]
        self.last, self.end = 0, -1
        # Splay trees over preferred paths, shallow states to the left.  The root of a
        # tree holds the path's colour (the last end position) and points up to the
        # parent of the path's top state.
        self.up, self.left, self.right, self.colour = [-1], [-1], [-1], [-1]

    def _state(self, length: int, link: int, moves: dict, colour: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(moves)
        self.up.append(link)
        self.left.append(-1)
        self.right.append(-1)
        self.colour.append(colour)
        return len(self.length) - 1

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            left[p] = b = right[x]
            right[x] = p
        else:
            right[p] = b = left[x]
            left[x] = p
        if b >= 0:
            up[b] = p
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
            else:                       # p was a root: its path's colour moves to x
                self.colour[x] = self.colour[p]
        else:
            self.colour[x] = self.colour[p]
        up[x] = g
        up[p] = x

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _insert_above(self, q: int, clone: int) -> None:
        """``clone`` becomes the parent of ``q`` on the path of ``q``."""
        self._splay(q)
        above = self.left[q]
        self.left[clone], self.left[q] = above, clone
        self.up[clone] = q
        if above >= 0:
            self.up[above] = clone

    def append(self, item: int) -> list[tuple[int, int]]:
        """Append ``item``; (distance, longest length) of each segment that makes a square."""
        length, link, moves = self.length, self.link, self.next
        self.end += 1
        p = self.last
        state = self._state(length[p] + 1, 0, {}, self.end)
        while p >= 0 and item not in moves[p]:
            moves[p][item] = state
            p = link[p]
        parent = 0
        if p >= 0:
            q = moves[p][item]
            if length[q] == length[p] + 1:
                parent = q
            else:
                parent = self._state(length[p] + 1, link[q], moves[q].copy(), -1)
                self._insert_above(q, parent)
                link[q] = parent
                while p >= 0 and moves[p].get(item) == q:
                    moves[p][item] = parent
                    p = link[p]
        link[state] = self.up[state] = parent
        self.last = state
        return self._access(state)

    def _access(self, state: int) -> list[tuple[int, int]]:
        """Recolour the path from ``state`` to the root; squares among the segments met."""
        end, found = self.end, []
        up, right, colour, length = self.up, self.right, self.colour, self.length
        below, x = state, up[state]
        while x >= 0:
            self._splay(x)
            cut = right[x]
            if cut >= 0:
                colour[cut] = colour[x]
            right[x] = below
            distance = end - colour[x]
            if colour[x] >= 0 and length[x] >= distance:
                found.append((distance, length[x]))
            below, x = x, up[x]
        colour[below] = end
        return found


def runs_of(items: Sequence[int], least: int = LEAST) -> list[Run]:
    """``(start, length, period)`` of the runs of a sequence, by start, then period."""
    automaton, ends = LastOccurrences(), {}
    for i, item in enumerate(items):
        for distance, longest in automaton.append(item):
            ends[i + 1 - longest - distance, distance] = i + 1
    return sorted((s, e - s, d) for (s, d), e in ends.items() if e - s >= max(least, 2 * d))


def _stretches(hashes: np.ndarray, gram: int, least: int) -> list[tuple[int, int]]:
    """Begin and end of the stretches that may hold runs."""
    todo, done = [(0, len(hashes))], []
    while todo:
        begin, end = todo.pop()
        if end - begin < least:
            continue
        h = hashes[begin:end]
        n = len(h) - gram + 1
        grams = h[:n].copy()
        for k in range(1, gram):
            grams *= np.uint64(0x9E3779B97F4A7C15)
            grams += h[k:n + k]
        order = np.argsort(grams, kind="stable")
        same = grams[order[1:]] == grams[order[:-1]]
        if not same.any():
            continue
        covered = np.zeros(len(h) + 1, np.int32)
        again = np.zeros(n, bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        at = np.flatnonzero(again)
        covered[at] += 1
        covered[at + gram] -= 1
        inside = np.concatenate(([False], np.cumsum(covered)[:-1] > 0, [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        parts = [(begin + int(a), begin + int(b)) for a, b in zip(edges[::2], edges[1::2])]
        (done if parts == [(begin, end)] else todo).extend(parts)
    return done


def text_runs(words: Sequence[bytes], least: int = LEAST) -> list[Run]:
    """Runs of a text's words, by start, then period."""
    if len(words) < least:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    found = []
    for begin, end in _stretches(hashes, max(least // 2, 1), least):
        number: dict[bytes, int] = {}
        items = [number.setdefault(w, len(number)) for w in words[begin:end]]
        found += [(begin + s, m, q) for s, m, q in runs_of(items, least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> bytes:
    """The words joined by a blank, without those that a run has after its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``key``, ``n_words``, ``runs`` (structs of start, length, period, by start, then period) and
    ``collapsed`` (the text with one period kept of each run) for every row of ``df``."""
    source = df.select(F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("t"))
    key_type = source.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                counts, runs, texts = [], [], []
                for t in part.column("t"):
                    words = t.as_py().split()           # bytes: blank and 0x09-0x0D
                    own = text_runs(words, least)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": m, "period": q} for s, m, q in own])
                    texts.append(collapsed(words, own))
                yield pa.record_batch([part.column("k"), pa.array(counts, pa.int64()), pa.array(runs, _RUNS),
                                       pa.array(texts, pa.binary()).cast(pa.string())],
                                      names=["k", "n_words", "runs", "collapsed"])

    return source.mapInArrow(run, f"k {key_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                                  "collapsed string").withColumnRenamed("k", key)
