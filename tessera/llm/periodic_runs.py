"""Runs in texts: stretches of words that repeat with a period, found with a suffix automaton.

The automaton of a text's words has a state for each set of places where the same strings of words end. From the longest strings to the
shorter ones, the sets of a state's children are merged, the smaller into the larger one, each in order. When a place joins a set, it
gets neighbours there; if it is no farther from one than the state's strings are long, d say, the string of d words before it occurs twice in a
row, a square that no word before the state's string extends. It stands for a run if the next word doesn't go on with the period. Every
run comes up once, at its last word: two places a period apart there share the run but for one period, their common state, and no place
between them does, for then the run would have a smaller period.

Only words that lie in a sequence of six words found twice or more in their part of the text can be in a run of twelve words; a text is cut at
all others, again and again until nothing changes, and the automaton is built for each of the parts that are left.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm import common
from tessera.llm.text import mix, repeated

LEAST = 12  # words of a run
GRAM = LEAST // 2
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


class Places:
    """Numbers in order, in lists of at most 2 * SIZE, so that one is put in without moving all."""

    SIZE = 512
    __slots__ = ("lists", "lows", "n")

    def __init__(self, first: int):
        self.lists, self.lows, self.n = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for part in self.lists:
            yield from part

    def add(self, x: int) -> tuple[int, int]:
        """Puts x in and returns its neighbours, -1 where there is none."""
        k = max(bisect_left(self.lows, x) - 1, 0)
        part = self.lists[k]
        at = bisect_left(part, x)
        before = part[at - 1] if at else -1
        after = part[at] if at < len(part) else self.lows[k + 1] if k + 1 < len(self.lows) else -1
        part.insert(at, x)
        self.n += 1
        if not at:
            self.lows[k] = x
        if len(part) > 2 * self.SIZE:
            self.lists[k : k + 1] = [part[: self.SIZE], part[self.SIZE :]]
            self.lows.insert(k + 1, part[self.SIZE])
        return before, after


def automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Of the states of the suffix automaton of a sequence: the length of the longest string, the state of its longest suffix elsewhere
    (link), and the place where the prefix that made the state ends (-1 for copies). State 0 is the empty string. Most states lead on by one
    word only, which is kept without a table of its own."""
    length, link, place = [0], [-1], [-1]
    by, to, more = [-1], [-1], {}  # a state's first way on, and tables for those with several
    last = 0
    for at, w in enumerate(word):
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        place.append(at)
        by.append(-1)
        to.append(-1)
        p = last
        last = new
        q = -1
        while p >= 0:
            if by[p] == w:
                q = to[p]
                break
            if by[p] < 0:
                by[p], to[p] = w, new
            else:
                ways = more.setdefault(p, {})
                if w in ways:
                    q = ways[w]
                    break
                ways[w] = new
            p = link[p]
        if q < 0:
            continue
        if length[q] == length[p] + 1:
            link[new] = q
            continue
        copy = len(length)
        length.append(length[p] + 1)
        link.append(link[q])
        place.append(-1)
        by.append(by[q])
        to.append(to[q])
        if q in more:
            more[copy] = dict(more[q])
        link[q] = link[new] = copy
        while p >= 0:
            if by[p] == w:
                if to[p] != q:
                    break
                to[p] = copy
            else:
                ways = more.get(p)
                if ways is None or ways.get(w) != q:
                    break
                ways[w] = copy
            p = link[p]
    return length, link, place


def runs_of(word: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of `least` words or more in a sequence of word numbers."""
    n = len(word)
    length, link, place = automaton(word)
    half = (least + 1) // 2  # a run is at most twice as long as the string of its last places' state
    order = np.argsort(np.array(length), kind="stable")[::-1].tolist()
    sets: list = [None if p < 0 else Places(p) for p in place]
    out = []

    def met(p: int, e: int, size: int) -> None:
        d = e - p
        if d <= size and size + d >= least and (e + 1 == n or word[p + 1] != word[e + 1]):
            out.append((p - size + 1, size + d, d))

    for state in order:
        mine, sets[state] = sets[state], None
        up = link[state]
        if up <= 0 or length[up] < half or mine is None:
            continue
        theirs = sets[up]
        if theirs is None:
            sets[up] = mine
            continue
        small, large = (mine, theirs) if mine.n <= theirs.n else (theirs, mine)
        size, last = length[up], -1
        for x in small:
            before, after = large.add(x)
            if before != last:  # those of one set have met before
                met(before, x, size)
            last = x
            if after >= 0:
                met(x, after, size)
        sets[up] = large
    return sorted(out)


def parts(hashes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (from, to) of words outside which no run lies: each word is in a sequence of GRAM words that occurs twice or more in the stretch."""
    n = len(hashes)
    if n < LEAST:
        return []
    step = np.uint64(0x9E3779B97F4A7C15)
    gram = np.zeros(n - GRAM + 1, np.uint64)
    for k in range(GRAM):
        gram = gram * step + hashes[k : n - GRAM + 1 + k]
    gram = mix(gram)
    key, live = gram, np.arange(len(gram))
    while len(live):
        again = live[repeated(key)]
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, again, 1)
        np.subtract.at(edge, again + GRAM, 1)
        inside = np.cumsum(edge[:n]) > 0
        turn = np.flatnonzero(np.diff(np.r_[False, inside, False]))
        a, b = turn[::2], turn[1::2]
        long = b - a >= LEAST
        a, b = a[long], b[long]
        if not len(a):
            return []
        of = np.searchsorted(a, live, "right") - 1
        keep = (of >= 0) & (live + GRAM <= b[np.maximum(of, 0)])
        if keep.all() and len(again) == len(live):
            return list(zip(a.tolist(), b.tolist()))
        keep &= np.isin(live, again, assume_unique=True)
        live, of = live[keep], of[keep]
        key = mix(gram[live] + of.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
    return []


def runs_of_words(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text's words, by start and period."""
    if len(words) < LEAST:
        return []
    out = []
    for a, b in parts(np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)):
        number: dict[bytes, int] = {}
        out += [(a + s, length, q) for s, length, q in runs_of([number.setdefault(w, len(number)) for w in words[a:b]])]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    drop = np.cumsum(edge[:-1]) > 0
    return [w for w, gone in zip(words, drop.tolist()) if not gone]


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, runs (an array of start, length and period in words, by start and period) and collapsed (the words that no run holds after its first
    period, joined by single spaces).

    Words are what lies between spaces and the characters 9 to 13. A run has a smallest period q, at least 12 words and twice q, and can't be
    extended by a word. Null and empty texts have no words, no runs and an empty collapsed text. Every row is judged by itself, repeated rows
    alike; texts are read whole, at some hundred bytes of memory for each word that may be in a run. An empty table gives no rows. Columns of docs with these names are
    replaced, others stay as they are.
    """
    names = ("n_words", "runs", "collapsed")
    own = [c for c in docs.columns if c.lower() not in names]
    common.prepare(docs.sparkSession)
    schema = T.StructType([f for f in docs.schema.fields if f.name in own])
    schema = schema.add("n_words", T.LongType()).add("runs", T.ArrayType(RUN)).add("collapsed", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
        for batch in batches:
            count, found, short = [], [], []
            for value in batch.column(text).cast(pa.large_binary()):
                words = (value.as_py() or b"").split()
                runs = runs_of_words(words)
                count.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                short.append(b" ".join(kept(words, runs)))
            new = [pa.array(count, pa.int64()), pa.array(found, pa.list_(kind)), pa.array(short, pa.large_binary()).cast(pa.large_string()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *new], names=[*own, *names])

    return docs.select(*own).mapInArrow(run, schema)
