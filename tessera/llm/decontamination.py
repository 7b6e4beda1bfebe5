"""Benchmark decontamination by q-gram lemma filtering.

The query set is the benchmark's items; all documents run against it, in blocks of items of bounded size. A document's
character q-grams (bytes, A-Z lower-cased, white space as one kind) are looked up among the items' q-grams; hits are counted
in overlapping bands of diagonals, and a band is retained where the count meets the bound of the q-gram lemma: an
occurrence of an item of m bytes with at most e edits shares at least m + 1 - q * (e + 1) q-grams with it, all within 2 e + 1
neighbouring diagonals. Retained regions are verified by alignment within the band.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import text as tx
from tessera.llm.common import prepare

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
HIT = "item_id long, edits int, begin long, finish long"
#: Hits of texts' q-grams with the index that are held at once, some 100 bytes each.
HITS = 1 << 20


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q bytes from each position, q <= 16; up to 8 it stands for these bytes alone."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if q < 8:
        g = np.zeros(n, np.uint64)
        for k in range(q):
            g = (g << np.uint64(8)) | data[k : k + n]
        return tx.mix(g)
    two = data[:-1].astype(np.uint64) | (data[1:].astype(np.uint64) << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    eight = four[:-4] | (four[4:] << np.uint64(32))
    if q == 8:
        return tx.mix(eight)
    return tx.mix(eight[:n] * np.uint64(0x9E3779B97F4A7C15) ^ (eight[q - 8 : q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)))


class Items:
    """An index of one block of items: (id, text) pairs.

    A q-gram's places in an item are kept as runs: places no further apart than a band is wide are one run, so that an item of
    equal letters has one entry for its q-gram, not one for each place. A run counts as a hit in every band that it reaches, which
    keeps a band too many at times and never one too few.
    """

    def __init__(self, items: list[tuple[int, str]], q: int, edit_share: float):
        self.q = q
        self.ids = np.array([i for i, _ in items], np.int64)
        self.texts = [_FOLD[np.frombuffer(t.encode(), np.uint8)] for _, t in items]
        m = np.array([len(t) for t in self.texts], np.int64)
        self.edits = (m * edit_share).astype(np.int64)
        self.bound = m + 1 - q * (self.edits + 1)
        #: Items whose bound would be none: those of fewer than q bytes without edits are searched for as they are, others have an
        #: index of shorter q-grams.
        none = self.bound < 1
        self.short = np.flatnonzero(none & (self.edits == 0) & (m > 0)).tolist()
        few = np.flatnonzero(none & (self.edits > 0))
        self.names = self.rest = None
        if len(few):
            shorter = int(max((m[few] // (self.edits[few] + 1)).min(), 1))
            self.names, self.rest = few, Items([items[k] for k in few], shorter, edit_share)
        key, item, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in np.flatnonzero(~none):
            g = grams(self.texts[k], q)
            key.append(g)
            item.append(np.full(len(g), k))
            place.append(np.arange(len(g)))
        key, item, place = map(np.concatenate, (key, item, place))
        order = np.lexsort((place, item, key))
        key, item, place = key[order], item[order], place[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (item[1:] != item[:-1]) | (place[1:] - place[:-1] > self.edits[item[1:]] + 1)][: len(key)]
        first = np.flatnonzero(new)
        self.key, self.item = key[first], item[first].astype(np.int32)
        self.low, self.high = place[first].astype(np.int32), place[np.r_[first[1:], len(key)][: len(first)] - 1].astype(np.int32)
        self.bits = min(max(int(len(first)).bit_length() + 3, 16), 24)
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[self.key >> np.uint64(64 - self.bits)] = True

    def find(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, begin, end) for each item within its edit budget in a text: the best place of each
        retained region, positions in bytes of the text."""
        return self._find(_FOLD[data], off)

    def _find(self, data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        out = self._short(data, off)
        if self.rest is not None:
            out += [(d, int(self.names[i]), *hit) for d, i, *hit in self.rest._find(data, off)]
        g = grams(data, self.q)
        at = np.flatnonzero(self.seen[g >> np.uint64(64 - self.bits)])
        low = np.searchsorted(self.key, g[at], "left")
        n = np.searchsorted(self.key, g[at], "right") - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        doc = np.searchsorted(off, at, "right") - 1
        inside = at + self.q <= off[doc + 1]
        at, low, n, doc = at[inside], low[inside], n[inside], doc[inside]
        if not len(at):
            return out
        # a text and an item may both repeat a q-gram many times: items are taken so many at once that the hits held stay bounded
        parts = 1 + int(n.sum()) // HITS
        for part in range(parts):
            chosen = self.item % parts == part
            before = np.concatenate([[0], np.cumsum(chosen)])
            out += self._bands(data, off, at, doc, np.flatnonzero(chosen), before[low], before[low + n] - before[low])
        return out

    def _bands(self, data: np.ndarray, off: np.ndarray, at: np.ndarray, doc: np.ndarray, entries: np.ndarray, low: np.ndarray, n: np.ndarray) -> list:
        """Hits of the positions `at` of the texts `doc` with the index's entries from low on, n each."""
        out: list = []
        # one row for each hit of a document's position with an item's run: it counts in the bands from `first` to `last`
        row = np.repeat(np.arange(len(at)), n)
        if not len(row):
            return out
        entry = entries[np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(row))]
        item, doc = self.item[entry].astype(np.int64), doc[row]
        wide = self.edits[item] + 1
        first = (at[row] - self.high[entry]) // wide - 1  # bands of two widths overlap by one
        last = (at[row] - self.low[entry]) // wide
        # counts along the bands of each text and item, as sums over where hits begin and end
        pair, step = np.tile(doc * len(self.ids) + item, 2), np.repeat([1, -1], len(item))
        edge = np.concatenate([first, last + 1])
        order = np.lexsort((edge, pair))
        pair, edge, count = pair[order], edge[order], np.cumsum(step[order])
        final = np.r_[(pair[1:] != pair[:-1]) | (edge[1:] != edge[:-1]), True]
        pair, edge, count = pair[final], edge[final], count[final]
        item = pair % len(self.ids)
        enough = count >= self.bound[item]  # from this edge to the next one, which is the same pair's
        begins = np.flatnonzero(enough & ~np.r_[False, enough[:-1] & (pair[1:] == pair[:-1])])
        ends = np.flatnonzero(enough & ~np.r_[enough[1:] & (pair[1:] == pair[:-1]), False]) + 1
        for x, y in zip(begins.tolist(), ends.tolist()):
            d, i = divmod(int(pair[x]), len(self.ids))
            w = int(self.edits[i]) + 1
            low_, high = int(edge[x]) * w - int(off[d]), (int(edge[y]) + 1) * w - int(off[d])
            hit = self._best(data[off[d] : off[d + 1]], low_, high, i)
            if hit:
                out.append((d, i, *hit))
        return out

    def _best(self, text: np.ndarray, low: int, high: int, i: int, at_once: int = 4096) -> tuple[int, int, int] | None:
        """The place of fewest edits, then first, on the diagonals from low to high, so many at once."""
        best = None
        for a in range(low, high, at_once):
            hit = self._verify(text, a, min(at_once, high - a), i)
            if hit and (best is None or hit < best):
                best = hit
            if best and not best[0]:
                break  # later diagonals begin later
        return best

    def _short(self, data: np.ndarray, off: np.ndarray) -> list:
        """Items of fewer than q bytes and no edits count where they occur."""
        out = []
        if self.short:
            whole = data.tobytes()
            for i in self.short:
                t = self.texts[i].tobytes()
                p = whole.find(t)
                while p >= 0:
                    d = int(np.searchsorted(off, p, "right")) - 1
                    if p + len(t) <= off[d + 1]:
                        out.append((d, i, 0, int(p - off[d]), int(p - off[d]) + len(t)))
                    p = whole.find(t, p + 1)
        return out

    def _verify(self, text: np.ndarray, diagonal: int, width: int, i: int) -> tuple[int, int, int] | None:
        """Aligns an item within `width` diagonals from `diagonal` and its edit budget to either side; the fewest edits,
        begin and end of the place, or None beyond the budget. Rows are the item's bytes, columns the band."""
        item, e = self.texts[i], int(self.edits[i])
        low, wide, far = diagonal - e, width + 2 * e + 1, 1 << 30
        cost = np.where((low + np.arange(wide) >= 0) & (low + np.arange(wide) <= len(text)), 0, far)
        begin = low + np.arange(wide)
        step = np.arange(wide)
        for r, ch in enumerate(item):
            column = low + r + np.arange(wide)  # text position that the band's cells come from
            fits = (column >= 0) & (column < len(text))
            same = np.zeros(wide, bool)
            same[fits] = text[column[fits]] == ch
            across = np.where(fits, cost + ~same, far)
            down = np.append(cost[1:], far) + 1  # the item's byte has no partner
            new = np.minimum(across, down)
            origin = np.where(across <= down, begin, np.append(begin[1:], 0))
            run = np.minimum.accumulate(new - step)  # text bytes without a partner
            best = run + step
            source = np.maximum.accumulate(np.where(new - step == run, step, 0))
            cost, begin = best, origin[source]
            if cost.min() > e:
                return None
        end = low + len(item) + np.arange(wide)
        cost = np.where((end >= 0) & (end <= len(text)), cost, far)
        k = int(np.argmin(cost))
        return (int(cost[k]), int(begin[k]), int(end[k])) if cost[k] <= e else None


def blocks(benchmark: DataFrame, q: int, edit_share: float, block_bytes: int = 2 << 20, item: str = "item_id", text: str = "text"):
    """Indexes of the benchmark's items, one after another, each of about block_bytes of text: a stated query set runs
    against all documents in blocks, so that what a task holds stays bounded. Items without id or text are left out."""
    items = benchmark.select(F.col(item).cast("long").alias("i"), F.col(text).cast("string").alias("t")).where("i is not null and length(t) > 0").distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = 1 + total // block_bytes
    for k in range(n):
        yield Items([tuple(r) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).orderBy("i", "t").collect()], q, edit_share)


def matches(docs: DataFrame, benchmark: DataFrame, q: int = 12, edit_share: float = 0.05, text: str = "text") -> DataFrame:
    """Rows (doc_id, item_id, edits, begin, finish): each benchmark item that occurs in a document within its edit budget
    (edit_share of its bytes), the fewest edits and that place's byte range in the folded text.

    A null or empty text has no matches, nor has an empty benchmark; repeated rows each match; a row without doc_id matches with a null one.
    """
    spark = docs.sparkSession
    prepare(spark)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = None
    for items in blocks(benchmark, q, edit_share):
        shared = spark.sparkContext.broadcast(items)  # an index of block_bytes of text, some 20 times as large

        def run(batches, shared=shared):
            index = shared.value
            for b in batches:
                best: dict = {}
                for d, i, edits, begin, end in index.find(*tx.buffers(b.column(1))):
                    if (d, i) not in best or (edits, begin) < best[d, i][:2]:
                        best[d, i] = edits, begin, end
                ids = b.column(0).to_pylist()
                rows = [(ids[d], int(index.ids[i]), *best[d, i]) for d, i in sorted(best)]
                cols = list(zip(*rows)) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "item_id", "edits", "begin", "finish"])

        found = source.mapInArrow(run, "doc_id long, " + HIT)
        out = found if out is None else out.unionByName(found)
    return out


def filter_documents(docs: DataFrame, benchmark: DataFrame, q: int = 12, edit_share: float = 0.05, text: str = "text") -> DataFrame:
    """The rows of docs in which no benchmark item occurs, with docs' own columns; rows are judged where they are.

    Rows without text or doc_id stay unless an item occurs in them; repeated rows all stay or all go; an empty table gives an
    empty one, and an empty benchmark leaves all rows.
    """
    prepare(docs.sparkSession)
    for items in blocks(benchmark, q, edit_share):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            index = shared.value
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                clean[[d for d, *_ in index.find(*tx.buffers(b.column(b.schema.get_field_index(text))))]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
