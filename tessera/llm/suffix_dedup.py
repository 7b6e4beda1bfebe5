"""Removal of byte strings that occur in an earlier document, by prefix-free parsing.

A rolling hash over SEED bytes triggers at positions where it is least within a window; the window is so long that every
string of `length` bytes holds a trigger, and the same string holds the same one at the same place. Each trigger, with all the
strings whose trigger it is, makes a phrase: the bytes those strings cover. Phrases of a document overlap by more than a trigger, their
sequence is its parse. The dictionary holds each phrase once, sharded by trigger; a phrase's owner is its first document.

1. Parse: within a task, equal phrases meet first, and only a phrase of its first document is sent on (what later ones hold is
   removed). Between tasks, a phrase that an earlier document has is removed as a whole, all its strings at once.
2. Dictionary: phrases that share a trigger but differ, as at the ends of a passage, are sent to the trigger's shard as bytes. Their
   suffixes of `length` bytes or more are sorted there, which is the shard's suffix array to that depth. No string lies in two
   shards, and none reaches from one phrase into the next, for a phrase holds its strings whole: so the order of the parse
   is needed only among equal suffixes, where it is the order of documents.
3. Corpus order: suffixes in order of their bytes, then of document and place. Equal neighbours to `length` bytes make a run, and
   all of a run but its first document's are removed.

A trigger with very many phrases would be one large shard. Its phrases are cut into strings, each a shard of its own.
The spans are then merged by document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import text as tx
from tessera.llm.common import prepare, stage

#: Bytes of the rolling hash. Longer seeds are shared by chance less often, shorter ones trigger less densely.
SEED = 24
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 2**64))


class Rolling:
    """Hashes of any span of the bytes, from one prefix sum; equal bytes have equal hashes."""

    def __init__(self, data: np.ndarray):
        self.inverse = tx.powers(len(data) + 1, _BASE_INVERSE)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(tx.BYTE_VALUE[data] * tx.powers(len(data), _BASE), out=self.total[1:])

    def span(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return tx.mix((self.total[ends] - self.total[starts]) * self.inverse[starts])

    def every(self, n: int) -> np.ndarray:
        if len(self.total) <= n:
            return np.zeros(0, np.uint64)
        return tx.mix((self.total[n:] - self.total[:-n]) * self.inverse[: len(self.total) - n])


def phrases(data: np.ndarray, off: np.ndarray, length: int, seed: int = SEED):
    """(trigger position, first string, last string, text, Rolling): for each trigger the range of the starts of those
    strings of `length` bytes whose least hash it is, the leftmost if there are ties."""
    rolling = Rolling(data)
    h = rolling.every(seed)
    w = length - seed + 1
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4 + (rolling,)
    # least of each w hashes in a row and its place from the left, by doubling; the leftmost where there are ties
    least, place, have = h, np.zeros(len(h), np.uint8), 1
    while have < w:
        step = min(have, w - have)
        right = least[step:] < least[:-step]
        place = np.where(right, place[step:] + np.uint8(step), place[:-step])
        least = np.where(right, least[step:], least[:-step])
        have += step
    start = np.arange(n)
    at = start + place[:n]
    # strings that cross a text's bounds have no trigger
    whole = np.ones(n + length, bool)
    for k in off[1:-1]:
        whole[max(k - length + 1, 0) : k] = False
    whole = whole[:n]
    key = np.where(whole, at, -1)
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    ends = np.r_[edge[1:], n] - 1
    use = key[edge] >= 0
    edge, ends = edge[use], ends[use]
    return key[edge], edge, ends, np.searchsorted(off, edge, "right") - 1, rolling


def merge(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the spans [a, b) of each text; touching spans are one."""
    order = np.lexsort((b, a, doc))
    doc, a, b = doc[order], a[order], b[order]
    if not len(doc):
        return doc, a, b
    far = int(b.max()) + 1
    reach = np.maximum.accumulate(b + doc * far)
    new = np.r_[True, (doc[1:] != doc[:-1]) | (a[1:] + doc[1:] * far > reach[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(doc)] - 1
    return doc[first], a[first], reach[last] - doc[first] * far


#: Bytes of phrases in one Arrow array, and rows of shards that a task holds before it settles them.
PART, HELD = 1 << 30, 20_000


def removed_spans(docs: DataFrame, length: int = 50, text: str = "text", id_column: str = "doc_id", crowd: int = 2_000) -> DataFrame:
    """(doc_id, begin, finish): byte ranges covered by strings of `length` bytes that also start in a document of smaller id;
    ranges may overlap. A trigger with more than `crowd` phrases counts as crowded."""
    if not SEED < length < SEED + 128:
        raise ValueError(f"length is to lie between {SEED + 1} and {SEED + 127}")
    prepare(docs.sparkSession)
    source = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def parse(batches):
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            data, off = tx.buffers(b.column(1))
            at, first, last, doc, rolling = phrases(data, off, length)
            trigger = rolling.span(at, at + SEED)
            phrase = tx.mix(rolling.span(first, last + length) + (at - first).astype(np.uint64))
            # the first document of each phrase within the batch
            order = np.lexsort((ids[doc], phrase, trigger)) if len(at) else np.zeros(0, np.int64)
            p, t = phrase[order], trigger[order]
            new = np.r_[True, (p[1:] != p[:-1]) | (t[1:] != t[:-1])] if len(p) else np.zeros(0, bool)
            owner = ids[doc[order]][np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))] if len(p) else ids[:0]
            gone = np.zeros(len(at), bool)
            gone[order] = ids[doc[order]] > owner
            sent = ~gone  # all places of a phrase in its first document
            d, s, e = merge(doc[gone], first[gone] - off[doc[gone]], last[gone] + length - off[doc[gone]])
            k = np.flatnonzero(sent)
            begin, finish = first[k] - off[doc[k]], last[k] + length - off[doc[k]]
            yield pa.RecordBatch.from_arrays(
                [
                    # 48 and 56 bits: shards may share a trigger by chance, phrases are told apart by both
                    pa.array((np.r_[trigger[k], tx.mix(d.astype(np.uint64) + tx.mix(ids[d].astype(np.uint64)))] >> np.uint64(16)).view(np.int64)),
                    pa.array(np.r_[(phrase[k] >> np.uint64(8)).view(np.int64), np.zeros(len(d), np.int64)]),
                    pa.array(np.r_[ids[doc[k]], ids[d]].astype(np.int64)),
                    pa.array(np.r_[begin, s]),
                    pa.array(np.r_[finish - begin, s - e].astype(np.int32)),
                ],
                ["trigger", "phrase", "doc_id", "begin", "size"],
            )

    # a size below 0 marks a run of bytes whose removal is settled
    parsed = source.mapInArrow(parse, "trigger long, phrase long, doc_id long, begin long, size int")
    # dictionary: first document of each phrase; phrases alone with their trigger need no more
    shards = (
        parsed.repartition("trigger")
        .withColumn("owner", F.expr("min(doc_id) over (partition by trigger, phrase)"))
        .withColumn("low", F.expr("min(phrase) over (partition by trigger)"))
        .withColumn("high", F.expr("max(phrase) over (partition by trigger)"))
        .withColumn("crowd", F.expr("count(*) over (partition by trigger)"))
        .withColumn("whole", F.expr("size < 0 or owner < doc_id"))
        .where("whole or low <> high")
        .select("doc_id", "begin", F.abs("size").alias("size"), "whole", F.when(~F.col("whole"), F.col("trigger")).alias("trigger"), (F.col("crowd") > crowd).alias("crowded"))
    )
    shards = stage(shards, "suffix-shards")
    open_ = shards.where("not whole").groupBy("doc_id").agg(F.collect_list(F.struct("begin", "size", "trigger", "crowded")).alias("cuts"))
    open_ = stage(open_, "suffix-open")

    def dictionary(batches):
        """The open phrases' bytes with their shards; those of a crowded trigger as strings."""
        for b in batches:
            data, off = tx.buffers(b.column(1))
            ids = b.column(0).to_numpy(zero_copy_only=False)
            cuts = b.column(2)
            doc = np.repeat(np.arange(len(ids)), cuts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            begin, size, trigger, crowded = (cuts.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(4))
            fits = begin + size <= np.diff(off)[doc]  # a repeated doc_id may bring another text
            doc, begin, size, trigger, crowded = (x[fits] for x in (doc, begin, size, trigger, crowded))
            strings = crowded.astype(bool)
            gone = (np.zeros(0, np.int64),) * 3
            if strings.any():
                count = size[strings] - length + 1
                owner = np.repeat(doc[strings], count)
                start = np.repeat(begin[strings] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(owner))
                one = Rolling(data).span(off[owner] + start, off[owner] + start + length).view(np.int64)
                # equal strings meet in the batch first: those of later documents are settled, and only the first's are sent
                order = np.lexsort((ids[owner], one))
                rows = np.lib.stride_tricks.sliding_window_view(data, length)[(off[owner] + start)[order]]
                new = np.r_[True, (one[order][1:] != one[order][:-1]) | (rows[1:] != rows[:-1]).any(1)]
                head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
                later = np.zeros(len(order), bool)
                later[order] = ids[owner[order]] > ids[owner[head]]
                gone = merge(owner[later], start[later], start[later] + length)
                keep = ~later
                doc = np.concatenate([doc[~strings], owner[keep]])
                begin = np.concatenate([begin[~strings], start[keep]])
                size = np.concatenate([size[~strings], np.full(int(keep.sum()), length, size.dtype)])
                trigger = np.concatenate([trigger[~strings], one[keep]])
            kinds = ["shard", "doc_id", "begin", "phrase", "settled"]
            # so many phrases at a time that their bytes' places fit an Arrow array
            part = np.cumsum(size, dtype=np.int64) // PART
            for low, high in zip(*(np.searchsorted(part, np.unique(part), side) for side in ("left", "right"))):
                at = np.concatenate([[0], np.cumsum(size[low:high])]).astype(np.int32)
                place = np.repeat(off[doc[low:high]] + begin[low:high] - at[:-1], size[low:high]) + np.arange(at[-1])
                raw = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data[place]))])
                none = pa.array(np.zeros(high - low, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(trigger[low:high].astype(np.int64)), pa.array(ids[doc[low:high]].astype(np.int64)), pa.array(begin[low:high].astype(np.int64)), raw, none], kinds)
            if len(gone[0]):
                # settled spans have no bytes, and no shard to share
                alone = tx.mix(ids[gone[0]].astype(np.uint64) + tx.mix(gone[1].astype(np.uint64))).view(np.int64)
                empty = pa.array([b""] * len(alone), pa.binary())
                settled = pa.array((gone[2] - gone[1]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(alone), pa.array(ids[gone[0]].astype(np.int64)), pa.array(gone[1].astype(np.int64)), empty, settled], kinds)

    phrases_ = source.join(open_, "doc_id").select("doc_id", "text", "cuts").mapInArrow(dictionary, "shard long, doc_id long, begin long, phrase binary, settled int")

    def suffixes(batches):
        """Spans of the strings that an earlier document has, from the suffix arrays of the shards; rows come in order of shards and documents. Of a
        shard that goes on beyond what is held, only a row for each string's first document stays."""
        held: list = []
        rows = stay = 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= HELD + stay:
                t = pa.Table.from_batches(held).combine_chunks()
                shard = t.column("shard").to_numpy()
                cut = int(np.searchsorted(shard, shard[-1]))  # the last shard may go on
                if cut:
                    yield later_spans(t.slice(0, cut), length)[0]
                t = t.slice(cut)
                if len(t) >= HELD:
                    spans, first = later_spans(t, length)
                    yield spans
                    t = t.take(pa.array(first))
                held, rows, stay = t.to_batches(), len(t), len(t)
        if held:
            yield later_spans(pa.Table.from_batches(held).combine_chunks(), length)[0]

    edges = phrases_.repartition("shard").sortWithinPartitions("shard", "doc_id").mapInArrow(suffixes, "doc_id long, begin long, size int")
    return shards.where("whole").select("doc_id", "begin", "size").unionByName(stage(edges, "suffix-edges"))


def later_spans(t: pa.Table, length: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """(doc_id, begin, size): the bytes of the phrases of t covered by strings of `length` bytes that a phrase of the same shard and a
    smaller doc_id has, and the spans that are settled; and the rows that have a string first, one for each string."""
    settled = t.column("settled").to_numpy()
    column = t.column("phrase").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    shard, ids, begin = (t.column(c).to_numpy() for c in ("shard", "doc_id", "begin"))
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)
    count = np.maximum(np.diff(off) - length + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    start = np.repeat(off[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(len(owner))
    text = np.lib.stride_tricks.sliding_window_view(data, length)[start] if len(start) else np.zeros((0, length), np.uint8)
    # numpy's byte strings end at their last byte other than NUL, so a byte is put behind them
    ended = np.concatenate([text, np.ones((len(text), 1), np.uint8)], 1).view(f"S{length + 1}").ravel()
    order = np.lexsort((ids[owner], ended, shard[owner]))
    text, at = text[order], owner[order]
    new = np.r_[True, (shard[at][1:] != shard[at][:-1]) | (text[1:] != text[:-1]).any(1)][: len(at)]
    later = ids[at] > ids[at][np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
    # runs of strings in one phrase are one span
    gone = order[later]
    which, s, e = merge(owner[gone], start[gone], start[gone] + length)
    own = np.flatnonzero(settled)
    spans = pa.RecordBatch.from_arrays(
        [pa.array(np.r_[ids[which], ids[own]]), pa.array(np.r_[begin[which] + s - off[which], begin[own]]), pa.array(np.r_[e - s, settled[own]].astype(np.int32))],
        ["doc_id", "begin", "size"],
    )
    return spans, np.unique(at[new])


def dedup(docs: DataFrame, length: int = 50, text: str = "text", crowd: int = 2_000) -> DataFrame:
    """docs' doc_id with n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and kept, the bytes that remain
    (binary: a cut may part a character's bytes).

    A null text counts as empty. Rows without doc_id lose nothing and give nothing. Rows that share a doc_id count as
    copies of one document. An empty table gives no rows.
    """
    spans = removed_spans(docs, length, text, crowd=crowd).groupBy("doc_id").agg(F.collect_list(F.struct("begin", "size")).alias("spans"))
    spans = stage(spans.withColumnRenamed("doc_id", "__id"), "suffix-spans")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    joined = rows.join(spans, F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", "spans")

    def cut(batches):
        for b in batches:
            data, off = tx.buffers(b.column(1))
            spans = b.column(2)
            n = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(n)), n)
            begin, size = (spans.flatten().field(k).to_numpy(zero_copy_only=False) for k in range(2))
            doc, s, e = merge(doc, begin, np.minimum(begin + size, np.diff(off)[doc]))
            bound = np.searchsorted(doc, np.arange(len(n) + 1))
            kept, sums, gone = [], [], np.zeros(len(n), np.int64)
            np.add.at(gone, doc, e - s)
            for k in range(len(n)):
                raw = data[off[k] : off[k + 1]].tobytes()
                at, parts = 0, []
                for x, y in zip(s[bound[k] : bound[k + 1]].tolist(), e[bound[k] : bound[k + 1]].tolist()):
                    parts.append(raw[at:x])
                    at = y
                raw = b"".join([*parts, raw[at:]])
                kept.append(raw)
                sums.append(hashlib.sha256(raw).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(off)), pa.array(gone), pa.array(np.diff(bound).astype(np.int64)), pa.array(sums, pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
