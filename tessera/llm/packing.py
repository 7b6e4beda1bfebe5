"""Mixture-controlled packing of documents into fixed-length token sequences.

Every source has a queue of documents. Deficit round-robin fills one window after another: a window asks each queue for
its share of the window's tokens, what a queue could not give in whole tokens stays its deficit and is asked for in the
next window, and a queue that has run dry leaves its turn to the others. Because quotas only depend on a queue's share and
on the window's number, the tokens a queue has given before window k are a closed form, min(total, floor(share * k * W)):
deficits carry across windows, and across partitions, without any pass that would have to run in order. What remains
is a running sum of tokens per queue, kept within a partition while it is tokenised and offset by the sums of the
partitions before it.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import prepare, stage

#: Runs of characters without a space beyond this are left to the `tokenizers` library, which merges long words faster.
LONG_RUN = 400
_ODD = re.compile(r"<\|endoftext\|>|\S{%d}" % LONG_RUN)
_CACHE: dict = {}


def tokenizer(path: str):
    """A function from a list of texts to a list of id arrays, equal to `tokenizers` with the vocabulary file at path
    and add_special_tokens=False.

    For a byte-level BPE file with a .tiktoken twin beside it the twin's ranks, the same vocabulary, are run by
    tiktoken, about four times as fast; texts with a special token's string or a very long word go to `tokenizers`.
    """
    if path not in _CACHE:
        import os

        slow: list = []  # made when first needed
        twin = path.removesuffix(".json") + ".tiktoken"
        fast = None
        if os.path.exists(twin):
            import public_tokenizers
            import tiktoken

            with open(twin, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _CACHE[path] = slow, fast
    slow, fast = _CACHE[path]

    def encode(text: str) -> np.ndarray:
        if fast is None or _ODD.search(text):
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(path))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return lambda texts: [encode(t) for t in texts]


def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def queues(docs: DataFrame, mixture: dict[str, float] | None, source: str, most: int) -> list[str | None]:
    """The sources that get a queue of their own: those of the mixture, which has `most` at most, or the `most` largest. All others share the
    last queue, so the list's length is bounded whatever the data."""
    if mixture:
        if len(mixture) > most:
            raise ValueError(f"a mixture has {most} sources at most")
        return sorted(mixture)
    rows = docs.groupBy(source).count().where(F.col(source).isNotNull()).orderBy(F.desc("count"), source).limit(most).collect()
    return sorted(r[0] for r in rows)


def tokenise(docs: DataFrame, names: list[str], path: str, end_id: int | None, text: str, source: str) -> DataFrame:
    """A stage table (doc_id, queue, part, at, n, ids): a document's ids as little-endian uint32, their number, and the
    tokens of its queue before it in its partition."""
    rank = {s: i for i, s in enumerate(names)}
    tail = np.array([] if end_id is None else [end_id], np.uint32)

    def run(batches):
        from pyspark import TaskContext

        encode, part, given = tokenizer(path), TaskContext.get().partitionId(), np.zeros(len(names) + 1, np.int64)
        for b in batches:
            texts = ["" if t is None else t for t in b.column(1).to_pylist()]
            ids = [np.concatenate([x, tail]) for x in encode(texts)]
            queue = [rank.get(s, len(names)) for s in b.column(2).to_pylist()]
            at = []
            for q, x in zip(queue, ids):
                at.append(int(given[q]))
                given[q] += len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).cast(pa.int64()), pa.array(queue, pa.int32()), pa.array([part] * len(ids), pa.int32()),
                    pa.array(at, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                ],
                ["doc_id", "queue", "part", "at", "n", "ids"],
            )

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(source).cast("string").alias("source"))
    return stage(out.mapInArrow(run, "doc_id long, queue int, part int, at long, n long, ids binary"), "tokens")


class Plan:
    """Where the tokens of each queue go: totals and shares are arrays over the queues, both bounded in length.

    grain: a queue gives whole grains of so many tokens, so that a small source isn't cut into crumbs; what is short of a
    grain is its deficit. Queues without a share follow, one after another, when the others have run dry.
    """

    def __init__(self, totals: np.ndarray, shares: np.ndarray, window: int, grain: int):
        self.totals, self.window, self.grain = totals, window, grain
        shares = np.maximum(shares, 0)
        self.shares = shares / max(shares.sum(), 1e-300)
        self.late = np.cumsum(np.where(self.shares > 0, 0, totals)) - np.where(self.shares > 0, 0, totals)
        self.late = self.late + totals[self.shares > 0].sum()

    def grains(self, queue, windows) -> np.ndarray:
        return np.floor(self.shares[queue] * (np.asarray(windows, float) * self.window) / self.grain)

    def given(self, windows: np.ndarray) -> np.ndarray:
        """Tokens that each queue (rows) has given before each window (columns): quotas carry their deficits."""
        asked = self.grains(np.arange(len(self.totals))[:, None], windows[None, :]) * self.grain
        return np.where(self.shares[:, None] > 0, np.minimum(self.totals[:, None], asked), 0).astype(np.int64)

    def window_of(self, queue: int, tokens: np.ndarray) -> np.ndarray:
        """The window that takes each of a queue's tokens (numbers from 0)."""
        need = tokens // self.grain + 1
        k = np.maximum(np.ceil(need * self.grain / (self.shares[queue] * self.window)).astype(np.int64) - 1, 0)
        k += self.grains(queue, k + 1) < need  # rounding
        return k - ((k > 0) & (self.grains(queue, k) >= need))

    def pieces(self, queue: int, start: int, length: int, size: int) -> list[tuple[int, int, int]]:
        """Cuts [start, start + length) of a queue's tokens at the bounds of windows and sequences: (offset within the
        run, length, position in the packed stream)."""
        if not length:
            return []
        if self.shares[queue] <= 0:
            runs = [(start, start + length, int(self.late[queue]) + start)]
        else:
            cuts = np.arange(start // self.grain + 1, (start + length - 1) // self.grain + 1) * self.grain
            begins = np.concatenate([[start], cuts]).astype(np.int64)
            ks, first = np.unique(self.window_of(queue, begins), return_index=True)
            begins = begins[first]
            now, then = self.given(ks), self.given(ks + 1)
            # a window starts after all that was given before it, and queues take turns in order within it
            place = now.sum(0) + (then[:queue] - now[:queue]).sum(0) + begins - now[queue]
            runs = zip(begins.tolist(), [*begins[1:].tolist(), start + length], place.tolist())
        out = []
        for a, b, at in runs:
            while a < b:
                n = min(b - a, size - at % size)
                out.append((a - start, n, at))
                a, at = a + n, at + n
        return out


def pack(
    docs: DataFrame,
    mixture: dict[str, float] | None = None,
    size: int = 2048,
    window_sequences: int = 128,
    path: str | None = None,
    end_id: int | None = 1,
    text: str = "text",
    source: str = "source",
    most_queues: int = 1024,
) -> DataFrame:
    """Pieces of documents in sequences of `size` tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    source, ids (binary, little-endian uint32).

    mixture: target shares by source; None takes each source's share of all tokens. Every token is packed, so once a
    queue runs dry, later windows hold the other sources in their proportions. All sequences but the last are full.
    window_sequences: sequences filled to the proportions at a time.

    A null text counts as empty and has only its end id; a null source joins the shared queue. Repeated rows are
    packed each; a row without doc_id keeps a null one. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    path = path or _default_path()
    names = queues(docs, mixture, source, most_queues)
    tokens = tokenise(docs, names, path, end_id, text, source)
    sums = stage(tokens.groupBy("queue", "part").agg(F.sum("n").alias("n")), "token-sums")
    # running sum over a queue's partitions in two levels, so that no task sees more than 4,096 of them
    block = sums.withColumn("block", F.expr("part div 4096"))
    blocks = block.groupBy("queue", "block").agg(F.sum("n").alias("m"))
    before = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("queue", "block", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("queue", "block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = block.withColumn("inner", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(blocks, ["queue", "block"])
    starts = stage(starts.select("queue", "part", (F.col("base") + F.col("inner")).alias("first")), "token-starts")

    totals = np.zeros(len(names) + 1, np.int64)  # at most most_queues + 1 rows
    for q, n in sums.groupBy("queue").agg(F.sum("n")).collect():
        totals[q] = n
    shares = totals.astype(float) if not mixture else np.array([*(float(mixture[s]) for s in names), 0.0])
    plan = Plan(totals, shares, size * window_sequences, max(size // 4, 1))

    def cut(batches):
        for b in batches:
            rows = {k: b.column(k).to_pylist() for k in ("doc_id", "queue", "at", "n", "first", "ids")}
            out = []
            for doc, q, at, n, first, ids in zip(*rows.values()):
                for begin, length, place in plan.pieces(q, first + at, n, size):
                    raw = ids[4 * begin : 4 * (begin + length)]
                    out.append((doc, begin, length, zlib.crc32(raw), n, place // size, place % size, names[q] if q < len(names) else None, raw))
            columns = list(zip(*out)) if out else [[] for _ in range(9)]
            kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], PIECE)

    # the sums are a row for each partition and queue: Spark broadcasts them while they are small, else it sorts
    placed = tokens.join(starts, ["queue", "part"])
    return placed.select("doc_id", "queue", "at", "n", "first", "ids").mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, ids binary"
    )


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "ids"]


def padding(pieces: pd.DataFrame, size: int = 2048) -> int:
    """Tokens of padding in sequences given as a (bounded) pandas table; a sequence whose length is a power of two has none."""
    lengths = pieces.groupby("sequence_id").length.sum().to_numpy()
    return int(sum(0 if n & (n - 1) == 0 else size - n for n in lengths.tolist()))
