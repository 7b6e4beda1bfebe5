"""Quality rules with an isolation forest over the rules' statistics.

Statistics are computed in one Arrow pass over the whole texts. An isolation forest, fitted on a bounded sample of
labelled rows, turns them into path lengths; the threshold on the anomaly score is calibrated from all labelled rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import text as tx
from tessera.llm.common import fresh, prepare, stage

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_codepoints", "n_upper", "n_marks", "n_lines"]
#: The symbols counted by the base rules, and the punctuation marks counted besides.
SYMBOLS, MARKS = b"#*$%&|<>", b"!?~^_\\{}[]"


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _MARK = _table(SYMBOLS), _table(MARKS)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def statistics(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """COUNTS and EXTRA of each text."""
    n = len(off) - 1
    starts, ends, doc = tx.word_spans(data, off)
    point = (data & 0xC0) != 0x80
    out = {
        "n_words": np.bincount(doc, minlength=n),
        "word_chars": tx.per_text(point & ~tx.SPACE[data], off),
        "n_symbols": tx.per_text(_SYMBOL[data], off),
        "n_codepoints": tx.per_text(point, off),
        "n_upper": tx.per_text(_UPPER[data], off),
        "n_marks": tx.per_text(_MARK[data], off),
    }
    # windows of three words found twice or more within a text
    salt = tx.mix(np.arange(1, n + 1, dtype=np.uint64))
    word = tx.span_hashes(data, starts, ends)
    covered = np.zeros(len(word), bool)
    if len(word) > 2:
        same = doc[2:] == doc[:-2]
        key = tx.mix(word[:-2] * np.uint64(3) + tx.mix(word[1:-1] * np.uint64(5) + tx.mix(word[2:] ^ salt[doc[2:]])))
        at = np.flatnonzero(same)
        at = at[tx.repeated(key[at])]
        for k in range(3):
            covered[at + k] = True
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)
    # lines with a word, equal to an earlier line of the text
    cut = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([off[:-1][off[:-1] < off[1:]], cut + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    line_doc = np.searchsorted(off, line_starts, "right") - 1
    line_ends = line_ends - ((data[line_ends - 1] == 10) if len(line_ends) else 0)
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends, line_doc = line_starts[with_word], line_ends[with_word], line_doc[with_word]
    key = tx.mix(tx.span_hashes(data, line_starts, line_ends) ^ salt[line_doc]) if len(line_doc) else np.zeros(0, np.uint64)
    _, firsts = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[firsts] = False
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=n)
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    return {k: np.asarray(v, np.int64) for k, v in out.items()}


def with_statistics(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs' columns `keep` (default: all but the text) with the statistics, base_failed and n_* of every whole text;
    columns of these names are replaced. A null text counts as one without words."""
    prepare(docs.sparkSession)
    names = [*COUNTS, *EXTRA]
    keep = [c for c in (keep or [c for c in docs.columns if c != text]) if c not in {*names, "base_failed"}]
    schema = docs.select(*keep).schema
    for c in names:
        schema = schema.add(c, "long")
    source = docs.select(*keep, F.col(text).alias(fresh(docs, "text")))

    def run(batches):
        for b in batches:
            stats = statistics(*tx.buffers(b.column(len(keep))))
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(keep))] + [pa.array(stats[c]) for c in names], [*keep, *names]
            )

    out = source.mapInArrow(run, schema)
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _added(df: DataFrame) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField("anomaly", T.DoubleType())])


#: Logarithms are taken of so many times each ratio, so that one address or key in a text doesn't make it stand apart.
_STRETCH = np.array([0.2, 10, 10, 10, 2, 2])


def features(p: pd.DataFrame) -> np.ndarray:
    """Logarithms of the statistics' ratios: word length, symbols and marks a word, capitals a character, and the shares of repeated
    lines and words."""
    words, chars, lines = (np.maximum(p[c].to_numpy(float), 1) for c in ("n_words", "n_codepoints", "n_lines"))
    counts = ((c, p[c].to_numpy(float)) for c in ("word_chars", "n_symbols", "n_marks", "n_upper", "n_dup_lines", "n_repeat_words"))
    over = {"n_upper": chars, "n_dup_lines": lines}
    return np.log1p(np.column_stack([v / over.get(c, words) for c, v in counts]) * _STRETCH)


def informative(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """For each feature, how far apart labelled rows lie in it: the square of 2 AUC - 1, by which its splits are drawn; 1 for all
    where rows of either label lack."""
    n1, n0 = int(good.sum()), int((~good).sum())
    if not n1 or not n0:
        return np.ones(x.shape[1])
    rank = pd.DataFrame(x).rank().to_numpy()
    auc = (rank[good].sum(0) - n1 * (n1 + 1) / 2) / (n1 * n0)
    return np.maximum((2 * auc - 1) ** 2, 1e-6)


class IsolationForest:
    """Trees of random splits; a row's score is 2 ** (-mean path length / expected path length), near 1 if anomalous.

    trees, sample: number of trees and rows each is grown from. Splits are drawn within the range of a node's rows, widened
    by `margin` times the feature's spread to either side, so that a value outside the range, even of a feature that is constant in
    the sample, is parted from it early. weight: how likely each feature is split on.
    """

    def __init__(self, trees: int = 100, sample: int = 256, seed: int = 7, margin: float = 1.0):
        self.trees, self.sample, self.seed, self.margin = trees, sample, seed, margin

    @staticmethod
    def expected(n) -> np.ndarray:
        n = np.asarray(n, float)
        return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / np.maximum(n, 1), (n == 2) * 1.0)

    def fit(self, x: np.ndarray, weight: np.ndarray | None = None, spread: np.ndarray | None = None) -> IsolationForest:
        rng = np.random.default_rng(self.seed)
        size = min(self.sample, len(x))
        self.norm = float(self.expected(size)) or 1.0
        self.limit = int(np.ceil(np.log2(max(size, 2))))
        weight = np.ones(x.shape[1]) if weight is None else weight
        beyond = self.margin * (x.std(0) if spread is None and len(x) else 0 if spread is None else spread)
        self.grown = []
        for _ in range(self.trees):
            # nodes lie in arrays; a node's children are left and left + 1
            feature, cut, left, length = [0], [0.0], [0], [0.0]
            todo = [(0, x[rng.choice(len(x), size, replace=False)] if len(x) else x, 0)]
            while todo:
                node, r, d = todo.pop()
                low, high = (r.min(0) - beyond, r.max(0) + beyond) if len(r) > 1 else (0 * weight, 0 * weight)
                able = weight * (high > low)
                if d >= self.limit or not able.sum():
                    feature[node], left[node], length[node] = -1, -1, d + float(self.expected(len(r)))
                    continue
                f = rng.choice(len(able), p=able / able.sum())
                c = rng.uniform(low[f], high[f])
                child = len(feature)
                for a in (feature, cut, left, length):
                    a.extend([0, 0])
                feature[node], cut[node], left[node] = f, c, child
                todo += [(child, r[r[:, f] < c], d + 1), (child + 1, r[r[:, f] >= c], d + 1)]
            self.grown.append((np.array(feature), np.array(cut, float), np.array(left), np.array(length, float)))
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for feature, cut, left, length in self.grown:
            node = np.zeros(len(x), int)
            for _ in range(self.limit):
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                go = left[node] + (x[np.arange(len(x)), np.maximum(f, 0)] >= cut[node])
                node = np.where(inner, go, node)
            total += length[node]
        return 2.0 ** (-(total / max(len(self.grown), 1)) / self.norm)


def fit_forest(stats: DataFrame, labels: DataFrame, max_rows: int = 8192, trees: int = 100, sample: int = 256) -> IsolationForest:
    """A forest grown from labelled good rows that pass the base rules, with splits drawn by how far the labels lie apart in a feature.

    At most max_rows labelled rows are read, of as many buckets of the hash of doc_id the row of least hash: minima are found in
    each task before any row is sent. Without a good row the forest has no splits and scores all rows alike.
    """
    h = F.xxhash64("doc_id")
    labelled = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = stats.where("not base_failed").select("doc_id", *COUNTS, *EXTRA).join(labelled, "doc_id").withColumn("__h", h)
    chosen = rows.groupBy(F.pmod("__h", F.lit(max_rows)).alias("bucket")).agg(F.min("__h").alias("__h")).select("__h")
    rows = rows.join(F.broadcast(chosen), "__h").dropDuplicates(["__h"]).orderBy("__h").toPandas()  # max_rows rows at most
    x, good = features(rows), rows["quality"].to_numpy() == 1
    return IsolationForest(trees, sample).fit(x[good], informative(x, good), x.std(0) if len(x) else None)


def calibrate(scored: DataFrame, labels: DataFrame, most_lost: float = 0.0005) -> float:
    """The score from which rows are rejected: over every labelled row that passes the base rules, the threshold that
    best parts quality 0 from 1 (share of the one above it less that of the other) among those that reject at most
    the share most_lost of the good rows. Counts are gathered in 4,096 bins. Without rows of either label nothing is
    rejected (2.0)."""
    marks = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    bins = (
        scored.where("not base_failed").select("doc_id", "anomaly").join(marks, "doc_id")
        .groupBy(F.floor(F.col("anomaly") * 4096).cast("int").alias("bin"))
        .agg(F.sum(F.expr("if(quality = 1, 1, 0)")).alias("good"), F.sum(F.expr("if(quality = 0, 1, 0)")).alias("bad"))
        .orderBy("bin").toPandas()
    )
    good, bad = bins["good"].to_numpy(float), bins["bad"].to_numpy(float)
    if not len(bins) or not good.sum() or not bad.sum():
        return 2.0
    lost, caught = good[::-1].cumsum()[::-1] / good.sum(), bad[::-1].cumsum()[::-1] / bad.sum()
    gain = np.where(lost <= most_lost, caught - lost, -1.0)
    best = int(np.argmax(gain))
    if gain[best] <= 0:
        return 2.0
    # midway to the next lower bin that holds rows, so that neither side lies at the edge
    below = bins["bin"].iloc[best - 1] + 1 if best else bins["bin"].iloc[best]
    return float((bins["bin"].iloc[best] + below) / 2 / 4096)


def judge(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs' columns `keep` with statistics, base_failed, anomaly (0 to 1) and kept, which is false where base_failed
    and else true unless the anomaly score reaches the calibrated threshold.

    Nulls: a null text has no words and so fails the base rules; rows without doc_id are judged but train nothing.
    Repeated rows are judged alike; an empty table gives an empty result; columns named as a result's are replaced.
    """
    spark = docs.sparkSession
    prepare(spark)
    names = {*COUNTS, *EXTRA, "base_failed", "anomaly", "kept"}
    keep = [c for c in (keep or [c for c in docs.columns if c != text]) if c not in names]
    stats = stage(with_statistics(docs, keep, text), "quality-stats")
    forest = fit_forest(stats, labels)

    def run(parts):
        for p in parts:
            p["anomaly"] = forest.score(features(p))
            yield p

    scored = stats.mapInPandas(run, _added(stats))
    threshold = calibrate(scored, labels)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < threshold))


def filter_documents(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs that are kept, with docs' own columns; for that the text travels along and is judged where it
    is, without a join.

    Nulls: a null text has no words and goes; a row without doc_id is judged but trains nothing. Repeated rows all stay or all go;
    an empty table gives an empty one; columns named as the statistics are left as they are.
    """
    spark = docs.sparkSession
    prepare(spark)
    columns = docs.columns
    stats = stage(with_statistics(docs.select("doc_id", text), ["doc_id"], text), "quality-stats")
    forest = fit_forest(stats, labels)

    def run(parts):
        for p in parts:
            p["anomaly"] = forest.score(features(p))
            yield p

    threshold = calibrate(stats.mapInPandas(run, _added(stats)), labels)

    def select(batches):
        for b in batches:
            stats = pd.DataFrame(statistics(*tx.buffers(b.column(b.schema.get_field_index(text)))))
            good = (stats.n_words >= 50) & (100 * stats.n_repeat_words <= 50 * stats.n_words)
            good &= forest.score(features(stats)) < threshold
            yield b.filter(pa.array(good.to_numpy()))

    return docs.select(*columns).mapInArrow(select, docs.schema)
