"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's units are code points (digits count as one), its n-grams strings of ORDER of them. Its tables are counts: how often a
longest n-gram occurs in the trusted text, in how many contexts a shorter one is seen, and the totals of each context. They
are sharded by n-gram and never gathered in one place; so are the n-grams that documents ask for. Per document:

1. Every task sends the distinct n-grams of its texts, and these are joined to the counts, from the shortest suffix to the
   whole n-gram: alpha(gram) + gamma(context) * p(suffix). No key is hot there, for an n-gram is one row and a suffix or context has
   at most one row for each code point.
2. Documents are dealt to chunks of CHUNK_BYTES. A chunk asks once for each of its distinct n-grams, so that a frequent one is
   asked for once a chunk, and the answers come back to the chunk, where log-probabilities are summed for each document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import text as tx
from tessera.llm.common import drop, prepare, stage

ORDER = 5
#: Bytes of text in a chunk; parts of the documents that are scored one after another, which bounds the disk that chunks take.
CHUNK_BYTES, SLICES = 16 << 20, 4
#: n-grams that a task holds before it sends what it has.
MOST_HELD = 2_000_000
#: Levels of the quantiles of trusted perplexity that may become a language's threshold.
LEVELS = [0.95, 0.97, 0.98, 0.99, 0.995, 0.998, 0.999, 0.9995, 1.0]
_LINE, _DIGIT = 10, 48
_BASE = np.uint64(0x9E3779B97F4A7C15)


def points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points uint32, offsets) with ORDER - 1 line ends before each text, any ASCII digit as 0 and NUL as U+0001."""
    try:
        whole = data.tobytes().decode()
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[off]
    except UnicodeDecodeError:
        texts = [data[a:b].tobytes().decode(errors="replace") for a, b in zip(off[:-1], off[1:])]
        whole, at = "".join(texts), np.cumsum([0, *map(len, texts)])
    u = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    pad = ORDER - 1
    out = np.full(len(u) + pad * (len(at) - 1), _LINE, np.uint32)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    out[np.arange(len(u)) + pad * (doc + 1)] = np.where((u >= 48) & (u < 58), _DIGIT, np.maximum(u, 1))
    return out, at + pad * np.arange(len(at))


def hashes(grams: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of ORDER code points."""
    h = np.zeros(len(grams), np.uint64)
    for k in range(ORDER):
        h = tx.mix(h * _BASE + grams[:, k])
    return h


def numbered(s: np.ndarray) -> tuple[np.ndarray, int]:
    """(a number for the n-gram from each position, equal for equal ones; how many there are): numbers of shorter n-grams times
    the alphabet's size, made dense again at each length."""

    def dense(key: np.ndarray, most: int) -> tuple[np.ndarray, int]:
        if most > 1 << 26:  # a large alphabet
            values, back = np.unique(key, return_inverse=True)
            return back, len(values)
        seen = np.zeros(most, bool)
        seen[key] = True
        ids = np.flatnonzero(seen)
        rank = np.zeros(most, np.int32)
        rank[ids] = np.arange(len(ids), dtype=np.int32)
        return rank[key], len(ids)

    code, letters = dense(s, 0x110000)
    r, m = code, letters
    for k in range(1, ORDER):
        r, m = dense(r[:-1].astype(np.int64) * letters + code[k:], m * letters)
    return r, m


def ngrams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct n-grams as rows of code points, their hashes, which of them each character of each text ends on, offsets)."""
    s, at = points(data, off)
    inside = np.ones(max(len(s) - ORDER + 1, 0), bool)
    for a in at[1:-1]:  # n-grams that reach into the next text
        inside[max(a - ORDER + 1, 0) : a] = False
    offsets = at - (ORDER - 1) * np.arange(len(at))
    if not inside.any():
        return np.zeros((0, ORDER), np.uint32), np.zeros(0, np.uint64), np.zeros(0, np.int64), offsets
    r, m = numbered(s)
    place = np.zeros(m, np.int64)
    place[r] = np.arange(len(r))
    grams = s[place[:, None] + np.arange(ORDER)]
    return grams, hashes(grams), r[inside], offsets


def strings(grams: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(grams).view(f"<U{ORDER}").ravel()


def distinct(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, strings, counts) of the distinct n-grams."""
    grams, h, which, _ = ngrams(data, off)
    n = np.bincount(which, minlength=len(h))
    return h[n > 0], strings(grams[n > 0]), n[n > 0]


def grouped(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): an order that sorts the hashes, and where in it each new value starts."""
    order = np.argsort(h)
    h = h[order]
    return order, np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else order


def merged(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, g, n = (np.concatenate(x) for x in zip(*held))
    order, new = grouped(h)
    return h[order[new]], g[order[new]], np.add.reduceat(n[order], new) if len(h) else n


def gathered(batches, text: int, group: int | None = None):
    """Record batches (gram, n), or (group, gram, n), of the texts in column `text`: each n-gram once for each run of equal values in
    column `group` (of all rows without one), or once for MOST_HELD others."""

    def sent(value, held):
        _, g, n = merged(held)
        for a in range(0, len(g), 50_000):
            cols = [pa.array(g[a : a + 50_000]), pa.array(n[a : a + 50_000])]
            head = [] if group is None else [pa.array(np.full(len(cols[0]), value, np.int64))]
            yield pa.RecordBatch.from_arrays([*head, *cols], [*(["chunk"] if head else []), "gram", "n"])

    held, value, size = [], None, 0
    for b in batches:
        values = np.zeros(b.num_rows, np.int64) if group is None else b.column(group).to_numpy(zero_copy_only=False)
        edge = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, int)
        for x, y in zip(edge, [*edge[1:], len(values)]):
            if held and (values[x] != value or size > MOST_HELD):
                held = [merged(held)]
                size = len(held[0][0])
                if values[x] != value or size > MOST_HELD // 2:
                    yield from sent(value, held)
                    held, size = [], 0
            value = values[x]
            held.append(distinct(*tx.buffers(b.column(text).slice(x, y - x))))
            size += len(held[-1][0])
    if held:
        yield from sent(value, held)


def count(texts: DataFrame) -> DataFrame:
    """gram, n: how often each n-gram occurs in the whole texts (one column)."""
    sent = texts.mapInArrow(lambda batches: gathered(batches, 0), "gram string, n long")
    return sent.groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney's discounts for counts of 1, 2 and more, from the numbers of n-grams that occur 1 to 4 times."""
    n = dict(counts.where("n <= 4").groupBy("n").count().collect())
    n1, n2, n3, n4 = (float(n.get(k, 0)) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return tuple(min(max(v, 0.05), k) for v, k in zip(d, (0.95, 1.9, 2.9)))


def fit(texts: DataFrame) -> list[tuple[DataFrame, tuple[float, float, float]]]:
    """For each order from 1 to ORDER: the counts (gram, n) as a stage table, and the discounts. Counts below ORDER are of the
    contexts that an n-gram is seen in."""
    counts, levels = stage(count(texts), "kn-counts"), []
    for _ in range(ORDER):
        levels.insert(0, (counts, discounts(counts)))
        counts = stage(counts.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n")), "kn-counts")
    return levels


def probabilities(grams: DataFrame, model: list) -> DataFrame:
    """(gram, p) of each of the distinct n-grams, by joins with the counts of each order."""
    need = [grams]
    for _ in range(ORDER - 1):
        need.insert(0, stage(need[0].select(F.expr("substring(gram, 2)").alias("gram")).distinct(), "kn-need"))
    symbols = model[0][0].count() + 1
    lower = None
    for wanted, (counts, (d1, d2, d3)) in zip(need, model):
        held = F.expr(f"case n when 1 then {d1}D when 2 then {d2}D else {d3}D end")
        by_context = F.expr("left(gram, char_length(gram) - 1)").alias("context")
        context = counts.groupBy(by_context).agg(F.sum("n").alias("total"), F.sum(held).alias("held"))
        rows = wanted.select("gram", by_context, F.expr("substring(gram, 2)").alias("suffix"))
        rows = rows.join(counts, "gram", "left").join(context, "context", "left")
        rows = rows.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix") if lower is not None else rows.withColumn("below", F.lit(1.0 / symbols))
        alpha = F.when(F.col("n").isNotNull(), F.greatest(F.col("n") - held, F.lit(0.0)) / F.col("total")).otherwise(0.0)
        gamma = F.coalesce(F.col("held") / F.col("total"), F.lit(1.0))
        lower = stage(rows.select("gram", (alpha + gamma * F.col("below")).alias("p")), "kn-probabilities")
    return lower


def score(docs: DataFrame, model: list, keep: list[str], text: str = "text") -> DataFrame:
    """docs' columns `keep` with n_scored (characters) and perplexity, null without any."""
    source = docs.select(*keep, F.col(text).alias("__text"))
    width = len(keep)
    asked = source.select("__text").mapInArrow(lambda batches: (b.select([0]) for b in gathered(batches, 0)), "gram string")
    logp = probabilities(stage(asked.distinct(), "kn-asked"), model).select("gram", F.ln("p").alias("logp"))
    schema = docs.select(*keep).schema.add("n_scored", "long").add("perplexity", "double")

    dealt = source.select("*", F.lit(0).cast("long").alias("__chunk")).schema

    def deal(batches):
        from pyspark import TaskContext

        chunk, held = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            yield b.append_column("__chunk", pa.array(np.full(b.num_rows, chunk)))
            held += b.column(width).nbytes
            if held >= CHUNK_BYTES:
                chunk, held = chunk + 1, 0

    def add(texts: pa.Table, known: pa.Table) -> pa.Table:
        h = hashes_of(known.column("gram"))
        order = np.argsort(h)
        h, value = h[order], known.column("logp").to_numpy()[order]
        n, total = [], []
        for b in texts.select(["__text"]).combine_chunks().to_batches(max_chunksize=1000):
            data, off = tx.buffers(b.column(0))
            bound = np.unique(np.r_[np.searchsorted(off, np.arange(0, len(data), 4 << 20)), len(off) - 1])
            for x, y in zip(bound[:-1], bound[1:]):  # some 4 MB at a time
                _, asked, which, at = ngrams(data[off[x] : off[y]], off[x : y + 1] - off[x])
                place = np.minimum(np.searchsorted(h, asked), max(len(h) - 1, 0))
                each = np.where(h[place] == asked, value[place], 0.0) if len(h) else np.zeros(len(asked))
                sums = np.zeros(len(which) + 1)
                np.cumsum(each[which], out=sums[1:])
                n.append(np.diff(at))
                total.append(sums[at[1:]] - sums[at[:-1]])
        n = np.concatenate(n) if n else np.zeros(0, np.int64)
        total = np.concatenate(total) if total else np.zeros(0)
        value = np.exp(-total / np.maximum(n, 1))
        return pa.table([*(texts.column(c) for c in range(width)), pa.array(n), pa.array(value, mask=n == 0)], schema.names)

    out = None
    part = F.pmod(F.xxhash64(F.lit(3), *[c for c in keep]), F.lit(SLICES))
    for k in range(SLICES):
        chunks = stage(source.where(part == k).mapInArrow(deal, dealt), "kn-chunks")
        asks = chunks.select("__chunk", "__text").mapInArrow(lambda batches: (b.select([0, 1]) for b in gathered(batches, 1, 0)), "chunk long, gram string")
        answers = asks.join(logp, "gram")
        scored = stage(chunks.groupBy("__chunk").cogroup(answers.groupBy("chunk")).applyInArrow(add, schema), "kn-scored")
        drop(chunks)
        out = scored if out is None else out.unionByName(scored)
    return out


def hashes_of(grams: pa.ChunkedArray) -> np.ndarray:
    """The hashes of n-grams given as strings."""
    s, _ = points(*tx.buffers(grams))
    return hashes(s.reshape(-1, 2 * ORDER - 1)[:, ORDER - 1 :])


def thresholds(known: DataFrame, most_lost: float, slack: float) -> DataFrame:
    """(l, high) for each language of known (lang, perplexity, good): `slack` times the quantile of its good texts at that one of LEVELS
    that parts the other texts from good ones best (the share of those beyond it less that of the good ones) among those that lose
    most_lost of the good ones at most. A language has its own, however few its texts; one without good texts has none."""
    q = F.percentile_approx(F.when(F.col("good"), F.col("perplexity")), F.array(*map(F.lit, LEVELS)), 10_000)
    q = stage(known.groupBy("lang").agg(q.alias("q")).where("q is not null").select(F.col("lang").alias("l"), "q"), "kn-quantiles")
    beyond = [F.col("perplexity") > F.col("q")[k] * slack for k in range(len(LEVELS))]
    shares = [[F.avg(F.when(F.expr(kind), F.when(b, 1.0).otherwise(0.0))) for b in beyond] for kind in ("good", "not good")]
    rows = known.join(q, F.col("lang") == F.col("l")).groupBy("l").agg(F.first("q").alias("q"), *[F.array(*x).alias(n) for x, n in zip(shares, ("lost", "caught"))])
    last = len(LEVELS) - 1
    gain = [F.when((F.col("lost")[k] <= most_lost) | F.lit(k == last), F.coalesce(F.col("caught")[k], F.lit(0.0)) - F.col("lost")[k]).otherwise(-1.0) for k in range(last + 1)]
    best = F.array_max(F.array(*[F.struct(g.alias("g"), F.lit(k).alias("k"), F.col("q")[k].alias("at")) for k, g in enumerate(gain)]))["at"]
    return rows.select("l", (best * slack).alias("high"))


def classify(docs: DataFrame, labels: DataFrame, most_lost: float = 0.01, slack: float = 1.02, held_out: int = 5, text: str = "text") -> DataFrame:
    """doc_id, lang, n_scored, perplexity, threshold and kept of every row.

    Trusted text is that of documents with a label of quality 1 and toxic 0. Of these, one in held_out (by hash of doc_id) isn't
    learned from; a language's threshold is a quantile of the perplexity of those that aren't, at a level calibrated on them and on
    all documents with other labels. A document is kept up to its language's threshold. A language without such texts has the
    threshold of all. Texts that are null or empty have no perplexity and aren't kept; a null lang is a language of its
    own; without trusted documents all texts are kept. Repeated rows are judged alike; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    good = F.max(F.expr("quality = 1 and coalesce(toxic, 0) = 0")).alias("good")
    learned = (F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(held_out)) > 0).alias("learned")
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(good).select("*", learned)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("und")).alias("lang"), F.col(text).alias("text"))
    # sort-merge at every size: labels grow with the documents
    model = fit(rows.select("doc_id", "text").join(marks.where("good and learned").select("doc_id").hint("merge"), "doc_id", "left_semi").select("text"))
    scored = score(rows, model, ["doc_id", "lang"])
    known = scored.where("perplexity is not null").join(marks.where("not (good and learned)"), "doc_id").select("lang", "perplexity", "good")
    known = stage(known, "kn-known")
    own = stage(thresholds(known, most_lost, slack), "kn-thresholds")  # a row for each language
    whole = thresholds(known.withColumn("lang", F.lit("all")), most_lost, slack).collect()
    out = scored.join(own, F.col("lang") == F.col("l"), "left")
    out = out.withColumn("threshold", F.coalesce("high", F.lit(whole[0]["high"] if whole else None).cast("double")))
    kept = F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return out.select("doc_id", "lang", "n_scored", "perplexity", "threshold", kept.alias("kept"))
