"""Language identification with a bidirectional gated recurrent network over bytes.

The network is written in numpy: an embedding of each byte, a GRU in either direction, and a softmax over the languages
at every position; it is trained by backpropagation through time on a bounded sample. Texts are cut into chunks of
CHUNK bytes, each labelled at all its positions, and a document's probability of a language is the mean over all the
positions of its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import text as tx
from tessera.llm.common import fresh, prepare

CHUNK = 48


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class BiGru:
    """hidden units in each direction; inputs are byte codes, outputs log-probabilities of the classes at every position.

    For a direction with state h: z, r = sigmoid(X[byte] + h U), c = tanh(Xc[byte] + (r * h) Uc), h' = h + z * (c - h).
    The input weights are one table row for each byte, which is an embedding times a matrix in one.
    """

    def __init__(self, classes: int, hidden: int = 8, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.hidden, self.classes = hidden, classes
        f32 = np.float32
        self.p = {}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(f32)
            self.p["u" + d] = rng.normal(0, hidden**-0.5, (hidden, 2 * hidden)).astype(f32)
            self.p["c" + d] = rng.normal(0, hidden**-0.5, (hidden, hidden)).astype(f32)
            self.p["o" + d] = rng.normal(0, 0.3, (hidden, classes)).astype(f32)
        self.p["bias"] = np.zeros(classes, f32)

    def states(self, codes: np.ndarray, d: str, keep: bool = False):
        """States of one direction for codes (chunks x time), as (time, chunks, hidden); with `keep` all that the backward pass needs."""
        n, time = codes.shape
        x, u, c, k = self.p["x" + d], self.p["u" + d], self.p["c" + d], self.hidden
        h = np.zeros((n, k), np.float32)
        out = np.empty((time, n, k), np.float32)
        trace = []
        for t in range(time) if d == "f" else range(time - 1, -1, -1):
            a = x[codes[:, t]]
            g = _sigmoid(a[:, : 2 * k] + h @ u)
            z, r = g[:, :k], g[:, k:]
            rh = r * h
            cand = np.tanh(a[:, 2 * k :] + rh @ c)
            if keep:
                trace.append((t, h, z, r, rh, cand))
            h = h + z * (cand - h)
            out[t] = h
        return (out, trace) if keep else out

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(time, chunks, classes): the probabilities of every position."""
        logit = self.states(codes, "f") @ self.p["of"]
        logit += self.states(codes, "b") @ self.p["ob"]
        logit += self.p["bias"]
        logit -= logit.max(-1, keepdims=True)
        np.exp(logit, out=logit)
        return logit / logit.sum(-1, keepdims=True)

    def gradients(self, codes: np.ndarray, target: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy over the positions in mask (time x chunks), through all time steps."""
        hidden = {d: self.states(codes, d, True) for d in "fb"}
        logit = hidden["f"][0] @ self.p["of"] + hidden["b"][0] @ self.p["ob"] + self.p["bias"]
        logit -= logit.max(-1, keepdims=True)
        p = np.exp(logit)
        p /= p.sum(-1, keepdims=True)
        p[:, np.arange(len(target)), target] -= 1
        p *= (mask / max(mask.sum(), 1))[:, :, None]
        grad = {"bias": p.sum((0, 1))}
        k = self.hidden
        for d in "fb":
            out, trace = hidden[d]
            grad["o" + d] = np.einsum("tnk,tnc->kc", out, p, optimize=True)
            into = p @ self.p["o" + d].T
            u, c = self.p["u" + d], self.p["c" + d]
            gx, gu, gc = np.zeros_like(self.p["x" + d]), np.zeros_like(u), np.zeros_like(c)
            dh = np.zeros((len(target), k), np.float32)
            for t, h, z, r, rh, cand in reversed(trace):
                dh = dh + into[t]
                dcand = dh * z * (1 - cand * cand)
                drh = dcand @ c.T
                dg = np.concatenate([dh * (cand - h) * z * (1 - z), drh * h * r * (1 - r)], 1)
                gu += h.T @ dg
                gc += rh.T @ dcand
                np.add.at(gx, codes[:, t], np.concatenate([dg, dcand], 1))
                dh = dh * (1 - z) + drh * r + dg @ u.T
            grad["x" + d], grad["u" + d], grad["c" + d] = gx, gu, gc
        return grad

    def fit(self, codes: np.ndarray, target: np.ndarray, steps: int = 240, batch: int = 256, rate: float = 0.02, seed: int = 5) -> BiGru:
        """Adam over random batches of chunks, with a rate that falls to a tenth."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1 if len(codes) else 1):
            rows = rng.integers(0, len(codes), min(batch, len(codes)))
            x = codes[rows]
            for k, g in self.gradients(x, target[rows], (x != 0).T.astype(np.float32)).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
                self.p[k] -= (rate * 10 ** (-step / steps) * move).astype(np.float32)
        return self


def chunks(data: np.ndarray, off: np.ndarray, size: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """(codes chunks x size, text of each): every text cut into chunks, the last one filled up with zeros; digits are one
    code, white space is one, and a NUL byte counts as white space."""
    lengths = np.diff(off)
    count = -(-lengths // size)
    doc = np.repeat(np.arange(len(lengths)), count)
    begin = np.repeat(off[:-1] - np.concatenate([[0], np.cumsum(count)[:-1]]) * size, count) + np.arange(len(doc)) * size
    place = begin[:, None] + np.arange(size)
    inside = place < off[1:][doc][:, None]
    folded = _FOLD[data] if len(data) else np.zeros(1, np.uint8)
    codes = np.where(inside, folded[np.minimum(place, len(folded) - 1)], 0)
    return codes, doc


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[48:58] = 48
_FOLD[[0, 9, 10, 11, 12, 13]] = 32


def pooled(model: BiGru, data: np.ndarray, off: np.ndarray, at_once: int = 4096) -> np.ndarray:
    """Mean probabilities (texts x classes) over all positions of each text; an empty text has zeros."""
    codes, doc = chunks(data, off)
    total, n = np.zeros((len(off) - 1, model.classes)), np.diff(off)
    for a in range(0, len(codes), at_once):
        x = codes[a : a + at_once]
        p = model.probabilities(x)
        p *= (x != 0).T[:, :, None]
        np.add.at(total, doc[a : a + at_once], p.sum(0))
    return total / np.maximum(n, 1)[:, None]


def sample(docs: DataFrame, per_language: int, per_text: int, text: str) -> list[tuple[str, bytes]]:
    """(language, chunk) pairs: at most per_language texts of each language, of as many hash buckets of doc_id the row of least hash, and
    of each text per_text chunks of CHUNK bytes, spread evenly from its begin to its end. Only ids and languages are read for
    the choice, and chunks are cut where the texts are."""
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(per_language))
    chosen = (
        docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col(text).isNotNull())
        .groupBy("lang", bucket.alias("bucket")).agg(F.min(F.struct(F.xxhash64("doc_id", F.lit(7)), "doc_id"))["doc_id"].alias("id"))
    )
    # at most per_language rows for each language, a bounded table
    rows = docs.join(F.broadcast(chosen.select("id", F.col("lang").alias("l"))), (F.col("doc_id") == F.col("id")) & (F.col("lang") == F.col("l")))
    raw, last = F.encode(F.col(text), "UTF-8"), F.greatest(F.octet_length(F.col(text)) - CHUNK, F.lit(0))
    at = F.transform(F.sequence(F.lit(0), F.lit(per_text - 1)), lambda k: F.floor(k * last / max(per_text - 1, 1)).cast("int"))
    cut = F.transform(F.array_distinct(at), lambda k: F.substring(raw, k + 1, F.lit(CHUNK)))
    return sorted((r[0], bytes(r[1])) for r in rows.select("lang", F.explode(cut)).collect() if r[1])


def train(docs: DataFrame, per_language: int = 128, per_text: int = 40, hidden: int = 8, steps: int = 240, text: str = "text") -> tuple[BiGru, list[str]]:
    """A network from at most per_language documents of each language and per_text chunks from all over each of them (predictions
    read whole texts), and the languages in order."""
    rows = sample(docs, per_language, per_text, text)
    names = sorted({lang for lang, _ in rows})
    codes = np.array([np.frombuffer(c.ljust(CHUNK, b"\0"), np.uint8) for _, c in rows], np.uint8).reshape(-1, CHUNK)
    length = np.array([len(c) for _, c in rows], int)
    codes = np.where(np.arange(CHUNK) < length[:, None], _FOLD[codes], 0)
    target = np.array([names.index(lang) for lang, _ in rows], int)
    if len(names) > 1:  # as many chunks of every language
        rng = np.random.default_rng(3)
        most = max(np.bincount(target).max(), 1)
        pick = np.concatenate([rng.choice(np.flatnonzero(target == k), most) for k in range(len(names)) if (target == k).any()])
        codes, target = codes[pick], target[pick]
    return BiGru(max(len(names), 1), hidden).fit(codes, target, steps if len(names) > 1 else 0), names


def identify(docs: DataFrame, model: BiGru, names: list[str], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs' columns `keep` with lang_pred and score, the pooled probability of that language.

    Null texts and those without a letter are `und` with score 0, as are all where nothing was learned. Equal texts
    are judged alike, ties go to the first language by name, and an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    keep = [c for c in (keep or [c for c in docs.columns if c != text]) if c not in {"lang_pred", "score"}]
    source = docs.select(*keep, F.col(text).alias(fresh(docs, "text")), F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)).alias(fresh(docs, "letter")))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        for b in batches:
            p = pooled(model, *tx.buffers(b.column(len(keep))))
            best = p.argmax(1)
            able = b.column(len(keep) + 1).to_numpy(zero_copy_only=False) & bool(names)
            lang = [names[k] if ok else "und" for k, ok in zip(best, able)]
            score = np.where(able, np.clip(p[np.arange(len(best)), best], 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(lang, pa.string()), pa.array(score)], schema.names)

    return source.mapInArrow(run, schema)
