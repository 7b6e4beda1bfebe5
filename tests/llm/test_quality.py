"""Operators 1 and 3: the quality classifier and the quality rules."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import quality_classifier as qc
from tessera.llm import quality_rules as qr
from tessera.llm import text as tx
from tests.llm import helpers


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup, covered = set(), 0, set()
    wins = collections.Counter(zip(w, w[1:], w[2:]))
    for i in range(len(w) - 2):
        if wins[w[i], w[i + 1], w[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)), "n_dup_lines": dup, "n_repeat_words": len(covered)}


def test_statistics():
    rng = random.Random(1)
    texts = ["", "a", None, "\n\n", "a b c a b c", "x\ny\nx\n", "é ñ | $", " \x0b\x85  x"]
    texts += ["".join(rng.choice(["a", "b", "é", " ", " ", "\n", "\t", "|", "漢"]) for _ in range(rng.randrange(60))) for _ in range(800)]
    got = qr.statistics(*tx.buffers(pa.array(texts)))
    for i, t in enumerate(texts):
        assert {k: int(got[k][i]) for k in qr.COUNTS} == brute(t), t


def test_forest_isolates_what_is_apart():
    rng = np.random.default_rng(0)
    x = np.r_[rng.normal(0, 1, (500, 3)), [[9, 9, 9]]]
    s = qr.IsolationForest(50, 128).fit(x).score(x)
    assert s.argmax() == 500 and 0 <= s.min() and s.max() <= 1
    assert len(set(qr.IsolationForest().fit(np.zeros((0, 3))).score(np.zeros((2, 3))))) == 1


def test_rules_reject_junk_and_keep_the_rest(spark):
    rng = random.Random(2)
    good = [(i, " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(999)}word" for _ in range(120)), "en", "s", 0) for i in range(200)]
    junk = [(1000 + i, " | ".join(f"{rng.choice('abcdefgh')}{rng.randrange(9999)}" for _ in range(90)), "en", "s", 0) for i in range(30)]
    docs = spark.createDataFrame([*good, *junk], helpers.SCHEMA)
    lab = helpers.labels(spark, [(d[0], int(d[0] < 1000), 0) for d in [*good[:120], *junk[:20]]])
    kept = {r.doc_id for r in qr.judge(docs, lab).where("kept").collect()}
    assert kept == {d[0] for d in good}
    out = qr.filter_documents(docs, lab)
    assert {r.doc_id for r in out.collect()} == kept and out.columns == docs.columns


def test_rules_on_awkward_rows(spark):
    docs = helpers.awkward(spark).withColumn("n_words", F.lit("clash")).withColumn("__text", F.lit("clash")).withColumn("quality", F.lit(7))
    out = qr.judge(docs, helpers.labels(spark))
    assert out.count() == docs.count()
    for r in out.join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        want = brute(r.text)
        assert {k: r[k] for k in want} == want
        assert r.base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]) and r.kept == (not r.base_failed)
    assert qr.judge(helpers.empty(spark), helpers.labels(spark)).count() == 0
    assert qr.filter_documents(helpers.awkward(spark), helpers.labels(spark, [(None, None, None)])).count() == 5


def kneser_ney(counts, order, size):
    """Interpolated modified Kneser-Ney from the formulas, as a function of an n-gram (a tuple)."""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        levels[k] = collections.Counter(g[1:] for g in levels[k + 1])

    def discount(k):
        n = collections.Counter(levels[k].values())
        if not n[1] or not n[2]:
            return 0.5, 0.75, 0.9
        y = n[1] / (n[1] + 2 * n[2])
        d = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 1.0)
        return tuple(min(max(v, 0.05), top) for v, top in zip(d, (0.95, 1.9, 2.9)))

    ds = {k: discount(k) for k in levels}

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / size
        own = {h: c for h, c in levels[k].items() if h[:-1] == g[:-1]}
        total = sum(own.values())
        if not total:
            return p(g[1:])
        d = lambda c: ds[k][min(c, 3) - 1]
        c = own.get(g, 0)
        return (max(c - d(c), 0) if c else 0) / total + sum(d(v) for v in own.values()) / total * p(g[1:])

    return p


def folded(t):
    return "\n" * (qc.ORDER - 1) + re.sub("[0-9]", "0", t.replace("\0", "\1"))


def grams_of(t):
    s = folded(t)
    return [tuple(s[k : k + qc.ORDER]) for k in range(len(s) - qc.ORDER + 1)]


def test_grams_of_texts():
    rng = random.Random(5)
    texts = ["", "a", None, "12 34", "\0x", "漢字仮名" * 3] + ["".join(rng.choice("abé漢7 \n\U0001f600") for _ in range(rng.randrange(30))) for _ in range(200)]
    grams, h, which, at = qc.ngrams(*tx.buffers(pa.array(texts)))
    shown = qc.strings(grams)
    assert len(set(h.tolist())) == len({*shown})
    assert np.array_equal(np.sort(qc.hashes_of(pa.chunked_array([pa.array(shown)]))), np.sort(h))
    for k, t in enumerate(texts):
        assert [tuple(shown[i]) for i in which[at[k] : at[k + 1]]] == grams_of(t or "")


def test_perplexity_and_verdict_equal_the_formulas(spark):
    """Three scripts, each document's perplexity from the formulas and the threshold from the quantiles."""
    rng = random.Random(3)
    alphabets = {"en": "ab c.1", "ru": "абвг д", "ja": "漢字仮名 。"}
    docs = [(i, "".join(rng.choice(alphabets[lang]) for _ in range(rng.randrange(0, 40))), lang, "s", 0) for i, lang in enumerate(sorted(alphabets) * 60)]
    junk = [(1000 + i, "".join(rng.choice("QXZ%$#!@") for _ in range(30)), lang, "s", 0) for i, lang in enumerate(sorted(alphabets) * 3)]
    lab = [(d[0], 1, 0) for d in docs[:150]] + [(d[0], 0, 0) for d in junk[:6]] + [(200, 1, 1)]
    table = spark.createDataFrame([*docs, *junk], helpers.SCHEMA).repartition(3)
    held = {r.doc_id for r in table.select("doc_id").where("pmod(xxhash64(doc_id, 11), 5) = 0").collect()}
    got = {r.doc_id: r for r in qc.classify(table, helpers.labels(spark, lab)).collect()}

    good = {i for i, quality, toxic in lab if quality and not toxic}
    counts = collections.Counter(g for d in docs if d[0] in good - held for g in grams_of(d[1]))
    p = kneser_ney(counts, qc.ORDER, len({g[-1] for g in counts}) + 1)
    want = {}
    for i, t, *_ in [*docs, *junk]:
        g = grams_of(t)
        want[i] = math.exp(-sum(math.log(p(x)) for x in g) / len(g)) if g else None
        assert got[i].n_scored == len(t) and (got[i].perplexity is None if not t else math.isclose(got[i].perplexity, want[i], rel_tol=1e-9)), t
    for lang in alphabets:
        known = sorted(want[d[0]] for d in docs if d[2] == lang and d[0] in good & held and d[1])
        bad = [want[d[0]] for d in [*docs, *junk] if d[2] == lang and d[0] in {i for i, *_ in lab} - good and d[1]]
        best = max(
            (sum(x > q for x in bad) / max(len(bad), 1) - lost, k, q)
            for k, level in enumerate(qc.LEVELS)
            for q in [known[max(math.ceil(level * len(known)) - 1, 0)] * 1.02]
            for lost in [sum(x > q for x in known) / len(known)]
            if lost <= 0.01 or k == len(qc.LEVELS) - 1
        )
        assert all(math.isclose(r.threshold, best[2], rel_tol=1e-9) for r in got.values() if r.lang == lang)
    assert all(r.kept == (r.perplexity is not None and r.perplexity <= r.threshold) for r in got.values())
    assert not any(got[d[0]].kept for d in junk)


def test_classifier_keeps_clean_and_rejects_junk(spark):
    rng = random.Random(4)
    words = ["the", "and", "ther", "ation", "ing", "over", "rain"]
    good = [(i, " ".join(rng.choice(words) for _ in range(80)) + ".", "en", "s", 0) for i in range(150)]
    junk = [(1000 + i, "".join(rng.choice("QXZ%$#!@0987") for _ in range(300)), "en", "s", 0) for i in range(15)]
    docs = spark.createDataFrame([*good, *junk], helpers.SCHEMA)
    out = qc.classify(docs, helpers.labels(spark, [(d[0], 1, 0) for d in good[:100]]))
    kept = {r.doc_id for r in out.where("kept").collect()}
    assert len(kept & {d[0] for d in good}) >= 149 and not kept & {d[0] for d in junk}


def test_classifier_on_awkward_rows(spark):
    docs = helpers.awkward(spark).withColumn("perplexity", F.lit("clash"))
    out = qc.classify(docs, helpers.labels(spark, [(1, 1, 0), (None, 1, 0), (2, None, None)])).collect()
    assert len(out) == docs.count()
    none = [r for r in out if r.perplexity is None]
    assert {r.doc_id for r in none} == {3, 4, None} and not any(r.kept for r in none)
    free = qc.classify(helpers.awkward(spark), helpers.labels(spark))
    assert free.where("perplexity is not null and not kept").count() == 0
    assert qc.classify(helpers.empty(spark), helpers.labels(spark)).count() == 0
