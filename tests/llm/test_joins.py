"""Operators 4, 6, 8 and 10, against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import common, decontamination, jaccard_join, line_dedup, queries, suffix_dedup
from tessera.llm import text as tx
from tests.llm import helpers


def classes_of(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in links:
        a, b = find(i), find(j)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = random.Random(0)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(None, 3), (7, 7)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    ids = sorted({x for e in real for x in e})
    want = classes_of(len(ids), [(ids.index(a), ids.index(b)) for a, b in real])
    assert got == {i: ids[w] for i, w in zip(ids, want)}


def random_sets(rng, gen, passage=None):
    sets = []
    for _ in range(6):
        base = gen.integers(0, 2**63, rng.randrange(1, 110)).astype(np.uint64) * np.uint64(2)
        if passage is not None:
            base = np.concatenate([base, gen.choice(passage, rng.randrange(0, 110), replace=False)])
        for _ in range(rng.randrange(1, 10)):
            x = set(base.tolist())
            for _ in range(rng.randrange(0, max(1, len(base) // 8) + 1)):
                if rng.random() < 0.5 and len(x) > 1:
                    x.discard(rng.choice(sorted(x)))
                else:
                    x.add(int(gen.integers(0, 2**63)))
            sets.append(np.array(sorted(x), np.uint64))
    return sets


@pytest.mark.parametrize("percent", [90, 80, 60])
@pytest.mark.parametrize("flagged", [False, True])
def test_linked_sets_share_a_run_and_the_tree_finds_all_links(percent, flagged):
    rng, gen = random.Random(percent), np.random.default_rng(percent)
    limits = jaccard_join.Classes(percent, 1 << 31)
    for _ in range(25):
        passage = gen.integers(0, 2**63, 150).astype(np.uint64) * np.uint64(2) if flagged else None
        flags = None
        if flagged:
            flags = np.zeros(1 << jaccard_join.FREQUENT_BITS, bool)
            flags[passage >> np.uint64(64 - jaccard_join.FREQUENT_BITS)] = True
        sets = random_sets(rng, gen, passage)
        plain = [set(s.tolist()) for s in sets]
        keys, owner = jaccard_join.run_keys(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), limits, percent, flags)
        runs = [set(keys[owner == i].tolist()) for i in range(len(sets))]
        links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(plain[i] & plain[j]) >= percent * len(plain[i] | plain[j])]
        assert all(plain[i] == plain[j] or runs[i] & runs[j] for i, j in links)
        assert jaccard_join.link_sets(sets, percent) == classes_of(len(sets), links)


@pytest.mark.parametrize("percent", [89, 85, 80, 60, 45])
@pytest.mark.parametrize("flagged", [False, True])
def test_linked_sets_share_a_window(percent, flagged):
    rng, gen = random.Random(percent), np.random.default_rng(percent)
    windows, shared = jaccard_join.Windows(percent), 0
    for _ in range(25):
        passage = gen.integers(0, 2**63, 150).astype(np.uint64) * np.uint64(2) if flagged else None
        flags = np.zeros(1 << jaccard_join.FREQUENT_BITS, bool)
        if flagged:
            flags[passage >> np.uint64(64 - jaccard_join.FREQUENT_BITS)] = True
        sets = random_sets(rng, gen, passage)
        plain = [set(s.tolist()) for s in sets]
        keys, owner = jaccard_join.window_keys(np.concatenate(sets), np.cumsum([0, *map(len, sets)]), windows, flags)
        own = [set(keys[owner == i].tolist()) for i in range(len(sets))]
        links = [(i, j) for i in range(len(sets)) for j in range(i) if plain[i] != plain[j] and 100 * len(plain[i] & plain[j]) >= percent * len(plain[i] | plain[j])]
        assert all(own[i] & own[j] for i, j in links)
        shared += len(links)
    assert shared > 100


def test_sets_that_share_single_ngrams_by_chance_make_no_block(spark, monkeypatch):
    """Every document has a few five-word n-grams in common with others, as happens in large collections. None is like another."""
    rng = random.Random(4)
    common = [" ".join("c%d" % rng.randrange(10**6) for _ in range(5)) for _ in range(400)]
    docs = []
    for k in range(600):
        words = [" ".join("w%d" % rng.randrange(10**9) for _ in range(20)) for _ in range(12)]
        for at in rng.sample(range(12), 6):
            words[at] += " " + rng.choice(common)
        docs.append((k, " ".join(words), "en", "s", 0))
    picked, stage = [], jaccard_join.stage

    def seen(df, name):
        out = stage(df, name)
        if name == "jaccard-picked":
            picked.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "stage", seen)
    got = jaccard_join.cluster(spark.createDataFrame(docs, helpers.SCHEMA).repartition(4), words=5, percent=80)
    assert all(r.component_id == r.doc_id for r in got.collect())
    assert picked[0] < 30


def shingle_set(t, k):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("percent,words,limit", [(90, 3, 1_000_000), (80, 5, 300)])
def test_cluster(spark, percent, words, limit):
    rng = random.Random(words)
    docs = []
    for g in range(12):
        base = helpers.text(rng, rng.randrange(1, 80)).split(" ")
        for _ in range(rng.randrange(1, 9)):
            w = list(base)
            for _ in range(rng.randrange(0, 3)):
                w[rng.randrange(len(w))] = "new%d" % rng.randrange(999)
            docs.append((rng.randrange(10**6), " ".join(w).upper() if rng.random() < 0.3 else " ".join(w), "en", "s", 0))
    d = spark.createDataFrame(docs, helpers.SCHEMA).unionByName(helpers.awkward(spark)).withColumn("component_id", F.lit(1)).repartition(5)
    rows = [(r.doc_id, shingle_set(r.text, words)) for r in d.collect() if r.doc_id is not None]
    rows.sort(key=lambda r: r[0])
    links = [(i, j) for i, (_, a) in enumerate(rows) for j, (_, b) in enumerate(rows[:i]) if a and b and 100 * len(a & b) >= percent * len(a | b)]
    want = sorted((rows[i][0], len(rows[i][1]), rows[c][0]) for i, c in enumerate(classes_of(len(rows), links)))
    got = jaccard_join.cluster(d, words=words, percent=percent, block_shingles=limit)
    assert sorted(tuple(r) for r in got.collect()) == want
    kept = jaccard_join.keep_first(d, words=words, percent=percent)
    assert {r.doc_id for r in kept.collect()} == {w[2] for w in want} | {None} and kept.columns == d.columns


def test_large_blocks_are_split(spark):
    """A large group around one text, with copies that are linked through others only, and other groups that share its passage."""
    rng = random.Random(11)
    base = helpers.text(rng, 120).split(" ")
    docs = []
    for k in range(150):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 6, 12])):
            w[rng.randrange(len(w))] = "new%d" % rng.randrange(99)
        docs.append((1000 + k, " ".join(w[: rng.choice([120, 120, 60])]), "en", "s", 0))
    d = spark.createDataFrame(docs, helpers.SCHEMA).repartition(4)
    rows = sorted((r.doc_id, shingle_set(r.text, 3)) for r in d.collect())
    for percent in (90, 80):
        links = [(i, j) for i, (_, a) in enumerate(rows) for j, (_, b) in enumerate(rows[:i]) if 100 * len(a & b) >= percent * len(a | b)]
        want = {rows[i][0]: rows[c][0] for i, c in enumerate(classes_of(len(rows), links))}
        for limit in (400, 2000, 10**6):
            got = jaccard_join.cluster(d, words=3, percent=percent, block_shingles=limit)
            assert {r.doc_id: r.component_id for r in got.collect()} == want


def test_cluster_of_nothing(spark):
    assert jaccard_join.cluster(helpers.empty(spark)).count() == 0


def fewest_edits(p, t):
    before = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        now = [i]
        for j, d in enumerate(t, 1):
            now.append(min(before[j - 1] + (c != d), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def test_decontamination_finds_edited_items(spark):
    rng = random.Random(3)
    parts = ["th", "er", "on", "an", "re", "he", " ", ". "]
    items = [(k, "".join(rng.choice(parts) for _ in range(rng.choice([3, 20, 60, 100])))) for k in range(12)]
    docs = []
    for n in range(200):
        t, p = "".join(rng.choice(parts) for _ in range(rng.randrange(150))), list(items[rng.randrange(12)][1])
        for _ in range(rng.randrange(0, 8)):
            o = rng.randrange(len(p)) if p else 0
            kind = rng.random()
            if kind < 0.4 and p:
                p[o] = rng.choice("xyz")
            elif kind < 0.7 and p:
                del p[o]
            else:
                p.insert(o, rng.choice("xyz"))
        cut = rng.randrange(len(t) + 1)
        docs.append((n, t[:cut] + "".join(p).upper() + t[cut:]))
    index = decontamination.Items(items, 12, 0.05)
    want = {(n, k): fewest_edits(p.lower(), t.lower()) for n, t in docs for k, p in items}
    want = {x: e for x, e in want.items() if e <= index.edits[x[1]]}
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame([*items, (None, "x"), (77, None), (78, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontamination.matches(d, b).collect()}
    assert got == want
    clean = decontamination.filter_documents(d, b)
    assert {r.doc_id for r in clean.collect()} == {n for n, _ in docs} - {n for n, _ in want}


def test_decontamination_on_awkward_rows(spark):
    d = helpers.awkward(spark).withColumn("edits", F.lit("clash"))
    b = spark.createDataFrame([(1, "no id no id no id")], "item_id long, text string")
    assert [r.doc_id for r in decontamination.matches(d, b).collect()] == [None]
    assert decontamination.filter_documents(d, b).count() == d.count() - 1
    assert decontamination.matches(d, b.where("item_id = 9")).count() == 0
    assert decontamination.matches(helpers.empty(spark), b).count() == 0


def test_repetitive_and_short_items(spark):
    """Items of few kinds of q-grams have few entries, and short ones have their share of edits too."""
    items = [(1, "a" * 1000), (2, "ab" * 300), (3, "wxyzwxyzvwxyzuvwxyzt"), (4, "q")]
    index = decontamination.Items(items, 12, 0.05)
    assert len(index.key) < 10
    texts = ["a" * 8000, "b" + "ab" * 297 + "c", "-- wxyzwxyzvwxyzuvwyzt", "-- wxyzwxyzvxyzuvwyzt", "q"]
    got = {(d, i + 1): e for d, i, e, *_ in index.find(*tx.buffers(pa.array(texts)))}
    assert got == {(0, 1): 0, (1, 2): fewest_edits("ab" * 300, texts[1]), (2, 3): 1, (4, 4): 0}


def without_earlier(docs, n):
    first: dict = {}
    for d, b in sorted(docs):
        for i in range(len(b) - n + 1):
            first.setdefault(b[i : i + n], d)
    out = []
    for d, b in docs:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if first[b[i : i + n]] < d:
                gone[i : i + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("seed", "crowd"), [(0, 20_000), (1, 20_000), (2, 2)])
def test_suffix_dedup(spark, seed, crowd):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdefgh é\0") for _ in range(rng.randrange(20, 120))) for _ in range(12)] + ["\0" * 57, "\0" * 49 + "z"]
    docs = [(i, "".join(rng.choice([*pool, "ab", "a" * 60, "abcabc" * 9, "xy"]) for _ in range(rng.randrange(0, 12)))) for i in range(150)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = sorted(tuple(r) for r in suffix_dedup.dedup(d, crowd=crowd).drop("kept").collect())
    assert got == without_earlier([(i, t.encode()) for i, t in docs], 50)


def test_suffix_arrays_of_many_batches(spark):
    """More phrases than a task sorts at once, under one trigger and many."""
    rng = random.Random(9)
    head = "".join(rng.choice("abcdefgh") for _ in range(40))
    docs = [(i, head + "".join(rng.choice("xyz") for _ in range(40)) + rng.choice(["", head])) for i in range(3000)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    for crowd in (10_000, 100):
        got = sorted(tuple(r) for r in suffix_dedup.dedup(d, crowd=crowd).drop("kept").collect())
        assert got == without_earlier([(i, t.encode()) for i, t in docs], 50)


def test_suffix_dedup_on_awkward_rows(spark):
    d = helpers.awkward(spark).withColumn("spans", F.lit(1))
    rows = [(r.doc_id, (r.text or "").encode()) for r in d.collect()]
    got = [tuple(r) for r in suffix_dedup.dedup(d).drop("kept").collect()]
    assert sorted(g for g in got if g[0] is not None) == without_earlier([r for r in rows if r[0] is not None], 50)
    assert sorted(g[1:3] for g in got if g[0] is None) == [(0, 0), (len("no id " * 60), 0)]
    assert suffix_dedup.dedup(helpers.empty(spark)).count() == 0


def distance(a, b):
    before = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        now = [i]
        for j, d in enumerate(b, 1):
            now.append(min(before[j - 1] + (c != d), before[j] + 1, now[-1] + 1))
        before = now
    return before[-1]


def change(rng, line):
    x = list(line)
    for _ in range(rng.randrange(0, 4)):
        kind, o = rng.random(), rng.randrange(len(x))
        if kind < 0.4:
            x[o] = rng.choice("xyé")
        elif kind < 0.7:
            del x[o]
        else:
            x.insert(o, rng.choice("xyé"))
    return "".join(x)


def earlier_lines(docs, edits=2, per_edit=10):
    want, seen = set(), []
    for d, t in sorted((d, t) for d, t in docs if d is not None and t is not None):
        for n, line in enumerate(t.split("\n")):
            if not re.search(r"[^\x20\x09-\x0D]", line):
                continue
            near = lambda m: abs(len(m) - len(line)) <= min(edits, min(len(m), len(line)) // per_edit) and distance(m, line) <= min(edits, min(len(m), len(line)) // per_edit)  # noqa: B023, E731
            if line in seen:
                want.add((d, n, True))
            elif any(map(near, seen)):
                want.add((d, n, False))
            seen.append(line)
    return want


@pytest.mark.parametrize("edits", [1, 2])
def test_line_dedup(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choice("ab é") for _ in range(rng.choice([rng.randrange(18, 40), rng.randrange(8, 24)]))) for _ in range(24)]
    docs = [(i, "\n".join(change(rng, rng.choice(base)) if rng.random() < 0.9 else rng.choice(["", "  ", "short"]) for _ in range(rng.randrange(1, 6)))) for i in range(100)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = earlier_lines(docs, edits)
    assert {tuple(r) for r in line_dedup.removed_lines(d, edits).collect()} == want
    out = {r.doc_id: r for r in line_dedup.dedup(d, edits).collect()}
    for i, t in docs:
        gone = {n for d_, n, _ in want if d_ == i}
        assert out[i].text == "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
        assert out[i].n_copies + out[i].n_near == len(gone) and out[i].n_lines == len(t.split("\n"))


def test_banded_distance(spark):
    rng = random.Random(9)
    pairs = [(a, change(rng, a)) for a in ("".join(rng.choice("abé") for _ in range(rng.randrange(6, 15))) for _ in range(300))]
    d = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2, 3):
        got = [r[0] for r in d.select(line_dedup.within(F.col("a"), F.col("b"), edits)).collect()]
        assert got == [distance(a, b) <= edits for a, b in pairs]
        got = [r[0] for r in d.select(line_dedup.within(F.col("a"), F.col("b"), edits, F.lit(edits - 1))).collect()]
        assert got == [distance(a, b) <= edits - 1 for a, b in pairs]


def test_line_dedup_on_awkward_rows(spark):
    d = helpers.awkward(spark).withColumn("n_lines", F.lit("clash")).withColumn("__copies", F.lit(1)).withColumn("__id", F.lit(1))
    out = line_dedup.dedup(d).collect()
    assert len(out) == d.count()
    by = {r.doc_id: r for r in out}
    assert by[3].text is None and by[3].n_lines == 0 and by[4].text == "" and by[5].text == " \n\t " and by[2].text == "" and by[2].n_copies == 1
    assert line_dedup.dedup(helpers.empty(spark)).count() == 0


def test_short_lines_lose_their_exact_copies(spark, tmp_path):
    """In the query and the pipeline's stage; near copies of lines under ten characters stay."""
    docs = [(2, "Les.\na\n\nabd\n \n" + "x" * 30), (1, "Les.\nabc\nLes.\n\n" + "x" * 30), (3, "a\nabc\nnew")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    want = {1: "Les.\nabc\n\n" + "x" * 30, 2: "a\n\nabd\n ", 3: "new"}
    d.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries.op10_line_dedup(spark, str(tmp_path)).collect()}
    assert {i: out[i].text for i in want} == want and [out[i].n_copies for i in (1, 2, 3)] == [1, 2, 2] and out[2].n_near == 0
    assert {r.doc_id: r.text for r in corpus_pipeline.lines(spark, d, str(tmp_path)).collect()} == want
