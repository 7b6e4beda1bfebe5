"""Runs against all periods tried one by one."""

import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import periodic_runs as pr
from tests.llm.helpers import awkward, empty


def plain(w, least=pr.LEAST):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q) and all(any(w[k] != w[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9), st.integers(0, 40), st.lists(st.integers(0, 1), max_size=30))
def test_equals_plain(head, p, k, tail):
    words = [b"%d" % x for x in head + (head[-p:] * 9)[:k] + tail]
    assert pr.runs_of_words(words) == plain(words)


def test_small_runs_of_the_automaton():
    rng = random.Random(3)
    for _ in range(400):
        w = [rng.randrange(2) for _ in range(rng.randrange(40))]
        assert sorted(pr.runs_of(w, 2)) == sorted(plain(w, 2))


def test_repeated_passages_apart():
    rng = random.Random(4)
    base = [b"%d" % rng.randrange(10_000) for _ in range(300)]
    words = base + [b"-"] + base + [b"+"] + base[:150] + base[:150]  # the last of them twice in a row
    assert pr.runs_of_words(words) == plain(words)
    assert len(pr.runs_of_words(words)) == 1


def test_long_repetitive_texts():
    began = time.time()
    assert pr.runs_of_words([b"a"] * 200_000) == [(0, 200_000, 1)]
    assert pr.runs_of_words([b"%d" % (k % 50_000) for k in range(200_000)]) == [(0, 200_000, 50_000)]
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 100_000:
        a, b = b, b + a
    runs = pr.runs_of_words(b)
    assert len(runs) > 20_000 and all(length >= max(12, 2 * q) for _, length, q in runs)
    assert time.time() - began < 60


def test_rows(spark):
    docs = awkward(spark, [(20, " ".join(["a b c"] * 10) + " d", "en", "s", 1), (21, "x" * 100_000 + " y" * 40, "en", "s", 1), (22, "漢\x1c字 é " * 30, "en", "s", 1)])
    docs = docs.selectExpr("*", "'mine' as h", "7 as runs", "8 as Collapsed")
    got = pr.with_runs(docs).collect()
    assert len(got) == docs.count() and set(got[0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars", "h", "n_words", "runs", "collapsed"}
    for r in got:
        words = (r["text"] or "").encode().split()
        runs = [tuple(x) for x in r["runs"]]
        if len(words) < 2000:
            assert runs == plain(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        assert r["n_words"] == len(words) and r["collapsed"].encode() == b" ".join(w for i, w in enumerate(words) if i not in gone)
    by = {r["doc_id"]: r for r in got}
    assert [tuple(x) for x in by[20]["runs"]] == [(0, 30, 3)] and by[20]["collapsed"] == "a b c d"
    assert [tuple(x) for x in by[21]["runs"]] == [(1, 40, 1)]
    assert [tuple(x) for x in by[22]["runs"]] == [(0, 30, 1)]


def test_empty_table(spark):
    assert pr.with_runs(empty(spark)).collect() == []
