"""Repetitive texts: results don't depend on what is held at once, and memory stays bounded."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import decontamination, suffix_dedup
from tessera.llm import text as tx


def find(index, texts):
    return sorted(index.find(*tx.buffers(pa.array(texts))))


@pytest.mark.parametrize("hits", [1, 40, 1000])
def test_hits_in_parts(monkeypatch, hits):
    rng = random.Random(hits)
    word = lambda: rng.choice(["aa", "ab", "ba", " ", "  ", "abab"])
    items = [(k, "".join(word() for _ in range(rng.randrange(5, 60)))) for k in range(20)]
    texts = ["".join(word() for _ in range(rng.randrange(200))) + rng.choice(items)[1] + "".join(word() for _ in range(50)) for _ in range(15)]
    index = decontamination.Items(items, 12, 0.05)
    whole = find(index, texts)
    monkeypatch.setattr(decontamination, "HITS", hits)
    assert find(index, texts) == whole and whole


def test_memory_of_a_run_that_many_items_share():
    rng = random.Random(1)
    items = [(k, "".join(rng.choice("abcdefghij klmnop") for _ in range(60)) + " " * 40 + "".join(rng.choice("qrstuvwxyz") for _ in range(60))) for k in range(1000)]
    index = decontamination.Items(items, 12, 0.05)
    text = "x" + " " * 30_000 + items[7][1]
    tracemalloc.start()
    got = find(index, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(d, i, e) for d, i, e, *_ in got] == [(0, 7, 0)] and peak < 400e6


def plain_spans(docs, length=50):
    """{doc_id: bytes removed} by a table of all strings."""
    first: dict = {}
    for i, t in sorted(docs):
        raw = t.encode()
        for k in range(len(raw) - length + 1):
            first.setdefault(raw[k : k + length], i)
    out = {}
    for i, t in docs:
        raw, gone = t.encode(), set()
        for k in range(len(raw) - length + 1):
            if first[raw[k : k + length]] < i:
                gone.update(range(k, k + length))
        out[i] = bytes(c for k, c in enumerate(raw) if k not in gone)
    return out


@pytest.mark.parametrize("held, part", [(20_000, 1 << 30), (30, 200), (5, 60)])
def test_suffix_dedup_of_repetitive_texts(spark, held, part):
    """A popular string in many documents and several times in each, with few rows held at once."""
    rng = random.Random(held)
    phrase = "".join(rng.choice("abcdef ") for _ in range(60))
    docs = [(i, "".join(rng.choice([phrase, "x" * rng.randrange(40, 90), "".join(rng.choice("gh") for _ in range(30)), "ab" * 40]) for _ in range(6))) for i in rng.sample(range(1000), 80)]

    def small(f):
        def run(batches):
            suffix_dedup.HELD, suffix_dedup.PART = held, part
            return f(batches)

        return run

    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    plain_map = type(d).mapInArrow
    try:
        type(d).mapInArrow = lambda self, f, schema, *a, **k: plain_map(self, small(f), schema, *a, **k)
        got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.dedup(d, 50, crowd=3).collect()}
    finally:
        type(d).mapInArrow = plain_map
    assert got == plain_spans(docs)


def test_long_run_of_one_letter(spark):
    docs = [(k, "a" * 200_000 + str(k)) for k in range(1, 4)]
    got = {r.doc_id: (r.n_removed, r.kept) for r in suffix_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string"), 50).collect()}
    assert got[1][0] == 0 and got[2] == (200_000, b"2") and got[3] == (200_000, b"3")
