"""Operator 2: packing."""

import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing
from tests.llm import helpers

public_tokenizers = pytest.importorskip("public_tokenizers")


def check(pdf, docs, size):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((-1 if d[0] is None else d[0], tok.encode(d[1] or "", add_special_tokens=False).ids + [1]) for d in docs)
    got: dict = {}
    for r in pdf.itertuples():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length and r.length > 0
    ids = sorted((-1 if r.doc_id != r.doc_id else int(r.doc_id), int(r.start), np.frombuffer(r.ids, "<u4").tolist()) for r in pdf.itertuples())
    for d, start, part in ids:
        got.setdefault(d, []).append((start, part))
    for d in {d for d, _ in want}:
        assert sorted(x for i, x in want if i == d for x in x) == sorted(x for _, p in got[d] for x in p)
    for q, g in pdf.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == np.concatenate([[0], g.length.cumsum()[:-1]]).tolist()
        assert g.length.sum() == size or q == pdf.sequence_id.max()


def test_every_token_once(spark):
    rng = random.Random(1)
    docs = [(i, helpers.text(rng, rng.randrange(0, 300)), "en", rng.choice("aaaaab"), 0) for i in range(200)]
    docs += [(900, "<|endoftext|> in a text", "en", "b", 0), (901, "x" * 3000, "en", "b", 0)]
    for mixture in (None, {"a": 0.5, "b": 0.5}, {"b": 1.0}):
        out = packing.pack(spark.createDataFrame(docs, helpers.SCHEMA).repartition(5), mixture, size=128, window_sequences=16).toPandas()
        check(out, docs, 128)
        by = {d: g.sort_values("start") for d, g in out.groupby("doc_id")}
        assert all(g.start.tolist() == np.concatenate([[0], g.length.cumsum()[:-1]]).tolist() and g.doc_tokens.iloc[0] == g.length.sum() for g in by.values())


def test_windows_hold_the_mixture(spark):
    docs = [(i, "a b c d e f g h " * 40, "en", "big" if i % 4 else "small", 0) for i in range(400)]
    out = packing.pack(spark.createDataFrame(docs, helpers.SCHEMA).repartition(7), {"big": 0.5, "small": 0.5}, size=256, window_sequences=32).toPandas()
    total = out[out.source == "small"].length.sum()
    out["window"] = out.sequence_id * 256 // (256 * 32)
    share = out.pivot_table(index="window", columns="source", values="length", aggfunc="sum", fill_value=0)
    full = share[share.small.cumsum() < total * 0.9]
    assert len(full) > 2 and (abs(full.small / full.sum(axis=1) - 0.5) < 0.03).all()


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_a_bijection(seed):
    rng = np.random.default_rng(seed)
    totals = rng.integers(0, 3000, 5)
    shares = rng.random(5) * (rng.random(5) > 0.3)
    plan = packing.Plan(totals, shares, 512, 32)
    taken = []
    for q, t in enumerate(totals):
        at = 0
        while at < t:
            n = min(int(rng.integers(1, 400)), t - at)
            for begin, length, place in plan.pieces(q, at, n, 128):
                assert length > 0 and place % 128 + length <= 128
                taken += range(place, place + length)
            at += n
    assert sorted(taken) == list(range(totals.sum()))


def test_awkward_rows(spark):
    d = helpers.awkward(spark).withColumnRenamed("n_chars", "length")
    out = packing.pack(d).toPandas()
    check(out, [tuple(r) for r in d.collect()], 2048)
    assert out[out.doc_id == 3].doc_tokens.tolist() == [1]
    assert packing.pack(helpers.empty(spark)).count() == 0


def test_ids_equal_the_named_library():
    """Over all documents of a table and random texts of many scripts."""
    path = packing._default_path()
    slow, encode = Tokenizer.from_file(path), packing.tokenizer(path)
    rng = random.Random(1)
    pool = [chr(c) for c in [*range(1, 128), *range(160, 600), *range(0x4E00, 0x4E30), *range(0x1F600, 0x1F610), 0x300, 0x200D, 0xFE0F, 0x0E31, 0x0915, 0x2028, 0x85, 0x3000]]
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()
    texts = [t or "" for t in texts] + ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(3000)] + ["<|endoftext|> x", "y" * 5000]
    for a in range(0, len(texts), 500):
        want = slow.encode_batch(texts[a : a + 500], add_special_tokens=False)
        assert all(x.tolist() == y.ids for x, y in zip(encode(texts[a : a + 500]), want))


def test_mixtures_of_too_many_sources_are_refused(spark):
    with pytest.raises(ValueError, match="at most"):
        packing.pack(helpers.empty(spark), {str(k): 1.0 for k in range(5)}, most_queues=4)
