"""Shards: counts, mixture, order, and every row once."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import sharding
from tests.llm.helpers import awkward, empty


def plain(docs, n_shards, seed):
    """(doc_id, shard, slot); ids are distinct."""
    queues = defaultdict(list)
    for d in docs:
        queues[d["source"]].append(d)
    order = []
    for s, rows in queues.items():
        rows.sort(key=lambda d: hashlib.md5(f"{seed}:{d['doc_id']}".encode()).digest())
        step = int(hashlib.md5(f"{seed}:{s or ''}".encode()).hexdigest()[:8], 16) / 2**32
        order += [((k + step) / len(rows), s is not None, s or "", d["doc_id"]) for k, d in enumerate(rows)]
    order.sort()
    at, out = Counter(), []
    for p, (*_, doc) in enumerate(order):
        shard = p * n_shards // len(order)
        out.append((doc, shard, at[shard]))
        at[shard] += 1
    return sorted(out)


@pytest.mark.parametrize("n, n_shards", [(1, 40), (39, 40), (1000, 40), (777, 7)])
def test_equals_plain(spark, n, n_shards):
    docs = spark.createDataFrame([(k, "é" * (k % 5), None if k % 11 == 0 else f"s{k % 3 * k % 4}" if k % 3 else "hot") for k in range(n)], "doc_id long, text string, source string")
    got = sharding.assign(docs, n_shards, seed=5).collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in got) == plain([r.asDict() for r in docs.collect()], n_shards, 5)


def test_mixture_and_counts(spark):
    docs = spark.range(8000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 17)).alias("source"))
    got = sharding.assign(docs.repartition(9), 40).collect()
    per = Counter(r["shard"] for r in got)
    assert len(per) == 40 and max(per.values()) - min(per.values()) <= 1
    of, by = Counter(r["source"] for r in got), Counter((r["shard"], r["source"]) for r in got)
    assert all(abs(by[s, x] - of[x] / 40) <= 2 for s in per for x in of)
    for s in per:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(per[s]))
    assert [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))] != sorted(r["doc_id"] for r in got)


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = sharding.assign(docs, 4).collect()
    want = Counter((r["doc_id"], r["source"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["source"], r["size"], r["text_crc32"]) for r in got) == want
    per = Counter(r["shard"] for r in got)
    assert max(per.values()) - min(per.values()) <= 1


def test_empty_table(spark):
    assert sharding.assign(empty(spark)).collect() == []


def test_many_equal_rows(spark):
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("same").alias("text"), F.lit("s").alias("source"))
    got = sharding.assign(docs.repartition(7), 40).collect()
    assert len({(r["shard"], r["slot"]) for r in got}) == 3000


def test_written_shards(spark, tmp_path):
    docs = awkward(spark).withColumn("__row", F.lit("mine")).withColumn("size", F.lit("clash"))
    sharding.write(docs, f"{tmp_path}/out", n_shards=4)
    back = spark.read.parquet(f"{tmp_path}/out")
    key = lambda df: sorted(map(str, df.select(*docs.columns).collect()))
    assert key(back) == key(docs)
    want = sorted((str(r["doc_id"]), r["shard"], r["slot"]) for r in sharding.assign(awkward(spark), 4).collect())
    assert sorted((str(r["doc_id"]), r["shard"], r["slot"]) for r in back.collect()) == want
