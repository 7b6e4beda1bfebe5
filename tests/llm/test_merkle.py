"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle, queries
from tests.llm.helpers import SCHEMA, awkward, empty

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(t: str) -> str:
    return hashlib.sha256(t.encode()).hexdigest()


def leaf(row) -> str:
    return sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def tree(hashes):
    """The root, and for each leaf its siblings left and right of it, level by level."""
    where, path = list(range(len(hashes))), [[] for _ in hashes]
    while len(hashes) > 1:
        for k, at in enumerate(where):
            run = at // 8 * 8
            path[k].append((hashes[run:at], hashes[at + 1 : run + 8]))
            where[k] = at // 8
        hashes = [sha("".join(hashes[a : a + 8])) for a in range(0, len(hashes), 8)]
    return hashes[0], path


def plain(docs):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of each row."""
    groups = defaultdict(list)
    for d in docs:
        groups[d["lang"]].append(d)
    names = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    made = {}
    for g in names:
        rows = sorted(groups[g], key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf(d)))
        made[g] = rows, *tree([leaf(d) for d in rows])
    root, tops = tree([made[g][1] for g in names])
    out = []
    for g, top in zip(names, tops):
        rows, subroot, paths = made[g]
        for d, path in zip(rows, paths):
            other = d | {"text": "".join(c.lower() if c.isascii() else c for c in d["text"])} if d["text"] is not None and d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 0 else d
            h, proof = leaf(other), ""
            for a, b in path + top:
                proof += "".join(a + b)
                h = sha("".join(a) + h + "".join(b))
            out.append((d["doc_id"], leaf(d), subroot, root, sha(proof), h, h == root))
    return out


def query(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(str, map(tuple, queries.op11_merkle_manifest(spark, str(tmp_path)).collect())))


@pytest.mark.parametrize("n, langs", [(1, 1), (8, 1), (9, 1), (65, 2), (600, 3), (100, 77)])
def test_query_equals_plain_tree(spark, tmp_path, n, langs):
    rng = random.Random(n)
    rows = [(k * 7, rng.choice(["Abc é漢", "xyz", "", None]), rng.choice([None, *map(str, range(langs))]), rng.choice([None, "s"]), rng.choice([None, k])) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert query(spark, tmp_path, docs) == sorted(map(str, plain([r.asDict() for r in docs.collect()])))


def test_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    assert query(spark, tmp_path, docs) == sorted(map(str, plain([r.asDict() for r in docs.collect()])))


def test_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, empty(spark)) == []


def test_one_group_over_many_partitions(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    got = {r["doc_id"]: r for r in merkle.manifest(docs.repartition(16), FIELDS).collect()}
    root, path = tree([leaf({"doc_id": k, "text": "x", "lang": "en", "source": "s", "n_chars": 1}) for k in range(5000)])
    assert len(got) == 5000 and {r["root"] for r in got.values()} == {root}
    for k in (0, 7, 8, 4095, 4096, 4999):
        assert [(p["slot"], p["preimage"]) for p in got[k]["path"]] == [(len(a), "".join(a) + (got[k]["leaf"] if i == 0 else p["preimage"][64 * len(a) : 64 * len(a) + 64]) + "".join(b)) for i, ((a, b), p) in enumerate(zip(path[k], got[k]["path"]))]


def test_every_change_is_seen(spark):
    docs = spark.createDataFrame([(k, f"Text {k}", "en" if k % 2 else "de", "s", k) for k in range(40)], SCHEMA)
    for field, value in (("text", F.lit("Text")), ("n_chars", F.lit(-1)), ("source", F.lit(None).cast("string"))):
        out = merkle.manifest(docs, FIELDS, changed={field: F.when(F.col("doc_id") == 5, value).otherwise(F.col(field))})
        bad = out.where(merkle.folded(F.col("changed_leaf"), F.col("path")) != F.col("root")).collect()
        assert [r["doc_id"] for r in bad] == [5]


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "t", "en", "s", 1, "a", "b", 5, "c")], SCHEMA + ", hash string, path string, i long, group string")
    (r,) = merkle.manifest(docs, FIELDS).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == leaf({"doc_id": 1, "text": "t", "lang": "en", "source": "s", "n_chars": 1}) and r["path"] == []
