"""Compressed columns and categories."""

import random

import pytest

from tessera.operators import sparse


@pytest.mark.parametrize("seed, block", [(0, 4096), (1, 3), (2, 1)])
def test_compressed_columns(spark, seed, block):
    rng = random.Random(seed)
    columns = [sorted(rng.sample(range(50), rng.choice([0, 0, 1, 7, 40]))) for _ in range(30)]
    entries, pointers, k = [], [], 0
    for c, rows in enumerate(columns):
        pointers.append((c, k, k + len(rows)))
        for r in rows:
            entries.append((k, r, float(c * 100 + r)))
            k += 1
    e = spark.createDataFrame(entries, "k long, row long, value double")
    p = spark.createDataFrame(pointers, "col long, first long, after long")
    got = sorted(map(tuple, sparse.from_columns(e, p, block).collect()))
    assert got == sorted((r, c, float(c * 100 + r)) for c, rows in enumerate(columns) for r in rows)
    back_e, back_p = sparse.to_columns(sparse.from_columns(e, p, block), "row", "col", "value")
    assert sorted(map(tuple, back_e.collect())) == entries
    assert sorted(map(tuple, back_p.select("col", "first", "after").collect())) == [q for q in pointers if q[1] < q[2]]


def test_categories(spark):
    rows = spark.createDataFrame([(1, 0), (2, 2), (3, -1), (4, 9), (5, None)], "id long, code int")
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "code int, name string")
    assert {r.id: r.type for r in sparse.categories(rows, "code", names, "type").collect()} == {1: "a", 2: "c", 3: None, 4: None, 5: None}
