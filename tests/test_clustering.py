"""Cells from reads: windows against the whole field, and against a plain version."""

import random

import pytest

from tessera.operators import clustering as cl


def plain(reads, how):
    """{name: peak} by comparing all pairs."""
    most = (how.xy_radius * how.z_radius) ** 2
    far = lambda a, b: how.z_radius**2 * ((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) + how.xy_radius**2 * (a[3] - b[3]) ** 2
    near = {a: [b for b in reads if far(a, b) <= most] for a in reads}
    rho = {a: len(near[a]) for a in reads}
    up = {}
    for a in reads:
        denser = [b for b in near[a] if (-rho[b], b[0]) < (-rho[a], a[0])]
        up[a] = min(denser, key=lambda b: (far(a, b), b[0])) if denser else a
    out = {}
    for a in reads:
        b = a
        while up[b] != b:
            b = up[b]
        out[a[0]] = b[0]
    return out


def field(seed, n, size, spread):
    rng = random.Random(seed)
    spots = [(rng.randrange(size), rng.randrange(size), rng.randrange(12)) for _ in range(max(1, n // 15))]
    out = []
    for k in range(n):
        x, y, z = rng.choice(spots)
        out.append((k, int(rng.gauss(x, spread)), int(rng.gauss(y, spread)), max(0, int(rng.gauss(z, 2)))))
    return out


@pytest.mark.parametrize("seed, window", [(0, 30), (1, 64), (2, 512), (3, 17)])
def test_windows_equal_the_whole_field(spark, seed, window):
    how = cl.Clustering(xy_radius=10, z_radius=4, window=window)
    fields = {f: field(seed * 10 + f, 250, 200, 12) for f in (1, 2)}
    reads = spark.createDataFrame([(f, *r) for f, rs in fields.items() for r in rs], "fov long, id long, x long, y long, z long")
    got = {(r.fov, r.id): r.cell for r in cl.peaks(reads, ["fov"], "id", how).collect()}
    assert got == {(f, k): c for f, rs in fields.items() for k, c in plain(rs, how).items()}


def test_a_chain_through_many_windows(spark):
    """A line of reads that get denser to one end: every read's way goes through all the windows up to there."""
    how = cl.Clustering(xy_radius=10, z_radius=1, window=10)
    line, k = [], 0
    x = 0.0
    while x < 300:
        line.append((k, int(x), 0, 0))
        k += 1
        x += 0.5 + 6 * (1 - x / 300)
    want = plain(line, how)
    assert len(set(want.values())) < len(line) / 4
    got = {r.id: r.cell for r in cl.peaks(spark.createDataFrame(line, "id long, x long, y long, z long"), [], "id", how).collect()}
    assert got == want


def test_noise_and_small_cells(spark):
    how = cl.Clustering(xy_radius=10, z_radius=5, noise_share=0.1, min_reads=6, window=64)
    rs = field(7, 300, 150, 8)
    reads = spark.createDataFrame([(1, *r) for r in rs], "fov long, id long, x long, y long, z long")
    got = cl.cells(reads, ["fov"], "id", how)
    rows = {r.id: r for r in got.collect()}
    near = {a[0]: sum((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= 100 for b in rs) - 1 for a in rs}
    ranked = sorted(near.values())
    place = 0.1 * (len(ranked) - 1)
    q = ranked[int(place)] + (place - int(place)) * (ranked[min(int(place) + 1, len(ranked) - 1)] - ranked[int(place)])
    assert {k for k, r in rows.items() if r.is_noise} == {k for k, n in near.items() if n < q}
    want = plain([r for r in rs if near[r[0]] >= q], how)
    size = {c: list(want.values()).count(c) for c in want.values()}
    assert {k: r.cell for k, r in rows.items()} == {r[0]: want[r[0]] if r[0] in want and size[want[r[0]]] >= 6 else -1 for r in rs}
    for c in cl.centers(reads, got, ["fov"], "id").collect():
        own = [r for r in rs if rows[r[0]].cell == c.cell]
        assert c.reads == len(own) and abs(c.column - sum(r[1] for r in own) / len(own)) < 1e-9 and abs(c.z_axis - sum(r[3] for r in own) / len(own)) < 1e-9


def test_no_reads_and_many_at_one_place(spark):
    how = cl.Clustering(window=64)
    empty = spark.createDataFrame([], "fov long, id long, x long, y long, z long")
    assert cl.cells(empty, ["fov"], "id", how).count() == 0
    same = spark.createDataFrame([(1, k, 5, 5, 1) for k in range(5000)], "fov long, id long, x long, y long, z long")
    assert {r.cell for r in cl.peaks(same, ["fov"], "id", how).collect()} == {0}


def test_reads_are_made_once(spark):
    """Neighbours, their share and the peaks take the same reads; places that cells carry give the same centres as those of the reads."""
    how = cl.Clustering(xy_radius=10, z_radius=5, min_reads=6, window=64)
    rows = [(f, *r) for f in (1, 2) for r in field(f, 300, 150, 8)]
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    reads = spark.createDataFrame(rows, "fov long, id long, x long, y long, z long")
    counted = reads.mapInArrow(count, reads.schema)
    plain_cells = cl.cells(reads, ["fov"], "id", how)
    carried = cl.cells(counted, ["fov"], "id", how, ("x", "y", "z"))
    key = lambda d: sorted(tuple(r) for r in d.collect())
    assert key(carried.select(plain_cells.columns)) == key(plain_cells)
    assert key(carried.select("fov", "id", "x", "y", "z")) == sorted(rows)
    assert made.value == len(rows)
    centres = lambda d: {(r.fov, r.cell): (r.reads, round(r.column, 9), round(r.row, 9), round(r.z_axis, 9)) for r in d.collect()}
    assert centres(cl.centers(counted, carried, ["fov"], "id")) == centres(cl.centers(reads, plain_cells, ["fov"], "id"))
    assert made.value == len(rows)
