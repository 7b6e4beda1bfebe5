import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import cells, expression, joins, kernels, spatial, stitch
from tessera.operators import images as im
from tessera.sources import fixtures, readers, sinks


def test_subtiles(spark):
    t = {r.t: r for r in stitch.subtiles(spark, 2048, 2048, 4, 0.1).collect()}
    assert (t[1].scoords_x, t[1].scoords_y, t[1].ecoords_x, t[1].ecoords_y) == (1, 1, 563, 563)
    assert (t[2].scoords_x, t[2].scoords_y, t[2].ecoords_x, t[2].ecoords_y) == (1, 462, 563, 1075)
    assert (t[16].scoords_x, t[16].ecoords_x, t[16].upperleft_x, t[16].inputdim_x) == (1486, 2048, 1536, 563)


@pytest.mark.parametrize("seed", range(6))
def test_corner_stitching_equals_the_fold(spark, seed):
    rng = random.Random(seed)
    corners = {t: (rng.randrange(20), rng.randrange(20)) for t in range(1, 5)}
    rows = [(1, t, rng.randrange(30), rng.randrange(30)) for t in rng.sample(sorted(corners), 3) for _ in range(12)]
    kept = []
    for t in sorted(corners):
        sx, sy = corners[t]
        own = [r for r in rows if r[1] == t]
        if not own:
            continue
        kept = own if not kept else [r for r in kept if r[2] <= sx or r[3] <= sy] + [r for r in own if r[2] > sx and r[3] > sy]
        if not kept:
            pytest.skip("the fold starts anew when nothing is left")
    tiles = spark.createDataFrame([(t, *c) for t, c in corners.items()], "t long, sx long, sy long")
    d = spark.createDataFrame(rows, "k long, t long, x long, y long").join(tiles, "t")
    got = stitch.stitch_corners(d, tiles, ["k"], "t", ("x", "y"), ("sx", "sy"))
    assert sorted(tuple(r) for r in got.select("k", "t", "x", "y").collect()) == sorted(kept)


def test_nearest(spark):
    rng = random.Random(4)
    pts = [(k, rng.randrange(2048), rng.randrange(2048)) for k in range(300)]
    sites = [(k, rng.randrange(2048), rng.randrange(2048)) for k in range(40)]
    got = joins.nearest(spark.createDataFrame(pts, "p long, x long, y long"), spark.createDataFrame(sites, "s long, sx long, sy long"), ("x", "y"), ("sx", "sy"), "s")
    want = {p: min(((x - a) ** 2 + (y - b) ** 2, s) for s, a, b in sites) for p, x, y in pts}
    assert {r.p: (r.d2, r.s) for r in got.collect()} == want


def test_bucket_join(spark):
    rng = random.Random(5)
    a = [(k, rng.randrange(500), rng.randrange(500)) for k in range(200)]
    b = [(k, rng.randrange(500), rng.randrange(500)) for k in range(50)]
    got = joins.bucket_join(spark.createDataFrame(a, "p long, x long, y long"), spark.createDataFrame(b, "s long, cx long, cy long"), ("x", "y"), ("cx", "cy"), 70)
    assert {(r.p, r.s) for r in got.collect()} == {(p, s) for p, x, y in a for s, u, v in b if (x - u) ** 2 + (y - v) ** 2 <= 4900}


def test_registration_undoes_a_shift():
    a = np.random.default_rng(0).random((8, 8))
    for s in ((2, 0), (-3, 1), (0, 0), (3, -2)):
        assert kernels.register(np.roll(a, s, (0, 1)), a)[:2] == s


def test_integer_shift_fills_with_zero(spark):
    v = spark.createDataFrame([(0, y, x, 1) for y in range(4) for x in range(4)], "img long, y long, x long, v long")
    down = im.shift(v, ["img"], "v", F.lit(2), F.lit(0), 4, 4)
    assert {(r.y, r.v) for r in down.collect()} == {(0, 0), (1, 0), (2, 1), (3, 1)}


def test_kernels():
    m = np.zeros((7, 7), bool)
    m[1:6, 1:6] = True
    m[3, 3] = False
    assert kernels.fill_holes(m).sum() == 25
    a = np.zeros((5, 9))
    markers = np.zeros((5, 9), int)
    markers[2, 1], markers[2, 7] = 1, 2
    w = kernels.watershed(np.abs(np.arange(9) - 4.0) * -1 + a, markers, np.ones((5, 9), bool))
    assert set(np.unique(w)) == {0, 1, 2} and (w == 1).any(0)[0] and (w == 2).any(0)[8]
    assert kernels.hull(np.array([0, 2, 2, 0, 1]), np.array([0, 0, 2, 2, 1])) == [(0, 0), (2, 0), (2, 2), (0, 2)]
    assert (kernels.reconstruct(np.array([[0.0, 3, 0]]), np.array([[5.0, 5, 1]])) == [[3, 3, 1]]).all()
    assert np.abs(kernels.demons(np.eye(8), np.eye(8))).max() == 0


def test_regional_maxima_and_labels():
    """Against a flood from every voxel, plateaus at edges and beside higher voxels included."""
    rng = np.random.default_rng(3)
    steps = [s for s in np.ndindex(3, 3, 3) if s != (1, 1, 1)]
    for _ in range(40):
        a = rng.integers(0, 4, rng.integers(1, 5, 3))
        at = np.argwhere(np.ones_like(a))
        inside = lambda p: all(0 <= c < n for c, n in zip(p, a.shape))
        want, done = [], set()
        for p in map(tuple, at):
            if p in done:
                continue
            todo, region, higher = [p], {p}, False
            while todo:
                q = todo.pop()
                for s in steps:
                    r = tuple(int(c) + d - 1 for c, d in zip(q, s))
                    if inside(r):
                        higher |= a[r] > a[q]
                        if a[r] == a[q] and r not in region:
                            region.add(r)
                            todo.append(r)
            done |= region
            if not higher and a[p] > 1:
                want.append((*np.floor(np.mean(sorted(region), 0) + 0.5).astype(int).tolist(), len(region)))
        order = rng.permutation(len(at))
        got = kernels.regional_maxima(at[order], a.ravel()[order], np.full(len(at), 1.0))
        assert sorted(g[:4] for g in got) == sorted(want)
    far = np.array([[0, 0], [0, 1], [5, 5], [1, 2], [9, 0]])
    lab = kernels.labels(far)
    assert lab[0] == lab[1] == lab[3] and len({lab[0], lab[2], lab[4]}) == 3


def test_volumes_are_registered():
    a = np.random.default_rng(1).random((4, 6, 5))
    for s in ((1, -2, 2), (0, 0, 0), (-1, 2, -1)):
        assert kernels.register_volumes(np.roll(a, s, (0, 1, 2)), a) == s


def test_density_peaks_and_neighbours(spark):
    rng = random.Random(8)
    pts = [(1, k, rng.randrange(300), rng.randrange(300)) for k in range(200)]
    d = spark.createDataFrame(pts, "w long, id long, x long, y long")
    near = {i: sum((x - a) ** 2 + (y - b) ** 2 <= 900 for _, _, a, b in pts) - 1 for _, i, x, y in pts}
    assert {r.id: r.near for r in joins.neighbours(d, ["w"], "id", ("x", "y"), 30).collect()} == near
    up = {}
    for _, i, x, y in pts:
        denser = [((x - a) ** 2 + (y - b) ** 2, j) for _, j, a, b in pts if (near[j] > near[i] or near[j] == near[i] and j < i) and (x - a) ** 2 + (y - b) ** 2 <= 900]
        up[i] = min(denser)[1] if denser else i

    def peak(i):
        return i if up[i] == i else peak(up[i])

    assert {r.id: r.cell for r in cells.density_peaks(d, ["w"], "id", ("x", "y"), 30).collect()} == {i: peak(i) for i in up}


def test_nearest_vectors(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(0, 3, (300, 4)).astype(float)
    d = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id long, v array<double>").repartition(3)
    got = {(r.q, r.k): (r.d, r.b) for r in expression.nearest_vectors(d, d.where("id % 100 = 0"), "id", "v", 5, at_once=2).collect()}
    for q in (0, 100, 200):
        want = sorted((float(((v[q] - v[b]) ** 2).sum()), b) for b in range(300) if b != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == want


def test_numbered_and_overlapping_intervals(spark):
    d = spark.createDataFrame([(k * 7 % 50,) for k in range(50)], "v long")
    assert {r.v: r.i for r in joins.numbered(d, ["v"], "i").collect()} == {k: k for k in range(50)}
    r = spark.createDataFrame([("a", 1, 1, 5), ("b", 2, 4, 8), ("c", 3, 9, 2), ("d", 4, None, 3)], "s string, k long, lo long, hi long")
    p = spark.createDataFrame([(k,) for k in range(10)], "p long")
    of = lambda how: {x.p: x.s for x in joins.interval_join(p, r, "p", "lo", "hi", "left", how, "k").collect()}
    assert of("first") == {**dict.fromkeys((0, 9)), **dict.fromkeys(range(1, 6), "a"), **dict.fromkeys((6, 7, 8), "b")}
    assert of("last") == {**dict.fromkeys((0, 9)), **dict.fromkeys(range(1, 4), "a"), **dict.fromkeys(range(4, 9), "b")}
    assert joins.interval_join(p, r, "p", "lo", "hi").count() == 10


def test_rank_sum_equals_dense_ranks(spark):
    rng = random.Random(6)
    values = [(g, i, i < 12, max(rng.randrange(-3, 4), 0)) for g in "ab" for i in range(40)]
    rows = spark.createDataFrame([v for v in values if v[3]], "g string, i long, near boolean, n long")
    for r in expression.rank_sum(rows, "g", "n", "near", F.lit(12), F.lit(28)).collect():
        v = [(n, near) for g, _, near, n in values if g == r.g]
        u = sum((a > b) + (a == b) / 2 for a, x in v if x for b, y in v if not y)
        assert r.u == u and (r.n1, r.n2) == (12, 28)


def test_empty_tables_keep_their_schema(spark):
    e = spark.createDataFrame([], "img long, y long, x long, v long")
    assert im.local_maxima(e, ["img"], "v", 8, 8).columns == ["img", "y", "x", "v"]
    assert im.components(e, ["img"], 8).count() == 0
    assert im.otsu(e, ["img"], "v").count() == 0


def test_kernels_against_plain_versions():
    """Reconstruction, holes, watershed and hulls on random images."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        h, w = rng.integers(2, 9, 2)
        a = rng.integers(0, 6, (h, w)).astype(float)
        near = lambda p, four=False: [(p[0] + i, p[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0) and (not four or 0 in (i, j)) and 0 <= p[0] + i < h and 0 <= p[1] + j < w]  # noqa: B023, E731
        seed = np.minimum(rng.integers(0, 6, (h, w)), a)
        # a place reaches as high as the best path's lowest place, starting from any seed
        want = np.zeros((h, w))
        for start in np.ndindex(h, w):
            for level in range(int(seed[start]), 0, -1):
                todo, seen = [start], {start}
                while todo:
                    for q in near(todo.pop()):
                        if q not in seen and a[q] >= level:
                            seen.add(q)
                            todo.append(q)
                for q in seen:
                    want[q] = max(want[q], level)
        assert (kernels.reconstruct(seed, a) == want).all()
        mask = a > 2
        todo = [p for p in np.ndindex(h, w) if not mask[p] and (p[0] in (0, h - 1) or p[1] in (0, w - 1))]
        outside = set(todo)
        while todo:
            for q in near(todo.pop(), True):
                if q not in outside and not mask[q]:
                    outside.add(q)
                    todo.append(q)
        assert {tuple(p) for p in np.argwhere(~kernels.fill_holes(mask))} == outside
        markers = np.where(rng.random((h, w)) < 0.1, np.arange(h * w).reshape(h, w) + 1, 0)
        out = kernels.watershed(a, markers, mask | (markers > 0))
        assert (out[markers > 0] == markers[markers > 0]).all() and not out[~mask & (markers == 0)].any()
        for p in map(tuple, np.argwhere(out > 0)):  # every label hangs together with its marker, and no two touch
            todo, seen = [p], {p}
            while todo:
                for q in near(todo.pop(), True):
                    if q not in seen and out[q] == out[p]:
                        seen.add(q)
                        todo.append(q)
            assert any(markers[q] == out[p] for q in seen)
            assert all(out[q] in (0, out[p]) or markers[p] or markers[q] for q in near(p, True))
        x, y = rng.integers(0, 6, 12), rng.integers(0, 6, 12)
        corners = kernels.hull(x, y)
        pts = set(zip(x.tolist(), y.tolist()))
        cross = lambda o, b, c: (b[0] - o[0]) * (c[1] - o[1]) - (b[1] - o[1]) * (c[0] - o[0])
        edges = [(o, b) for o in pts for b in pts if o != b and all(cross(o, b, c) > 0 or cross(o, b, c) == 0 and (c[0] - o[0]) * (b[0] - o[0]) + (c[1] - o[1]) * (b[1] - o[1]) >= 0 and (c[0] - o[0]) ** 2 + (c[1] - o[1]) ** 2 <= (b[0] - o[0]) ** 2 + (b[1] - o[1]) ** 2 for c in pts)]
        assert set(corners) == {p for e in edges for p in e}


def test_images_keep_their_shape():
    """A channel without pixels at its edge is as large as the others."""
    import pandas as pd

    p = pd.DataFrame({"y": [0, 3], "x": [1, 2], "v": [5.0, 6.0]})
    assert kernels.grid(p, shape=(8, 8)).shape == (8, 8) and kernels.grid(p).shape == (4, 3)
    m = kernels.median(np.ones((8, 8)), 10)
    assert m[0, 0] == 0 and m[4, 4] == 1


def test_writers(spark, tmp_path):
    d = spark.createDataFrame([("P1", "round2", 3, -4, 0), ("P1", "round3", 1, 2, 0)], "fov_id string, round string, row long, col long, z long")
    sinks.write_shifts(d, f"{tmp_path}/shifts")
    assert spark.read.csv(f"{tmp_path}/shifts", header=True, inferSchema=True).count() == 2
    px = spark.createDataFrame([(1, "ch00", z, y, x, z + y * x) for z in range(2) for y in range(3) for x in range(4)], "fov long, channel string, z long, y long, x long, v long")
    sinks.write_stacks(px, ["fov", "channel"], f"{tmp_path}/stacks", "{fov}/{channel}.tif", 3, 4)
    pages = list(readers.tiff_pages((tmp_path / "stacks/1/ch00.tif").read_bytes()))
    assert len(pages) == 2 and pages[1].shape == (3, 4) and pages[1][2, 3] == 7
    positions = spark.createDataFrame([("s1", "Position1", 1.5, 2.5, 4), ("s1", "Position2", 3.5, 2.5, 4)], "sample_id string, name string, sx double, sy double, sections int")
    sinks.write_positions(positions, f"{tmp_path}/maf")
    back = readers.read_stage_xml(spark, f"{tmp_path}/maf/sample_id=s1")
    assert sorted((r.StageXPos, r.PositionID) for r in back.collect()) == [(1.5, "Position1"), (3.5, "Position2")]
    sinks.write_flags(spark, f"{tmp_path}/flags", ["stitch", "decode"])
    assert sinks.finished(spark, f"{tmp_path}/flags") == ["decode", "stitch"]


def test_nearest_by_places(spark):
    """Sites at few places, as points: no more rows meet than there are places; and so many sites that cells are cut."""
    rng = random.Random(14)
    many = [(k, k * 97 % 64, k * 53 % 64) for k in range(4000)]
    pts = [(k, rng.randrange(64), rng.randrange(64)) for k in range(500)]
    of = lambda rows, names: spark.createDataFrame(rows, names)
    got = joins.nearest(of(pts, "p long, x long, y long"), of(many, "s long, sx long, sy long"), ("x", "y"), ("sx", "sy"), "s", 32, 64)
    want = {p: min(((x - a) ** 2 + (y - b) ** 2, s) for s, a, b in many[:64]) for p, x, y in pts}
    assert {r.p: (r.d2, r.s) for r in got.collect()} == want
    sites = [(k, rng.randrange(256), rng.randrange(256)) for k in range(3000)]
    pts = [(k, rng.randrange(256), rng.randrange(256)) for k in range(500)]
    got = joins.nearest(of(pts, "p long, x long, y long"), of(sites, "s long, sx long, sy long"), ("x", "y"), ("sx", "sy"), "s", 64, 256)
    want = {p: min(((x - a) ** 2 + (y - b) ** 2, s) for s, a, b in sites) for p, x, y in pts}
    assert {r.p: (r.d2, r.s) for r in got.collect()} == want


def test_rank_sum_of_large_groups(spark):
    d = spark.createDataFrame([("a", 1, True), ("a", 2, False)], "gene string, n long, near boolean")
    r = expression.rank_sum(d, "gene", "n", "near", F.lit(900_000), F.lit(2_700_000)).first()
    assert (r["n1"], r["n2"]) == (900_000, 2_700_000) and abs(r["u"] - 900_000 * 2_700_000 / 2) < 4e6


def test_chi_square_of_large_tables(spark):
    a, b, c, d = 400_000, 500_000, 1_500_000, 1_200_000
    r = spark.createDataFrame([(a, b, c, d)], "a long, b long, c long, d long").select(spatial.chi_square_yates(*(F.col(k) for k in "abcd"))).first()[0]
    want = (a + b + c + d) * (abs(a * d - b * c) - (a + b + c + d) / 2) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d))
    assert abs(r / want - 1) < 1e-12


def test_positions_of_more_than_four_digits(spark):
    assert [r[0] for r in spark.createDataFrame([(7,), (12345,)], "k long").select(fixtures.position(F.col("k"))).collect()] == ["Position0007", "Position1234"]


def test_numbered_over_several_ranges(spark):
    """More rows than the ranges' sample: parts made anew would have other bounds."""
    d = spark.range(300_000).select((F.col("id") * 7919 % 300_007).alias("v"))
    n = joins.numbered(d, ["v"], "i")
    assert n.agg(F.min("i"), F.max("i"), F.count_distinct("i")).first()[:] == (0, 299_999, 300_000)
    up = n.groupBy((F.col("i") / 1000).cast("long").alias("g")).agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("g").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(up, up[1:]))


def test_counts_around_by_places(spark):
    rng = random.Random(6)
    a = [(k % 3, rng.randrange(30) * 10, rng.randrange(30) * 10) for k in range(600)]
    b = [(k, rng.randrange(30) * 10, rng.randrange(30) * 10) for k in range(60)]
    got = joins.counts_around(spark.createDataFrame(a, "kind long, x long, y long"), spark.createDataFrame(b, "s long, cx long, cy long"), ("x", "y"), ("cx", "cy"), 70, "kind", "n")
    want = {(s, k): sum(t == k and (x - u) ** 2 + (y - v) ** 2 <= 4900 for t, x, y in a) for s, u, v in b for k in range(3)}
    assert {(r.s, r.kind): r.n for r in got.collect()} == {k: n for k, n in want.items() if n}


def test_hulls_of_many_cells(spark):
    """Hulls of rows of cells equal each cell's own; a column of points is cut to its ends before."""
    rng = np.random.default_rng(0)
    points = [(int(c), int(x), int(y)) for c, x, y in zip(rng.integers(0, 60, 900), rng.integers(0, 40, 900), rng.integers(0, 40, 900))]
    points += [(100, 7, y) for y in range(50)] + [(101, x, 3) for x in range(9)] + [(102, 5, 5), (102, 5, 5)] + [(103, x, 9 - x) for x in range(9)]
    got = {}
    for r in spatial.hulls(spark.createDataFrame(points, "cell long, x long, y long"), "cell", "x", "y").orderBy("cell", "corner").collect():
        got.setdefault(r.cell, []).append((r.x, r.y))
        assert r.corner == len(got[r.cell]) - 1
    want = {c: kernels.hull(*(np.array([p[k] for p in points if p[0] == c]) for k in (1, 2))) for c in {p[0] for p in points}}
    assert got == want and got[100] == [(7, 0), (7, 49)]


def test_components_read_reads_once(spark):
    """The table of cells and genes behind the components is made once, and its scaled logarithms equal those of the long table."""
    from tessera.plans import expression as plan
    from tests.conftest import SF

    files = plan.pca(spark, SF).inputFiles()
    assert files and not any("lineitem" in f for f in files)
    panel = sorted(r[0] for r in fixtures.codebook(spark, SF).select("gene").collect())
    wide = expression.counts_by_cell(fixtures.reads(spark, SF).where("seg_label > 0"), "seg_label", "gene", panel)
    got = {r.seg_label: r[1:] for r in expression.scaled_counts(wide, "seg_label", len(panel), 10000.0).collect()}
    want = {(r.seg_label, r.gene): r.z or 0.0 for r in plan.scaled(spark, SF).collect()}
    assert len(want) == len(got) * len(panel)
    assert all(abs(z - want[cell, g]) < 1e-9 for cell, row in got.items() for g, z in zip(panel, row))


def test_nearest_of_all(spark):
    """Every row as a query: equal to all pairs compared, with copies, ties and blocks smaller than the rows; and no row passes through the driver."""
    rng = np.random.default_rng(1)
    v = np.r_[rng.integers(0, 4, (150, 3)).astype(float), rng.random((60, 3)), np.ones((40, 3))]
    names = rng.permutation(1000)[: len(v)]
    rows = spark.createDataFrame([(int(n), [float(c) for c in a]) for n, a in zip(names, v)] + [(5000, None)], "id long, v array<double>")
    got = {}
    for r in expression.nearest_of_all(rows, "id", "v", 6, 30, 64).orderBy("q", "k").collect():
        got.setdefault(r.q, []).append((r.d, r.b))
        assert r.k == len(got[r.q])
    want = {int(n): sorted((float(round(((a - b) ** 2).sum(), 6)), int(m)) for m, b in zip(names, v) if m != n)[:6] for n, a in zip(names, v)}
    assert got == want
