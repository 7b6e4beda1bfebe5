"""Registration in strips against the transform of the whole volume."""

import numpy as np
import pytest

from tessera.operators import fourier, kernels
from tessera.plans.dataset import Dataset


def rows(fixed, moving, key):
    z, y, x = np.indices(fixed.shape)
    return [(key, *map(int, p), float(a), float(b)) for *p, a, b in zip(z.ravel(), y.ravel(), x.ravel(), fixed.ravel(), moving.ravel())]


@pytest.mark.parametrize("shape, strip", [((1, 16, 16), 5), ((3, 12, 17), 4), ((4, 9, 8), 64), ((2, 30, 7), 1), ((1, 1, 20), 3)])
def test_equal_shifts(spark, shape, strip):
    rng = np.random.default_rng(0)
    pairs = {}
    for key in range(3):
        a = rng.integers(0, 100, shape)
        s = tuple(int(rng.integers(-(n // 2), n // 2 + 1)) for n in shape)
        pairs[key] = a, np.roll(a, s, (0, 1, 2)) if key < 2 else rng.integers(0, 100, shape)
    v = spark.createDataFrame([r for key, (a, b) in pairs.items() for r in rows(a, b, key)], "k long, z long, y long, x long, a double, b double")
    got = {r.k: (r.dz, r.dy, r.dx) for r in fourier.shifts(v, ["k"], "a", "b", shape, strip).collect()}
    assert got == {key: kernels.register_volumes(a, b) for key, (a, b) in pairs.items()}


def test_the_facade_in_strips(spark):
    rng = np.random.default_rng(1)
    images = []
    for fov in (1, 2):
        a = rng.integers(0, 200, (2, 20, 24))
        for r in range(3):
            b = np.roll(a, (r % 2, -2 * r, r), (0, 1, 2))
            for c in range(2):
                z, y, x = np.indices(b.shape)
                images += [(fov, r, c, int(i), int(j), int(k), int(b[i, j, k]) // (c + 1)) for i, j, k in zip(z.ravel(), y.ravel(), x.ravel())]
    d = Dataset(spark.createDataFrame(images, "fov long, round long, channel long, z long, y long, x long, v long"), 20, 24)
    key = lambda t: sorted(map(tuple, t.select("fov", "round", "dz", "dy", "dx").collect()))
    assert key(d.shifts(0)) == key(d.shifts(0, strip=7)) and key(d.shifts(0, channel=1, scale=2)) == key(d.shifts(0, channel=1, scale=2, strip=3))


def test_a_larger_image_in_thin_strips(spark):
    """600 by 500 pixels, of which a task holds 16 rows or columns: 0.3 MB of the 4.8 MB that a complex volume takes."""
    rng = np.random.default_rng(2)
    a = rng.integers(0, 255, (1, 600, 500))
    b = np.roll(a, (0, 41, -33), (0, 1, 2))
    v = spark.createDataFrame(rows(a, b, 0), "k long, z long, y long, x long, a double, b double").repartition(4)
    (r,) = fourier.shifts(v, ["k"], "a", "b", (1, 600, 500), 16).collect()
    assert (r.dz, r.dy, r.dx) == (0, -41, 33)
