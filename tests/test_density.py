import numpy as np
import pytest

from tessera.operators import clustering, density


@pytest.mark.parametrize("wide, deep, radius, z_radius", [(60, 3, 20, 10), (200, 7, 50, 10), (40, 5, 7, 2), (90, 1, 9, 1)])
def test_rasters_give_what_pairs_give(wide, deep, radius, z_radius):
    rng = np.random.default_rng(wide)
    x, y, z, name = rng.integers(-5, wide, 2500), rng.integers(0, wide, 2500), rng.integers(1, deep + 1, 2500), rng.permutation(2500)
    every, core = np.ones(2500, bool), (x > wide // 4) & (x < wide // 2)
    want = clustering.followed(x, y, z, name, radius, z_radius)
    assert (density.followed(x, y, z, name, radius, z_radius, every) == want).all()
    assert (density.followed(x, y, z, name, radius, z_radius, core)[core] == want[core]).all()
    near = ((x[:, None] - x) ** 2 + (y[:, None] - y) ** 2 <= radius * radius).sum(1)
    assert (density.neighbours(x, y, every, radius) == near).all()


def test_a_dense_window_makes_no_pairs():
    """90,000 reads in a window of 300: a tenth of all their pairs would be 8e8."""
    rng = np.random.default_rng(1)
    x, y, n = rng.integers(0, 300, 90_000), rng.integers(0, 300, 90_000), np.arange(90_000)
    up = density.followed(x, y, n * 0, n, 50, 1, n >= 0)
    assert (up != n).mean() > 0.99
