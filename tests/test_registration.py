"""Fields of displacements against a known warp, and their application."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import registration as reg
from tessera.operators import tiles


def blobs(shape, n, rng):
    at = np.indices(shape).astype(float)
    out = np.zeros(shape)
    for _ in range(n):
        c = [rng.uniform(0, s) for s in shape]
        width = [1.5 if s < 10 else 4.0 for s in shape]
        out += np.exp(-sum(((at[k] - c[k]) / width[k]) ** 2 for k in range(len(shape))))
    return out


def known(shape):
    """A smooth field of up to three pixels."""
    at = np.indices(shape).astype(float)
    y, x = at[-2] / shape[-2], at[-1] / shape[-1]
    field = np.zeros((len(shape), *shape))
    field[-2], field[-1] = 3 * np.sin(2 * np.pi * x), 2 * np.cos(2 * np.pi * y)
    return field


def voxels(a, **names):
    z, y, x = np.indices(a.shape)
    return [(*names.values(), *map(int, p), float(v)) for *p, v in zip(z.ravel(), y.ravel(), x.ravel(), a.ravel())]


SCHEMA = "fov long, round long, channel long, z long, y long, x long, v double"


@pytest.mark.parametrize("shape", [(1, 64, 64), (6, 48, 56)])
def test_a_known_warp_is_undone(spark, shape):
    rng = np.random.default_rng(1)
    moving, true = blobs(shape, 60, rng), known(shape)
    fixed = reg.sample(moving, np.indices(shape) + true)
    other = blobs(shape, 60, rng)  # a second channel that takes part in nothing but the warp
    rows = voxels(fixed, fov=1, round=1, channel=0) + voxels(moving, fov=1, round=2, channel=0) + voxels(other, fov=1, round=2, channel=1)
    images = spark.createDataFrame(rows, SCHEMA)
    field = reg.local_field(images, 1, *shape[1:], channel=0, levels=3, rounds=60)
    got = field.toPandas()
    assert len(got) == fixed.size and set(got["round"]) == {2}
    found = np.zeros_like(true)
    for k, c in enumerate(reg.AXES):
        found[k][got.z, got.y, got.x] = got[c]
    inner = (slice(None), slice(8, -8), slice(8, -8))
    clear = np.abs(np.gradient(fixed, axis=(1, 2))).max(0)[inner] > 0.05  # where there is something to see
    error = np.abs(found - true)[(slice(None), *inner)][1:, clear]
    assert np.median(error) < 0.25 and np.median(np.abs(true[(slice(None), *inner)][1:, clear])) > 1
    back = reg.warp(images, field, *shape[1:])
    assert back.count() == len(rows)
    first = images.where("round = 1")
    before = reg.gap(images.where("round = 2 and channel = 0").drop("round"), first.drop("round"), ["fov", "channel"]).first()["gap"]
    after = reg.gap(back.where("round = 2 and channel = 0").drop("round"), first.drop("round"), ["fov", "channel"]).first()["gap"]
    assert after < 0.2 * before
    second = back.where("channel = 1").toPandas()
    image = np.zeros(shape)
    image[second.z, second.y, second.x] = second.v
    assert np.allclose(image, reg.sample(other, np.indices(shape) + found, 0.0))
    same = back.where("round = 1").join(first.withColumnRenamed("v", "was"), ["fov", "round", "channel", "z", "y", "x"]).where(F.abs(F.col("v") - F.col("was")) > 1e-12)
    assert same.isEmpty()


def test_windows_change_little(spark):
    rng = np.random.default_rng(2)
    shape = (1, 96, 80)
    moving = blobs(shape, 90, rng)
    fixed = reg.sample(moving, np.indices(shape) + known(shape))
    images = spark.createDataFrame(voxels(fixed, fov=1, round=1, channel=0) + voxels(moving, fov=1, round=2, channel=0), SCHEMA)
    place = ["z", "y", "x"]
    whole = reg.local_field(images, 1, 96, 80, levels=2, rounds=20, tile=256).toPandas().sort_values(place)
    parts = reg.local_field(images, 1, 96, 80, levels=2, rounds=20, tile=32, margin=32).toPandas().sort_values(place)
    assert (whole[place].to_numpy() == parts[place].to_numpy()).all()
    assert np.abs(whole.dy.to_numpy() - parts.dy.to_numpy()).mean() < 0.02 and np.abs(whole.dx.to_numpy() - parts.dx.to_numpy()).mean() < 0.02
    field = spark.createDataFrame(whole)
    one = reg.warp(images, field, 96, 80, tile=256).toPandas().sort_values(["round", *place])
    many = reg.warp(images, field, 96, 80, tile=16).toPandas().sort_values(["round", *place])
    assert np.allclose(one.v, many.v)


@pytest.mark.parametrize("tile", [5, 16, 64])
def test_gaussian_by_tiles(spark, tile):
    rng = np.random.default_rng(3)
    a = rng.random((2, 40, 33))
    px = spark.createDataFrame([(k, y, x, float(a[k, y, x])) for k in range(2) for y in range(40) for x in range(33)], "img long, y long, x long, v double")
    got = tiles.gaussian(px, ["img"], "v", 1.3, 40, 33, tile).toPandas()
    out = np.zeros_like(a)
    out[got.img, got.y, got.x] = got.blurred
    reach = int(4 * 1.3 + 0.5)
    w = np.exp(-0.5 * (np.arange(-reach, reach + 1) / 1.3) ** 2)
    w /= w.sum()
    p = np.pad(a, ((0, 0), (reach, reach), (reach, reach)), mode="edge")
    want = sum(w[i] * w[j] * p[:, i : i + 40, j : j + 33] for i in range(len(w)) for j in range(len(w)))
    assert np.allclose(out, want)


def test_no_reference(spark):
    images = spark.createDataFrame(voxels(np.ones((1, 8, 8)), fov=1, round=2, channel=0), SCHEMA)
    field = reg.local_field(images, 1, 8, 8)
    assert field.count() == 0 and reg.warp(images, field, 8, 8).where("v = 1").count() == 64
