"""Non-rigid registration: fields of displacements found by demons from coarse to fine, and their application to images."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import tiles

AXES = ("dz", "dy", "dx")


def sample(a: np.ndarray, at: np.ndarray, fill: float | None = None) -> np.ndarray:
    """Values of an array at places (axes, ...) between its cells, by linear interpolation; more than half a cell beyond the edges
    `fill`, or the nearest edge's value without it."""
    size = np.array(a.shape).reshape(-1, *[1] * (at.ndim - 1))
    place = np.clip(at, 0, size - 1)
    low = np.minimum(np.floor(place).astype(np.int64), np.maximum(size - 2, 0))
    part = place - low
    out = np.zeros(at.shape[1:])
    for corner in itertools.product(*[(0, 1) if n > 1 else (0,) for n in a.shape]):
        weight = np.ones(at.shape[1:])
        for k, c in enumerate(corner):
            weight = weight * (part[k] if c else 1 - part[k])
        out += weight * a[tuple(low[k] + c for k, c in enumerate(corner))]
    if fill is not None:
        out[((at < -0.5) | (at > size - 0.5)).any(0)] = fill
    return out


def halved(a: np.ndarray) -> np.ndarray:
    """Means of blocks of two along each axis of four cells or more."""
    for axis, n in enumerate(a.shape):
        if n >= 4:
            if n % 2:
                a = np.concatenate([a, np.take(a, [-1], axis)], axis)
            a = (a[(slice(None),) * axis + (slice(0, None, 2),)] + a[(slice(None),) * axis + (slice(1, None, 2),)]) / 2
    return a


def doubled(field: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """A field of a halved array brought to its shape, the displacements grown alike."""
    at = np.stack([(i - 0.5) / 2 if n >= 4 else i for i, n in zip(np.indices(shape).astype(float), shape)])
    return np.stack([sample(c, at) * (2 if n >= 4 else 1) for c, n in zip(field, shape)])


def demons(fixed: np.ndarray, moving: np.ndarray, levels: int, rounds: int = 10, smoothing: float = 1.0) -> np.ndarray:
    """The field (axes, ...) with moving(place + field) close to fixed: on each level from the coarsest, `rounds` steps along fixed's gradient
    by what differs, the whole field smoothed by a Gaussian after each. Axes of less than four cells aren't halved."""
    if levels > 1 and max(fixed.shape) >= 4:
        field = doubled(demons(halved(fixed), halved(moving), levels - 1, rounds, smoothing), fixed.shape)
    else:
        field = np.zeros((fixed.ndim, *fixed.shape))
    long = [k for k, n in enumerate(fixed.shape) if n > 1]
    slope = np.zeros_like(field)
    for k in long:
        slope[k] = np.gradient(fixed, axis=k)
    steep = (slope**2).sum(0)
    here = np.indices(fixed.shape).astype(float)
    for _ in range(rounds):
        gap = fixed - sample(moving, here + field)
        size = steep + gap * gap
        field = field + np.where(size > 1e-12, gap / np.maximum(size, 1e-12), 0) * slope
        field = np.stack([tiles.blur(c, smoothing, tuple(long)) for c in field])
    return field


def local_field(
    images: DataFrame, ref_round: int, height: int, width: int, channel: int | None = None, levels: int | None = None, rounds: int = 10,
    smoothing: float = 1.0, tile: int = tiles.TILE, margin: int = 64,
) -> DataFrame:
    """fov, round, z, y, x, dz, dy, dx for every voxel of every other round than the reference: where in its own round (voxel plus displacement) what
    lies there in the reference round is found. images: fov, round, channel, z, y, x, v.

    One channel is compared, or the channels' largest values. By default there are as many levels as the depth can be halved, one at least.
    Fields are found in windows with a margin, which bounds a task's memory and how far a displacement is seen; voxels that either round lacks
    have no row."""
    v = images if channel is None else images.where(F.col("channel") == channel)
    v = v.groupBy("fov", "round", "z", "y", "x").agg(F.max("v").cast("double").alias("moving"))
    fixed = v.where(F.col("round") == ref_round).select("fov", "z", "y", "x", F.col("moving").alias("fixed"))
    both = v.where(F.col("round") != ref_round).join(fixed, ["fov", "z", "y", "x"])

    def run(a: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        n = levels or max(1, a["fixed"].shape[0].bit_length() - 1)
        top = max(a["fixed"].max(), a["moving"].max(), 1e-12)
        return dict(zip(AXES, demons(a["fixed"] / top, a["moving"] / top, n, rounds, smoothing)))

    return tiles.over_tiles(both, ["fov", "round"], ["fixed", "moving"], dict.fromkeys(AXES, "double"), height, width, margin, run, tile)


def warp(images: DataFrame, field: DataFrame, height: int, width: int, tile: int = tiles.TILE) -> DataFrame:
    """images (fov, round, channel, z, y, x, v) with the values that the field (fov, round, z, y, x, dz, dy, dx) points to in the same round and
    channel, between voxels by linear interpolation, 0 more than half a voxel beyond the edges, as doubles. Voxels without a displacement, the reference round's,
    stay. The windows' margin is the largest displacement, one number."""
    keys = ["fov", "round", "channel"]
    far = field.agg(F.max(F.greatest(F.abs("dy"), F.abs("dx")))).first()[0] or 0.0
    moved = images.join(field, ["fov", "round", "z", "y", "x"], "left").select(*keys, "z", "y", "x", "v", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in AXES])

    def run(a: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        shift = np.stack([a[c] for c in AXES])
        return {"v": sample(a["v"], np.indices(a["v"].shape) + shift, 0.0)}

    return tiles.over_tiles(moved, keys, ["v", *AXES], {"v": "double"}, height, width, int(np.ceil(far)) + 1, run, tile)


def gap(a: DataFrame, b: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """The mean absolute difference of two tables of voxels for each of the keys."""
    place = [*keys, "z", "y", "x"]
    both = a.select(*place, F.col(value).alias("__a")).join(b.select(*place, F.col(value).alias("__b")), place)
    return both.groupBy(*keys).agg(F.avg(F.abs(F.col("__a") - F.col("__b"))).alias("gap"))
