"""Kernels on tiles of images of any size: pixel tables cut into windows with a margin, one group a window."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 256


def over_tiles(
    v: DataFrame, keys: list[str], values: list[str], out: dict[str, str], height: int, width: int, margin: int,
    kernel: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], tile: int = TILE,
) -> DataFrame:
    """keys, (z,) y, x and the columns `out` (name: type) for every pixel of v (keys, z if volumes, y, x, values).

    The kernel gets each value's array (z, y, x), as doubles with zeros where there is no pixel, over a window of `tile` by `tile` pixels and
    `margin` more on each side inside the image, and gives an array of the same shape for each name of `out`. What it says of the margin is
    left out, so a kernel that looks no farther than the margin gives the same as on the whole image. A pixel is sent to four windows at
    most as long as the margin is under half a tile; a task holds a window's planes."""
    flat = "z" not in v.columns
    axes = ["y", "x"] if flat else ["z", "y", "x"]
    px = v.select(*keys, *axes, *[F.col(c).cast("double").alias(c) for c in values])
    for axis, name, size in (("y", "__ty", height), ("x", "__tx", width)):
        px = px.where(F.col(axis).between(0, size - 1))
        low = F.expr(f"greatest({axis} - {margin}, 0) div {tile}")
        high = F.expr(f"least({axis} + {margin}, {size - 1}) div {tile}")
        px = px.withColumn(name, F.explode(F.sequence(low, high)))
    schema = v.select(*keys, *axes).schema
    for name, kind in out.items():
        schema = schema.add(name, kind)
    kinds = {f.name: f.dataType for f in schema.fields}

    def run(t: pa.Table) -> pa.Table:
        ty, tx = (t.column(c)[0].as_py() for c in ("__ty", "__tx"))
        y0, x0 = max(ty * tile - margin, 0), max(tx * tile - margin, 0)
        y1, x1 = min((ty + 1) * tile + margin, height), min((tx + 1) * tile + margin, width)
        y, x = t.column("y").to_numpy() - y0, t.column("x").to_numpy() - x0
        z = np.zeros(len(y), np.int64) if flat else t.column("z").to_numpy()
        arrays = {}
        for c in values:
            arrays[c] = np.zeros((int(z.max()) + 1, y1 - y0, x1 - x0))
            arrays[c][z, y, x] = t.column(c).to_numpy()
        made = kernel(arrays)
        core = np.flatnonzero((y + y0) // tile == ty)
        core = core[(x[core] + x0) // tile == tx]
        rows = pa.array(core)
        own = [t.column(c).take(rows) for c in (*keys, *axes)]
        new = []
        for name in out:
            a = made[name][z[core], y[core], x[core]]
            new.append(pa.array(np.rint(a).astype(np.int64) if kinds[name].typeName() in ("long", "integer") else a))
        return pa.table([*own, *new], schema.names)

    return px.groupBy(*keys, "__ty", "__tx").applyInArrow(run, schema)


def blur(a: np.ndarray, sigma: float, axes: tuple[int, ...] = (1, 2)) -> np.ndarray:
    """A Gaussian filter along some axes, cut off at four standard deviations, with the border repeated beyond the edges."""
    reach = int(4 * sigma + 0.5)
    weight = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight /= weight.sum()
    for axis in axes:
        if a.shape[axis] == 1:
            continue
        pad = [(0, 0)] * a.ndim
        pad[axis] = (reach, reach)
        p, n = np.pad(a, pad, mode="edge"), a.shape[axis]
        a = sum(w * p[(slice(None),) * axis + (slice(k, k + n),)] for k, w in enumerate(weight))
    return a


def gaussian(v: DataFrame, keys: list[str], value: str, sigma: float, height: int, width: int, tile: int = TILE) -> DataFrame:
    """v's pixels with their Gaussian blur in y and x (`blurred`, a double); an image lacks no pixel."""
    run = lambda a: {"blurred": blur(a[value], sigma)}
    return over_tiles(v, keys, [value], {"blurred": "double"}, height, width, int(4 * sigma + 0.5), run, tile)
