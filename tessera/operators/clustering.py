"""Cells from reads alone: density peaks over whole fields, found in windows and joined across their edges.

A read follows the nearest denser read within the radii; a read without one is a peak and gives its cell the name. Both need no more than
two radii around a read, so windows with that margin see the same as the whole field. In a window every read is led to its peak or to the
first read beyond the window's edge; the few reads that others are led to there are then followed from window to window by joins that double
the way with each round. The result doesn't depend on the windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import density, joins
from tessera.operators.checkpoints import checkpointed

PAIRS = 1 << 22  # pairs that a task looks at at once
FEW = 4_000  # reads whose pairs are looked at one by one


@dataclass(frozen=True)
class Clustering:
    """xy_radius and z_radius of a read's neighbourhood (an ellipsoid), the share of each field's reads with the fewest neighbours in the plane that
    counts as noise, the fewest reads of a cell, and the width of the windows."""

    xy_radius: int = 50
    z_radius: int = 10
    noise_share: float = 0.1
    min_reads: int = 5
    window: int = 512


def _pairs(x: np.ndarray, y: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (rows a to b, pairs' first rows, second rows): all pairs in neighbouring squares as wide as the radius, for reads sorted by
    squares (rows of squares, then columns)."""
    cx, cy = (x - x.min()) // radius + 1, (y - y.min()) // radius + 1
    wide = int(cx.max()) + 2
    code = cy * wide + cx
    low = np.stack([np.searchsorted(code, code + d * wide - 1, "left") for d in (-1, 0, 1)])
    high = np.stack([np.searchsorted(code, code + d * wide + 1, "right") for d in (-1, 0, 1)])
    total = np.r_[0, np.cumsum((high - low).sum(0))]
    a, n = 0, len(x)
    while a < n:
        b = max(a + 1, int(np.searchsorted(total, total[a] + PAIRS, "right")) - 1)
        many = (high - low)[:, a:b].T.ravel()
        first = np.repeat(np.repeat(np.arange(a, b), 3), many)
        begin = np.cumsum(many) - many
        second = np.arange(len(first)) - np.repeat(begin - low[:, a:b].T.ravel(), many)
        yield np.array([a, b]), first, second
        a = b


def order(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    """Rows sorted by squares."""
    return np.lexsort(((x - x.min()) // radius, (y - y.min()) // radius))


def followed(x: np.ndarray, y: np.ndarray, z: np.ndarray, name: np.ndarray, xy_radius: int, z_radius: int) -> np.ndarray:
    """For each read the row of the one it follows, its own for a peak. A read is denser than another if more reads lie within the radii of
    it, or as many and its name is smaller; of equally near ones the smaller name is followed."""
    back = order(x, y, xy_radius)
    x, y, z, name = x[back], y[back], z[back], name[back]
    n, most = len(x), (xy_radius * z_radius) ** 2
    far = lambda i, j: z_radius**2 * ((x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2) + xy_radius**2 * (z[i] - z[j]) ** 2
    rho, up = np.zeros(n, np.int64), np.arange(n)
    for (a, b), i, j in _pairs(x, y, xy_radius):
        rho[a:b] = np.bincount(i[far(i, j) <= most] - a, minlength=b - a)
    for _, i, j in _pairs(x, y, xy_radius):
        d = far(i, j)
        able = (d <= most) & ((rho[j] > rho[i]) | ((rho[j] == rho[i]) & (name[j] < name[i])))
        i, j = i[able], j[able]
        for by in ("distance", "name"):  # the nearest, of these the smallest name; pairs come by their first row
            if not len(i):
                break
            value = d[able] if by == "distance" else name[j]
            new = np.r_[True, i[1:] != i[:-1]]
            best = np.minimum.reduceat(value, np.flatnonzero(new))[np.cumsum(new) - 1] == value
            i, j = i[best], j[best]
        up[i] = j
    out = np.empty(n, np.int64)
    out[back] = back[up]
    return out


def peaks(reads: DataFrame, keys: list[str], name: str, how: Clustering = Clustering(), carry: tuple[str, ...] = ()) -> DataFrame:
    """keys, name, `carry` (of x, y and z) and cell (the name of the read's peak) of reads (keys, name, x, y, z: integers; names differ within the
    keys)."""
    margin, window = 2 * how.xy_radius, how.window
    schema = reads.select(*keys, name, *carry).schema.add("to", reads.schema[name].dataType).add("done", "boolean")
    sent = reads.select(*keys, name, "x", "y", "z")
    for axis, w in (("x", "__wx"), ("y", "__wy")):
        sent = sent.withColumn(w, F.explode(F.sequence(F.floor((F.col(axis) - margin) / window), F.floor((F.col(axis) + margin) / window))))

    def run(t: pa.Table) -> pa.Table:
        x, y, z, names = (t.column(c).to_numpy() for c in ("x", "y", "z", name))
        core = (x // window == t.column("__wx")[0].as_py()) & (y // window == t.column("__wy")[0].as_py())
        if not core.any():
            return t.select([*keys, name, *carry, name, name]).rename_columns(schema.names).slice(0, 0).set_column(len(schema.names) - 1, "done", pa.array([], pa.bool_()))
        if len(x) > FEW and density.fits(x, y, z, how.xy_radius):
            to = density.followed(x, y, z, names, how.xy_radius, how.z_radius, core)
        else:
            to = np.where(core, followed(x, y, z, names, how.xy_radius, how.z_radius), np.arange(len(x)))
        while (to[to] != to).any():
            to = to[to]
        rows = np.flatnonzero(core)
        at = pa.array(rows)
        return pa.table([*(t.column(c).take(at) for c in (*keys, name, *carry)), pa.array(names[to[rows]]), pa.array(core[to[rows]])], schema.names)

    led = checkpointed(sent.groupBy(*keys, "__wx", "__wy").applyInArrow(run, schema))
    place = [*keys, name]
    doors = led.where("not done").select(*keys, F.col("to").alias(name)).distinct()
    doors = checkpointed(led.select(*place, "to", "done").join(doors, place, "left_semi"))  # reads that others of another window are led to
    while not doors.where("not done").isEmpty():
        onward = doors.select(*keys, F.col(name).alias("to"), F.col("to").alias("__to"), F.col("done").alias("__done"))
        step = doors.join(onward, [*keys, "to"], "left")
        gone = ~F.col("done") & F.col("__to").isNotNull()
        step = step.select(*place, F.when(gone, F.col("__to")).otherwise(F.col("to")).alias("to"), F.when(gone, F.col("__done")).otherwise(F.col("done")).alias("done"))
        doors = checkpointed(step, doors)
    ends = doors.select(*keys, F.col(name).alias("to"), F.col("to").alias("__to"))
    out = led.join(ends, [*keys, "to"], "left")
    return out.select(*place, *carry, F.when(F.col("done"), F.col("to")).otherwise(F.col("__to")).alias("cell"))


def cells(reads: DataFrame, keys: list[str], name: str, how: Clustering = Clustering(), carry: tuple[str, ...] = ()) -> DataFrame:
    """keys, name, `carry` (of x, y and z), is_noise and cell of every read: reads with fewer neighbours in the plane than a share of their field's are
    noise and take no part; noise, and reads of cells with fewer than `min_reads`, have the cell -1.

    Reads are counted and led to their peaks once, each with its place, so they are made and dealt once for either and never joined to themselves."""
    near = checkpointed(joins.neighbours(reads, keys, name, ("x", "y"), how.xy_radius, ("x", "y", "z")))
    least = checkpointed(near.groupBy(*keys).agg(F.percentile("near", how.noise_share).alias("__q")))
    flagged = near.join(least, keys).withColumn("is_noise", F.col("near") < F.col("__q"))
    found = checkpointed(peaks(flagged.where("not is_noise"), keys, name, how, carry))
    size = found.groupBy(*keys, "cell").agg(F.count("*").alias("__n"))
    cell = F.when(F.col("__n") >= how.min_reads, F.col("cell")).otherwise(-1).alias("cell")
    found = found.join(size, [*keys, "cell"]).select(*keys, name, *carry, F.lit(False).alias("is_noise"), cell)
    return found.unionByName(flagged.where("is_noise").select(*keys, name, *carry, "is_noise", F.lit(-1).alias("cell")))


def centers(reads: DataFrame, found: DataFrame, keys: list[str], name: str) -> DataFrame:
    """keys, cell, reads and the mean column, row and plane of each cell; found may carry its reads' places itself."""
    placed = found.where("cell <> -1")
    if not {"x", "y", "z"} <= set(found.columns):
        placed = reads.select(*keys, name, "x", "y", "z").join(placed, [*keys, name])
    return placed.groupBy(*keys, "cell").agg(F.count("*").alias("reads"), F.avg("x").alias("column"), F.avg("y").alias("row"), F.avg("z").alias("z_axis"))
