"""Image operators over pixel tables: a row for each pixel with image keys, y, x and a value.

Neighbourhoods are made by sending each pixel to its neighbours' places (a row for each offset) and grouping there, which
needs one shuffle and no join of ranges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import kernels


def stretch(v: DataFrame, keys: list[str], value: str, low: Column, high: Column, out_low: float = 0, out_high: float = 255, gamma: float = 1.0) -> Column:
    """A value between two bounds moved to an output range; beyond the bounds it takes the range's ends."""
    span = F.when(high > low, high - low).otherwise(F.lit(1)).cast("double")
    share = F.least(F.greatest((F.col(value) - low) / span, F.lit(0.0)), F.lit(1.0))
    if gamma != 1.0:
        share = F.pow(share, F.lit(gamma))
    return share * (out_high - out_low) + out_low


def disk(radius: int) -> list[tuple[int, int]]:
    r = range(-radius, radius + 1)
    return [(a, b) for a in r for b in r if a * a + b * b <= radius * radius]


def box(radius: int) -> list[tuple[int, int]]:
    r = range(-radius, radius + 1)
    return [(a, b) for a in r for b in r]


def cross() -> list[tuple[int, int]]:
    return [(0, 0), (-1, 0), (1, 0), (0, -1), (0, 1)]


def spread(v: DataFrame, keys: list[str], values: list[str], offsets: list[tuple[int, int]], height: int, width: int) -> DataFrame:
    """Each pixel at the places of all pixels that have it as a neighbour, with dy and dx of the neighbour seen from there."""
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in offsets]))
    out = v.select(*keys, "y", "x", *values, each.alias("o"))
    out = out.select(*keys, (F.col("y") - F.col("o.dy")).alias("y"), (F.col("x") - F.col("o.dx")).alias("x"), *values, F.col("o.dy").alias("dy"), F.col("o.dx").alias("dx"))
    return out.where(F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1))


def window_agg(v: DataFrame, keys: list[str], value: str, offsets: list[tuple[int, int]], height: int, width: int, agg, name: str) -> DataFrame:
    """An aggregate over each pixel's neighbours inside the image."""
    return spread(v, keys, [value], offsets, height, width).groupBy(*keys, "y", "x").agg(agg(value).alias(name))


def opening(v: DataFrame, keys: list[str], value: str, offsets, height: int, width: int) -> DataFrame:
    low = window_agg(v, keys, value, offsets, height, width, F.min, "__low")
    return window_agg(low, keys, "__low", offsets, height, width, F.max, "opened")


def top_hat(v: DataFrame, keys: list[str], value: str, radius: int, height: int, width: int) -> DataFrame:
    """What an image has above its opening by a disk."""
    o = opening(v, keys, value, disk(radius), height, width)
    return v.join(o, [*keys, "y", "x"]).withColumn("tophat", F.col(value) - F.col("opened"))


def local_maxima(v: DataFrame, keys: list[str], value: str, height: int, width: int) -> DataFrame:
    """Pixels above all their eight neighbours inside the image."""
    near = window_agg(v, keys, value, [o for o in box(1) if o != (0, 0)], height, width, F.max, "__near")
    return v.join(near, [*keys, "y", "x"]).where(F.col(value) > F.col("__near")).drop("__near")


def shift(v: DataFrame, keys: list[str], value: str, dy: Column, dx: Column, height: int, width: int) -> DataFrame:
    """Pixels moved by whole steps; what enters from beyond the edge is 0, what leaves is lost."""
    places = v.select(*keys, "y", "x", (F.col("y") - dy).alias("sy"), (F.col("x") - dx).alias("sx"))
    source = v.select(*keys, F.col("y").alias("sy"), F.col("x").alias("sx"), value)
    return places.join(source, [*keys, "sy", "sx"], "left").select(*keys, "y", "x", F.coalesce(value, F.lit(0)).alias(value))


def otsu(v: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, threshold: the value up to which pixels count as background, such that the variance between the two groups is largest (the
    smallest such value)."""
    h = v.groupBy(*keys, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys).orderBy(value)
    whole = Window.partitionBy(*keys)
    h = h.select(
        *keys, F.col(value).alias("threshold"), F.sum("n").over(w).alias("n0"), F.sum(F.col("n") * F.col(value)).over(w).alias("s0"),
        F.sum("n").over(whole).alias("n"), F.sum(F.col("n") * F.col(value)).over(whole).alias("s"),
    ).where("n0 < n")
    gain = F.pow((F.col("s") * F.col("n0") - F.col("s0") * F.col("n")).cast("double"), 2) / (F.col("n0") * (F.col("n") - F.col("n0"))).cast("double")
    return h.groupBy(*keys).agg(F.min(F.struct((-F.round(gain, 3)).alias("g"), "threshold"))["threshold"].alias("threshold"))


def turned(quarters: Column, height: int, width: int) -> tuple[Column, Column]:
    """Places (y, x) of the pixels of an image turned by so many quarters."""
    y, x = F.col("y"), F.col("x")
    by = [(y, x), (height - 1 - x, y), (height - 1 - y, width - 1 - x), (x, width - 1 - y)]
    pick = lambda k: F.when(quarters == 0, by[0][k]).when(quarters == 1, by[1][k]).when(quarters == 2, by[2][k]).otherwise(by[3][k])
    return pick(0), pick(1)


def components(mask: DataFrame, keys: list[str], width: int) -> DataFrame:
    """mask's pixels (keys, y, x) with the label of their component (eight neighbours): the least place, y * width + x, in it. An image is a
    group, labelled in one pass."""
    schema = mask.select(*keys, "y", "x").schema.add("label", "long")

    def run(t: pa.Table) -> pa.Table:
        at = np.stack([t.column(c).to_numpy() for c in ("y", "x")], 1)
        label = kernels.labels(at)
        first = np.full(len(at), np.iinfo(np.int64).max)
        np.minimum.at(first, label, at[:, 0] * width + at[:, 1])
        return pa.table([*(t.column(c) for c in schema.names[:-1]), pa.array(first[label])], schema.names)

    return mask.select(*keys, "y", "x").groupBy(*keys).applyInArrow(run, schema)


def regional_maxima(v: DataFrame, keys: list[str], value: str, threshold: str) -> DataFrame:
    """Spots in volumes (keys, z, y, x, value, threshold): keys, z, y, x, n_voxels and the value. A spot is a set of connected voxels (26
    neighbours) of one value above the volume's threshold with no higher voxel next to any of them; its place is the centre, halves
    rounded up. Volumes with none give no rows."""
    schema = v.select(*keys).schema.add("z", "long").add("y", "long").add("x", "long").add("n_voxels", "long").add(value, v.schema[value].dataType)

    def run(t: pa.Table) -> pa.Table:
        at = np.stack([t.column(c).to_numpy() for c in "zyx"], 1)
        spots = kernels.regional_maxima(at, t.column(value).to_numpy(), t.column(threshold).to_numpy())
        centre = [np.array([s[k] for s in spots], np.int64) for k in range(4)]
        row = pa.array(np.array([s[4] for s in spots], np.int64))
        return pa.table([*(t.column(c).take(row) for c in keys), *map(pa.array, centre), t.column(value).take(row)], schema.names)

    return v.select(*keys, "z", "y", "x", value, threshold).groupBy(*keys).applyInArrow(run, schema)


def expand_labels(labels: DataFrame, keys: list[str], radius: int, height: int, width: int) -> DataFrame:
    """Every pixel within the radius of a labelled one, with the nearest label (the smaller where there are ties)."""
    s = spread(labels, keys, ["label"], disk(radius), height, width)
    d = (F.col("dy") * F.col("dy") + F.col("dx") * F.col("dx")).alias("d2")
    return s.groupBy(*keys, "y", "x").agg(F.min(F.struct(d, "label"))["label"].alias("label"))


def boundaries(labels: DataFrame, keys: list[str], height: int, width: int) -> DataFrame:
    """Labelled pixels with a neighbour (of four) of another label or none, inside the image."""
    at = spread(labels, keys, ["label"], cross(), height, width)
    own = at.where("dy = 0 and dx = 0").select(*keys, "y", "x", F.col("label").alias("own"))
    y, x = F.col("y"), F.col("x")
    inside = 5 - (y == 0).cast("int") - (y == height - 1).cast("int") - (x == 0).cast("int") - (x == width - 1).cast("int")
    same = at.join(own, [*keys, "y", "x"]).groupBy(*keys, "y", "x", F.col("own").alias("label")).agg(F.count_if(F.col("label") == F.col("own")).alias("n"))
    return same.where(F.col("n") < inside).drop("n")
