"""Distances between cells and structures, and densities around them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import kernels


def ring(d2: Column, width: int, rings: int) -> Column:
    """The number (from 1) of the ring of a squared distance, rings + 1 beyond the last: d is in ring k if
    (k - 1) * width <= d < k * width."""
    out = F.lit(rings + 1)
    for k in range(rings, 0, -1):
        out = F.when(d2 < (k * width) ** 2, k).otherwise(out)
    return out.cast("long")


def chi_square_yates(a: Column, b: Column, c: Column, d: Column) -> Column:
    """The statistic of a two by two table with Yates's correction; null where a margin is zero."""
    n = a + b + c + d
    gap = F.abs(a * d - b * c) - F.least(F.lit(0.5) * n, F.abs(a * d - b * c))
    # the product of all four is beyond a long from some 55,000 rows on
    return F.try_divide(n * gap * gap, ((a + b) * (c + d)).cast("double") * ((a + c) * (b + d)).cast("double"))


def share(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """value as a percentage of its sum within `by`."""
    total = df.groupBy(*by).agg(F.sum(value).alias("__t"))
    return df.join(total, by).withColumn(name, F.try_divide(100.0 * F.col(value), F.col("__t"))).drop("__t")


def march(x: Column, y: Column, cx: Column, cy: Column, inside, most: int) -> Column:
    """The distance from (x, y) to the first pixel on the line to (cx, cy), in steps of one, for which inside(px, py) holds; -1 if there is
    none in `most` steps or up to the centre."""
    x, y = x.cast("double"), y.cast("double")
    d = F.sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y))
    at = lambda k, a, c: F.floor(a + F.when(d > 0, k * (c - a) / d).otherwise(0.0) + 0.5)
    steps = F.sequence(F.lit(0).cast("long"), F.least(F.lit(most).cast("long"), F.floor(d) + 1))
    places = F.transform(steps, lambda k: F.struct(at(k, x, cx).alias("x"), at(k, y, cy).alias("y")))
    met = F.get(F.filter(places, lambda p: inside(p["x"], p["y"])), F.lit(0))
    return F.coalesce(F.sqrt((met["x"] - x) * (met["x"] - x) + (met["y"] - y) * (met["y"] - y)), F.lit(-1.0))


def hulls(points: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """key, corner (from 0), x and y: the corners of the convex hull of each key's points (integers), by angle around their mean.

    Only the least and the greatest y of a key's points at one x can be corners, so a key's row holds two points for each x at most, and a batch
    of rows is one call."""
    schema = points.select(key).schema.add("corner", "long").add("x", "long").add("y", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column(1)
            at = ends.offsets.to_numpy()
            xs, low, high = (c.to_numpy() for c in ends.values.flatten())
            found = []
            for a, b in zip(at[:-1], at[1:]):
                found.append(kernels.hull(np.r_[xs[a:b], xs[a:b]], np.r_[low[a:b], high[a:b]]))
            many = np.array([len(c) for c in found], np.int64)
            corner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            out = np.array([p for c in found for p in c], np.int64).reshape(-1, 2)
            names = batch.column(0).take(pa.array(np.repeat(np.arange(len(many)), many)))
            yield pa.RecordBatch.from_arrays([names, pa.array(corner), pa.array(out[:, 0]), pa.array(out[:, 1])], schema.names)

    here = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(key, F.col(x).cast("long").alias("x"), F.col(y).cast("long").alias("y"))
    ends = here.groupBy(key, "x").agg(F.min("y").alias("low"), F.max("y").alias("high"))
    return ends.groupBy(key).agg(F.collect_list(F.struct("x", "low", "high"))).mapInArrow(run, schema)
