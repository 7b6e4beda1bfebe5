"""Registration of volumes of any size by Fourier transforms in passes: along rows, then along columns and planes, with blocks of bytes exchanged
between; a task holds a strip of rows or of columns with all its planes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STRIP = 64


def shifts(images: DataFrame, keys: list[str], fixed: str, moving: str, shape: tuple[int, int, int], strip: int = STRIP) -> DataFrame:
    """keys, dz, dy, dx: the circular shift that brings `moving` onto `fixed` (columns of images: keys, z, y, x and the two), at the largest absolute
    cross-correlation (to six digits; the first place in the axes' order where there are ties). Voxels that lack count as 0.

    The same as a transform of the whole volume of this shape (planes, rows, columns). Rows are transformed in strips of rows; strips of columns are
    transformed along columns and planes, multiplied and transformed back; rows are transformed back where they began. Two exchanges of the volumes."""
    depth, height, width = shape
    block = images.select(*keys).schema.add("__at", "integer").add("__of", "integer").add("block", "binary")
    best = images.select(*keys).schema.add("size", "double").add("z", "integer").add("y", "integer").add("x", "integer")
    tall = lambda s: min(strip, height - s * strip)
    wide = lambda c: min(strip, width - c * strip)

    def table(t: pa.Table, of: int, parts: list[np.ndarray]) -> pa.Table:
        """A row for each part, to the strip with its number, from the strip `of`."""
        n = len(parts)
        key = [pa.array([t.column(c)[0].as_py()] * n, t.schema.field(c).type) for c in keys]
        return pa.table([*key, pa.array(range(n), pa.int32()), pa.array([of] * n, pa.int32()), pa.array([np.ascontiguousarray(p).tobytes() for p in parts], pa.binary())], block.names)

    def along_rows(t: pa.Table) -> pa.Table:
        s = t.column("__at")[0].as_py()
        both = np.zeros((2, depth, tall(s), width))
        z, y, x = (t.column(c).to_numpy() for c in "zyx")
        for k, c in enumerate((fixed, moving)):
            both[k, z, y - s * strip, x] = t.column(c).to_numpy()
        both = np.fft.fft(both, axis=3)
        return table(t, s, [both[..., a : a + strip] for a in range(0, width, strip)])

    def along_columns(t: pa.Table) -> pa.Table:
        c = t.column("__at")[0].as_py()
        both = np.zeros((2, depth, height, wide(c)), complex)
        for s, b in zip(t.column("__of").to_pylist(), t.column("block")):
            both[:, :, s * strip : s * strip + tall(s)] = np.frombuffer(b.as_buffer(), np.complex128).reshape(2, depth, tall(s), wide(c))
        both = np.fft.fftn(both, axes=(1, 2))
        product = np.fft.ifftn(both[0] * np.conj(both[1]), axes=(0, 1))
        return table(t, c, [product[:, a : a + strip] for a in range(0, height, strip)])

    def largest(t: pa.Table) -> pa.Table:
        s = t.column("__at")[0].as_py()
        rows = np.zeros((depth, tall(s), width), complex)
        for c, b in zip(t.column("__of").to_pylist(), t.column("block")):
            rows[:, :, c * strip : c * strip + wide(c)] = np.frombuffer(b.as_buffer(), np.complex128).reshape(depth, tall(s), wide(c))
        size = np.round(np.abs(np.fft.ifft(rows, axis=2)), 6)
        z, y, x = np.unravel_index(int(np.argmax(size)), size.shape)
        place = [pa.array([int(v)], pa.int32()) for v in (z, y + s * strip, x)]
        return pa.table([*(t.column(c).slice(0, 1) for c in keys), pa.array([float(size[z, y, x])]), *place], best.names)

    v = images.where((F.col("z") < depth) & F.col("y").between(0, height - 1) & F.col("x").between(0, width - 1))
    v = v.select(*keys, F.expr(f"cast(y div {strip} as int)").alias("__at"), "z", "y", "x", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in (fixed, moving)])
    place = [*keys, "__at"]
    out = v.groupBy(*place).applyInArrow(along_rows, block).groupBy(*place).applyInArrow(along_columns, block).groupBy(*place).applyInArrow(largest, best)
    top = out.groupBy(*keys).agg(F.min(F.struct((-F.col("size")).alias("size"), "z", "y", "x")).alias("b"))

    def wrapped(c: str, n: int) -> Column:
        at = F.col(f"b.{c}")
        return F.when(at < (n + 1) // 2, at).otherwise(at - n).cast("long").alias(f"d{c}")

    return top.select(*keys, wrapped("z", depth), wrapped("y", height), wrapped("x", width))
