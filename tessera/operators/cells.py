"""Assignment of reads to cells, and tables of cells and genes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import density


FEW = 4000  # rows whose distances are all taken


def label_reads(reads: DataFrame, labels: DataFrame, on: list[str], label: str = "label") -> DataFrame:
    """reads with the label of the pixel they lie on, 0 where there is none. labels holds only labelled pixels."""
    return reads.join(labels.select(*on, label), on, "left").withColumn(label, F.coalesce(label, F.lit(0).cast("long")))


def count_matrix(reads: DataFrame, cell: str, gene: str, genes: list[str]) -> DataFrame:
    """A row for each cell and a column for each gene, 0 where it has none."""
    return reads.groupBy(cell).pivot(gene, genes).agg(F.count(F.lit(1))).na.fill(0)


def with_all_cells(counts: DataFrame, cells: DataFrame, on: str) -> DataFrame:
    return cells.join(counts, on, "left")


def remap(rows: DataFrame, key: str, order: list[str], name: str, by: list[str] | None = None) -> DataFrame:
    """rows with the keys numbered from 1 in the order of their first appearance (within `by`)."""
    by = by or []
    first = rows.groupBy(*by, key).agg(F.min(F.struct(*order)).alias("__f"))
    numbered = first.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy("__f")).cast("long"))
    return rows.join(numbered.drop("__f"), [*by, key])


def within(col: Column, start: Column, end: Column) -> Column:
    """A half-open range."""
    return (col >= start) & (col < end)


def density_peaks(rows: DataFrame, keys: list[str], name: str, xy: tuple[str, str], radius: int) -> DataFrame:
    """keys, name and cell: within a window (keys) each row follows the nearest denser row within the radius (the smaller name where there are
    ties), and the row without one, its peak, gives the cell its name. A row is denser if more rows lie within the radius of it, or as many
    and its name is smaller. A window is a group; large ones at whole coordinates are put on a raster, of others distances are taken a block of rows
    at a time."""
    schema = rows.select(*keys, name).schema.add("cell", rows.schema[name].dataType)

    def run(t: pa.Table) -> pa.Table:
        x, y, ids = (t.column(c).to_numpy() for c in (*xy, name))
        step, n = max(1, (1 << 22) // max(len(x), 1)), len(x)
        flat = np.zeros(n, np.int64)
        if n > FEW and density.fits(x, y, flat, radius):
            up = density.followed(x, y, flat, ids, radius, 1, np.ones(n, bool))
            while (up[up] != up).any():
                up = up[up]
            return pa.table([*(t.column(c) for c in schema.names[:-1]), pa.array(ids[up])], schema.names)
        rho, up = np.zeros(n, np.int64), np.arange(n)
        for a in range(0, n, step):
            rho[a : a + step] = ((x[a : a + step, None] - x) ** 2 + (y[a : a + step, None] - y) ** 2 <= radius * radius).sum(1)
        order = np.argsort(ids)
        x, y, r = x[order], y[order], rho[order]  # in order of names, so that the first least distance is the smaller name's
        for a in range(0, n, step):
            d = (x[a : a + step, None] - x) ** 2 + (y[a : a + step, None] - y) ** 2
            place = np.arange(a, min(a + step, n))[:, None]
            denser = (r > r[a : a + step, None]) | ((r == r[a : a + step, None]) & (np.arange(n) < place))
            d = np.where(denser & (d <= radius * radius), d, np.iinfo(np.int64).max)
            best = d.argmin(1)
            some = d[np.arange(len(d)), best] < np.iinfo(np.int64).max
            up[a : a + step] = np.where(some, best, place[:, 0])
        while (up[up] != up).any():
            up = up[up]
        cell = np.empty(n, ids.dtype)
        cell[order] = ids[order][up]
        return pa.table([*(t.column(c) for c in schema.names[:-1]), pa.array(cell)], schema.names)

    return rows.select(*keys, name, *xy).groupBy(*keys).applyInArrow(run, schema)
