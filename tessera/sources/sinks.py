"""Writers of a run's results."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources import tiff


def write_reads(reads: DataFrame, path: str, fields: list[str] | None = ("x", "y", "z", "gene"), by: str = "fov_id") -> None:
    """Reads as CSV, a folder for each field of view; fields None keeps all columns."""
    columns = list(fields) if fields else [c for c in reads.columns if c != by]
    reads.select(by, *columns).repartition(by).write.partitionBy(by).mode("overwrite").csv(path, header=True)


def write_matrix(counts: DataFrame, path: str, cell: str, gene: str, n: str, genes: list[str]) -> None:
    """The count matrix as CSV with a column for each gene of the panel."""
    counts.groupBy(cell).pivot(gene, genes).agg(F.sum(n)).na.fill(0).write.mode("overwrite").csv(path, header=True)


def write_samples(table: DataFrame, path: str, sample: str = "sample_id") -> None:
    """A table as Parquet, a folder for each sample."""
    table.write.partitionBy(sample).mode("overwrite").parquet(path)


def tiff_bytes(pages: list[np.ndarray], compress: str | None = None) -> bytes:
    """A TIFF file of grey pages, one strip a page."""
    return tiff.encode(pages, compress)


def page_of(g, height: int, width: int, kind: str) -> np.ndarray:
    """A page from its pixels; values that its type can't hold are an error."""
    v = g.v.to_numpy()
    a = np.zeros((height, width), kind)
    cast = v.astype(kind)
    if a.dtype.kind in "ui" and not (cast == v).all():
        raise ValueError(f"values that {a.dtype} can't hold: choose another type of page")
    a[g.y.to_numpy(int), g.x.to_numpy(int)] = cast
    return a


def stacks(pixels: DataFrame, keys: list[str], kind: str = "u2", compress: str | None = None) -> DataFrame:
    """keys and tiff: each stack of pixels (z, y, x, v) as the bytes of a TIFF file (pages of numpy's type `kind`), to be written as any table."""

    def run(p):
        import pandas as pd

        pages = [page_of(g, int(p.y.max()) + 1, int(p.x.max()) + 1, kind) for _, g in sorted(p.groupby("z"))]
        return pd.DataFrame([{**{k: p[k].iloc[0] for k in keys}, "tiff": tiff_bytes(pages, compress)}])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pixels.select(*keys).schema) + ", tiff binary"
    return pixels.groupBy(*keys).applyInPandas(run, schema)


def write_shifts(shifts: DataFrame, path: str, suffix: str = "") -> None:
    """The log of shifts (fov_id, round, row, col, z) as CSV, added to what is there."""
    shifts.select("fov_id", "round", "row", "col", "z").write.mode("append").csv(path + suffix, header=True)


def write_scores(scores: DataFrame, path: str) -> None:
    """The table of the filtering's scores as CSV with empty fields for nulls, added to what is there."""
    scores.write.mode("append").csv(path, header=True, nullValue="")


def write_stacks(pixels: DataFrame, keys: list[str], path: str, name: str, height: int, width: int, kind: str = "u2", compress: str | None = None) -> None:
    """Each stack of pixels (keys, z, y, x, v) as a TIFF file (pages of numpy's type `kind`, compressed by "lzw" or "deflate" if asked) under a
    folder or store that executors share, its name formatted from the keys; what is there is written over. A stack is a group, and its file
    is complete before it gets its name, so that a task may run twice."""
    uri = path if "://" in path else f"file://{path}"

    def run(p):
        import uuid

        import pandas as pd
        import pyarrow.fs as pafs

        fs, root = pafs.FileSystem.from_uri(uri)
        pages = [page_of(g, height, width, kind) for _, g in sorted(p.groupby("z"))]
        file = f"{root}/{name.format(**{k: p[k].iloc[0] for k in keys})}"
        fs.create_dir(file.rsplit("/", 1)[0], recursive=True)
        part = f"{file}.{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as f:
            f.write(tiff_bytes(pages, compress))
        fs.move(part, file)
        return pd.DataFrame({"file": [file]})

    pixels.groupBy(*keys).applyInPandas(run, "file string").write.format("noop").mode("overwrite").save()


def write_positions(positions: DataFrame, path: str) -> None:
    """Stage positions (sample_id, name, sx, sy, sections) as XML, a folder for each sample."""
    t = positions.select("sample_id", F.col("sx").alias("_StageXPos"), F.col("sy").alias("_StageYPos"), F.col("name").alias("_PositionID"), F.col("sections").alias("_Sections"))
    t.write.format("xml").option("rootTag", "StagePositions").option("rowTag", "XYZStagePointDefinition").partitionBy("sample_id").mode("overwrite").save(path)


def write_flags(spark, path: str, steps: list[str]) -> None:
    """A mark for each finished step of a run."""
    spark.createDataFrame([(s,) for s in steps], "step string").select("step", F.current_timestamp().alias("at")).write.mode("append").parquet(path)


def finished(spark, path: str) -> list[str]:
    """The finished steps, each once."""
    return sorted(r[0] for r in spark.read.parquet(path).select("step").distinct().collect())
