"""Readers of the files that a run leaves: tables, XML, logs and image stacks. Schemas are explicit."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources import tiff

READS = "x int, y int, z int, gene string"


def read_codebook(spark: SparkSession, path: str) -> DataFrame:
    """gene, barcode from a file without a header."""
    return spark.read.csv(path, schema="gene string, barcode string", mode="FAILFAST")


def read_reads(spark: SparkSession, path: str) -> DataFrame:
    """x, y, z, gene from the files of all fields of view, with the field's name out of each file's."""
    t = spark.read.csv(path, schema=READS, header=True, mode="FAILFAST")
    return t.withColumn("fov_id", F.regexp_extract(F.col("_metadata.file_name"), "^(.*?)_", 1))


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, fov_start, fov_end and further columns as text."""
    t = spark.read.csv(path, header=True)
    return t.select("sample_id", F.col("fov_start").cast("int").alias("fov_start"), F.col("fov_end").cast("int").alias("fov_end"), *[c for c in t.columns if c not in ("sample_id", "fov_start", "fov_end")])


def read_stage_xml(spark: SparkSession, path: str, row_tag: str = "XYZStagePointDefinition") -> DataFrame:
    """Stage positions from attributes of an XML file's elements."""
    t = spark.read.format("xml").option("rowTag", row_tag).schema("_StageXPos double, _StageYPos double, _PositionID string, _Sections int").load(path)
    return t.select(*[F.col(c).alias(c[1:]) for c in t.columns])


def read_registration_xml(spark: SparkSession, path: str) -> DataFrame:
    """setup, name, affine of each transform of each tile."""
    schema = "_setup int, ViewTransform array<struct<Name: string, affine: string>>"
    t = spark.read.format("xml").option("rowTag", "ViewRegistration").schema(schema).load(path)
    return t.select(F.col("_setup").alias("setup"), F.explode("ViewTransform").alias("t")).select("setup", F.col("t.Name").alias("name"), F.col("t.affine").alias("affine"))


def read_tile_lines(spark: SparkSession, path: str) -> DataFrame:
    """The tile lines of a stitcher's text file, without its comments and other settings."""
    return spark.read.text(path).select(F.col("value").alias("line")).where(F.col("line").rlike("^[^#].*;.*;\\s*\\("))


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """The percentage in each log, and the third word of its second line."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    second = F.get(F.split("value", "\n"), F.lit(1))
    return t.select("path", F.regexp_extract("value", "([0-9.]+)%", 1).cast("double").alias("percent"), F.get(F.split(second, "\\s+"), F.lit(2)).alias("word"))


def tiff_pages(data: bytes) -> Iterator[np.ndarray]:
    """The pages of a TIFF file, one at a time."""
    for _, page in tiff.pages(io.BytesIO(data)):
        yield page


def read_stacks(spark: SparkSession, path: str, convert_uint8: bool = False) -> DataFrame:
    """Pixels of image stacks <round>/<fov>/<name>.tif: path, round, fov_id, channel, z, y, x, v. Files are spread over tasks; a task holds
    a file and gives it out page by page. For files beyond 2 GB and for some of a file's pages there is tiff.read_pages."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").option("recursiveFileLookup", "true").load(path)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for name, content in zip(p.path, p.content):
                for z, page in enumerate(tiff_pages(content)):
                    y, x = np.indices(page.shape)
                    v = page.astype(np.int64).ravel()
                    if convert_uint8 and page.dtype.itemsize == 2:
                        v = np.rint(v / 257).astype(np.int64)
                    yield pd.DataFrame({"path": name, "z": z, "y": y.ravel(), "x": x.ravel(), "v": v})

    px = files.select("path", "content").mapInPandas(run, "path string, z long, y long, x long, v long")
    part = lambda k: F.element_at(F.split("path", "/"), k)
    return px.select("path", part(-3).alias("round"), part(-2).alias("fov_id"), F.regexp_extract("path", "(ch\\d+)", 1).alias("channel"), "z", "y", "x", "v")
