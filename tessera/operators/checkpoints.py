"""Cutting the lineage of iterations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """df as a table written to the folder that spark.checkpoint.dir names, so that a lost executor costs no round again and plans don't grow
    with the rounds. `before`, the table of the round before, is deleted then. Only a session whose master is local and where that is unset, as
    in tests, gets a temporary folder."""
    spark = df.sparkSession
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/rounds/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    if before is not None:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before._written_to)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return out
