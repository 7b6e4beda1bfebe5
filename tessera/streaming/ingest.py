"""Fields of view as they arrive: a file stream of reads, counted and stored once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "fov long, spot_id long, x long, y long, gene string"


def read_stream(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_at_once).parquet(path)


def decode(reads: DataFrame, codebook: DataFrame) -> DataFrame:
    """Reads of genes in the codebook, each spot once."""
    return reads.dropDuplicates(["fov", "spot_id"]).join(codebook.select("gene"), "gene", "left_semi")


def run(reads: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes what has arrived, batch by batch under the batch's number, and ends: a batch that is run again replaces itself."""

    def store(batch: DataFrame, number: int) -> None:
        batch.groupBy("fov", "gene").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return reads.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).groupBy("fov", "gene").agg(F.sum("n").alias("n"))
