"""Shards that all hold the sources in the dataset's proportions, by interleaving the sources.

Rows of a source are shuffled by a seeded hash and numbered; the number as a fraction of the source's size is a row's place between 0 and 1.
In the order of these fractions every stretch holds each source in its share, so cutting it into equal stretches gives the shards: their counts
of rows differ by one at most. A source's rows begin at a part of its first step that depends on its name, for sources of one size would else
come in clusters, and a cut through a cluster would miss a source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

SEED = 20240229
OVERHEAD = 16  # bytes counted for a row besides its text


def assign(docs: DataFrame, n_shards: int = 40, seed: int = SEED, source: str = "source") -> DataFrame:
    """doc_id, source, size, text_crc32, shard (from 0) and slot (from 0 without gaps in its shard): a row for each row of docs.

    The shuffle is by the MD5 of seed and doc_id; ties, and rows without doc_id, go by text (its CRC and size), and equal rows in any order. A
    null source is a source of its own. A null or empty text has no bytes and the CRC 0. With fewer rows than shards, some shards
    are empty; an empty table gives no rows. Further columns are neither read nor returned. Copies of a text aren't kept together.
    """
    return _assigned(_slim(docs, source), n_shards, seed).drop("__row")


def _slim(docs: DataFrame, source: str, row: str | None = None) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", F.col(source).alias("source"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), (F.col(row) if row else F.monotonically_increasing_id()).alias("__row"),
    )


def _assigned(slim: DataFrame, n_shards: int, seed: int) -> DataFrame:
    shuffled = F.unhex(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")))
    rows = common.stage(slim.withColumn("__key", shuffled), "rows")
    rows = common.ranked(rows, ["source"], ["__key", "doc_id", "text_crc32", "size", "__row"], "__k").drop("__key")
    name = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))).cast("binary"))
    step = F.conv(F.substring(name, 1, 8), 16, 10).cast("double") / float(1 << 32)
    rows = rows.withColumn("__part", (F.col("__k").cast("double") + step) / F.col("__k_of").cast("double")).drop("__k_of")
    rows = common.ranked(rows, [], ["__part", "source", "__k"], "__p")
    shard = F.expr(f"__p * {n_shards} div __p_of")
    first = F.expr(f"(shard * __p_of + {n_shards - 1}) div {n_shards}")
    return rows.withColumn("shard", shard).withColumn("slot", F.col("__p") - first).select("doc_id", "source", "size", "text_crc32", F.col("shard").cast("int"), "slot", "__row")


def write(docs: DataFrame, path: str, n_shards: int = 40, seed: int = SEED, source: str = "source") -> None:
    """All columns of docs as Parquet under path, a folder `shard=N` for each shard, its rows in the order of their slots (a column besides).
    Whole rows go through two shuffles: one to meet their places, one to their shards."""
    row, own = common.fresh(docs, "row"), [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    rows = common.stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    places = _assigned(_slim(rows, source, row), n_shards, seed).select(F.col("__row").alias(row), "shard", "slot")
    out = rows.select(*own, row).join(places, row).drop(row)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
