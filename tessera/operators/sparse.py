"""Matrices stored as compressed columns, and categories stored as codes, to and from long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import joins

BLOCK = 4096  # entries that share a key of the join to their columns


def from_columns(entries: DataFrame, pointers: DataFrame, block: int = BLOCK) -> DataFrame:
    """row, col and value of the entries (k: place from 0, row, value) of a matrix in compressed columns, given the place where each column begins and
    ends (col, first, after: the first is a column's pointer, after the next one's).

    Entries and columns meet by blocks of places: a column takes a row for each block it reaches into, so a long one is spread over many keys,
    and no table is collected. Columns without entries give no rows; entries outside all columns are left out."""
    reach = pointers.where("first < after").withColumn("__b", F.explode(F.sequence(F.expr(f"first div {block}"), F.expr(f"(after - 1) div {block}"))))
    placed = entries.withColumn("__b", F.expr(f"k div {block}")).join(reach, "__b")
    return placed.where((F.col("k") >= F.col("first")) & (F.col("k") < F.col("after"))).select("row", "col", "value")


def to_columns(long: DataFrame, row: str, col: str, value: str) -> tuple[DataFrame, DataFrame]:
    """The entries (k, row, value) and pointers (col, first, after) of a long table, columns and rows in order."""
    numbered = joins.numbered(long.select(F.col(row).alias("row"), F.col(col).alias("col"), F.col(value).alias("value")), ["col", "row"], "k")
    pointers = numbered.groupBy("col").agg(F.min("k").alias("first"), (F.max("k") + 1).alias("after"))
    return numbered.select("k", "row", "value"), pointers


def categories(rows: DataFrame, code: str, names: DataFrame, name: str) -> DataFrame:
    """rows with the name (of names: code from 0, name) of their code; null for a negative code, which stands for no value."""
    named = names.select(F.col("code").alias("__c"), F.col("name").alias(name))
    return rows.join(named, F.when(F.col(code) >= 0, F.col(code)) == F.col("__c"), "left").drop("__c")
