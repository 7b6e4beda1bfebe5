"""Session settings, stage tables and connected components shared by the operators."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Shuffle files go as soon as the job that wrote them has ended, rows per Arrow batch stay small for long texts.
SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def prepare(spark: SparkSession) -> str:
    """Apply SETTINGS and return the folder for stage tables.

    The folder is the one named by spark.checkpoint.dir, which driver and executors share. Only a session whose master is
    local and where that is unset, as in tests, gets a temporary one; on a cluster it must be set.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="stages-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/") + "/stages"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and return the table: lineage ends here, and a lost executor
    costs no recomputation of what came before."""
    spark = df.sparkSession
    path = f"{prepare(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for paths in _OPEN:
        paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name in taken:
        name += "_"
    return name


def drop(*tables: DataFrame) -> None:
    """Delete the files of stage tables that nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, t._stage_path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def workspace(spark: SparkSession):
    """Within it, results may be computed and written; at its end the stage tables made within it are deleted and the settings
    that prepare() makes are as before. Results not yet written then can't be read any more."""
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield
    finally:
        _OPEN.remove(paths)
        for path in paths:
            _delete(spark, path)
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Lists of the stage tables' paths of open workspaces.
_OPEN: list[list[str]] = []


def ranked(rows: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """rows with `name`, their number from 0 in their group by the order (nulls first), and `name`_of, how many rows the group has.

    Rows are dealt by ranges of (groups, order) and written in that order with their places; a place less the group's first one in
    its partition, plus the group's rows in partitions before, is the number. So no group, however large, has to fit a task: what one task sees
    of all of it is a row for each partition. Give an order without ties, or rows that tie come in any order.
    """
    at, part, first, before, total = (fresh(rows, c) for c in ("at", "part", "first", "before", "total"))
    placed = rows.repartitionByRange(*groups, *order) if groups or order else rows
    placed = stage(placed.sortWithinPartitions(*groups, *order).withColumn(at, F.monotonically_increasing_id()), "ranked")
    pid = F.shiftright(at, 33)
    sizes = placed.groupBy(*groups, pid.alias(part)).agg(F.min(at).alias(first), F.count("*").alias(total))
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*groups, part, first, F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(before), F.sum(total).over(whole).alias(total))
    sizes = stage(sizes, "ranges").select(*[F.col(c).alias(f"{part}{k}") for k, c in enumerate(groups)], part, first, before, total)
    same = F.col(part) == pid
    for k, c in enumerate(groups):
        same = same & F.col(c).eqNullSafe(F.col(f"{part}{k}"))
    out = placed.join(sizes, same)
    return out.select(*rows.columns, (F.col(at) - F.col(first) + F.col(before)).alias(name), F.col(total).alias(f"{name}_of"))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a long, b long): rows (node long, component long), the component being the
    smallest node reached. Nodes without an edge to another node don't appear; nulls are left out.

    Alternates large-star and small-star rounds, each a minimum per node (combined before its shuffle) joined back to
    the edges; both sides of that join come from stage tables, so a hub node's rows can be split. Every round's edges
    are written to the shared folder.
    """
    e = stage(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    mark = None
    for _ in range(max_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stage(large, "large")
        drop(low, e)
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u")
        small = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        e = stage(small, "edges")
        drop(low, large)
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first()
        if tuple(now) == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = tuple(now)
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")
