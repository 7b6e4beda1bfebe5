"""Queries over cells and the structures around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import distributions, expression, joins
from tessera.operators import spatial as ops
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

NEAREST = f"""WITH {fx.CELLS}, {fx.OBJECTS}, d AS (SELECT seg_label, cell_type, object_id, (x - cx) * (x - cx) + (y - cy) * (y - cy) AS d2 FROM cells, objects),
near AS (SELECT seg_label, cell_type, object_id, d2 FROM (SELECT *, row_number() OVER (PARTITION BY seg_label ORDER BY d2, object_id) AS k FROM d) WHERE k = 1)"""
RINGS = NEAREST + ", ringed AS (SELECT *, CASE WHEN d2 < 400 THEN 1 WHEN d2 < 1600 THEN 2 WHEN d2 < 3600 THEN 3 WHEN d2 < 6400 THEN 4 WHEN d2 < 10000 THEN 5 ELSE 6 END AS ring FROM near)"


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fx.cells(spark, sf_dir).select("seg_label", "cell_type", "x", "y")
    out = joins.nearest(cells, fx.objects(spark, sf_dir), ("x", "y"), ("cx", "cy"), "object_id")
    return out.select("seg_label", "cell_type", "object_id", "d2")


def ringed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near(spark, sf_dir).withColumn("ring", ops.ring(F.col("d2"), 20, 5))


@query(f"{NEAREST} SELECT seg_label, object_id, d2, round(sqrt(d2), 6) AS d FROM near")
def nearest_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest structure to each cell and its distance."""
    return near(spark, sf_dir).select("seg_label", "object_id", "d2", F.round(F.sqrt("d2"), 6).alias("d"))


@query(f"{RINGS} SELECT ring, cell_type, count(*) AS n FROM ringed GROUP BY ALL")
def distance_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells by type in rings around the structures."""
    return ringed(spark, sf_dir).groupBy("ring", "cell_type").agg(F.count("*").alias("n"))


@query(f"""WITH {fx.CELLS}, {fx.OBJECTS} SELECT o.object_id, c.cell_type, count(*) AS n FROM cells c JOIN objects o ON (x - cx) * (x - cx) + (y - cy) * (y - cy) <= 22500 GROUP BY ALL""")
def cells_around(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells within a distance of each structure."""
    o = fx.objects(spark, sf_dir)
    return joins.counts_around(fx.cells(spark, sf_dir), o, ("x", "y"), ("cx", "cy"), 150, "cell_type", "n").select("object_id", "cell_type", "n")


REGIONS = "regions AS (SELECT seg_label, CASE fov % 3 WHEN 0 THEN 'Hippocampus' WHEN 1 THEN 'Cortex' ELSE 'Corpus Callosum' END AS region FROM cells)"


def with_region(cells: DataFrame) -> DataFrame:
    return cells.withColumn("region", F.when(F.col("fov") % 3 == 0, "Hippocampus").when(F.col("fov") % 3 == 1, "Cortex").otherwise("Corpus Callosum"))


@query(f"""WITH {fx.CELLS}, {REGIONS}, t AS (SELECT DISTINCT cell_type FROM cells), g AS (SELECT DISTINCT region FROM regions), n AS (SELECT cell_type, region, count(*) AS n FROM cells JOIN regions USING (seg_label) WHERE area > 3000 GROUP BY ALL),
s AS (SELECT t.cell_type, g.region, coalesce(n.n, 0) AS n FROM t CROSS JOIN g LEFT JOIN n ON n.cell_type = t.cell_type AND n.region = g.region)
SELECT cell_type, region, n, round(1e6 * n / (4194304 / (3.3 * 3.3)), 6) AS density, round(100.0 * n / nullif(sum(n) OVER (PARTITION BY region), 0), 6) AS percentage FROM s""")
def composition_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density and share of each cell type in each region, of those without cells too."""
    c = with_region(fx.cells(spark, sf_dir))
    scaffold = c.select("cell_type").distinct().crossJoin(F.broadcast(c.select("region").distinct()))  # three regions
    n = c.where("area > 3000").groupBy("cell_type", "region").agg(F.count("*").alias("n"))
    s = scaffold.join(n, ["cell_type", "region"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    s = ops.share(s, ["region"], "n", "percentage")
    return s.select("cell_type", "region", "n", F.round(1e6 * F.col("n") / (4194304 / (3.3 * 3.3)), 6).alias("density"), F.round("percentage", 6).alias("percentage"))


@query(f"""{RINGS}, t AS (SELECT cell_type, ring, count(*) AS a FROM ringed WHERE ring <= 5 GROUP BY ALL), r AS (SELECT ring, count(*) AS rn FROM ringed GROUP BY ring), c AS (SELECT cell_type, count(*) AS cn FROM ringed GROUP BY cell_type), n AS (SELECT count(*) AS n FROM ringed),
x AS (SELECT cell_type, ring, a, rn - a AS b, cn - a AS c, n - rn - cn + a AS d, n FROM t JOIN r USING (ring) JOIN c USING (cell_type), n)
, y AS (SELECT cell_type, ring, a, b, c, d, n * (abs(a * d - b * c) - least(0.5 * n, abs(a * d - b * c))) ** 2 / nullif((a + b) * (c + d) * (a + c) * (b + d), 0)::DOUBLE AS s FROM x)
SELECT cell_type, ring, a, b, c, d, round(s, 4) AS chi2, round(2 * ({expression.upper_tail_sql('sqrt(s)')}), 6) AS p FROM y""")
def chi2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a cell type is over-represented in a ring: the table, its corrected statistic and the probability of a larger one."""
    r = ringed(spark, sf_dir)
    t = r.where("ring <= 5").groupBy("cell_type", "ring").agg(F.count("*").alias("a"))
    rings = r.groupBy("ring").agg(F.count("*").alias("rn"))
    types = r.groupBy("cell_type").agg(F.count("*").alias("cn"))
    n = r.agg(F.count("*").alias("n"))
    x = t.join(rings, "ring").join(types, "cell_type").crossJoin(F.broadcast(n))  # one row
    x = x.select("cell_type", "ring", "a", (F.col("rn") - F.col("a")).alias("b"), (F.col("cn") - F.col("a")).alias("c"), (F.col("n") - F.col("rn") - F.col("cn") + F.col("a")).alias("d"))
    s = ops.chi_square_yates(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    return x.withColumn("chi2", F.round(s, 4)).withColumn("p", F.round(2 * expression.upper_tail(F.sqrt(s)), 6))


PER_OBJECT = f"{RINGS}, p AS (SELECT object_id, cell_type, ring, count(*) AS n FROM ringed WHERE ring <= 5 GROUP BY ALL), dens AS (SELECT *, n * 1e6 / (3.14159265 * 400 * (2 * ring - 1)) AS density FROM p)"


def densities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = ringed(spark, sf_dir).where("ring <= 5").groupBy("object_id", "cell_type", "ring").agg(F.count("*").alias("n"))
    return p.withColumn("density", F.col("n") * 1e6 / (3.14159265 * 400 * (2 * F.col("ring") - 1)))


@query(f"{PER_OBJECT} SELECT object_id, cell_type, ring, n, round(density, 4) AS density FROM dens")
def object_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density of each type in each ring of each structure."""
    return densities(spark, sf_dir).withColumn("density", F.round("density", 4))


@query(f"""{PER_OBJECT}, o AS (SELECT cell_type, avg(density) AS mean FROM dens GROUP BY cell_type), s AS (SELECT cell_type, ring, avg(density) AS m, stddev_samp(density) AS sd, count(*) AS k FROM dens GROUP BY ALL)
SELECT cell_type, ring, k, round((m - mean) / nullif(sd / sqrt(k), 0), 4) AS t, CASE WHEN m > mean THEN 'greater' ELSE 'less' END AS side FROM s JOIN o USING (cell_type)""")
def t_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-sample t of the densities in a ring against their type's mean, and the side it lies on."""
    d = densities(spark, sf_dir)
    o = d.groupBy("cell_type").agg(F.avg("density").alias("mean"))
    s = d.groupBy("cell_type", "ring").agg(F.avg("density").alias("m"), F.stddev_samp("density").alias("sd"), F.count("*").alias("k")).join(o, "cell_type")
    error = F.col("sd") / F.sqrt("k")
    t = F.try_divide(F.col("m") - F.col("mean"), F.when(error != 0, error))
    return s.select("cell_type", "ring", "k", F.round(t, 4).alias("t"), F.when(F.col("m") > F.col("mean"), "greater").otherwise("less").alias("side"))


@query(f"""{PER_OBJECT}, o AS (SELECT cell_type, avg(density) AS mean FROM dens GROUP BY cell_type), s AS (SELECT cell_type, ring, avg(density) AS m, stddev_samp(density) AS sd, count(*) AS k FROM dens GROUP BY ALL),
t AS (SELECT cell_type, ring, k, (m - mean) / (sd / sqrt(k)) AS t, m > mean AS up FROM s JOIN o USING (cell_type) WHERE k > 1 AND sd > 0)
SELECT cell_type, ring, CASE WHEN up THEN 'greater' ELSE 'less' END AS side, round(greatest({distributions.t_tail_sql("abs(t)", "(k - 1)")}, 0.0), 8) AS p FROM t""")
def t_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of a mean as far on its side as each ring's, by Student's distribution; rings with one density or equal ones have none."""
    d = densities(spark, sf_dir)
    o = d.groupBy("cell_type").agg(F.avg("density").alias("mean"))
    s = d.groupBy("cell_type", "ring").agg(F.avg("density").alias("m"), F.stddev_samp("density").alias("sd"), F.count("*").alias("k")).join(o, "cell_type")
    s = s.where("k > 1 and sd > 0").withColumn("t", (F.col("m") - F.col("mean")) / (F.col("sd") / F.sqrt("k")))
    p = distributions.t_tail(F.abs("t"), (F.col("k") - 1).cast("double"))
    return s.select("cell_type", "ring", F.when(F.col("m") > F.col("mean"), "greater").otherwise("less").alias("side"), F.round(p, 8).alias("p"))


@query(f"""{PER_OBJECT}, q AS (SELECT cell_type, quantile_cont(density, 0.99) AS top FROM dens GROUP BY cell_type) SELECT cell_type, count(*) AS k, round(max(density), 4) AS largest FROM dens JOIN q USING (cell_type) WHERE density <= top GROUP BY cell_type""")
def trim_p99(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Densities without those above the 99th percentile of their type."""
    d = densities(spark, sf_dir)
    q = d.groupBy("cell_type").agg(F.percentile("density", 0.99).alias("top"))
    return d.join(q, "cell_type").where("density <= top").groupBy("cell_type").agg(F.count("*").alias("k"), F.round(F.max("density"), 4).alias("largest"))


DENSE = f"{PER_OBJECT}, dense AS (SELECT o.object_id, t.cell_type, k AS ring, coalesce(density, 0) AS density FROM objects o CROSS JOIN (SELECT DISTINCT cell_type FROM cells) t CROSS JOIN range(1, 6) r(k) LEFT JOIN dens d ON d.object_id = o.object_id AND d.cell_type = t.cell_type AND d.ring = k)"


@query(f"""{DENSE}, q AS (SELECT cell_type, ring, CASE WHEN count(*) FILTER (density = 0) < 0.99 * count(*) THEN quantile_cont(density, 0.99) END AS top FROM dense GROUP BY ALL)
SELECT cell_type, ring, count(*) AS k, round(avg(density), 6) AS mean FROM dense JOIN q USING (cell_type, ring) WHERE top IS NULL OR density <= top GROUP BY ALL""")
def trim_unless_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Densities of all structures, those without cells as 0, less those above the 99th percentile of their type and ring, unless 99 of a hundred
    are 0."""
    types = fx.cells(spark, sf_dir).select("cell_type").distinct()
    every = fx.objects(spark, sf_dir).select("object_id").crossJoin(F.broadcast(types)).withColumn("ring", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(5).cast("long"))))  # a catalogue's types
    d = every.join(densities(spark, sf_dir), ["object_id", "cell_type", "ring"], "left").withColumn("density", F.coalesce("density", F.lit(0.0)))
    top = F.when(F.count_if(F.col("density") == 0) < 0.99 * F.count("*"), F.percentile("density", 0.99)).alias("top")
    q = d.groupBy("cell_type", "ring").agg(top)
    return d.join(q, ["cell_type", "ring"]).where("top is null or density <= top").groupBy("cell_type", "ring").agg(F.count("*").alias("k"), F.round(F.avg("density"), 6).alias("mean"))


@query(f"""{RINGS}, w AS (SELECT cell_type, nullif(count(*) FILTER (WHERE ring = 1), 0) AS r1, nullif(count(*) FILTER (WHERE ring = 2), 0) AS r2, nullif(count(*) FILTER (WHERE ring = 3), 0) AS r3 FROM ringed GROUP BY cell_type)
SELECT cell_type, ring, n FROM w UNPIVOT (n FOR ring IN (r1, r2, r3))""")
def melt_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by ring turned from columns to rows, without empty ones."""
    n = lambda k: F.when(F.count_if(F.col("ring") == k) > 0, F.count_if(F.col("ring") == k)).alias(f"r{k}")
    wide = ringed(spark, sf_dir).groupBy("cell_type").agg(n(1), n(2), n(3))
    return wide.unpivot("cell_type", ["r1", "r2", "r3"], "ring", "n").where("n is not null")


@query(f"""{PER_OBJECT}, s AS (SELECT object_id % 3 AS sample, cell_type, ring, sum(n) AS n, avg(density) AS density FROM dens GROUP BY ALL) SELECT cell_type, ring, sum(n)::BIGINT AS n, round(avg(density), 4) AS density, count(*) AS samples FROM s GROUP BY ALL""")
def combine_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples together: sums of counts, and means of the samples' mean densities."""
    s = densities(spark, sf_dir).groupBy((F.col("object_id") % 3).alias("sample"), "cell_type", "ring").agg(F.sum("n").alias("n"), F.avg("density").alias("density"))
    return s.groupBy("cell_type", "ring").agg(F.sum("n").alias("n"), F.round(F.avg("density"), 4).alias("density"), F.count("*").alias("samples"))


@query(f"{RINGS} SELECT cell_type, coalesce(ring::VARCHAR, 'overall') AS ring, count(*) AS n FROM ringed GROUP BY GROUPING SETS ((cell_type, ring), (cell_type))")
def stacked_bar_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type and ring with a row for all rings of a type."""
    r = ringed(spark, sf_dir).withColumn("ring", F.col("ring").cast("string"))
    return r.rollup("cell_type", "ring").agg(F.count("*").alias("n")).where("cell_type is not null").select("cell_type", F.coalesce("ring", F.lit("overall")).alias("ring"), "n")


@query(f"""WITH {fx.CELLS}, n AS (SELECT fov, cell_type, count(*) AS n, median(area) AS mid FROM cells GROUP BY ALL), s AS (SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY fov), 4) AS share FROM n)
SELECT fov, cell_type, n, mid, share FROM (SELECT *, rank() OVER (PARTITION BY fov ORDER BY share DESC) AS k FROM s) WHERE k <= 2""")
def label_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two most common types of each field with all that tie, and their median areas."""
    n = fx.cells(spark, sf_dir).groupBy("fov", "cell_type").agg(F.count("*").alias("n"), F.median("area").alias("mid"))
    s = ops.share(n, ["fov"], "n", "share").withColumn("share", F.round("share", 4))
    return s.withColumn("k", F.rank().over(Window.partitionBy("fov").orderBy(F.desc("share")))).where("k <= 2").select("fov", "cell_type", "n", "mid", "share")


@query(f"WITH {fx.CELLS}, m AS (SELECT fov, max(area) AS top FROM cells GROUP BY fov) SELECT seg_label, round(100.0 * area / nullif(top, 0), 4) AS percent FROM cells JOIN m USING (fov)")
def percent_of_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas as percentages of the largest in their field."""
    c = fx.cells(spark, sf_dir)
    top = c.groupBy("fov").agg(F.max("area").alias("top"))
    return c.join(top, "fov").select("seg_label", F.round(F.try_divide(100.0 * F.col("area"), F.when(F.col("top") != 0, F.col("top"))), 4).alias("percent"))


@query(f"""WITH {fx.OBJECTS}, raster AS (SELECT k % 64 AS px, k // 64 AS py, k * 7 % 4 AS code FROM range(4096) r(k)) SELECT object_id, CASE code WHEN 1 THEN 'Cortex' WHEN 2 THEN 'Corpus Callosum' WHEN 3 THEN 'Hippocampus' ELSE 'none' END AS region FROM objects JOIN raster ON px = cx // 32 AND py = cy // 32""")
def raster_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region of each structure, read off a raster below its centre."""
    k = F.col("id")
    raster = spark.range(4096).select((k % 64).alias("px"), F.expr("id div 64").alias("py"), (k * 7 % 4).alias("code"))
    o = fx.objects(spark, sf_dir).select("object_id", F.expr("cx div 32").alias("px"), F.expr("cy div 32").alias("py"))
    name = F.when(F.col("code") == 1, "Cortex").when(F.col("code") == 2, "Corpus Callosum").when(F.col("code") == 3, "Hippocampus").otherwise("none")
    return o.join(F.broadcast(raster), ["px", "py"]).select("object_id", name.alias("region"))  # 4,096 rows
