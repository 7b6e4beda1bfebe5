"""Queries over reads, cells and their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import cells as ops
from tessera.operators import joins
from tessera.plans.registry import query
from tessera.sources import fixtures as fx


@query(f"""WITH {fx.READS}, {fx.CELLS}, labels AS (SELECT x // 4 AS px, y // 4 AS py, min(seg_label) AS label FROM cells GROUP BY ALL)
SELECT fov, coalesce(label, 0) AS label, count(*) AS n FROM reads LEFT JOIN labels ON (x - 1) // 4 = px AND (y - 1) // 4 = py GROUP BY ALL""")
def reads_to_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads with the label of the pixel below them, counted by field and label."""
    labels = fx.cells(spark, sf_dir).groupBy(F.expr("x div 4").alias("px"), F.expr("y div 4").alias("py")).agg(F.min("seg_label").alias("label"))
    r = fx.reads(spark, sf_dir).select("fov", F.expr("(x - 1) div 4").alias("px"), F.expr("(y - 1) div 4").alias("py"))
    return ops.label_reads(r, labels, ["px", "py"]).groupBy("fov", "label").agg(F.count("*").alias("n"))


#: The genes of the test tables' codebook, for the SQL, which has to name its columns.
GENES = [f"Brand#{k}" for k in range(1, 26)]


@query(f"""WITH {fx.READS} SELECT seg_label, {", ".join(f"count(*) FILTER (WHERE gene = '{g}') AS {g.replace('#', '_').lower()}" for g in GENES)} FROM reads WHERE seg_label > 0 GROUP BY seg_label""")
def cell_gene_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count matrix, a column for each gene of the codebook."""
    named = F.lower(F.replace("gene", F.lit("#"), F.lit("_"))).alias("gene")
    panel = [r[0] for r in fx.codebook(spark, sf_dir).select(named).distinct().orderBy("gene").collect()]  # a codebook's genes
    r = fx.reads(spark, sf_dir).where("seg_label > 0").select("seg_label", named)
    return ops.count_matrix(r, "seg_label", "gene", panel)


@query(f"""WITH {fx.READS}, {fx.CELLS}, kept AS (SELECT seg_label FROM cells WHERE x >= 200 AND x < 1800 AND y >= 100 AND y < 1500),
r AS (SELECT * FROM reads WHERE (seg_label > 0 AND seg_label IN (SELECT seg_label FROM kept)) OR (seg_label = 0 AND x >= 200 AND x < 1800 AND y >= 100 AND y < 1500))
SELECT seg_label = 0 AS background, gene, count(*) AS n, count(DISTINCT seg_label) AS cells FROM r GROUP BY ALL""")
def crop_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose centre lies in a rectangle with their reads, and the background reads in it."""
    inside = ops.within(F.col("x"), F.lit(200), F.lit(1800)) & ops.within(F.col("y"), F.lit(100), F.lit(1500))
    kept = fx.cells(spark, sf_dir).where(inside).select("seg_label")
    r = fx.reads(spark, sf_dir)
    # counted by cell before anything is sorted or joined; the background counts as one cell
    own = r.where("seg_label > 0").groupBy("seg_label", "gene").agg(F.count("*").alias("n")).join(kept, "seg_label", "left_semi")
    own = own.groupBy("gene").agg(F.sum("n").alias("n"), F.count("*").alias("cells")).withColumn("background", F.lit(False))
    rest = r.where((F.col("seg_label") == 0) & inside).groupBy("gene").agg(F.count("*").alias("n")).withColumn("cells", F.lit(1).cast("long"))
    return own.unionByName(rest.withColumn("background", F.lit(True))).select("background", "gene", "n", "cells")


@query(f"""WITH {fx.READS}, {fx.CODEBOOK} SELECT fov, count(*) AS n_reads, count(*) FILTER (WHERE seg_label > 0 AND codebook.gene IS NOT NULL) AS assigned,
  round(count(*) FILTER (WHERE seg_label > 0 AND codebook.gene IS NOT NULL) / count(*), 6) AS rate, round(100.0 * count(*) FILTER (WHERE seg_label > 0) / nullif(count(*) FILTER (WHERE quantity > 10), 0), 6) AS coverage
FROM reads LEFT JOIN codebook ON reads.gene = codebook.gene GROUP BY fov""")
def assignment_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of reads in cells, and of labelled among bright places in percent."""
    book = fx.codebook(spark, sf_dir).select("gene", F.lit(True).alias("known"))
    r = fx.reads(spark, sf_dir).join(book, "gene", "left")
    good = F.count_if((F.col("seg_label") > 0) & F.col("known").isNotNull())
    return r.groupBy("fov").agg(
        F.count("*").alias("n_reads"), good.alias("assigned"), F.round(good / F.count("*"), 6).alias("rate"),
        F.round(F.try_divide(100.0 * F.count_if(F.col("seg_label") > 0), F.count_if(F.col("quantity") > 10)), 6).alias("coverage"),
    )


@query(f"""WITH {fx.READS}, m AS (SELECT max(seg_label) AS top FROM reads), ids AS (SELECT unnest(range(1, top + 1)) AS seg_label FROM m),
layers AS (SELECT seg_label, CASE WHEN z % 2 = 0 THEN 'nucleus' ELSE 'cytoplasm' END AS layer, x, y FROM reads WHERE seg_label > 0 UNION ALL SELECT seg_label, 'whole', x, y FROM reads WHERE seg_label > 0),
names AS (SELECT unnest(['whole', 'nucleus', 'cytoplasm']) AS layer)
SELECT ids.seg_label, names.layer, count(l.x) AS area, coalesce(floor(avg(l.x)), 0)::BIGINT AS cx, coalesce(floor(avg(l.y)), 0)::BIGINT AS cy FROM ids CROSS JOIN names LEFT JOIN layers l ON l.seg_label = ids.seg_label AND l.layer = names.layer GROUP BY ALL""")
def compartment_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas and centres of each cell's compartments for all labels up to the largest, zero where a cell has none."""
    r = fx.reads(spark, sf_dir).where("seg_label > 0").select("seg_label", "x", "y", "z")
    part = F.when(F.col("z") % 2 == 0, "nucleus").otherwise("cytoplasm")
    layered = r.withColumn("layer", F.explode(F.array(F.lit("whole"), part)))
    top = r.agg(F.max("seg_label")).first()[0] or 0  # one number
    ids = spark.range(1, top + 1).withColumnRenamed("id", "seg_label")
    scaffold = ids.withColumn("layer", F.explode(F.array(*[F.lit(n) for n in ("whole", "nucleus", "cytoplasm")])))
    got = layered.groupBy("seg_label", "layer").agg(F.count("*").alias("area"), F.floor(F.avg("x")).alias("cx"), F.floor(F.avg("y")).alias("cy"))
    zero = F.lit(0).cast("long")
    return scaffold.join(got, ["seg_label", "layer"], "left").select("seg_label", "layer", *[F.coalesce(c, zero).alias(c) for c in ("area", "cx", "cy")])


LAYERS = f"""{fx.READS}, layers AS (SELECT seg_label, gene, CASE WHEN z % 2 = 0 THEN 'nucleus' ELSE 'cytoplasm' END AS layer FROM reads UNION ALL SELECT seg_label, gene, 'whole' FROM reads)"""


def layered(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.when(F.col("z") % 2 == 0, "nucleus").otherwise("cytoplasm")
    return fx.reads(spark, sf_dir).withColumn("layer", F.explode(F.array(F.lit("whole"), part)))


@query(f"WITH {LAYERS} SELECT layer, seg_label, gene, count(*) AS n FROM layers WHERE seg_label > 0 GROUP BY ALL")
def compartment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of each gene in each cell's compartments (zeros left out)."""
    return layered(spark, sf_dir).where("seg_label > 0").groupBy("layer", "seg_label", "gene").agg(F.count("*").alias("n"))


@query(f"WITH {LAYERS}, t AS (SELECT count(*) AS total FROM reads) SELECT layer, count(*) FILTER (WHERE seg_label > 0) AS assigned, any_value(total) AS total, count(DISTINCT seg_label) FILTER (WHERE seg_label > 0) AS cells, round(100.0 * count(*) FILTER (WHERE seg_label > 0) / any_value(total), 2) AS percent FROM layers, t GROUP BY layer")
def compartment_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of all reads that lie in the cells' compartments, and the cells that have any there."""
    v = layered(spark, sf_dir)
    total = v.where("layer = 'whole'").agg(F.count("*").alias("total"))
    own = v.groupBy("layer").agg(F.count_if(F.col("seg_label") > 0).alias("assigned"), F.count_distinct(F.when(F.col("seg_label") > 0, F.col("seg_label"))).alias("cells"))
    return own.crossJoin(F.broadcast(total)).select("layer", "assigned", "total", "cells", F.round(100.0 * F.col("assigned") / F.col("total"), 2).alias("percent"))  # one row


@query(f"""WITH {fx.READS}, {fx.ANNOTATION} SELECT sample_id || '_Position' || lpad(fov::VARCHAR, 3, '0') || '_' || seg_label AS unique_index, sample_id, fov, seg_label, count(*) AS n
FROM reads LEFT JOIN annotation ON fov BETWEEN fov_start AND fov_end WHERE seg_label > 0 GROUP BY ALL""")
def sample_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of all fields in one table, with their sample and a name of their own."""
    c = fx.reads(spark, sf_dir).where("seg_label > 0").groupBy("fov", "seg_label").agg(F.count("*").alias("n"))
    c = joins.interval_join(c, fx.annotation(spark, sf_dir), "fov", "fov_start", "fov_end", "left")
    name = F.concat_ws("_", "sample_id", F.format_string("Position%03d", "fov"), F.col("seg_label").cast("string"))
    return c.select(name.alias("unique_index"), "sample_id", "fov", "seg_label", "n")


DUPS = "places AS (SELECT fov, x // 16 AS px, y // 16 AS py, seg_label FROM reads WHERE seg_label > 0)"


@query(f"""WITH {fx.READS}, {DUPS}, u AS (SELECT DISTINCT * FROM places) SELECT fov, px, py, count(*) AS n FROM u GROUP BY ALL HAVING count(*) > 1""")
def dup_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places that several cells claim, repeated rows apart."""
    return places(spark, sf_dir).dropDuplicates().groupBy("fov", "px", "py").agg(F.count("*").alias("n")).where("n > 1")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.reads(spark, sf_dir).where("seg_label > 0").select("fov", F.expr("x div 16").alias("px"), F.expr("y div 16").alias("py"), "seg_label")


@query(f"""WITH {fx.READS}, {fx.CELLS}, {DUPS}, u AS (SELECT DISTINCT * FROM places), d AS (SELECT fov, px, py FROM u GROUP BY ALL HAVING count(*) > 1)
SELECT u.fov, u.px, u.py, arg_min(c.seg_label, (c.x - u.px * 16) ** 2 + (c.y - u.py * 16) ** 2 + c.seg_label / 1e7) AS seg_label, min((c.x - u.px * 16) * (c.x - u.px * 16) + (c.y - u.py * 16) * (c.y - u.py * 16)) AS d2
FROM u JOIN d USING (fov, px, py) JOIN cells c ON c.seg_label = u.seg_label GROUP BY ALL""")
def closest_cell_for_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the cells that claim a place, the one whose centre is nearest (the smaller label where there are ties)."""
    u = places(spark, sf_dir).dropDuplicates()
    dup = u.groupBy("fov", "px", "py").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    c = fx.cells(spark, sf_dir).select("seg_label", "x", "y")
    dx, dy = F.col("x") - F.col("px") * 16, F.col("y") - F.col("py") * 16
    near = u.join(dup, ["fov", "px", "py"]).join(c, "seg_label").groupBy("fov", "px", "py").agg(F.min(F.struct((dx * dx + dy * dy).alias("d2"), "seg_label")).alias("b"))
    return near.select("fov", "px", "py", "b.seg_label", "b.d2")


@query(f"""WITH {fx.READS}, f AS (SELECT fov, seg_label, min(l_orderkey * 100000 + l_partkey) AS k FROM reads WHERE seg_label > 0 GROUP BY ALL)
SELECT fov, seg_label, row_number() OVER (PARTITION BY fov ORDER BY k, seg_label) AS barcode FROM f""")
def barcode_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a field numbered in the order they appear in."""
    r = fx.reads(spark, sf_dir).where("seg_label > 0").select("fov", "seg_label", (F.col("l_orderkey") * 100000 + F.col("l_partkey")).alias("k"))
    return ops.remap(r, "seg_label", ["k", "seg_label"], "barcode", ["fov"]).select("fov", "seg_label", "barcode").distinct()


@query(f"""WITH {fx.READS}, f AS (SELECT fov, seg_label, min(l_orderkey * 100000 + l_partkey) AS k FROM reads WHERE seg_label > 0 GROUP BY ALL)
SELECT fov, seg_label, row_number() OVER (ORDER BY fov, k, seg_label) AS barcode FROM f""")
def barcode_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells numbered through all fields: each field goes on from the number of cells in the fields before it. The window over fields sees a row for
    each field."""
    own = barcode_remap(spark, sf_dir)
    fields = own.groupBy("fov").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("fov").rowsBetween(Window.unboundedPreceding, -1))
    offset = fields.select("fov", F.coalesce(before, F.lit(0)).alias("offset"))
    return own.join(offset, "fov").select("fov", "seg_label", (F.col("barcode") + F.col("offset")).alias("barcode"))


@query(f"""WITH {fx.READS} SELECT gene, dense_rank() OVER (ORDER BY gene) AS code, n FROM (SELECT gene, count(*) AS n FROM reads GROUP BY gene)""")
def gene_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes numbered from 1 in alphabetical order; the window sees one row for each gene."""
    n = fx.reads(spark, sf_dir).groupBy("gene").agg(F.count("*").alias("n"))
    return n.select("gene", F.dense_rank().over(Window.orderBy("gene")).cast("long").alias("code"), "n")


@query("""WITH seen AS (SELECT DISTINCT s_suppkey % 60 + 1 AS fov FROM supplier WHERE s_suppkey % 5 <> 3), n AS (SELECT max(fov) AS top FROM seen)
SELECT k AS fov, 'Position' || lpad(k::VARCHAR, 3, '0') AS fov_id FROM n, LATERAL (SELECT unnest(range(1, top + 1)) AS k) u WHERE k NOT IN (SELECT fov FROM seen)""")
def missing_fovs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of view that should be there and aren't."""
    seen = fx.table(spark, sf_dir, "supplier").where("s_suppkey % 5 <> 3").select((F.col("s_suppkey") % 60 + 1).alias("fov")).distinct()
    top = seen.agg(F.max("fov")).first()[0] or 0  # one number
    every = spark.range(1, top + 1).withColumnRenamed("id", "fov")
    return every.join(seen, "fov", "left_anti").select("fov", F.format_string("Position%03d", "fov").alias("fov_id"))


SHIFTS = "shifts AS (SELECT user_id % 25 + 1 AS fov, event_type AS round, floor(value * 10)::BIGINT % 500 - 250 AS row_shift, floor(value * 7)::BIGINT % 300 - 150 AS col_shift FROM events)"


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = fx.table(spark, sf_dir, "events")
    whole = lambda k: F.floor(F.col("value") * k).cast("long")
    return e.select((F.col("user_id") % 25 + 1).alias("fov"), F.col("event_type").alias("round"), (whole(10) % 500 - 250).alias("row_shift"), (whole(7) % 300 - 150).alias("col_shift"))


@query(f"""WITH {SHIFTS} SELECT fov, round, count(*) AS n, count(*) FILTER (WHERE NOT (row_shift >= -200 AND row_shift < 200)) AS outliers, max(row_shift) AS max_row, max(col_shift) AS max_col FROM shifts GROUP BY ALL""")
def shift_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifts of the rounds that lie beyond a tenth of the frame."""
    far = ~ops.within(F.col("row_shift"), F.lit(-200), F.lit(200))
    return shifts(spark, sf_dir).groupBy("fov", "round").agg(F.count("*").alias("n"), F.count_if(far).alias("outliers"), F.max("row_shift").alias("max_row"), F.max("col_shift").alias("max_col"))


@query(f"""WITH {SHIFTS}, {fx.ANNOTATION} SELECT sample_id, round, quantile_cont(row_shift::DOUBLE, 0.25) AS q1, quantile_cont(row_shift::DOUBLE, 0.5) AS q2, quantile_cont(row_shift::DOUBLE, 0.75) AS q3
FROM shifts JOIN annotation ON fov BETWEEN fov_start AND fov_end GROUP BY ALL""")
def shift_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of the shifts by sample and round."""
    s = joins.interval_join(shifts(spark, sf_dir), fx.annotation(spark, sf_dir), "fov", "fov_start", "fov_end")
    v = F.col("row_shift").cast("double")
    return s.groupBy("sample_id", "round").agg(*[F.percentile(v, p).alias(n) for n, p in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))])


@query(f"""WITH {fx.CELLS} SELECT seg_label, CASE cell_type WHEN 'BUILDING' THEN 'HOUSEHOLD' ELSE cell_type END AS cell_type, area FROM cells WHERE cell_type <> 'MACHINERY' AND area > 400""")
def recode_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells above an area with one type renamed and one left out."""
    c = fx.cells(spark, sf_dir).where((F.col("cell_type") != "MACHINERY") & (F.col("area") > 400))
    return c.select("seg_label", F.when(F.col("cell_type") == "BUILDING", "HOUSEHOLD").otherwise(F.col("cell_type")).alias("cell_type"), "area")


@query(f"""WITH {fx.READS} SELECT fov, count(*) AS n, 'list' AS how FROM reads WHERE fov IN (2, 3, 5, 7) GROUP BY fov UNION ALL SELECT fov, count(*), 'range' FROM reads WHERE fov BETWEEN 10 AND 14 GROUP BY fov""")
def fov_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of the fields of view in a list and in a range."""
    n = fx.reads(spark, sf_dir).groupBy("fov").agg(F.count("*").alias("n"))
    return n.where(F.col("fov").isin(2, 3, 5, 7)).withColumn("how", F.lit("list")).unionByName(n.where(F.col("fov").between(10, 14)).withColumn("how", F.lit("range")))


@query(f"""WITH {fx.READS}, b AS (SELECT seg_label, min(x) AS x0, min(y) AS y0 FROM reads WHERE seg_label > 0 GROUP BY ALL)
SELECT seg_label, gene, r.x - x0 AS rx, r.y - y0 AS ry, z FROM reads r JOIN b USING (seg_label) WHERE seg_label = 42""")
def one_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reads of one cell, from the corner of its bounding box."""
    r = fx.reads(spark, sf_dir).where("seg_label = 42").select("seg_label", "gene", "x", "y", "z")
    box = r.groupBy("seg_label").agg(F.min("x").alias("x0"), F.min("y").alias("y0"))
    return r.join(box, "seg_label").select("seg_label", "gene", (F.col("x") - F.col("x0")).alias("rx"), (F.col("y") - F.col("y0")).alias("ry"), "z")


@query("""SELECT s_suppkey AS job, regexp_extract(log, '([0-9.]+)%', 1)::DOUBLE AS percent, string_split(string_split(log, chr(10))[2], ' ')[3] AS cells
FROM (SELECT s_suppkey, s_suppkey % 101 || '.5% of reads assigned' || chr(10) || 'number of ' || s_suppkey * 3 || ' cells' AS log FROM supplier)""")
def log_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers read back from text logs: a percentage, and the third word of the second line."""
    k = F.col("s_suppkey")
    log = F.concat((k % 101).cast("string"), F.lit(".5% of reads assigned\nnumber of "), (k * 3).cast("string"), F.lit(" cells"))
    t = fx.table(spark, sf_dir, "supplier").select(k.alias("job"), log.alias("log"))
    second = F.get(F.split("log", "\n"), F.lit(1))
    return t.select("job", F.regexp_extract("log", "([0-9.]+)%", 1).cast("double").alias("percent"), F.get(F.split(second, " "), F.lit(2)).alias("cells"))


@query(f"""WITH {fx.READS}, n AS (SELECT count(DISTINCT fov) AS k FROM reads), g AS (SELECT gene FROM reads GROUP BY gene HAVING count(DISTINCT fov) = (SELECT k FROM n))
SELECT gene, seg_label % 10 AS part, count(*) AS n FROM reads WHERE gene IN (SELECT gene FROM g) AND seg_label > 0 GROUP BY ALL""")
def matrix_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count tables of all fields together, of the genes that every field has."""
    r = fx.reads(spark, sf_dir).select("fov", "gene", "seg_label")
    fields = r.select("fov").distinct().agg(F.count("*").alias("k"))
    own = r.select("fov", "gene").distinct().groupBy("gene").agg(F.count("*").alias("m"))
    genes = own.join(F.broadcast(fields), F.col("m") == F.col("k")).select("gene")  # one row
    return r.where("seg_label > 0").join(genes, "gene", "left_semi").groupBy("gene", (F.col("seg_label") % 10).alias("part")).agg(F.count("*").alias("n"))
