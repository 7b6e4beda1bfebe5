"""Queries over a run's records: what is there and what is missing, logs of shifts and scores, merges of tile configurations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import cells as cell_ops
from tessera.operators import clustering, joins
from tessera.plans import assignment
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

FILES = "files AS (SELECT 'Position' || lpad((s_suppkey % 60 + 1)::VARCHAR, 3, '0') AS fov_id, 'ch' || lpad((s_suppkey % 7)::VARCHAR, 2, '0') AS channel, s_suppkey AS k FROM supplier WHERE s_suppkey % 7 < 5)"


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a run by field of view and channel, some of them missing."""
    k = F.col("s_suppkey")
    s = fx.table(spark, sf_dir, "supplier").where(k % 7 < 5)
    return s.select(F.format_string("Position%03d", k % 60 + 1).alias("fov_id"), F.format_string("ch%02d", k % 7).alias("channel"), k.alias("k"))


@query(f"WITH {FILES} SELECT f.fov_id, c.channel FROM (SELECT DISTINCT fov_id FROM files) f CROSS JOIN (SELECT 'ch0' || unnest(range(5)) AS channel) c ANTI JOIN files USING (fov_id, channel)")
def missing_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels without a file in the fields of view that are there."""
    f = files(spark, sf_dir).select("fov_id", "channel").distinct()
    every = f.select("fov_id").distinct().withColumn("channel", F.explode(F.array(*[F.lit(f"ch{k:02d}") for k in range(5)])))
    return every.join(f, ["fov_id", "channel"], "left_anti")


@query(f"WITH {FILES}, a AS (SELECT fov_id || '/' || channel || '.tif' AS file, k FROM files) SELECT DISTINCT file FROM a WHERE file NOT IN (SELECT file FROM a WHERE k % 3 = 0)")
def not_uploaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a run that the store doesn't have."""
    a = files(spark, sf_dir).select(F.concat("fov_id", F.lit("/"), "channel", F.lit(".tif")).alias("file"), "k")
    return a.select("file").distinct().join(a.where("k % 3 = 0").select("file"), "file", "left_anti")


@query(f"WITH {FILES} SELECT fov_id, min(fov_id || '/' || channel || '.tif') AS dapi FROM files WHERE contains(channel, 'ch04') GROUP BY fov_id")
def stain_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file of the stain's channel for each field of view (the first by name)."""
    f = files(spark, sf_dir).where(F.contains("channel", F.lit("ch04")))
    return f.groupBy("fov_id").agg(F.min(F.concat("fov_id", F.lit("/"), "channel", F.lit(".tif"))).alias("dapi"))


@query(f"WITH {assignment.SHIFTS} SELECT 'Position' || lpad(fov::VARCHAR, 3, '0') AS fov_id, round, arg_max(row_shift, (abs(row_shift), row_shift)) AS row, max(col_shift) AS col, 0::BIGINT AS z FROM shifts GROUP BY fov, round")
def shifts_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of shifts: a row for each field of view and round."""
    s = assignment.shifts(spark, sf_dir).groupBy("fov", "round").agg(F.max_by("row_shift", F.struct(F.abs("row_shift"), "row_shift")).alias("row"), F.max("col_shift").alias("col"))
    return s.select(F.format_string("Position%03d", "fov").alias("fov_id"), "round", "row", "col", F.lit(0).cast("long").alias("z"))


@query(f"""WITH {fx.READS} SELECT fov, CASE WHEN fov % 2 = 0 THEN z::VARCHAR END AS subtile, CASE WHEN fov % 3 > 0 THEN 'AC' END AS end_bases, count(*) AS spots, count(*) FILTER (WHERE quantity % 11 > 0) AS kept,
round(100.0 * count(*) FILTER (WHERE quantity % 11 > 0) / count(*), 6) AS percent, printf('%.2f%%', 100.0 * count(*) FILTER (WHERE quantity % 11 > 0) / count(*)) AS shown FROM reads GROUP BY ALL""")
def score_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the filtering of spots in one tidy table: no sub-tile or end bases are null."""
    r = fx.reads(spark, sf_dir).select("fov", F.when(F.col("fov") % 2 == 0, F.col("z").cast("string")).alias("subtile"), F.when(F.col("fov") % 3 > 0, "AC").alias("end_bases"), (F.col("quantity") % 11 > 0).alias("good"))
    share = 100.0 * F.count_if("good") / F.count("*")
    return r.groupBy("fov", "subtile", "end_bases").agg(F.count("*").alias("spots"), F.count_if("good").alias("kept"), F.round(share, 6).alias("percent"), F.format_string("%.2f%%", share).alias("shown"))


@query(f"""WITH {fx.READS}, {fx.CELLS} SELECT c.seg_label, count(r.gene) FILTER (WHERE gene = 'Brand#11') AS brand_11, count(r.gene) FILTER (WHERE gene = 'Brand#23') AS brand_23, count(r.gene) AS total, count(r.gene) = 0 AS empty
FROM cells c LEFT JOIN reads r ON r.seg_label = c.seg_label GROUP BY c.seg_label""")
def all_cells_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of chosen genes for every labelled cell, those without a read too."""
    r = fx.reads(spark, sf_dir).where("seg_label > 0").select("seg_label", "gene")
    m = cell_ops.count_matrix(r, "seg_label", "gene", ["Brand#11", "Brand#23"]).join(r.groupBy("seg_label").agg(F.count("*").alias("total")), "seg_label")
    m = cell_ops.with_all_cells(m, fx.cells(spark, sf_dir).select("seg_label"), "seg_label").na.fill(0)
    return m.select("seg_label", F.col("`Brand#11`").alias("brand_11"), F.col("`Brand#23`").alias("brand_23"), "total", (F.col("total") == 0).alias("empty"))


@query(f"WITH {fx.CELLS} SELECT seg_label, trunc(x * 0.5)::BIGINT AS x_cut, trunc(y * 0.5)::BIGINT AS y_cut, round_even(x * 0.5, 0)::BIGINT AS x_even, round_even(y * 0.5, 0)::BIGINT AS y_even FROM cells WHERE area BETWEEN 800 AND 9000 AND fov IN (1, 2, 3, 5, 8, 13, 21)")
def rescaled_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of an area within bounds in chosen regions, at half the scale, cut and rounded to even."""
    c = fx.cells(spark, sf_dir).where(F.col("area").between(800, 9000) & F.col("fov").isin(1, 2, 3, 5, 8, 13, 21))
    half = lambda n: F.col(n) * 0.5
    return c.select("seg_label", half("x").cast("long").alias("x_cut"), half("y").cast("long").alias("y_cut"), F.rint(half("x")).cast("long").alias("x_even"), F.rint(half("y")).cast("long").alias("y_even"))


@query(f"""WITH {fx.READS} SELECT fov, count(*) AS spots_before, count(*) FILTER (WHERE quantity > 5) AS spots_after, count(DISTINCT CASE WHEN seg_label > 0 THEN seg_label END) AS cells, round(sum(quantity) / 60.0, 4) AS minutes FROM reads GROUP BY fov""")
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for each field of view: spots before and after the noise went, cells, and minutes."""
    r = fx.reads(spark, sf_dir)
    cell = F.when(F.col("seg_label") > 0, F.col("seg_label"))
    return r.groupBy("fov").agg(F.count("*").alias("spots_before"), F.count_if(F.col("quantity") > 5).alias("spots_after"), F.countDistinct(cell).alias("cells"), F.round(F.sum("quantity") / 60.0, 4).alias("minutes"))


RANGES = "ranges AS (SELECT r_name AS sample_id, r_regionkey AS k, 4 * r_regionkey + 1 AS a, 4 * r_regionkey + 6 AS b FROM region)"


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples whose ranges of fields of view overlap."""
    k = F.col("r_regionkey").cast("long")
    return fx.table(spark, sf_dir, "region").select(F.col("r_name").alias("sample_id"), k.alias("k"), (4 * k + 1).alias("a"), (4 * k + 6).alias("b"))


@query(f"""WITH {RANGES}, f AS (SELECT unnest(range(1, 31)) AS fov) SELECT fov, arg_max(sample_id, k) AS last_wins, coalesce(arg_min(sample_id, k), (SELECT arg_max(sample_id, k) FROM ranges)) AS first_match FROM f LEFT JOIN ranges ON fov BETWEEN a AND b GROUP BY fov""")
def overlapping_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample of each field of view where ranges overlap: that of the last one (none where there is none), and that of the first one
    (the last of all where there is none)."""
    f, r = spark.range(1, 31).withColumnRenamed("id", "fov"), ranges(spark, sf_dir)
    last = joins.interval_join(f, r, "fov", "a", "b", "left", "last", "k").select("fov", F.col("sample_id").alias("last_wins"))
    first = joins.interval_join(f, r, "fov", "a", "b", "left", "first", "k").select("fov", F.col("sample_id").alias("first_match"))
    none = r.agg(F.max_by("sample_id", "k").alias("of_all"))  # one row
    return last.join(first, "fov").crossJoin(F.broadcast(none)).select("fov", "last_wins", F.coalesce("first_match", "of_all").alias("first_match"))


CONFIG = "config AS (SELECT s_suppkey AS id, 'Position' || lpad(s_suppkey::VARCHAR, 4, '0') || '.tif; ; (' || (s_suppkey * 97 % 2048) || '.6, ' || (s_suppkey * 53 % 2048) || '.4)' AS line FROM supplier)"
PARSED = "parsed AS (SELECT id, regexp_extract(line, '^(.*)\\.tif; ; \\(', 1) AS fov, trunc(regexp_extract(line, '\\((-?[0-9.]+), ', 1)::DOUBLE + 0.5)::BIGINT AS col, trunc(regexp_extract(line, ', (-?[0-9.]+)\\)', 1)::DOUBLE + 0.5)::BIGINT AS row FROM config)"


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of a stitcher's lines, halves rounded up: id, fov, col, row."""
    k = F.col("s_suppkey")
    line = F.concat(fx.position(k), F.lit(".tif; ; ("), (k * 97 % 2048).cast("string"), F.lit(".6, "), (k * 53 % 2048).cast("string"), F.lit(".4)"))
    s = fx.table(spark, sf_dir, "supplier").select(k.alias("id"), line.alias("line"))
    number = lambda p: (F.regexp_extract("line", p, 1).cast("double") + 0.5).cast("long")
    return s.select("id", F.regexp_extract("line", "^(.*)\\.tif; ; \\(", 1).alias("fov"), number("\\((-?[0-9.]+), ").alias("col"), number(", (-?[0-9.]+)\\)").alias("row"))


@query(f"WITH {CONFIG}, {PARSED} SELECT * FROM parsed")
def tile_lines_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile places from a stitcher's lines as they stand, halves rounded up."""
    return parsed(spark, sf_dir)


@query(f"""WITH {CONFIG}, {PARSED}, reg AS (SELECT id, col + id % 5 AS col, row + id % 3 AS row FROM parsed WHERE id % 4 > 0), grid AS (SELECT id, id % 10 AS gx, id // 10 AS gy FROM parsed WHERE id % 5 > 0 UNION ALL SELECT -1, 99, 99)
SELECT coalesce(p.id, g.id) AS id, p.fov, p.col::VARCHAR AS col_original, p.row::VARCHAR AS row_original, r.col::VARCHAR AS col_registered, r.row::VARCHAR AS row_registered, g.gx::VARCHAR AS gx, g.gy::VARCHAR AS gy FROM parsed p LEFT JOIN reg r ON r.id = p.id FULL JOIN grid g ON g.id = p.id""")
def merged_configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles before and after registration side by side, and with the grid, of either what the other lacks too."""
    p = parsed(spark, sf_dir)
    reg = p.where("id % 4 > 0").select("id", (F.col("col") + F.col("id") % 5).alias("col_registered"), (F.col("row") + F.col("id") % 3).alias("row_registered"))
    grid = p.where("id % 5 > 0").select("id", (F.col("id") % 10).alias("gx"), F.expr("id div 10").alias("gy")).unionByName(spark.range(-1, 0).select("id", F.lit(99).cast("long").alias("gx"), F.lit(99).cast("long").alias("gy")))
    return p.withColumnsRenamed({"col": "col_original", "row": "row_original"}).join(reg, "id", "left").join(grid, "id", "full").select(
        "id", "fov", *[F.col(c).cast("string").alias(c) for c in ("col_original", "row_original", "col_registered", "row_registered", "gx", "gy")]
    )


@query(f"""WITH {CONFIG}, {PARSED}, a AS (SELECT row_number() OVER (ORDER BY id) - 1 AS i, fov FROM parsed WHERE id % 3 = 0), b AS (SELECT row_number() OVER (ORDER BY col, id) - 1 AS i, col, row FROM parsed WHERE id % 4 = 0) SELECT coalesce(a.i, b.i) AS i, fov, col::VARCHAR AS col, row::VARCHAR AS row FROM a FULL JOIN b ON a.i = b.i""")
def aligned_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of tiles side by side by their rows' numbers."""
    p = parsed(spark, sf_dir)
    number = lambda df, *by: joins.numbered(df, list(by), "i")
    return number(p.where("id % 3 = 0").select("id", "fov"), "id").drop("id").join(number(p.where("id % 4 = 0").select("id", "col", "row"), "col", "id").drop("id"), "i", "full").select("i", "fov", F.col("col").cast("string").alias("col"), F.col("row").cast("string").alias("row"))


@query(f"""WITH {RANGES}, pos AS (SELECT c_custkey AS pos, 'Position' || lpad(c_custkey::VARCHAR, 4, '0') AS name, c_custkey % 25 + 1 AS fov, c_custkey * 37 % 500 / 4.0 AS sx, c_custkey * 11 % 300 / 4.0 AS sy FROM customer),
links AS (SELECT pos, name, count(*) OVER (PARTITION BY fov) AS linked FROM pos) SELECT r.sample_id, p.name, p.sx, p.sy, l.linked FROM pos p JOIN ranges r ON p.fov BETWEEN r.a AND r.b JOIN links l ON l.name = p.name""")
def sample_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each sample's stage positions by its range of fields of view, with what is linked to a position by its name."""
    k = F.col("c_custkey")
    p = fx.table(spark, sf_dir, "customer").select(fx.position(k).alias("name"), (k % 25 + 1).alias("fov"), (k * 37 % 500 / 4.0).alias("sx"), (k * 11 % 300 / 4.0).alias("sy"))
    # names of four digits, which longer numbers share, so a place meets the links of all of its name
    links = p.select("name", "fov").join(p.groupBy("fov").agg(F.count("*").alias("linked")), "fov").select("name", "linked")
    return joins.interval_join(p, ranges(spark, sf_dir), "fov", "a", "b").join(links, "name").select("sample_id", "name", "sx", "sy", "linked")


@query(f"""WITH {fx.VOXELS}, g AS (SELECT c_custkey AS place, CASE WHEN c_custkey % 6 = 0 THEN 0 ELSE c_custkey END AS id FROM customer), px AS (SELECT unnest(range(64)) AS p)
SELECT g.place, count(*) AS pixels, sum(coalesce(v.v, 0))::BIGINT AS total FROM g CROSS JOIN px LEFT JOIN voxels v ON v.img = g.id AND g.id > 0 AND v.y * 8 + v.x = px.p GROUP BY g.place""")
def grid_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images of a grid's places, a blank one where there is none."""
    k = F.col("c_custkey")
    g = fx.table(spark, sf_dir, "customer").select(k.alias("place"), F.when(k % 6 == 0, 0).otherwise(k).alias("img"))
    v = fx.voxels(spark, sf_dir).where("img > 0").select("img", (F.col("y") * 8 + F.col("x")).alias("p"), "v")
    dense = g.withColumn("p", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))
    return dense.join(v, ["img", "p"], "left").groupBy("place").agg(F.count("*").alias("pixels"), F.sum(F.coalesce("v", F.lit(0))).alias("total"))


SPOTS = f"{fx.READS}, spots AS (SELECT fov, id, x, y, x // 512 AS wx, y // 512 AS wy FROM (SELECT fov, l_orderkey * 8 + l_linenumber AS id, min(x - 1) AS x, min(y - 1) AS y FROM reads GROUP BY ALL))"


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads as spots in windows of 512 pixels."""
    r = fx.reads(spark, sf_dir).groupBy("fov", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))
    r = r.agg((F.min("x") - 1).alias("x"), (F.min("y") - 1).alias("y"))
    return r.select("fov", "id", "x", "y", F.expr("x div 512").alias("wx"), F.expr("y div 512").alias("wy"))


DENSE = f"""{SPOTS}, near AS (SELECT a.fov, a.id, count(*) - 1 AS near FROM spots a JOIN spots b ON a.fov = b.fov AND b.x BETWEEN a.x - 50 AND a.x + 50 AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 2500 GROUP BY ALL), q AS (SELECT fov, quantile_cont(near, 0.1) AS q FROM near GROUP BY fov)"""


@query(f"WITH {DENSE} SELECT fov, id, near, near < q AS is_noise FROM near JOIN q USING (fov)")
def read_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spots with the number of others within a radius; those below a percentile of their field count as noise."""
    near = joins.neighbours(windows(spark, sf_dir), ["fov"], "id", ("x", "y"), 50)
    q = near.groupBy("fov").agg(F.percentile("near", 0.1).alias("q"))
    return near.join(q, "fov").select("fov", "id", "near", (F.col("near") < F.col("q")).alias("is_noise"))


@query(f"""WITH RECURSIVE {SPOTS}, full_ AS (SELECT fov, wx, wy FROM spots GROUP BY ALL HAVING count(*) >= 5), s AS (SELECT spots.* FROM spots JOIN full_ USING (fov, wx, wy)),
rho AS (SELECT a.fov, a.wx, a.wy, a.id, a.x, a.y, count(*) - 1 AS rho FROM s a JOIN s b ON a.fov = b.fov AND a.wx = b.wx AND a.wy = b.wy AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 2500 GROUP BY ALL),
up AS (SELECT a.fov, a.wx, a.wy, a.id, arg_min(b.id, ((a.x - b.x) ** 2 + (a.y - b.y) ** 2, b.id)) AS up FROM rho a JOIN rho b ON a.fov = b.fov AND a.wx = b.wx AND a.wy = b.wy AND (b.rho > a.rho OR (b.rho = a.rho AND b.id < a.id)) AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 2500 GROUP BY ALL),
roots AS (SELECT fov, wx, wy, id FROM rho ANTI JOIN up USING (fov, wx, wy, id)), r(fov, wx, wy, id, cell) AS (SELECT fov, wx, wy, id, id FROM roots UNION ALL SELECT u.fov, u.wx, u.wy, u.id, r.cell FROM r JOIN up u ON u.fov = r.fov AND u.wx = r.wx AND u.wy = r.wy AND u.up = r.id)
SELECT fov, id, cell FROM r""")
def density_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spots of each window grouped around its peaks of density: every spot follows the nearest denser one within a radius. Windows with
    fewer than five spots are left out."""
    s = windows(spark, sf_dir)
    full = s.groupBy("fov", "wx", "wy").agg(F.count("*").alias("n")).where("n >= 5").drop("n")
    return cell_ops.density_peaks(s.join(full, ["fov", "wx", "wy"]), ["fov", "wx", "wy"], "id", ("x", "y"), 50).select("fov", "id", "cell")


CLUSTER = clustering.Clustering()
Z = "spots AS (SELECT fov, l_orderkey * 8 + l_linenumber AS id, min(x - 1) AS x, min(y - 1) AS y, min(z) AS z FROM reads GROUP BY ALL)"
PEAKS = f"""{fx.READS}, {Z}, near AS (SELECT a.fov, a.id, count(*) - 1 AS near FROM spots a JOIN spots b ON a.fov = b.fov AND b.x BETWEEN a.x - 50 AND a.x + 50 AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 2500 GROUP BY ALL),
q AS (SELECT fov, quantile_cont(near, 0.1) AS q FROM near GROUP BY fov), s AS (SELECT spots.* FROM spots JOIN near USING (fov, id) JOIN q USING (fov) WHERE near >= q),
pair AS (SELECT a.fov, a.id AS a, b.id AS b, 100 * ((a.x - b.x) ** 2 + (a.y - b.y) ** 2) + 2500 * (a.z - b.z) ** 2 AS d FROM s a JOIN s b ON a.fov = b.fov AND b.x BETWEEN a.x - 50 AND a.x + 50 WHERE 100 * ((a.x - b.x) ** 2 + (a.y - b.y) ** 2) + 2500 * (a.z - b.z) ** 2 <= 250000),
rho AS (SELECT fov, a AS id, count(*) AS rho FROM pair GROUP BY ALL),
up AS (SELECT p.fov, p.a AS id, arg_min(p.b, (p.d, p.b)) AS up FROM pair p JOIN rho x ON x.fov = p.fov AND x.id = p.a JOIN rho y ON y.fov = p.fov AND y.id = p.b WHERE y.rho > x.rho OR (y.rho = x.rho AND p.b < p.a) GROUP BY ALL),
led(fov, id, cell) AS (SELECT fov, id, id FROM rho ANTI JOIN up USING (fov, id) UNION ALL SELECT u.fov, u.id, l.cell FROM led l JOIN up u ON u.fov = l.fov AND u.up = l.id),
found AS (SELECT fov, id, cell FROM (SELECT *, count(*) OVER (PARTITION BY fov, cell) AS n FROM led) WHERE n >= 5)"""


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.reads(spark, sf_dir).groupBy("fov", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))
    return r.agg((F.min("x") - 1).alias("x"), (F.min("y") - 1).alias("y"), F.min("z").alias("z"))


@query(f"WITH RECURSIVE {PEAKS} SELECT spots.fov, spots.id, near < q AS is_noise, coalesce(cell, -1) AS cell FROM spots JOIN near USING (fov, id) JOIN q USING (fov) LEFT JOIN found ON found.fov = spots.fov AND found.id = spots.id")
def clustered_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each field's reads grouped around their peaks of density in three dimensions, cells on windows' edges being one; -1 for noise and for
    cells of fewer than five reads."""
    return clustering.cells(spots(spark, sf_dir), ["fov"], "id", CLUSTER)


@query(f"WITH RECURSIVE {PEAKS} SELECT f.fov, f.cell, count(*) AS reads, round(avg(x), 6) AS \"column\", round(avg(y), 6) AS \"row\", round(avg(z), 6) AS z_axis FROM found f JOIN spots USING (fov, id) GROUP BY ALL")
def cluster_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The centres of the cells that reads were grouped to."""
    s = spots(spark, sf_dir)
    c = clustering.centers(s, clustering.cells(s, ["fov"], "id", CLUSTER, ("x", "y", "z")), ["fov"], "id")
    return c.select("fov", "cell", "reads", *[F.round(n, 6).alias(n) for n in ("column", "row", "z_axis")])
