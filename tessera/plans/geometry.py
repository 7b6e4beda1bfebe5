"""Queries over tiles, grids and stitching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import joins, stitch
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

SUBTILES = """subtiles AS (
  SELECT i * 4 + j + 1 AS t, i AS ind_x, j AS ind_y, CASE WHEN i = 0 THEN 1 ELSE i * 512 - 51 + 1 END AS scoords_x, CASE WHEN j = 0 THEN 1 ELSE j * 512 - 51 + 1 END AS scoords_y,
    CASE WHEN i = 3 THEN 2048 ELSE (i + 1) * 512 + 51 END AS ecoords_x, CASE WHEN j = 3 THEN 2048 ELSE (j + 1) * 512 + 51 END AS ecoords_y, i * 512 AS upperleft_x, j * 512 AS upperleft_y
  FROM range(4) a(i), range(4) b(j))"""
SUBTILE_READS = "subtile_reads AS (SELECT r.fov, r.x, r.y, r.z, r.gene, s.t, s.scoords_x, s.scoords_y FROM reads r JOIN subtiles s ON r.x BETWEEN s.scoords_x AND s.ecoords_x AND r.y BETWEEN s.scoords_y AND s.ecoords_y)"


def subtile_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fx.reads(spark, sf_dir).select("fov", "x", "y", "z", "gene")
    tiles = stitch.subtiles(spark, 2048, 2048, 4, 0.1)
    inside = F.col("x").between(F.col("scoords_x"), F.col("ecoords_x")) & F.col("y").between(F.col("scoords_y"), F.col("ecoords_y"))
    return r.join(F.broadcast(tiles), inside).select(*r.columns, "t", "scoords_x", "scoords_y")  # sixteen tiles


@query(f"WITH {SUBTILES} SELECT *, ecoords_x - scoords_x + 1 AS inputdim_x, ecoords_y - scoords_y + 1 AS inputdim_y FROM subtiles")
def subtile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen overlapping tiles of an image."""
    return stitch.subtiles(spark, 2048, 2048, 4, 0.1)


@query(f"""WITH {fx.READS}, {SUBTILES}, {SUBTILE_READS}, f AS (SELECT fov, min(t) AS first FROM subtile_reads GROUP BY fov),
taking AS (SELECT DISTINCT fov, t, scoords_x, scoords_y FROM subtile_reads),
kept AS (SELECT r.* FROM subtile_reads r JOIN f USING (fov) WHERE (t = first OR (x > scoords_x AND y > scoords_y))
  AND NOT EXISTS (SELECT 1 FROM taking u WHERE u.fov = r.fov AND u.t > r.t AND r.x > u.scoords_x AND r.y > u.scoords_y))
SELECT fov, t, count(*) AS n, sum(x)::BIGINT AS sx, sum(y)::BIGINT AS sy FROM kept GROUP BY ALL""")
def subtile_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of overlapping tiles, stitched tile after tile."""
    tiles = stitch.subtiles(spark, 2048, 2048, 4, 0.1)
    kept = stitch.stitch_corners(subtile_reads(spark, sf_dir), tiles, ["fov"], "t", ("x", "y"), ("scoords_x", "scoords_y"))
    return kept.groupBy("fov", "t").agg(F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))


#: Fields of a sample laid out side by side with overlaps, as tiles of one canvas.
TILED = """tiled AS (SELECT (fov - 1) // 5 AS grp, (fov - 1) % 5 AS tile, x % 500 + (fov - 1) % 5 * 400 AS gx, y % 500 + (fov - 1) % 3 * 300 AS gy, gene FROM reads)"""


def tiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = F.col("fov") - 1
    return fx.reads(spark, sf_dir).select(
        F.expr("(fov - 1) div 5").alias("grp"), (f % 5).alias("tile"), (F.col("x") % 500 + f % 5 * 400).alias("gx"), (F.col("y") % 500 + f % 3 * 300).alias("gy"), "gene"
    )


@query(f"""WITH {fx.READS}, {TILED}, b AS (SELECT grp, tile, greatest(least(min(gx), 2000), 0) AS x0, greatest(least(max(gx), 2000), 0) AS x1,
  greatest(least(min(gy), 2000), 0) AS y0, greatest(least(max(gy), 2000), 0) AS y1 FROM tiled GROUP BY ALL)
SELECT grp, tile, count(*) AS n, sum(gx)::BIGINT AS sx, sum(gy)::BIGINT AS sy FROM tiled r
WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.grp = r.grp AND b.tile < r.tile AND r.gx BETWEEN x0 AND x1 AND r.gy BETWEEN y0 AND y1) GROUP BY ALL""")
def region_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads outside the regions that earlier tiles occupy."""
    kept = stitch.stitch_regions(tiled(spark, sf_dir), ["grp"], "tile", ("gx", "gy"), 0, 2000)
    return kept.groupBy("grp", "tile").agg(F.count("*").alias("n"), F.sum("gx").alias("sx"), F.sum("gy").alias("sy"))


@query(f"""WITH {fx.READS}, {TILED}, c AS (SELECT *, tile * 400 + 50 AS sx, (grp * 5 + tile) % 3 * 300 + 50 AS sy FROM tiled),
f AS (SELECT grp, min(tile) AS first FROM c GROUP BY grp), t AS (SELECT DISTINCT grp, tile, sx, sy FROM c)
SELECT grp, tile, count(*) AS n, sum(gx)::BIGINT AS gx, sum(gy)::BIGINT AS gy FROM c r JOIN f USING (grp) WHERE (tile = first OR (r.gx > sx AND r.gy > sy))
  AND NOT EXISTS (SELECT 1 FROM t WHERE t.grp = r.grp AND t.tile > r.tile AND r.gx > t.sx AND r.gy > t.sy AND r.gy < t.sy + 400) GROUP BY ALL""")
def midedge_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of tiles stitched at the middle of their overlaps."""
    c = tiled(spark, sf_dir).withColumn("sx", F.col("tile") * 400 + 50).withColumn("sy", (F.col("grp") * 5 + F.col("tile")) % 3 * 300 + 50)
    kept = stitch.stitch_edges(c, ["grp"], "tile", ("gx", "gy"), ("sx", "sy"), 400)
    return kept.groupBy("grp", "tile").agg(F.count("*").alias("n"), F.sum("gx").alias("gx"), F.sum("gy").alias("gy"))


#: Tiles of 25 fields in a grid, some of them blank, at positions that don't quite fit.
GRID = """grid AS (SELECT k % 5 AS col, k // 5 AS row, CASE WHEN (k + 1) % 7 = 0 THEN 0 ELSE k + 1 END AS id, k % 5 * 1843 + k * 3 % 11 AS x, k // 5 * 1850 + k * 5 % 13 AS y FROM range(25) r(k))"""


def grid(spark: SparkSession) -> DataFrame:
    k = F.col("id")
    return spark.range(25).select(
        (k % 5).alias("col"), F.expr("id div 5").alias("row"), F.when((k + 1) % 7 == 0, 0).otherwise(k + 1).alias("id"),
        (k % 5 * 1843 + k * 3 % 11).alias("x"), (F.expr("id div 5") * 1850 + k * 5 % 13).alias("y"),
    )


@query(f"""WITH {GRID}, n AS (SELECT g.*, (SELECT x FROM grid o WHERE o.col = g.col - 1 AND o.row = g.row AND o.id <> 0) AS l, (SELECT x FROM grid o WHERE o.col = g.col + 1 AND o.row = g.row AND o.id <> 0) AS r,
  (SELECT y FROM grid o WHERE o.row = g.row - 1 AND o.col = g.col AND o.id <> 0) AS u, (SELECT y FROM grid o WHERE o.row = g.row + 1 AND o.col = g.col AND o.id <> 0) AS d FROM grid g)
SELECT id, col, row, x, y, coalesce(trunc((l + 2048 - x) / 2 + 0.5)::BIGINT + x, x) AS start_x, coalesce(trunc((u + 2048 - y) / 2 + 0.5)::BIGINT + y, y) AS start_y,
  coalesce(trunc((x + 2048 - r) / 2 + 0.5 + r)::BIGINT, x + 2048) AS end_x, coalesce(trunc((y + 2048 - d) / 2 + 0.5 + d)::BIGINT, y + 2048) AS end_y FROM n WHERE id <> 0""")
def tile_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds of the tiles at the middle of their overlaps with those next to them."""
    tiles = stitch.midlines(stitch.neighbours(grid(spark), "col", "row", "id", "x", "y"), "x", "y", 2048, 2048)
    return tiles.where("id <> 0").select("id", "col", "row", "x", "y", "start_x", "start_y", "end_x", "end_y")


AFFINES = """affines AS (SELECT s_suppkey AS setup, kind, '1.0 0.0 0.0 ' || a || '.5 0.0 1.0 0.0 ' || b || '.25 0.0 0.0 1.0 ' || c || '.75' AS affine
  FROM supplier, (VALUES ('Stitching Transform', 1), ('Translation to Regular Grid', 2)) v(kind, f), LATERAL (SELECT s_suppkey * 37 * f % 700 AS a, s_suppkey * 53 * f % 900 AS b, s_suppkey * 7 * f % 30 AS c) n)"""


@query(f"""WITH {AFFINES}, p AS (SELECT setup, sum(string_split(affine, ' ')[4]::DOUBLE) AS x, sum(string_split(affine, ' ')[8]::DOUBLE) AS y, sum(string_split(affine, ' ')[12]::DOUBLE) AS z FROM affines GROUP BY setup)
SELECT setup, trunc(x)::BIGINT + abs(min(trunc(x)::BIGINT) OVER ()) AS x, trunc(y)::BIGINT + abs(min(trunc(y)::BIGINT) OVER ()) AS y, trunc(z)::BIGINT + abs(min(trunc(z)::BIGINT) OVER ()) AS z FROM p""")
def affine_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of tiles from the affine transforms of a registration file: two of a tile are added, and all moved by the least."""
    s, key = fx.table(spark, sf_dir, "supplier").select("s_suppkey"), F.col("s_suppkey")
    num = lambda m, f, mod: (key * m * f % mod).cast("string")
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(f).alias("f")) for k, f in (("Stitching Transform", 1), ("Translation to Regular Grid", 2))]))
    t = s.withColumn("k", kinds).select(
        key.alias("setup"), "k.kind",
        F.concat(F.lit("1.0 0.0 0.0 "), num(37, F.col("k.f"), 700), F.lit(".5 0.0 1.0 0.0 "), num(53, F.col("k.f"), 900), F.lit(".25 0.0 0.0 1.0 "), num(7, F.col("k.f"), 30), F.lit(".75")).alias("affine"),
    )
    wide = t.groupBy("setup").pivot("kind", ["Stitching Transform", "Translation to Regular Grid"]).agg(F.first("affine"))
    part = lambda i: sum(F.get(F.split(F.col(f"`{c}`"), " "), F.lit(i)).cast("double") for c in wide.columns[1:]).cast("long")
    p = wide.select("setup", part(3).alias("x"), part(7).alias("y"), part(11).alias("z"))
    least = p.agg(*[F.abs(F.min(c)).alias(f"m{c}") for c in "xyz"])
    return p.crossJoin(F.broadcast(least)).select("setup", *[(F.col(c) + F.col(f"m{c}")).alias(c) for c in "xyz"])  # one row


STAGE = "stage AS (SELECT c_nationkey::BIGINT AS grp, c_custkey AS pos, c_custkey % 9 // 3 * 500 + c_custkey * 7 % 5 AS sx, c_custkey % 3 * 480 AS sy FROM customer)"


@query(f"""WITH {STAGE}, m AS (SELECT grp, abs(lead(sy) OVER (PARTITION BY grp ORDER BY pos) - sy) AS d FROM stage),
s AS (SELECT grp, d AS step FROM (SELECT grp, d, row_number() OVER (PARTITION BY grp ORDER BY count(*) DESC, d) AS k FROM m WHERE d > 0 GROUP BY grp, d) WHERE k = 1)
SELECT st.grp, pos, sx, sy, step, trunc((sx - min(sx) OVER w) / step + 0.5)::BIGINT AS col, trunc((sy - min(sy) OVER w) / step + 0.5)::BIGINT AS row
FROM stage st JOIN s ON s.grp = st.grp WINDOW w AS (PARTITION BY st.grp)""")
def stage_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid places of positions on a microscope's stage."""
    k = F.col("c_custkey")
    st = fx.table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("long").alias("grp"), k.alias("pos"), (F.expr("c_custkey % 9 div 3") * 500 + k * 7 % 5).alias("sx"), (k % 3 * 480).alias("sy")
    )
    return stitch.stage_grid(st, ["grp"], "sx", "sy", "pos")


@query("""WITH s AS (SELECT c_nationkey::BIGINT AS grp, c_custkey * 7 % 6 AS col, c_custkey * 11 % 5 AS row, c_custkey AS id FROM customer),
m AS (SELECT grp, max(col) AS c, max(row) AS r FROM s GROUP BY grp), p AS (SELECT grp, x.col, y.row FROM m, LATERAL (SELECT unnest(range(c + 1)) AS col) x, LATERAL (SELECT unnest(range(r + 1)) AS row) y)
SELECT p.grp, p.col, p.row, coalesce(sum(s.id), 0)::BIGINT AS id, 'tile_' || p.row || '_' || p.col AS grid FROM p LEFT JOIN s ON s.grp = p.grp AND s.col = p.col AND s.row = p.row GROUP BY ALL""")
def dense_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids of tiles with their blank places filled in."""
    k = F.col("c_custkey")
    s = fx.table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("grp"), (k * 7 % 6).alias("col"), (k * 11 % 5).alias("row"), k.alias("id"))
    return stitch.dense_grid(s, ["grp"], "col", "row", "id")


@query(f"""WITH {fx.READS}, {fx.ANNOTATION} SELECT fov, sample_id, count(*) AS n FROM reads LEFT JOIN annotation ON fov BETWEEN fov_start AND fov_end GROUP BY ALL""")
def fov_to_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads by field of view with its sample, found by the sample's range of fields."""
    n = fx.reads(spark, sf_dir).groupBy("fov").agg(F.count("*").alias("n"))
    return joins.interval_join(n, fx.annotation(spark, sf_dir), "fov", "fov_start", "fov_end", "left").select("fov", "sample_id", "n")


@query(f"""WITH {fx.READS}, {fx.ANNOTATION}, {fx.CODEBOOK} SELECT sample_id, fov, gene, count(*) AS n FROM reads JOIN codebook USING (gene) JOIN annotation ON fov BETWEEN fov_start AND fov_end GROUP BY ALL""")
def gene_counts_by_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of each gene of the codebook by sample and field of view."""
    counts = fx.reads(spark, sf_dir).groupBy("fov", "gene").agg(F.count("*").alias("n"))
    counts = counts.join(fx.codebook(spark, sf_dir).select("gene"), "gene")
    return joins.interval_join(counts, fx.annotation(spark, sf_dir), "fov", "fov_start", "fov_end").select("sample_id", "fov", "gene", "n")


@query(f"""WITH {fx.READS}, {GRID} SELECT fov, gene, count(*) AS n, sum(r.x - 1 + g.x)::BIGINT AS gx, sum(r.y - 1 + g.y)::BIGINT AS gy FROM reads r JOIN grid g ON g.id = r.fov GROUP BY ALL""")
def global_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads moved from their field's coordinates, counted from 1, to the canvas's, counted from 0."""
    g = grid(spark).select(F.col("id").alias("fov"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    r = fx.reads(spark, sf_dir).join(F.broadcast(g), "fov")  # 25 rows
    return r.groupBy("fov", "gene").agg(F.count("*").alias("n"), F.sum(F.col("x") - 1 + F.col("ox")).alias("gx"), F.sum(F.col("y") - 1 + F.col("oy")).alias("gy"))


TILE_LINES = "tile_lines AS (SELECT 'Position' || lpad(s_suppkey::VARCHAR, 4, '0') || '.tif; ; (' || (s_suppkey * 97 % 2048 - 900) || '.6, ' || (s_suppkey * 53 % 2048 - 800) || '.4)' AS line FROM supplier)"


@query(f"""WITH {TILE_LINES}, p AS (SELECT regexp_extract(line, '^([^.]+)\\.', 1) AS name, regexp_extract(line, '\\((-?[0-9.]+),', 1)::DOUBLE AS x, regexp_extract(line, ', (-?[0-9.]+)\\)', 1)::DOUBLE AS y FROM tile_lines)
SELECT name, round(x + abs(min(x) OVER ()))::BIGINT AS x, round(y + abs(min(y) OVER ()))::BIGINT AS y FROM p""")
def tile_configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile places from the lines of a stitcher's text file, moved so that none is below zero."""
    s, k = fx.table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    line = F.concat(fx.position(k), F.lit(".tif; ; ("), (k * 97 % 2048 - 900).cast("string"), F.lit(".6, "), (k * 53 % 2048 - 800).cast("string"), F.lit(".4)"))
    return parse_tiles(s.select(line.alias("line")))


def parse_tiles(lines: DataFrame) -> DataFrame:
    at = lambda p: F.regexp_extract("line", p, 1).cast("double")
    p = lines.select(F.regexp_extract("line", "^([^.]+)\\.", 1).alias("name"), at("\\((-?[0-9.]+),").alias("x"), at(", (-?[0-9.]+)").alias("y"))
    least = p.agg(F.abs(F.min("x")).alias("mx"), F.abs(F.min("y")).alias("my"))
    return p.crossJoin(F.broadcast(least)).select("name", *[F.round(F.col(c) + F.col(f"m{c}")).cast("long").alias(c) for c in "xy"])  # one row
