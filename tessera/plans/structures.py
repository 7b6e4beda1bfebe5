"""Queries over masks of structures, the rings around them and the cells in these."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.operators import images as im
from tessera.operators import structures as st
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

SIZE = fx.SLIDE
LEAST = 2  # pixels that a structure has to exceed
RESOLUTION = 5.0  # microns a pixel
DIAMETERS = st.brushes([10, 20, 30, 40, 50], RESOLUTION)
UNIT = 1 << 20
SIDE, DIAGONAL = (round((1e-4 * n / (1 + 1e-4)) ** 0.5 * UNIT) for n in (1, 2))
#: Square millimetres a pixel.
MM2 = (RESOLUTION / 1000) ** 2


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bright connected pixels of the slides: slide, y, x, label; without small ones."""
    px = im.components(fx.slides(spark, sf_dir).where("v > 200"), ["slide"], SIZE)
    large = px.groupBy("slide", "label").agg(F.count("*").alias("n")).where(F.col("n") > LEAST)
    return px.join(large.select("slide", "label"), ["slide", "label"], "left_semi").select("slide", "y", "x", "label")


LABELS = f"""{fx.VOXELS}, {fx.SLIDES}, bright AS (SELECT slide, y, x FROM slides WHERE v > 200),
grown(slide, y, x, label) AS (SELECT slide, y, x, y * {SIZE} + x FROM bright UNION SELECT b.slide, b.y, b.x, g.label FROM grown g JOIN bright b ON b.slide = g.slide AND abs(b.y - g.y) <= 1 AND abs(b.x - g.x) <= 1),
named AS (SELECT slide, y, x, min(label) AS label FROM grown GROUP BY ALL),
labels AS (SELECT slide, y, x, label FROM (SELECT *, count(*) OVER (PARTITION BY slide, label) AS n FROM named) WHERE n > {LEAST})"""
SHAPES = "shapes AS (SELECT slide, label, area, cy, cx, sqrt(max((y - cy) ** 2 + (x - cx) ** 2)) AS radius FROM labels JOIN (SELECT slide, label, count(*) AS area, avg(y) AS cy, avg(x) AS cx FROM labels GROUP BY ALL) USING (slide, label) GROUP BY ALL)"
GRID = f"grid AS (SELECT slide, k // {SIZE} AS y, k % {SIZE} AS x FROM (SELECT DISTINCT slide FROM labels), range({SIZE * SIZE}) r(k))"
DISTANCE = "distance AS (SELECT slide, y, x, d.d2, d.label FROM (SELECT g.slide, g.y, g.x, min({'d2': (g.y - l.y) ** 2 + (g.x - l.x) ** 2, 'label': l.label}) AS d FROM grid g JOIN labels l USING (slide) GROUP BY ALL))"
RING = "CASE " + " ".join(f"WHEN 4 * d2 <= {d * d} THEN {k}" for k, d in enumerate(DIAMETERS, 1)) + " END::BIGINT"
DY, DX = "abs(g.y - l.y)", "abs(g.x - l.x)"
REACHED = f"""reached AS (SELECT slide, y, x, c.cost, c.label FROM (SELECT g.slide, g.y, g.x, min({{'cost': least({DY}, {DX}) * {DIAGONAL} + abs({DY} - {DX}) * {SIDE}, 'label': l.label}}) AS c FROM grid g JOIN labels l USING (slide) GROUP BY ALL))"""


@query(f"WITH RECURSIVE {LABELS}, {SHAPES} SELECT slide, label, area, round(cy, 6) AS cy, round(cx, 6) AS cx, round(radius, 6) AS radius FROM shapes")
def structure_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area, centre and largest radius of each structure."""
    f = st.features(labels(spark, sf_dir), ["slide"])
    return f.select("slide", "label", "area", *[F.round(c, 6).alias(c) for c in ("cy", "cx", "radius")])


def distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.distance_transform(labels(spark, sf_dir), ["slide"], SIZE, SIZE)


@query(f"WITH RECURSIVE {LABELS}, {GRID}, {DISTANCE} SELECT slide, y, x, d2::BIGINT AS d2, label FROM distance")
def structure_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The squared distance of every pixel to the nearest structure, and which it is."""
    return distance(spark, sf_dir)


def blank(mask: DataFrame) -> DataFrame:
    """Images without features where there are structures."""
    one = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SIZE - 1).cast("long")))
    return mask.select("slide").distinct().withColumn("y", one).withColumn("x", one).withColumn("v", F.lit(0.0))


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels propagated over images without features."""
    mask = labels(spark, sf_dir)
    return st.propagate(blank(mask), mask, ["slide"], SIZE, SIZE)


@query(f"WITH RECURSIVE {LABELS}, {GRID}, {REACHED} SELECT slide, y, x, label, round(cost / {UNIT}, 6) AS cost FROM reached")
def structure_territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The structure that every pixel belongs to, by propagation from neighbour to neighbour, and the way's cost."""
    return territories(spark, sf_dir).withColumn("cost", F.round("cost", 6))


@query()
def propagate_over_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The structure that every pixel belongs to where ways cost more across edges of the image."""
    v = fx.slides(spark, sf_dir).withColumn("v", F.least(F.col("v") / 1000.0, F.lit(1.0)))
    return st.propagate(v, labels(spark, sf_dir), ["slide"], SIZE, SIZE).withColumn("cost", F.round("cost", 6))


def ring_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """slide, label, ring, area: pixels of each ring that belong to each structure."""
    mask = labels(spark, sf_dir)
    return st.ring_areas(mask, st.propagated_strips(blank(mask), mask, ["slide"], SIZE, SIZE), ["slide"], SIZE, SIZE, DIAMETERS)


AREAS = f"ring_areas AS (SELECT slide, r.label, ring, count(*) AS area FROM (SELECT slide, y, x, {RING} AS ring FROM distance) JOIN reached r USING (slide, y, x) WHERE ring IS NOT NULL GROUP BY ALL)"
AROUND_SQL = f"""near AS (SELECT seg_label, cell_type, c.slide, c.y, c.x, min({{'d2': (c.y - cy) ** 2 + (c.x - cx) ** 2, 'label': label}}) AS m FROM slide_cells c JOIN shapes USING (slide) GROUP BY ALL),
start AS (SELECT n.*, s.label, cy, cx, radius, sqrt(m.d2) AS d, greatest(0, sqrt(m.d2) - radius) AS gone FROM near n JOIN shapes s ON s.slide = n.slide AND s.label = n.m.label),
ray AS (SELECT *, round_even(y - CASE WHEN d > 0 THEN (gone + k) * (y - cy) / d ELSE 0 END, 0)::BIGINT AS py, round_even(x - CASE WHEN d > 0 THEN (gone + k) * (x - cx) / d ELSE 0 END, 0)::BIGINT AS px FROM start, range(300) t(k)),
met AS (SELECT ray.slide, seg_label, arg_min(sqrt((px - ray.x) ** 2 + (py - ray.y) ** 2), k) AS border FROM ray JOIN labels l ON l.slide = ray.slide AND l.label = ray.label AND l.y = py AND l.x = px GROUP BY ALL),
around AS (SELECT seg_label, cell_type, s.slide, s.y, s.x, s.label, s.d AS center, coalesce(border, -1) AS border, {RING} AS ring FROM start s LEFT JOIN met USING (slide, seg_label) JOIN distance e ON e.slide = s.slide AND e.y = s.y AND e.x = s.x)"""
AROUND = f"WITH RECURSIVE {LABELS}, {SHAPES}, {GRID}, {DISTANCE}, {fx.CELLS}, {fx.SLIDE_CELLS}, {AROUND_SQL}"


def around(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fx.slide_cells(spark, sf_dir)
    a = st.around_cells(cells, labels(spark, sf_dir), ["slide"], "seg_label", SIZE, SIZE, DIAMETERS)
    return a.join(cells, ["slide", "seg_label"])


@query(f"WITH RECURSIVE {LABELS}, {GRID}, {DISTANCE}, {REACHED}, {AREAS} SELECT slide, label, ring, area FROM ring_areas")
def structure_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area of each ring around each structure, of what belongs to the structure."""
    return ring_areas(spark, sf_dir)


@query(f"{AROUND} SELECT seg_label, slide, label, round(center, 6) AS center, round(border, 6) AS border, ring FROM around")
def cells_near_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cell's nearest structure, the distances to its centre and its border, and the ring that the cell lies in."""
    return around(spark, sf_dir).select("seg_label", "slide", "label", F.round("center", 6).alias("center"), F.round("border", 6).alias("border"), "ring")


BANDS = len(DIAMETERS)


@query(f"""{AROUND}, size AS (SELECT slide, count(*) * {MM2!r} AS whole, {", ".join(f"count(*) FILTER ({RING} = {k}) * {MM2!r} AS a{k}" for k in range(1, BANDS + 1))} FROM distance GROUP BY slide),
n AS (SELECT slide, cell_type, count(*) AS n, {", ".join(f"count(*) FILTER (border >= {2 * (k - 1)} AND border < {2 * k}) AS n{k}" for k in range(1, BANDS + 1))} FROM around GROUP BY ALL)
SELECT slide, cell_type, round(n / whole, 4) AS density_all, round(100.0 * n / sum(n) OVER (PARTITION BY slide), 4) AS percentage_all,
{", ".join(f"round(n{k} / nullif(a{k}, 0), 4) AS density_{k}0um, round(100.0 * n{k} / nullif(sum(n{k}) OVER (PARTITION BY slide), 0), 4) AS percentage_{k}0um" for k in range(1, BANDS + 1))} FROM n JOIN size USING (slide)""")
def band_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density (a square millimetre) and share of each type on each slide: over all of it, and in bands of distance to a structure's border, as
    wide as the rings whose areas they are divided by."""
    bands = range(1, BANDS + 1)
    ring = st.ring_of(F.col("d2"), DIAMETERS)
    size = distance(spark, sf_dir).groupBy("slide").agg((F.count("*") * MM2).alias("whole"), *[(F.count_if(ring == k) * MM2).alias(f"a{k}") for k in bands])
    near = lambda k: (F.col("border") >= 2 * (k - 1)) & (F.col("border") < 2 * k)
    n = around(spark, sf_dir).groupBy("slide", "cell_type").agg(F.count("*").alias("n"), *[F.count_if(near(k)).alias(f"n{k}") for k in bands])
    slide = Window.partitionBy("slide")
    share = lambda c: F.round(F.try_divide(100.0 * F.col(c), F.sum(c).over(slide)), 4)
    density = lambda c, a: F.round(F.try_divide(F.col(c).cast("double"), F.col(a)), 4)
    columns = [density("n", "whole").alias("density_all"), share("n").alias("percentage_all")]
    for k in bands:
        columns += [density(f"n{k}", f"a{k}").alias(f"density_{k}0um"), share(f"n{k}").alias(f"percentage_{k}0um")]
    return n.join(size, "slide").select("slide", "cell_type", *columns)


@query(f"""{AROUND}, {REACHED}, {AREAS}, types AS (SELECT DISTINCT cell_type FROM slide_cells), n AS (SELECT slide, label, cell_type, ring, count(*) AS n FROM around WHERE ring IS NOT NULL GROUP BY ALL)
SELECT s.slide, s.label, t.cell_type, k AS ring, CASE WHEN a.area IS NOT NULL THEN round(coalesce(n, 0) / (a.area * {MM2!r}), 4) END AS density
FROM shapes s CROSS JOIN types t CROSS JOIN range(1, {BANDS + 1}) r(k) LEFT JOIN ring_areas a ON a.slide = s.slide AND a.label = s.label AND a.ring = k LEFT JOIN n ON n.slide = s.slide AND n.label = s.label AND n.cell_type = t.cell_type AND n.ring = k""")
def structure_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density of each type in each ring of each structure: 0 without cells, null where nothing of the ring belongs to the structure."""
    shapes = st.features(labels(spark, sf_dir), ["slide"]).select("slide", "label")
    types = fx.slide_cells(spark, sf_dir).select("cell_type").distinct()
    scaffold = shapes.crossJoin(F.broadcast(types)).withColumn("ring", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(BANDS).cast("long"))))  # types of a catalogue
    n = around(spark, sf_dir).where("ring is not null").groupBy("slide", "label", "cell_type", "ring").agg(F.count("*").alias("n"))
    out = scaffold.join(ring_areas(spark, sf_dir), ["slide", "label", "ring"], "left").join(n, ["slide", "label", "cell_type", "ring"], "left")
    density = F.when(F.col("area").isNotNull(), F.round(F.coalesce("n", F.lit(0)) / (F.col("area") * MM2), 4))
    return out.select("slide", "label", "cell_type", "ring", density.alias("density"))


@query(f"""{AROUND}, {fx.READS}, {fx.EXPR}, b AS (SELECT seg_label, CASE WHEN ring <= 4 THEN ring * 10 || 'um' ELSE '40+' END AS band FROM around), m AS (SELECT band, count(*) AS m FROM b GROUP BY band)
SELECT gene, band, round(sum(n) / m, 6) AS mean FROM expr JOIN b USING (seg_label) JOIN m USING (band) GROUP BY gene, band, m""")
def ring_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean counts of each gene over the cells of each ring around the structures, the last one with all farther cells."""
    band = F.when(F.col("ring") <= 4, F.concat((F.col("ring") * 10).cast("string"), F.lit("um"))).otherwise("40+")
    b = around(spark, sf_dir).select("seg_label", band.alias("band"))
    m = b.groupBy("band").agg(F.count("*").alias("m"))
    e = fx.expr(spark, sf_dir).join(b, "seg_label").groupBy("gene", "band").agg(F.sum("n").alias("s"))
    return e.join(m, "band").select("gene", "band", F.round(F.col("s") / F.col("m"), 6).alias("mean"))
