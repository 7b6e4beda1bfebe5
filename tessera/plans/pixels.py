"""Queries over images as pixel tables (8 x 8 images made from the embeddings)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import images as im
from tessera.operators import kernels as k
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

V = f"WITH {fx.VOXELS}"
MASK = "mask AS (SELECT img, y, x, v FROM voxels WHERE v > 150)"


def vox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.voxels(spark, sf_dir)


def mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vox(spark, sf_dir).where("v > 150").select("img", "y", "x", "v")


def bounds(v: DataFrame, keys: list[str], low, high) -> DataFrame:
    b = v.groupBy(*keys).agg(low.alias("lo"), high.alias("hi"))
    return v.join(b, keys)


@query(f"{V}, b AS (SELECT img, min(v) AS lo, max(v) AS hi FROM voxels GROUP BY img) SELECT img, y, x, round((v - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END * 255)::BIGINT AS v FROM voxels JOIN b USING (img)")
def minmax_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each channel stretched to the whole range."""
    v = bounds(vox(spark, sf_dir), ["img"], F.min("v"), F.max("v"))
    return v.select("img", "y", "x", F.round(im.stretch(v, ["img"], "v", F.col("lo"), F.col("hi"))).cast("long").alias("v"))


@query(f"""{V}, b AS (SELECT img, quantile_cont(v::DOUBLE, 0.01) AS lo, quantile_cont(v::DOUBLE, 0.95) AS hi FROM voxels GROUP BY img)
SELECT img, y, x, round(pow(least(greatest((v - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END, 0), 1), 0.5), 6) AS v FROM voxels JOIN b USING (img)""")
def imadjust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contrast between two quantiles, with a gamma."""
    p = lambda q: F.percentile(F.col("v").cast("double"), q)
    v = bounds(vox(spark, sf_dir), ["img"], p(0.01), p(0.95))
    return v.select("img", "y", "x", F.round(im.stretch(v, ["img"], "v", F.col("lo"), F.col("hi"), 0, 1, 0.5), 6).alias("v"))


@query(f"{V} SELECT fov, y, x, max(v) AS top, sum(v)::BIGINT AS total FROM voxels GROUP BY ALL")
def max_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest value and sum over the planes of a field."""
    return vox(spark, sf_dir).groupBy("fov", "y", "x").agg(F.max("v").alias("top"), F.sum("v").alias("total"))


@query(f"{V} SELECT fov, y, x, max(v) AS merged, arg_max(channel, v * 10 - channel) AS channel FROM voxels GROUP BY ALL")
def merge_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels merged to the brightest, with its number (the first where there are ties)."""
    b = F.max(F.struct("v", (-F.col("channel")).alias("c"))).alias("b")
    return vox(spark, sf_dir).groupBy("fov", "y", "x").agg(b).select("fov", "y", "x", F.col("b.v").alias("merged"), (-F.col("b.c")).alias("channel"))


@query(f"""{V}, b AS (SELECT img, quantile_cont(v::DOUBLE, CASE WHEN img % 4 = 0 THEN 0.005 ELSE 0.001 END) AS lo, quantile_cont(v::DOUBLE, CASE WHEN img % 4 = 0 THEN 0.995 ELSE 0.999 END) AS hi FROM voxels GROUP BY img)
SELECT fov, y, x, max(round(least(greatest((v - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END, 0), 1) * 255, 3)) AS v FROM voxels JOIN b USING (img) GROUP BY ALL""".replace(
    "quantile_cont(v::DOUBLE, CASE WHEN img % 4 = 0 THEN 0.005 ELSE 0.001 END)", "CASE WHEN img % 4 = 0 THEN quantile_cont(v::DOUBLE, 0.005) ELSE quantile_cont(v::DOUBLE, 0.001) END").replace(
    "quantile_cont(v::DOUBLE, CASE WHEN img % 4 = 0 THEN 0.995 ELSE 0.999 END)", "CASE WHEN img % 4 = 0 THEN quantile_cont(v::DOUBLE, 0.995) ELSE quantile_cont(v::DOUBLE, 0.999) END"))
def quantile_stretch_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nuclei and spots, each stretched between its own quantiles, overlaid by the brighter."""
    p = lambda a, b: F.when(F.col("img") % 4 == 0, F.percentile(F.col("v").cast("double"), a)).otherwise(F.percentile(F.col("v").cast("double"), b))
    v = bounds(vox(spark, sf_dir), ["img"], p(0.005, 0.001), p(0.995, 0.999))
    s = F.round(im.stretch(v, ["img"], "v", F.col("lo"), F.col("hi")), 3)
    return v.groupBy("fov", "y", "x").agg(F.max(s).alias("v"))


NEAR = "JOIN voxels b ON b.img = a.img AND"


@query(f"{V} SELECT a.img, a.y, a.x, quantile_cont(b.v::DOUBLE, 0.5) AS v FROM voxels a {NEAR} abs(a.y - b.y) + abs(a.x - b.x) <= 1 GROUP BY ALL")
def median_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median of each pixel and its four neighbours."""
    return im.window_agg(vox(spark, sf_dir).withColumn("v", F.col("v").cast("double")), ["img"], "v", im.cross(), 8, 8, lambda c: F.percentile(F.col(c), 0.5), "v")


@query(f"""{V}, b AS (SELECT img, quantile_cont(v::DOUBLE, 0.001) AS l0, quantile_cont(v::DOUBLE, 0.999) AS h0, quantile_cont(v::DOUBLE, 0.005) AS l1, quantile_cont(v::DOUBLE, 0.995) AS h1 FROM voxels GROUP BY img),
s AS (SELECT fov, channel, img, y, x, CASE WHEN channel = 0 THEN least(greatest((v - l0) / CASE WHEN h0 > l0 THEN h0 - l0 ELSE 1 END, 0), 1) ELSE least(greatest((v - l1) / CASE WHEN h1 > l1 THEN h1 - l1 ELSE 1 END, 0), 1) END AS v FROM voxels JOIN b USING (img) WHERE channel < 2),
m AS (SELECT a.fov, a.y, a.x, quantile_cont(b.v, 0.5) AS v FROM s a JOIN s b ON b.img = a.img AND abs(a.y - b.y) + abs(a.x - b.x) <= 1 WHERE a.channel = 1 GROUP BY ALL)
SELECT s.fov, s.y, s.x, floor(s.v * (1 - m.v) * 255 + 0.5)::BIGINT AS v FROM s JOIN m USING (fov, y, x) WHERE s.channel = 0""")
def enhanced_nuclei(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nuclei (the first channel) dimmed where the membranes (the second) are bright: both stretched between their own quantiles, the membranes smoothed
    by the median of a pixel and its four neighbours and inverted, and the two multiplied."""
    v = vox(spark, sf_dir).where("channel < 2")
    p = lambda a, b: F.when(F.first("channel") == 0, F.percentile(F.col("v").cast("double"), a)).otherwise(F.percentile(F.col("v").cast("double"), b))
    v = bounds(v, ["img"], p(0.001, 0.005), p(0.999, 0.995))
    s = v.select("fov", "channel", "img", "y", "x", im.stretch(v, ["img"], "v", F.col("lo"), F.col("hi"), 0, 1).alias("v"))
    membrane = im.window_agg(s.where("channel = 1"), ["fov"], "v", im.cross(), 8, 8, lambda c: F.percentile(F.col(c), 0.5), "m")
    out = s.where("channel = 0").join(membrane, ["fov", "y", "x"])
    return out.select("fov", "y", "x", F.floor(F.col("v") * (1 - F.col("m")) * 255 + 0.5).alias("v"))


@query(f"""{V}, lo AS (SELECT a.img, a.y, a.x, min(b.v) AS v FROM voxels a {NEAR} (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 4 GROUP BY ALL),
op AS (SELECT a.img, a.y, a.x, max(b.v) AS v FROM lo a JOIN lo b ON b.img = a.img AND (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 4 GROUP BY ALL)
SELECT a.img, a.y, a.x, a.v - op.v AS tophat FROM voxels a JOIN op USING (img, y, x)""")
def tophat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The white top-hat by a disk."""
    return im.top_hat(vox(spark, sf_dir), ["img"], "v", 2, 8, 8).select("img", "y", "x", "tophat")


@query(f"{V}, {MASK} SELECT DISTINCT a.img, a.y, a.x FROM voxels a JOIN mask b ON b.img = a.img AND (a.y - b.y) ** 2 + (a.x - b.x) ** 2 <= 4")
def dilate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mask widened by a disk."""
    return im.spread(mask(spark, sf_dir), ["img"], [], im.disk(2), 8, 8).select("img", "y", "x").distinct()


@query(f"{V} SELECT a.img, a.y, a.x, min(b.v) AS v FROM voxels a {NEAR} abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL")
def erode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least value among each pixel and its eight neighbours."""
    return im.window_agg(vox(spark, sf_dir), ["img"], "v", im.box(1), 8, 8, F.min, "v")


@query(f"""{V}, q AS (SELECT img, v // 10 AS b FROM voxels), h AS (SELECT img, b, count(*) AS n FROM q GROUP BY ALL),
c AS (SELECT img, b, sum(n) OVER w AS n0, sum(n * b) OVER w AS s0, sum(n) OVER (PARTITION BY img) AS n, sum(n * b) OVER (PARTITION BY img) AS s FROM h WINDOW w AS (PARTITION BY img ORDER BY b)),
g AS (SELECT img, b, round(((s * n0 - s0 * n)::DOUBLE ** 2) / (n0 * (n - n0))::DOUBLE, 3) AS g FROM c WHERE n0 < n)
SELECT img, b AS threshold FROM (SELECT img, b, row_number() OVER (PARTITION BY img ORDER BY g DESC, b) AS k FROM g) WHERE k = 1""")
def otsu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Otsu's threshold of each image, over values in steps."""
    return im.otsu(vox(spark, sf_dir).select("img", F.expr("v div 10").alias("b")), ["img"], "b")


@query(f"{V} SELECT a.img, a.y, a.x, coalesce(b.v, 0) AS v FROM voxels a LEFT JOIN voxels b ON b.img = a.img AND b.y = a.y - (a.img % 5 - 2) AND b.x = a.x - (a.img % 3 - 1)")
def apply_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images moved by whole pixels, zero where nothing moves in."""
    return im.shift(vox(spark, sf_dir).select("img", "y", "x", "v"), ["img"], "v", F.col("img") % 5 - 2, F.col("img") % 3 - 1, 8, 8)


@query(f"""{V}, a AS (SELECT img, y, x, v FROM voxels WHERE img % 4 = 0), b AS (SELECT img - 1 AS img, y, x, v FROM voxels WHERE img % 4 = 1),
c AS (SELECT a.img, (a.y - b.y + 8) % 8 AS dy, (a.x - b.x + 8) % 8 AS dx, abs(sum(a.v * b.v))::BIGINT AS s FROM a JOIN b USING (img) GROUP BY ALL),
r AS (SELECT img, dy, dx, s, row_number() OVER (PARTITION BY img ORDER BY s DESC, dx, dy) AS k FROM c)
SELECT img, CASE WHEN dy < 4 THEN dy ELSE dy - 8 END AS dy, CASE WHEN dx < 4 THEN dx ELSE dx - 8 END AS dx, s FROM r WHERE k = 1""")
def xcorr_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The circular shift that brings the second channel of a field onto the first, with the largest cross-correlation; by Fourier
    transforms, a field at a time."""
    v = vox(spark, sf_dir).where("img % 4 < 2").select((F.col("img") - F.col("img") % 4).alias("img"), (F.col("img") % 4).alias("channel"), "y", "x", "v")

    def run(p: pd.DataFrame) -> pd.DataFrame:
        a, b = (k.grid(p[p.channel == c], shape=(8, 8)) for c in (0, 1))
        if not (p.channel == 1).any() or not (p.channel == 0).any():
            return pd.DataFrame({"img": [], "dy": [], "dx": [], "s": []})
        dy, dx, _ = k.register(a, b)
        return pd.DataFrame({"img": [int(p.img.iloc[0])], "dy": [dy], "dx": [dx], "s": [int(round(float((a * np.roll(b, (dy, dx), (0, 1))).sum())))]})

    return v.groupBy("img").applyInPandas(run, "img long, dy long, dx long, s long")


@query(f"{V} SELECT a.img, a.y, a.x, a.v FROM voxels a WHERE a.v > 200 AND NOT EXISTS (SELECT 1 FROM voxels b WHERE b.img = a.img AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND (a.y <> b.y OR a.x <> b.x) AND b.v >= a.v)")
def local_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spots: pixels above a threshold and above all their neighbours."""
    return im.local_maxima(vox(spark, sf_dir).select("img", "y", "x", "v"), ["img"], "v", 8, 8).where("v > 200")


@query(f"{V}, m AS (SELECT img, max(v) * 0.2 AS t FROM voxels GROUP BY img) SELECT img, count(*) FILTER (WHERE v > t) AS adaptive, count(*) FILTER (WHERE v > 255 * 0.2) AS fixed FROM voxels JOIN m USING (img) GROUP BY img")
def adaptive_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels above a share of their channel's largest value, and of the type's."""
    v = vox(spark, sf_dir)
    t = v.groupBy("img").agg((F.max("v") * 0.2).alias("t"))
    return v.join(t, "img").groupBy("img").agg(F.count_if(F.col("v") > F.col("t")).alias("adaptive"), F.count_if(F.col("v") > 255 * 0.2).alias("fixed"))


COMPONENTS = f"""WITH RECURSIVE {fx.VOXELS}, {MASK}, r(img, y, x, label) AS (SELECT img, y, x, y * 8 + x FROM mask
  UNION SELECT b.img, b.y, b.x, r.label FROM r JOIN mask b ON b.img = r.img AND abs(b.y - r.y) <= 1 AND abs(b.x - r.x) <= 1),
lab AS (SELECT img, y, x, min(label) AS label FROM r GROUP BY ALL)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return im.components(mask(spark, sf_dir), ["img"], 8)


@query(f"{COMPONENTS} SELECT img, y, x, label FROM lab")
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Connected components of a mask."""
    return labelled(spark, sf_dir)


@query(f"{COMPONENTS}, n AS (SELECT img, label, count(*) AS n FROM lab GROUP BY ALL) SELECT img, y, x, label FROM lab JOIN n USING (img, label) WHERE n BETWEEN 3 AND 20")
def remove_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of a size between two bounds."""
    lab = labelled(spark, sf_dir)
    n = lab.groupBy("img", "label").agg(F.count("*").alias("n")).where("n between 3 and 20").select("img", "label")
    return lab.join(n, ["img", "label"], "left_semi").select("img", "y", "x", "label")


SEEDS = "seeds AS (SELECT img, y, x, y * 8 + x + 1 AS label FROM voxels WHERE v > 300)"


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vox(spark, sf_dir).where("v > 300").select("img", "y", "x", (F.col("y") * 8 + F.col("x") + 1).alias("label"))


@query(f"""{V}, {SEEDS}, d AS (SELECT a.img, a.y, a.x, s.label, row_number() OVER (PARTITION BY a.img, a.y, a.x ORDER BY (a.y - s.y) ** 2 + (a.x - s.x) ** 2, s.label) AS k
  FROM voxels a JOIN seeds s ON s.img = a.img AND (a.y - s.y) ** 2 + (a.x - s.x) ** 2 <= 9) SELECT img, y, x, label FROM d WHERE k = 1""")
def expand_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels grown by a distance."""
    return im.expand_labels(seeds(spark, sf_dir), ["img"], 3, 8, 8)


GROWN = f"""{V}, {SEEDS}, d AS (SELECT a.img, a.y, a.x, s.label, row_number() OVER (PARTITION BY a.img, a.y, a.x ORDER BY (a.y - s.y) ** 2 + (a.x - s.x) ** 2, s.label) AS k
  FROM voxels a JOIN seeds s ON s.img = a.img AND (a.y - s.y) ** 2 + (a.x - s.x) ** 2 <= 9), lab AS (SELECT img, y, x, label FROM d WHERE k = 1)"""


@query(f"{GROWN} SELECT img, label, count(*) AS area, round(avg(y), 6) AS cy, round(avg(x), 6) AS cx, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1, max(v) AS top FROM lab JOIN voxels USING (img, y, x) GROUP BY ALL")
def region_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area, centre, bounds and brightest value of each label."""
    lab = expand_labels(spark, sf_dir).join(vox(spark, sf_dir).select("img", "y", "x", "v"), ["img", "y", "x"])
    return lab.groupBy("img", "label").agg(
        F.count("*").alias("area"), F.round(F.avg("y"), 6).alias("cy"), F.round(F.avg("x"), 6).alias("cx"),
        F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.max("v").alias("top"),
    )


@query(f"""{GROWN} SELECT l.img, l.y, l.x, l.label FROM lab l WHERE EXISTS (SELECT 1 FROM voxels a LEFT JOIN lab b ON b.img = a.img AND b.y = a.y AND b.x = a.x
  WHERE a.img = l.img AND abs(a.y - l.y) + abs(a.x - l.x) = 1 AND b.label IS DISTINCT FROM l.label)""")
def boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels at the border of their label."""
    return im.boundaries(expand_labels(spark, sf_dir), ["img"], 8, 8)


@query(f"{GROWN} SELECT l.img, l.y, l.x, greatest(l.label - CASE WHEN v > 150 THEN 20 ELSE 0 END, 0) AS cyto FROM lab l JOIN voxels USING (img, y, x)")
def cyto_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell labels less nucleus labels, not below zero."""
    lab = expand_labels(spark, sf_dir).join(vox(spark, sf_dir).select("img", "y", "x", "v"), ["img", "y", "x"])
    return lab.select("img", "y", "x", F.greatest(F.col("label") - F.when(F.col("v") > 150, 20).otherwise(0), F.lit(0)).alias("cyto"))


@query(f"""{V}, a AS (SELECT img, y, x FROM voxels WHERE v > 150), b AS (SELECT img, y, x FROM voxels WHERE (y + x) % 3 = 0)
SELECT 'and' AS op, count(*) AS n FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'or', count(*) FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'minus', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def mask_set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """And, or and difference of two masks."""
    v = vox(spark, sf_dir)
    a, b = v.where("v > 150").select("img", "y", "x"), v.where("(y + x) % 3 = 0").select("img", "y", "x")
    parts = [("and", a.intersect(b)), ("or", a.union(b).distinct()), ("minus", a.subtract(b))]
    rows = [d.agg(F.count("*").alias("n")).select(F.lit(k).alias("op"), "n") for k, d in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(f"""{V} SELECT img, CASE img % 4 WHEN 0 THEN y WHEN 1 THEN 7 - x WHEN 2 THEN 7 - y ELSE x END AS y, CASE img % 4 WHEN 0 THEN x WHEN 1 THEN y WHEN 2 THEN 7 - x ELSE 7 - y END AS x, v FROM voxels""")
def rotate90(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images turned by no, one, two or three quarters, in turn."""
    v = vox(spark, sf_dir)
    y, x = im.turned(F.col("img") % 4, 8, 8)
    return v.select("img", y.alias("y"), x.alias("x"), "v")


@query(f"{V} SELECT img, 7 - y AS y, CASE WHEN img % 3 = 0 THEN 7 - x ELSE x END AS x, v FROM voxels")
def flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images mirrored up and down, and a third of them left and right too."""
    x = F.when(F.col("img") % 3 == 0, 7 - F.col("x")).otherwise(F.col("x"))
    return vox(spark, sf_dir).select("img", (7 - F.col("y")).alias("y"), x.alias("x"), "v")


@query(f"""{V}, c AS (SELECT * FROM voxels WHERE y < 8 - img % 3 AND x < 8 - img % 2), s AS (SELECT fov, img, max(y) AS my, max(x) AS mx FROM c GROUP BY ALL), l AS (SELECT fov, min(my) AS my, min(mx) AS mx FROM s GROUP BY fov)
SELECT c.fov, count(*) AS n, sum(v)::BIGINT AS total FROM c JOIN l USING (fov) WHERE y <= my AND x <= mx GROUP BY c.fov""")
def crop_min_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of a field cut to the least size among them."""
    c = vox(spark, sf_dir).where("y < 8 - img % 3 and x < 8 - img % 2")
    size = c.groupBy("fov", "img").agg(F.max("y").alias("my"), F.max("x").alias("mx")).groupBy("fov").agg(F.min("my").alias("my"), F.min("mx").alias("mx"))
    return c.join(size, "fov").where("y <= my and x <= mx").groupBy("fov").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@query(f"{V} SELECT img, y, x, least(round(v * 16 / 257.0)::BIGINT, 255) AS v FROM voxels")
def to_uint8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen-bit values brought to eight bits."""
    return vox(spark, sf_dir).select("img", "y", "x", F.least(F.round(F.col("v") * 16 / 257.0).cast("long"), F.lit(255)).alias("v"))


@query(f"{V} SELECT a.img, a.y, a.x, sum(b.v * (2 - abs(a.y - b.y)) * (2 - abs(a.x - b.x)))::BIGINT AS v FROM voxels a {NEAR} abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL")
def smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A separable binomial blur, not divided by its weight."""
    s = im.spread(vox(spark, sf_dir), ["img"], ["v"], im.box(1), 8, 8)
    return s.groupBy("img", "y", "x").agg(F.sum(F.col("v") * (2 - F.abs("dy")) * (2 - F.abs("dx"))).alias("v"))


@query(f"{V}, h AS (SELECT fov, y // 2 AS y, x // 2 AS x, channel, avg(v) AS v FROM voxels GROUP BY ALL) SELECT fov, channel, y, x, round(v, 6) AS v FROM h")
def downscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images at half their size, by the mean of blocks."""
    return vox(spark, sf_dir).groupBy("fov", F.expr("y div 2").alias("y"), F.expr("x div 2").alias("x"), "channel").agg(F.round(F.avg("v"), 6).alias("v"))
