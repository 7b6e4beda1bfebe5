"""Queries over volumes: the channels of a field as its planes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import images as im
from tessera.operators import kernels as k
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

VOLUMES = f"{fx.VOXELS}, vol AS (SELECT fov, channel AS z, y, x, v // 40 AS v FROM voxels)"
NEXT = "abs(b.z - a.z) <= 1 AND abs(b.y - a.y) <= 1 AND abs(b.x - a.x) <= 1"


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.voxels(spark, sf_dir).select("fov", F.col("channel").alias("z"), "y", "x", F.expr("v div 40").alias("v"))


@query(f"""WITH RECURSIVE {VOLUMES}, t AS (SELECT fov, max(v) * 0.2 AS t FROM vol GROUP BY fov), cand AS (SELECT vol.* FROM vol JOIN t USING (fov) WHERE v > t),
r(fov, z, y, x, v, label) AS (SELECT fov, z, y, x, v, (z * 8 + y) * 8 + x FROM cand UNION SELECT b.fov, b.z, b.y, b.x, b.v, a.label FROM r a JOIN cand b ON b.fov = a.fov AND b.v = a.v AND {NEXT}),
lab AS (SELECT fov, z, y, x, v, min(label) AS label FROM r GROUP BY ALL), low AS (SELECT DISTINCT a.fov, a.label FROM lab a JOIN vol b ON b.fov = a.fov AND b.v > a.v AND {NEXT})
SELECT lab.fov, floor(avg(z) + 0.5)::BIGINT AS z, floor(avg(y) + 0.5)::BIGINT AS y, floor(avg(x) + 0.5)::BIGINT AS x, count(*) AS n_voxels, any_value(v) AS v
FROM lab LEFT JOIN low ON low.fov = lab.fov AND low.label = lab.label WHERE low.fov IS NULL GROUP BY lab.fov, lab.label""")
def spots_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional maxima of volumes above a share of their largest value, plateaus as one spot at their centre."""
    v = volumes(spark, sf_dir)
    top = v.groupBy("fov").agg((F.max("v") * 0.2).alias("t"))
    return im.regional_maxima(v.join(top, "fov"), ["fov"], "v", "t")


@query(f"""WITH {fx.VOXELS}, o AS (SELECT a.dy, b.dx FROM (SELECT unnest(range(-4, 6)) AS dy) a, (SELECT unnest(range(-4, 6)) AS dx) b)
SELECT v.img, v.y, v.x, quantile_cont(coalesce(n.v, 0)::DOUBLE, 0.5) AS v FROM voxels v CROSS JOIN o LEFT JOIN voxels n ON n.img = v.img AND n.y = v.y + dy AND n.x = v.x + dx GROUP BY v.img, v.y, v.x""")
def median_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median of the ten by ten pixels around each pixel, with zeros beyond the edge."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        out = k.pixels(k.median(k.grid(p, shape=(8, 8)), 10))
        out.insert(0, "img", int(p.img.iloc[0]))
        return out

    return fx.voxels(spark, sf_dir).select("img", "y", "x", "v").groupBy("img").applyInPandas(run, "img long, y long, x long, v double")


@query(f"""WITH RECURSIVE {fx.VOXELS}, s AS (SELECT a.img, a.y, a.x, sum(b.v * (2 - abs(a.y - b.y)) * (2 - abs(a.x - b.x))) / 16 AS v FROM voxels a JOIN voxels b ON b.img = a.img AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL),
m AS (SELECT img, y, x FROM s WHERE v > 50), r(img, y, x, label) AS (SELECT img, y, x, y * 8 + x FROM m UNION SELECT b.img, b.y, b.x, r.label FROM r JOIN m b ON b.img = r.img AND abs(b.y - r.y) <= 1 AND abs(b.x - r.x) <= 1),
lab AS (SELECT img, y, x, min(label) AS label FROM r GROUP BY ALL), n AS (SELECT img, label, count(*) AS n FROM lab GROUP BY ALL HAVING count(*) BETWEEN 10 AND 500)
SELECT img, count(*) AS n_objects, sum(n)::BIGINT AS n_pixels FROM n GROUP BY img""")
def protein_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects in blurred images above a fixed value, of a size within bounds."""
    s = im.spread(fx.voxels(spark, sf_dir), ["img"], ["v"], im.box(1), 8, 8)
    s = s.groupBy("img", "y", "x").agg((F.sum(F.col("v") * (2 - F.abs("dy")) * (2 - F.abs("dx"))) / 16).alias("v")).where("v > 50")
    n = im.components(s, ["img"], 8).groupBy("img", "label").agg(F.count("*").alias("n")).where("n between 10 and 500")
    return n.groupBy("img").agg(F.count("*").alias("n_objects"), F.sum("n").alias("n_pixels"))


@query(f"""WITH {fx.VOXELS}, o AS (SELECT unnest(range(2)) AS d), up AS (SELECT img, 2 * y + a.d AS y, 2 * x + b.d AS x, v FROM voxels, o a, o b) SELECT img, y, x, v FROM up""")
def upscale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images at twice their size, each pixel as a block."""
    two = F.explode(F.expr("transform(sequence(0, 3), k -> struct(k div 2 as dy, k % 2 as dx))")).alias("o")
    return fx.voxels(spark, sf_dir).select("img", "y", "x", "v", two).select("img", (2 * F.col("y") + F.col("o.dy")).alias("y"), (2 * F.col("x") + F.col("o.dx")).alias("x"), "v")


@query(f"""WITH {VOLUMES}, lab AS (SELECT fov, y, x, 1 + (y // 4) * 2 + x // 4 AS label FROM vol WHERE z = 0 AND v > 1), n AS (SELECT fov, z, y, x FROM vol WHERE v > 3)
SELECT v.fov, v.z, v.y, v.x, l.label, CASE WHEN n.fov IS NULL THEN l.label ELSE 0 END AS cyto FROM vol v JOIN lab l ON l.fov = v.fov AND l.y = v.y AND l.x = v.x LEFT JOIN n ON n.fov = v.fov AND n.z = v.z AND n.y = v.y AND n.x = v.x WHERE v.v > 0""")
def labels_by_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat label image taken into every slice's mask, and what of it lies outside the nuclei."""
    v = volumes(spark, sf_dir)
    lab = v.where("z = 0 and v > 1").select("fov", "y", "x", F.expr("1 + (y div 4) * 2 + x div 4").alias("label"))
    n = v.where("v > 3").select("fov", "z", "y", "x", F.col("z").alias("nucleus"))
    out = v.where("v > 0").join(lab, ["fov", "y", "x"]).join(n, ["fov", "z", "y", "x"], "left")
    return out.select("fov", "z", "y", "x", "label", F.when(F.col("nucleus").isNull(), F.col("label")).otherwise(0).alias("cyto"))


@query(f"""WITH RECURSIVE {fx.VOXELS}, h AS (SELECT img, v // 10 AS b, count(*) AS n FROM voxels GROUP BY ALL),
c AS (SELECT img, b, sum(n) OVER w AS n0, sum(n * b) OVER w AS s0, sum(n) OVER (PARTITION BY img) AS n, sum(n * b) OVER (PARTITION BY img) AS s FROM h WINDOW w AS (PARTITION BY img ORDER BY b)),
g AS (SELECT img, b, round(((s * n0 - s0 * n)::DOUBLE ** 2) / (n0 * (n - n0))::DOUBLE, 3) AS g FROM c WHERE n0 < n),
t AS (SELECT img, b FROM (SELECT img, b, row_number() OVER (PARTITION BY img ORDER BY g DESC, b) AS k FROM g) WHERE k = 1), m AS (SELECT v.img, y, x FROM voxels v JOIN t ON t.img = v.img WHERE v.v // 10 > t.b),
r(img, y, x, label) AS (SELECT img, y, x, y * 8 + x FROM m UNION SELECT b.img, b.y, b.x, r.label FROM r JOIN m b ON b.img = r.img AND abs(b.y - r.y) <= 1 AND abs(b.x - r.x) <= 1),
lab AS (SELECT img, y, x, min(label) AS label FROM r GROUP BY ALL), n AS (SELECT img, label, count(*) AS n FROM lab GROUP BY ALL)
SELECT img, max(n) AS largest, max(n) > 12 AS segment FROM n GROUP BY img""")
def segmentation_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an image is worth segmenting: the largest component above Otsu's threshold against a least size."""
    v = fx.voxels(spark, sf_dir).select("img", "y", "x", F.expr("v div 10").alias("b"))
    m = v.join(im.otsu(v, ["img"], "b"), "img").where("b > threshold")
    n = im.components(m, ["img"], 8).groupBy("img", "label").agg(F.count("*").alias("n"))
    return n.groupBy("img").agg(F.max("n").alias("largest"), (F.max("n") > 12).alias("segment"))
