"""Queries that run a kernel on each image."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import kernels as k
from tessera.operators import spatial as sp
from tessera.plans import spatial
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

#: Height and width of the images; a channel may lack pixels at its edges.
SHAPE = (8, 8)


@query(f"""WITH {fx.VOXELS}, a AS (SELECT img, y, x, v FROM voxels WHERE img % 4 = 0), b AS (SELECT img - 1 AS img, y, x, v FROM voxels WHERE img % 4 = 1),
c AS (SELECT a.img, (a.y - b.y + 8) % 8 AS dy, (a.x - b.x + 8) % 8 AS dx, abs(sum(a.v * b.v))::BIGINT AS s FROM a JOIN b USING (img) GROUP BY ALL),
r AS (SELECT img, dy, dx, row_number() OVER (PARTITION BY img ORDER BY s DESC, dx, dy) AS k FROM c)
SELECT img, CASE WHEN dy < 4 THEN dy ELSE dy - 8 END AS dy, CASE WHEN dx < 4 THEN dx ELSE dx - 8 END AS dx FROM r WHERE k = 1""")
def fft_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shift between two channels of every field, by fast Fourier transforms."""
    v = fx.voxels(spark, sf_dir).where("channel < 2")

    def run(p: pd.DataFrame) -> pd.DataFrame:
        a, b = p[p.channel == 0], p[p.channel == 1]
        if not len(a) or not len(b):
            return pd.DataFrame({"img": [], "dy": [], "dx": []})
        dy, dx, _ = k.register(k.grid(a, shape=SHAPE), k.grid(b, shape=SHAPE))
        return pd.DataFrame({"img": [int(a.img.iloc[0])], "dy": [dy], "dx": [dx]})

    return v.groupBy("fov").applyInPandas(run, "img long, dy long, dx long")


def each(spark: SparkSession, sf_dir: str, f, name: str = "v", kind: str = "long") -> DataFrame:
    def run(p: pd.DataFrame) -> pd.DataFrame:
        out = k.pixels(f(k.grid(p, shape=SHAPE)), name)
        out.insert(0, "img", int(p.img.iloc[0]))
        return out

    v = fx.voxels(spark, sf_dir).select("img", "y", "x", "v")
    return v.groupBy("img").applyInPandas(run, f"img long, y long, x long, {name} {kind}")


@query()
def morph_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images without their background, by reconstruction."""
    return each(spark, sf_dir, lambda a: np.round(k.remove_background(a, 3)).astype(int))


@query()
def watershed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels flooded from bright pixels, with lines between them."""

    def run(a):
        markers = np.where(a >= np.quantile(a, 0.95), np.arange(a.size).reshape(a.shape) + 1, 0)
        return k.watershed(-a, markers, a > np.quantile(a, 0.3))

    return each(spark, sf_dir, run, "label")


@query(f"""WITH RECURSIVE {fx.VOXELS}, q AS (SELECT img, quantile_cont(v, 0.5) AS m FROM voxels GROUP BY img), bg AS (SELECT img, y, x FROM voxels JOIN q USING (img) WHERE v <= m),
r(img, y, x) AS (SELECT img, y, x FROM bg WHERE y IN (0, 7) OR x IN (0, 7) UNION SELECT b.img, b.y, b.x FROM r JOIN bg b ON b.img = r.img AND abs(b.y - r.y) + abs(b.x - r.x) = 1)
SELECT v.img, v.y, v.x, CASE WHEN r.img IS NULL THEN 1 ELSE 0 END::BIGINT AS filled FROM voxels v LEFT JOIN r ON r.img = v.img AND r.y = v.y AND r.x = v.x""")
def fill_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks with their holes filled."""
    return each(spark, sf_dir, lambda a: k.fill_holes(a > np.quantile(a, 0.5)).astype(int), "filled")


@query(f"""WITH {fx.VOXELS}, f AS (SELECT fov, channel, y, x, v, min(channel) OVER (PARTITION BY fov) AS c0 FROM voxels), t AS (SELECT fov, channel, greatest(max(v), 1)::DOUBLE AS top FROM f GROUP BY ALL),
h AS (SELECT t.fov, t.channel, greatest(t.top, l.top) AS high FROM t JOIN t l ON l.fov = t.fov JOIN (SELECT DISTINCT fov, c0 FROM f) z ON z.fov = l.fov AND z.c0 = l.channel),
own AS (SELECT f.fov, f.channel, y, x, least(floor(v / high * 64), 63)::BIGINT AS b, high FROM f JOIN h ON h.fov = f.fov AND h.channel = f.channel),
lik AS (SELECT h.fov, h.channel, least(floor(f.v / high * 64), 63)::BIGINT AS b FROM h JOIN f ON f.fov = h.fov AND f.channel = f.c0),
bins AS (SELECT unnest(range(64)) AS b), ca AS (SELECT p.fov, p.channel, p.b, count(o.b) / 64 AS c FROM (SELECT DISTINCT fov, channel, b FROM own) p JOIN own o ON o.fov = p.fov AND o.channel = p.channel AND o.b <= p.b GROUP BY ALL),
cl AS (SELECT h.fov, h.channel, bins.b, count(l.b) / 64 AS c FROM h CROSS JOIN bins LEFT JOIN lik l ON l.fov = h.fov AND l.channel = h.channel AND l.b <= bins.b GROUP BY ALL),
m AS (SELECT ca.fov, ca.channel, ca.b, arg_min(cl.b, (round(abs(ca.c - cl.c), 9), cl.b)) AS to_b FROM ca JOIN cl ON cl.fov = ca.fov AND cl.channel = ca.channel GROUP BY ALL)
SELECT own.fov, own.channel, y, x, round((to_b + 0.5) / 64 * high, 8) AS v FROM own JOIN m ON m.fov = own.fov AND m.channel = own.channel AND m.b = own.b""")
def histogram_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every channel of a field with the distribution of its first."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        images = {c: k.grid(g, shape=SHAPE) for c, g in p.groupby("channel")}
        like = images[min(images)]
        out = []
        for c, a in images.items():
            q = k.pixels(np.round(k.match_histogram(a, like), 8))
            q.insert(0, "channel", c)
            q.insert(0, "fov", int(p.fov.iloc[0]))
            out.append(q)
        return pd.concat(out)

    return fx.voxels(spark, sf_dir).groupBy("fov").applyInPandas(run, "fov long, channel long, y long, x long, v double")


@query()
def local_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean displacement that carries a field's second channel onto its first."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        a, b = p[p.channel == 0], p[p.channel == 1]
        if not len(a) or not len(b):
            return pd.DataFrame({"fov": [], "dy": [], "dx": []})
        u = k.demons(k.grid(a, shape=SHAPE), k.grid(b, shape=SHAPE))
        return pd.DataFrame({"fov": [int(p.fov.iloc[0])], "dy": [round(float(u[0].mean()), 6)], "dx": [round(float(u[1].mean()), 6)]})

    return fx.voxels(spark, sf_dir).where("channel < 2").groupBy("fov").applyInPandas(run, "fov long, dy double, dx double")


@query()
def cell_hulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline of each cell's reads."""

    r = fx.reads(spark, sf_dir).where("seg_label > 0")
    return sp.hulls(r, "seg_label", "x", "y")


MARCH = f"""{spatial.NEAREST}, o AS (SELECT n.seg_label, n.object_id, c.x::DOUBLE AS x, c.y::DOUBLE AS y, cx, cy, objects.area AS area, sqrt(d2) AS d FROM near n JOIN cells c USING (seg_label) JOIN objects USING (object_id)),
s AS (SELECT *, unnest(range(least(1000, floor(d)::BIGINT + 1) + 1)) AS k FROM o),
p AS (SELECT seg_label, object_id, x, y, cx, cy, area, k, floor(x + CASE WHEN d > 0 THEN k * (cx - x) / d ELSE 0 END + 0.5) AS px, floor(y + CASE WHEN d > 0 THEN k * (cy - y) / d ELSE 0 END + 0.5) AS py FROM s),
hit AS (SELECT seg_label, object_id, min(k) AS k FROM p WHERE ((px - cx) * (px - cx) + (py - cy) * (py - cy)) * 3.141592653589793 <= area GROUP BY ALL)
SELECT o.seg_label, o.object_id, coalesce(round(sqrt((p.px - o.x) ** 2 + (p.py - o.y) ** 2), 6), -1) AS d FROM o LEFT JOIN hit ON hit.seg_label = o.seg_label LEFT JOIN p ON p.seg_label = hit.seg_label AND p.k = hit.k"""


@query(MARCH)
def border_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distance of each cell to the border of its nearest structure: along the line to its centre, pixel by pixel up to a thousand, to
    the first pixel that is the structure's; -1 where none is met. Structures are disks of their area here."""
    o = fx.objects(spark, sf_dir)
    cells = spatial.near(spark, sf_dir).join(fx.cells(spark, sf_dir).select("seg_label", "x", "y"), "seg_label").join(o, "object_id")
    inside = lambda px, py: ((px - F.col("cx")) * (px - F.col("cx")) + (py - F.col("cy")) * (py - F.col("cy"))) * 3.141592653589793 <= F.col("area")
    way = ["x", "y", "cx", "cy", "area"]  # cells at one place go one way
    d = sp.march(F.col("x"), F.col("y"), F.col("cx"), F.col("cy"), inside, 1000)
    ways = cells.select(*way).distinct().withColumn("d", F.round(d, 6))
    return cells.join(ways, way).select("seg_label", "object_id", "d")
