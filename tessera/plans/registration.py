"""Queries over smoothed images and fields of displacements."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import fourier, registration, tiles
from tessera.plans.registry import query
from tessera.sources import fixtures as fx

SIGMA, REACH = 1.5, 6
WEIGHTS = [math.exp(-0.5 * (k / SIGMA) ** 2) for k in range(-REACH, REACH + 1)]
WEIGHTS = [w / sum(WEIGHTS) for w in WEIGHTS]


@query(f"""WITH {fx.VOXELS}, k(d, w) AS (VALUES {", ".join(f"({d - REACH}, {w!r}::DOUBLE)" for d, w in enumerate(WEIGHTS))}), p AS (SELECT img, y, x FROM voxels),
q AS (SELECT p.img, p.y, p.x, i.w * j.w AS w, least(greatest(p.y + i.d, 0), 7) AS sy, least(greatest(p.x + j.d, 0), 7) AS sx FROM p, k i, k j)
SELECT q.img, q.y, q.x, round(sum(w * v), 6) AS blurred FROM q JOIN voxels v ON v.img = q.img AND v.y = q.sy AND v.x = q.sx GROUP BY ALL""")
def gaussian_blur(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images blurred by a Gaussian."""
    v = fx.voxels(spark, sf_dir).select("img", "y", "x", "v")
    return tiles.gaussian(v, ["img"], "v", SIGMA, 8, 8).withColumn("blurred", F.round("blurred", 6))


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slides as two rounds of a field: smooth images, and the same with rows and columns moved by up to two pixels in waves."""
    v = tiles.gaussian(fx.slides(spark, sf_dir), ["slide"], "v", 2.0, fx.SLIDE, fx.SLIDE, 64)
    first = v.select(F.col("slide").alias("fov"), F.lit(0).cast("long").alias("channel"), F.lit(0).cast("long").alias("z"), "y", "x", F.col("blurred").alias("v"))
    wave = lambda c: F.rint(2 * F.sin(F.col(c) * (2 * math.pi / fx.SLIDE))).cast("long")
    second = first.select("fov", "channel", "z", (F.col("y") + wave("x")).alias("y"), "x", "v").where(F.col("y").between(0, fx.SLIDE - 1))
    return first.withColumn("round", F.lit(1).cast("long")).unionByName(second.withColumn("round", F.lit(2).cast("long")))


@query()
def displacement_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The displacement of each pixel between two rounds, found from coarse to fine in windows with a margin."""
    field = registration.local_field(rounds(spark, sf_dir), 1, fx.SLIDE, fx.SLIDE, levels=3, rounds=30, tile=64, margin=24)
    return field.select("fov", "round", "z", "y", "x", *[F.round(c, 4).alias(c) for c in registration.AXES])


@query()
def registration_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean difference between two rounds of each field before and after their local registration."""
    v = rounds(spark, sf_dir)
    field = registration.local_field(v, 1, fx.SLIDE, fx.SLIDE, levels=3, rounds=30, tile=64, margin=24)
    first = v.where("round = 1").drop("round")
    before = registration.gap(v.where("round = 2").drop("round"), first, ["fov"]).withColumnRenamed("gap", "before")
    moved = registration.warp(v.where("round = 2"), field, fx.SLIDE, fx.SLIDE, 64).drop("round")
    after = registration.gap(moved, first, ["fov"]).withColumnRenamed("gap", "after")
    return before.join(after, "fov").select("fov", F.round("before", 4).alias("before"), F.round("after", 4).alias("after"))


@query(f"""WITH {fx.VOXELS}, a AS (SELECT fov, channel, y, x, v FROM voxels), p AS (SELECT a.fov, b.channel, (a.y - b.y + 8) % 8 AS dy, (a.x - b.x + 8) % 8 AS dx, abs(sum(a.v * b.v))::BIGINT AS s FROM a JOIN a b ON b.fov = a.fov AND b.channel > 0 WHERE a.channel = 0 GROUP BY ALL),
r AS (SELECT fov, channel, dy, dx, row_number() OVER (PARTITION BY fov, channel ORDER BY s DESC, dy, dx) AS k FROM p)
SELECT fov, channel, CASE WHEN dy < 4 THEN dy ELSE dy - 8 END AS dy, CASE WHEN dx < 4 THEN dx ELSE dx - 8 END AS dx FROM r WHERE k = 1""")
def fft_register_strips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shift of each channel of a field against its first, by Fourier transforms in strips of three rows or columns."""
    v = fx.voxels(spark, sf_dir).select("fov", "channel", F.lit(0).cast("long").alias("z"), "y", "x", F.col("v").cast("double").alias("v"))
    first = v.where("channel = 0").select("fov", "z", "y", "x", F.col("v").alias("fixed"))
    both = v.where("channel > 0").withColumnRenamed("v", "moving").join(first, ["fov", "z", "y", "x"])
    return fourier.shifts(both, ["fov", "channel"], "fixed", "moving", (1, 8, 8), 3).drop("dz")
