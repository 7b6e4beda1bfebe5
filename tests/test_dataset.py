"""The facade: filtering with scores, boxes in depth, colours that aren't numbers, saved signals and tiles."""

import math
import random

from pyspark.sql import functions as F

from tessera.functions import barcodes as bc
from tessera.plans.dataset import Dataset
from tessera.operators import stitch

IMAGES = "fov long, round long, channel long, z long, y long, x long, v long"


def decoded(colors, first):
    out = first
    for c in colors:
        out += "ACGT"["ACGT".index(out[-1]) ^ (int(c) - 1)]
    return out


def calls(spark, n=400, fields=2):
    rng = random.Random(1)
    rows = [(k, k % fields + 1, 0, k % 7, k % 5, "".join(rng.choice("1234" if rng.random() < 0.97 else "NM") for _ in range(5))) for k in range(n)]
    book = sorted({r[5] for r in rows if not set(r[5]) & set("NM")})[::3]
    d = spark.createDataFrame(rows, "spot_id long, fov long, z long, y long, x long, color_seq string").withColumn("scores", F.array(F.lit(0.5), F.lit(1.5)))
    codebook = spark.createDataFrame([(c, f"g{k}") for k, c in enumerate(book)], "color_seq string, gene string")
    return rows, set(book), Dataset(None, 8, 8, calls=d, codebook=codebook)


def test_filtering_with_end_bases(spark):
    rows, book, d = calls(spark)
    out = d.filter_reads(["CC", "AT"])
    assert {r.spot_id for r in out.reads.collect()} == {r[0] for r in rows if r[5] in book}
    for s in out.scores.collect():
        good = [r[5] for r in rows if r[1] == s.fov and not set(r[5]) & set("NM")]
        hit = sum(c in book for c in good)
        assert s.total == len(good) and math.isclose(s.in_codebook, hit / len(good))
        for k, ends in ((1, "CC"), (2, "AT")):
            form = sum(decoded(c, ends[0]).endswith(ends[1]) for c in good)
            assert math.isclose(s[f"form_{k}"], form / len(good)) and math.isclose(s[f"per_form_{k}"], hit / form)


def test_filtering_by_segments(spark):
    rows, book, d = calls(spark)
    out = d.filter_reads(["CC", "AT"], cuts=[3])
    for s in out.scores.collect():
        good = [r[5] for r in rows if r[1] == s.fov and not set(r[5]) & set("NM")]
        for k, (ends, part) in enumerate((("CC", slice(0, 2)), ("AT", slice(2, None))), 1):
            assert math.isclose(s[f"form_{k}"], sum(decoded(c[part], ends[0]).endswith(ends[1]) for c in good) / len(good))
        assert "per_form_1" not in s


def test_nothing_in_the_codebook(spark):
    _, _, d = calls(spark)
    none = Dataset(None, 8, 8, calls=d.calls, codebook=d.codebook.where("false"))
    out = none.filter_reads(["CC"])
    assert out.reads.count() == 0 and all(s.in_codebook == 0 and s.per_form_1 == 0 for s in out.scores.collect())


def test_colors_of_values_that_are_no_numbers(spark):
    nan = float("nan")
    d = spark.createDataFrame([([1.0, nan, 2.0],), ([nan] * 3,), ([0.0, 0.0, 0.0],), ([1.0, 3.0, 3.0],), ([1.0, 5.0, 3.0],), ([1.0, None, 3.0],)], "v array<double>")
    assert [r.c.color for r in d.select(bc.call_color(F.col("v")).alias("c")).collect()] == ["N", "N", "M", "M", "2", "N"]


def volume(spark, depth=4, size=9):
    rng = random.Random(2)
    return [(1, r, c, z, y, x, rng.randrange(200)) for r in range(2) for c in range(3) for z in range(depth) for y in range(size) for x in range(size)]


def test_boxes_in_depth(spark):
    rows = volume(spark)
    v = {r[1:6]: r[6] for r in rows}
    spots = [(k, 1, z, y, x) for k, (z, y, x) in enumerate([(0, 0, 0), (1, 4, 4), (3, 8, 8), (2, 1, 7)])]
    d = Dataset(spark.createDataFrame(rows, IMAGES), 9, 9, spots=spark.createDataFrame(spots, "spot_id long, fov long, z long, y long, x long"))
    got = {r.spot_id: r.color_seq for r in d.extract().calls.collect()}
    for k, _, z, y, x in spots:
        want = ""
        for r in range(2):
            sums = [sum(v.get((r, c, a, b, e), 0) for a in range(z - 1, z + 2) for b in range(y - 2, y + 3) for e in range(x - 2, x + 3)) for c in range(3)]
            want += str(sums.index(max(sums)) + 1) if sums.count(max(sums)) == 1 else "M"
        assert got[k] == want


def test_projections(spark):
    rows = volume(spark)
    d = Dataset(spark.createDataFrame(rows, IMAGES), 9, 9)
    for how, f in (("max", max), ("sum", sum)):
        got = {(r["round"], r.channel, r.y, r.x): r.v for r in d.project(how).images.collect()}
        assert got == {k: f(r[6] for r in rows if (r[1], r[2], r[4], r[5]) == k) for k in got} and len(got) == 2 * 3 * 81


def test_saved_signal(spark, tmp_path):
    rows, book, d = calls(spark)
    out = d.filter_reads()
    out.save_signal(f"{tmp_path}/good")
    assert spark.read.csv(f"{tmp_path}/good", header=True).count() == out.reads.count()
    out.save_signal(f"{tmp_path}/all", "allSpots", "all")
    back = spark.read.csv(f"{tmp_path}/all", header=True)
    assert back.count() == len(rows) and {"color_seq", "scores", "fov"} <= set(back.columns)


def test_tiles(spark, tmp_path):
    rows = [(f, 0, 0, 0, y, x, y * 100 + x + f) for f in (1, 2) for y in range(40) for x in range(40)]
    d = Dataset(spark.createDataFrame(rows, IMAGES), 40, 40)
    d.save_subtiles(f"{tmp_path}/tiles", 2, 0.2)
    for t in stitch.subtiles(spark, 40, 40, 2, 0.2).collect():
        tile = Dataset.load_subtile(spark, f"{tmp_path}/tiles", 2, t.t)
        assert (tile.height, tile.width) == (t.inputdim_x, t.inputdim_y)
        got = {(r.y, r.x): r.v for r in tile.images.collect()}
        assert got == {(y, x): (y + t.scoords_x - 1) * 100 + x + t.scoords_y - 1 + 2 for y in range(t.inputdim_x) for x in range(t.inputdim_y)}
