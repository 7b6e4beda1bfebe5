import numpy as np
from pyspark.sql import functions as F

from tessera.config import RunConfig
from tessera.plans.dataset import Dataset
from tessera.sources import readers, sinks
from tessera.streaming import ingest


def test_stacks(spark, tmp_path):
    pages = [np.arange(12, dtype=np.uint16).reshape(3, 4) * 257, np.full((3, 4), 65535, np.uint16)]
    for fov in ("Position001", "Position002"):
        (tmp_path / "round1" / fov).mkdir(parents=True)
        (tmp_path / "round1" / fov / "img_ch00.tif").write_bytes(sinks.tiff_bytes(pages))
    px = readers.read_stacks(spark, str(tmp_path), convert_uint8=True)
    got = px.groupBy("round", "fov_id", "channel", "z").agg(F.sum("v").alias("s")).orderBy("fov_id", "z").collect()
    assert [tuple(r) for r in got[:2]] == [("round1", "Position001", "ch00", 0, 66), ("round1", "Position001", "ch00", 1, 255 * 12)]
    assert len(got) == 4
    again = sinks.stacks(px.where("fov_id = 'Position001'").select("fov_id", "z", "y", "x", "v"), ["fov_id"]).first()
    assert [p.sum() for p in readers.tiff_pages(bytes(again.tiff))] == [66, 255 * 12]


def test_text_sources(spark, tmp_path):
    (tmp_path / "genes.csv").write_text("A,CGCAC\nB,CAAAC\n")
    assert readers.read_codebook(spark, str(tmp_path / "genes.csv")).count() == 2
    (tmp_path / "Position003_goodSpots.csv").write_text("x,y,z,gene\n1,2,3,A\n")
    assert tuple(readers.read_reads(spark, str(tmp_path / "Position003_goodSpots.csv")).first()) == (1, 2, 3, "A", "Position003")
    (tmp_path / "stage.maf").write_text('<a><XYZStagePointDefinition StageXPos="1.5" StageYPos="2" PositionID="7" Sections="3"/></a>')
    assert tuple(readers.read_stage_xml(spark, str(tmp_path / "stage.maf")).first()) == (1.5, 2.0, "7", 3)
    (tmp_path / "d.xml").write_text(
        '<S><ViewRegistration setup="0"><ViewTransform><Name>a</Name><affine>1 0 0 5</affine></ViewTransform><ViewTransform><Name>b</Name><affine>1 0 0 6</affine></ViewTransform></ViewRegistration></S>'
    )
    assert {tuple(r) for r in readers.read_registration_xml(spark, str(tmp_path / "d.xml")).collect()} == {(0, "a", "1 0 0 5"), (0, "b", "1 0 0 6")}
    (tmp_path / "tiles.txt").write_text("# dimensions\ndim = 2\n\n# tiles\ntile_1.tif; ; (0.0, 1.0)\n")
    assert readers.read_tile_lines(spark, str(tmp_path / "tiles.txt")).count() == 1
    (tmp_path / "log.txt").write_text("12.5% assigned\nnumber of 40 cells\n")
    assert tuple(readers.read_logs(spark, str(tmp_path / "log.txt")).first())[1:] == (12.5, "40")


def test_sinks(spark, tmp_path):
    d = spark.createDataFrame([("P1", 1, 2, 3, "A", 9), ("P2", 4, 5, 6, "B", 9)], "fov_id string, x int, y int, z int, gene string, extra int")
    sinks.write_reads(d, str(tmp_path / "r"))
    assert sorted(spark.read.csv(str(tmp_path / "r"), header=True).columns) == ["fov_id", "gene", "x", "y", "z"]
    sinks.write_matrix(d, str(tmp_path / "m"), "x", "gene", "z", ["A", "B"])
    assert spark.read.csv(str(tmp_path / "m"), header=True).columns == ["x", "A", "B"]
    sinks.write_samples(d.withColumnRenamed("fov_id", "sample_id"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2


def test_stream(spark, tmp_path):
    book = spark.createDataFrame([("A", "C")], "gene string, barcode string")
    path = str(tmp_path / "in")
    spark.createDataFrame([(1, 1, 0, 0, "A"), (1, 1, 0, 0, "A"), (1, 2, 0, 0, "Z")], ingest.SCHEMA).write.mode("append").parquet(path)
    args = (str(tmp_path / "out"), str(tmp_path / "cp"))
    ingest.run(ingest.decode(ingest.read_stream(spark, path), book), *args).awaitTermination()
    spark.createDataFrame([(1, 1, 0, 0, "A"), (2, 5, 0, 0, "A")], ingest.SCHEMA).write.mode("append").parquet(path)
    ingest.run(ingest.decode(ingest.read_stream(spark, path), book), *args).awaitTermination()
    assert {tuple(r) for r in ingest.totals(spark, args[0]).collect()} == {(1, "A", 1), (2, "A", 1)}


def test_config():
    c = RunConfig.from_json('{"n_fovs": 5, "subset_range": [2, 3], "steps": {"stitch": {"run": false}, "register": {"parameters": {"scale": 1}}}}')
    assert c.fovs() == [2, 3] and not c.on("stitch") and c.parameters("register") == {"scale": 1}
    assert RunConfig(n_fovs=9, subset_random=(3, 1)).fovs() == RunConfig(n_fovs=9, subset_random=(3, 1)).fovs()


def test_dataset(spark):
    """A spot planted with the colours of a gene, in three rounds, the later ones shifted."""
    colors, rows = "132", []
    for rnd in range(3):
        for ch in range(4):
            for y in range(8):
                for x in range(8):
                    bright = (y, x) == (3 + rnd, 4) and ch == int(colors[rnd]) - 1
                    rows.append((1, rnd, ch, 0, y, x, 200 if bright else 1 + (y * 3 + x * 5 + ch) % 4))
    v = spark.createDataFrame(rows, "fov long, round long, channel long, z long, y long, x long, v long")
    shifts = spark.createDataFrame([(1, r, -r, 0) for r in range(3)], "fov long, round long, dy long, dx long")
    book = spark.createDataFrame([("G", "AAGT"), ("H", "CCCC")], "gene string, barcode string")
    found = Dataset(v, 8, 8).shifts(0)
    assert {(r.fov, r.round): (r.dz, r.dy, r.dx) for r in found.collect()} == {(1, r): (0, -r, 0) for r in range(3)}
    d = Dataset(v, 8, 8).register(shifts).find_spots(0, 0.5).extract().load_codebook(book.unionByName(spark.createDataFrame([("T", "TACA")], "gene string, barcode string")), reverse=False)
    found = {(r.y, r.x): r.color_seq for r in d.calls.collect()}
    assert found[3, 4] == colors
    book2 = spark.createDataFrame([("K", "AACC")], "gene string, barcode string")
    assert d.load_codebook(book2, reverse=False).codebook.first().color_seq == "121"
    assert d.filter_reads().reads.columns == ["fov", "x", "y", "z", "gene", "spot_id"]
    assert Dataset(v, 8, 8).enhance().tophat(1).images.columns == ["fov", "round", "channel", "z", "y", "x", "v"]
    assert Dataset(v, 8, 8).project().images.count() == v.count()
