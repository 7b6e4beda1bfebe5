import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import barcodes as bc


def one(spark, **columns):
    return spark.createDataFrame([tuple(columns.values())], list(columns))


@pytest.mark.parametrize("pair,color", [(p, c) for c, ps in {"1": "AA CC GG TT", "2": "AC CA GT TG", "3": "AG CT GA TC", "4": "AT CG GC TA"}.items() for p in ps.split()])
def test_color_table(spark, pair, color):
    assert one(spark, s=pair).select(bc.encode_bases(F.col("s"))).first()[0] == color


def test_known_barcodes(spark):
    r = one(spark, a="CGCAC", b="4422", c="1234", d="12345", e="123456").select(
        bc.encode_bases(F.col("a")), bc.decode_colors(F.col("b"), "C"), bc.decode_colors(F.col("c"), "A"), bc.split_rotate(F.col("d"), 3),
        bc.segments(F.col("e"), [5]), bc.segments(F.col("e"), [3, 5]), bc.decode_colors(F.lit("15"), "A"), bc.encode_bases(F.lit("")),
    ).first()
    assert tuple(r) == ("4422", "CGCAC", "AACTA", "4512", ["1234", "56"], ["12", "3456", "4", "56"], None, "")


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ACGT", min_size=1, max_size=12), min_size=1, max_size=20))
def test_round_trip(spark, seqs):
    d = spark.createDataFrame([(s,) for s in seqs], "s string").withColumn("c", bc.encode_bases(F.col("s")))
    back = F.coalesce(*[F.when(F.col("s").startswith(b), bc.decode_colors(F.col("c"), b)) for b in "ACGT"])
    assert d.where(back != F.col("s")).count() == 0


def test_color_call(spark):
    d = spark.createDataFrame([([0.0, 0.0, 0.0, 0.0],), ([5.0, 5.0, 0.0, 0.0],), ([3.0, 0.0, 4.0, 0.0],)], "v array<double>")
    got = [tuple(r.c) for r in d.select(bc.call_color(F.col("v")).alias("c")).collect()]
    assert got[:2] == [("M", math.inf)] * 2
    assert got[2][0] == "3" and got[2][1] == pytest.approx(-math.log(4 / (5 + 1e-6)))


def test_natural_order(spark):
    d = spark.createDataFrame([("a2.txt",), ("a10.txt",), ("a1.txt",)], "n string")
    assert [r.n for r in d.orderBy(bc.natural_key(F.col("n"))).collect()] == ["a1.txt", "a2.txt", "a10.txt"]
