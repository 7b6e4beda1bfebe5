"""Tails against numerical integration and known values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import distributions as ds


def t_tail(t, df):
    """By the trapezoid rule over the angle whose tangent is the value."""
    n = 400_001
    a = np.linspace(math.atan(abs(t) / math.sqrt(df)), math.pi / 2, n)
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)
    with np.errstate(all="ignore"):
        f = np.cos(a) ** (df - 1)
    f[-1] = 0.0 if df > 1 else f[-1]
    half = c * ((f[1:] + f[:-1]) / 2 * np.diff(a)).sum()
    return half if t >= 0 else 1 - half


def test_log_gamma(spark):
    xs = [0.05, 0.5, 1.0, 1.5, 2.0, 7.3, 50.0, 1234.5, 1e6]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(ds.log_gamma(F.col("x"))).collect()]
    assert got == pytest.approx([math.lgamma(x) for x in xs], rel=1e-11, abs=1e-11)


def test_t_tail(spark):
    cases = [(t, df) for t in (-6.0, -1.2, -0.1, 0.0, 0.3, 1.0, 2.5, 8.0, 40.0) for df in (1.0, 2.0, 2.7, 5.0, 13.4, 30.0, 240.5, 5000.0)]
    d = spark.createDataFrame(cases, "t double, df double")
    got = {(r.t, r.df): r.p for r in d.select("t", "df", ds.t_tail(F.col("t"), F.col("df")).alias("p")).collect()}
    for case, p in got.items():
        assert p == pytest.approx(t_tail(*case), abs=1e-8), case
    # Quantiles as printed in tables.
    table = {(1.0, 6.313751514675): 0.05, (4.0, 2.776445105198): 0.025, (10.0, 2.763769458113): 0.01}
    d = spark.createDataFrame(list(table), "df double, t double")
    for r in d.select("t", "df", ds.t_tail(F.col("t"), F.col("df")).alias("p")).collect():
        assert r.p == pytest.approx(table[r.df, r.t], abs=1e-8)


def test_small_tails_keep_their_digits(spark):
    (p,) = spark.range(1).select(ds.t_tail(F.lit(30.0), F.lit(20.0))).first()
    assert p == pytest.approx(2.0178e-18, rel=1e-1) or 0 < p < 1e-17


def test_incomplete_beta(spark):
    d = spark.createDataFrame([(2.0, 3.0, x) for x in (0.0, 0.1, 0.5, 0.9, 1.0)], "a double, b double, x double")
    got = [r[0] for r in d.select(ds.incomplete_beta(F.col("a"), F.col("b"), F.col("x"))).collect()]
    assert got == pytest.approx([sum(math.comb(4, k) * x**k * (1 - x) ** (4 - k) for k in range(2, 5)) for x in (0.0, 0.1, 0.5, 0.9, 1.0)], abs=1e-12)


def test_no_degrees_of_freedom(spark):
    d = spark.createDataFrame([(1.0, 0.0), (None, 3.0), (float("nan"), 3.0), (1.0, None)], "t double, df double")
    assert [r[0] for r in d.select(ds.t_tail(F.col("t"), F.col("df"))).collect()] == [None] * 4
