"""Tails of distributions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_gamma(x: Column) -> Column:
    """The logarithm of the gamma function of x > 0: its asymptotic series eight steps on, stepped back."""
    y = x + 8
    steps = x
    for k in range(1, 8):
        steps = steps * (x + k)
    # The series' coefficients from Bernoulli numbers.
    series = sum(c / F.pow(y, F.lit(float(p))) for c, p in ((1 / 12, 1), (-1 / 360, 3), (1 / 1260, 5), (-1 / 1680, 7), (1 / 1188, 9)))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(steps)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, from its far end; so many terms that they settle below (a + 1) / (a + b + 2)."""
    terms = (F.lit(60) + 6 * F.ceil(F.sqrt(F.greatest(a, b)))).cast("int")
    even = lambda m: m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
    odd = lambda m: -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
    step = lambda acc, m: 1 + odd(m) / (1 + even(m + 1) / acc)
    return F.aggregate(F.sequence(terms, F.lit(0), F.lit(-1)), F.lit(1.0), step)


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function for a, b > 0 and x from 0 to 1."""

    def low(a: Column, b: Column, x: Column) -> Column:
        front = a * F.log(x) + b * F.log1p(-x) + log_gamma(a + b) - log_gamma(a) - log_gamma(b)
        return F.exp(front) / (a * _fraction(a, b, x))

    below = x < (a + 1) / (a + b + 2)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(below, low(a, b, x)).otherwise(1 - low(b, a, 1 - x))


def t_tail(t: Column, df: Column) -> Column:
    """The probability of a larger value than t of Student's distribution with df > 0 degrees of freedom (not whole ones either); null without."""
    half = incomplete_beta(df / 2, F.lit(0.5), df / (df + t * t)) / 2
    return F.when((df > 0) & t.isNotNull() & ~F.isnan(t), F.when(t >= 0, half).otherwise(1 - half))


def t_tail_sql(t: str, df: str) -> str:
    """DuckDB: the same for whole degrees of freedom, by the finite sum over powers of the angle's cosine."""
    angle = f"atan(abs({t}) / sqrt({df}))"
    even = f"sin({angle}) * list_sum(list_transform(range(({df}) // 2), lambda j: exp(lgamma(j + 0.5) - lgamma(j + 1)) / sqrt(pi()) * cos({angle}) ** (2 * j)))"
    odd = f"2 / pi() * ({angle} + sin({angle}) * coalesce(list_sum(list_transform(range((({df}) - 1) // 2), lambda j: exp(lgamma(j + 1) - lgamma(j + 1.5)) * sqrt(pi()) / 2 * cos({angle}) ** (2 * j + 1))), 0))"
    tail = f"(1 - CASE WHEN ({df}) % 2 = 0 THEN {even} ELSE {odd} END) / 2"
    return f"CASE WHEN {t} >= 0 THEN {tail} ELSE 1 - {tail} END"
