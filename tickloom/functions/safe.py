"""Arithmetic that gives null where it is undefined, under ANSI mode too. NaN and infinities become null as well."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def lit(x: float) -> Column:
    return F.lit(float(x))


def finite(x: Column) -> Column:
    """x, or null if it is NaN or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) < INF), x)


def div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def ln(x: Column) -> Column:
    return F.when(x > 0, F.log(x))


def clip(x: Column, low: float | Column, high: float | Column) -> Column:
    """Null stays null, unlike with least and greatest alone."""
    low, high = (v if isinstance(v, Column) else lit(v) for v in (low, high))
    return F.when(x.isNotNull(), F.least(F.greatest(x, low), high))


def zero(x: Column) -> Column:
    return F.coalesce(x, lit(0))


def positive_variance(mean_square: Column, mean: Column) -> Column:
    """E[x^2] - E[x]^2; zero where that is no more than rounding leaves of E[x^2]."""
    v = mean_square - mean * mean
    return F.when(v > lit(1e-12) * mean_square, v).when(v.isNotNull(), lit(0))
