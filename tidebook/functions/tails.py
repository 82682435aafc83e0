"""Tail probabilities for result-sized tables (one row per series), as Arrow-batched functions.

Formulas: regularized incomplete gamma and beta by series and continued fraction (published
numerical-analysis forms); MacKinnon (1994) response surface; KPSS (1992) critical values.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from . import normal

TINY = 1e-300


def gamma_q(a: float, x: float) -> float:
    """Upper regularized incomplete gamma."""
    if not (math.isfinite(a) and a > 0) or math.isnan(x):
        return math.nan
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * front)
    b = x + 1 - a
    c, d = 1 / TINY, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > TINY else TINY)
        c = b + an / c
        c = c if abs(c) > TINY else TINY
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return front * h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > TINY else TINY)
    h = d
    for m in range(1, 10_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / (d if abs(d) > TINY else TINY)
            c = 1 + num / c
            c = c if abs(c) > TINY else TINY
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def chi2_tail(x: float, df: float) -> float:
    return gamma_q(df / 2, x / 2)


def f_tail(x: float, d1: float, d2: float) -> float:
    if not math.isfinite(x) or d1 <= 0 or d2 <= 0:
        return math.nan
    return beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * x))


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


# Response-surface coefficients for the constant case, one variable.
ADF_MAX, ADF_MIN, ADF_STAR = 2.74, -18.83, -1.61
ADF_LOW = (2.1659, 1.4412, 0.038269)
ADF_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)

# Level-stationarity critical values and their probabilities.
KPSS_CRITICAL = (0.347, 0.463, 0.574, 0.739)
KPSS_P = (0.10, 0.05, 0.025, 0.01)


def adf_p(stat: float) -> float:
    if not math.isfinite(stat):
        return math.nan
    if stat > ADF_MAX:
        return 1.0
    if stat < ADF_MIN:
        return 0.0
    coef = ADF_LOW if stat <= ADF_STAR else ADF_HIGH
    return normal_tail(-sum(c * stat**i for i, c in enumerate(coef)))


def kpss_p(stat: float) -> float:
    return float(np.interp(stat, KPSS_CRITICAL, KPSS_P)) if math.isfinite(stat) else math.nan


def _rows(fn, *cols: pd.Series) -> pd.Series:
    def one(args):
        if any(a is None or a != a for a in args):
            return None
        y = fn(*args)
        return None if y != y else y

    return pd.Series([one(args) for args in zip(*cols)], dtype="float64")


@F.pandas_udf(DoubleType())
def _chi2(x: pd.Series, df: pd.Series) -> pd.Series:
    return _rows(chi2_tail, x, df)


@F.pandas_udf(DoubleType())
def _f(x: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _rows(f_tail, x, d1, d2)


@F.pandas_udf(DoubleType())
def _adf(z: pd.Series) -> pd.Series:
    return _rows(adf_p, z)


@F.pandas_udf(DoubleType())
def _kpss(z: pd.Series) -> pd.Series:
    return _rows(kpss_p, z)


def chi2_sf(x: Column, df: Column) -> Column:
    return _chi2(x, df.cast("double"))


def f_sf(x: Column, d1: Column, d2: Column) -> Column:
    return _f(x, d1.cast("double"), d2.cast("double"))


def normal_sf(z: Column) -> Column:
    return normal.tail(z)


def adf_pvalue(z: Column) -> Column:
    return _adf(z)


def kpss_pvalue(z: Column) -> Column:
    return _kpss(z)
