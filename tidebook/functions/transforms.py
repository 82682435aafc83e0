"""Column forms of the normalizing transforms (published Box-Cox and Yeo-Johnson families)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def is_finite(x: Column) -> Column:
    """False for NULL, NaN and infinities."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(INF))


def finite_or_null(x: Column) -> Column:
    return F.when(is_finite(x), x)


def box_cox(x: Column, lam: Column) -> Column:
    """``(x^lam - 1) / lam``; by ``expm1``, so nothing cancels for values near 1."""
    return F.when(lam == 0.0, F.log(x)).otherwise(F.expm1(lam * F.log(x)) / lam)


def yeo_johnson(x: Column, lam: Column) -> Column:
    up, down = F.log1p(x), F.log1p(-x)
    gap = F.lit(2.0) - lam
    return F.when(x >= 0.0, F.when(lam == 0.0, up).otherwise(F.expm1(lam * up) / lam)).otherwise(
        F.when(gap == 0.0, -down).otherwise(-F.expm1(gap * down) / gap))


def apply_named(x: Column, name: Column | str, lam: Column, offset: Column) -> Column:
    """Value of the named transform; NULL where input, shifted input or result is not usable."""
    name = F.lit(name) if isinstance(name, str) else name
    moved = x + offset
    out = (
        F.when(name == "log", F.when(moved > 0.0, F.log(moved)))
        .when(name == "sqrt", F.when(moved >= 0.0, F.sqrt(moved)))
        .when(name == "asinh", F.asinh(x))
        .when(name == "yeo-johnson", yeo_johnson(x, lam))
        .when(name == "box-cox", F.when(moved > 0.0, box_cox(moved, lam)))
    )
    return F.when(is_finite(x), finite_or_null(out))
