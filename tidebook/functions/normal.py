"""The standard normal distribution as plain column expressions, and the same formulas as SQL text.

Quantile: Wichura (1988), algorithm AS 241. Tail: Hart's approximation in the form of West (2005), about 1e-15
relative near the centre; both are published rational functions, so they stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numerators and denominators of AS 241 by region, highest power first.
CENTRAL = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125,
     1971.5909503065514427, 133.14166789178437745, 3.3871328727963666080),
    (5226.4952788528545610, 28729.085735721942674, 39307.895800092710610, 21213.794301586595867, 5394.1960214247511077,
     687.18700749205790830, 42.313330701600911252, 1.0),
)
MIDDLE = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258,
     3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
     6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0),
)
FAR = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
     2.96560571828504891230e-1, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
     1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)
# Hart's numerator and denominator as given by West, highest power first.
TAIL = (
    (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931,
     220.206867912376),
    (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831,
     793.826512519948, 440.413735824752),
)
ROOT_2PI = 2.5066282746310002
SWITCH = 7.07106781186547


def _poly(coef: Sequence[float], x: Column) -> Column:
    out = F.lit(coef[0])
    for c in coef[1:]:
        out = out * x + c
    return out


def _poly_sql(coef: Sequence[float], x: str) -> str:
    out = f"{coef[0]!r}::DOUBLE"
    for c in coef[1:]:
        out = f"({out} * {x} + {c!r}::DOUBLE)"
    return out


def once(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with x computed once; for result-sized tables, as a lambda is not compiled."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def with_quantile(df: DataFrame, p: str, name: str) -> DataFrame:
    """Add the quantile of column ``p``, NULL outside (0, 1). Steps are columns of their own, so generated code stays small."""
    q, r, near = (F.col(f"_{name}_{x}") for x in "qrn")
    staged = df.withColumns({f"_{name}_q": F.col(p) - 0.5}).withColumns({
        f"_{name}_r": F.sqrt(-F.log(F.when(q <= 0, F.col(p)).otherwise(1.0 - F.col(p)))), f"_{name}_n": 0.180625 - q * q})
    outer = F.when(r <= 5, _poly(MIDDLE[0], r - 1.6) / _poly(MIDDLE[1], r - 1.6)).otherwise(
        _poly(FAR[0], r - 5.0) / _poly(FAR[1], r - 5.0))
    side = F.when(q < 0, -1.0).otherwise(1.0)
    value = F.when(F.abs(q) <= 0.425, q * _poly(CENTRAL[0], near) / _poly(CENTRAL[1], near)).otherwise(side * outer)
    return staged.withColumn(name, F.when((F.col(p) > 0) & (F.col(p) < 1), value)).drop(f"_{name}_q", f"_{name}_r", f"_{name}_n")


def quantile_array(p: np.ndarray) -> np.ndarray:
    """The quantile of an array of probabilities inside (0, 1)."""
    q = p - 0.5
    near = 0.180625 - q * q
    out = q * np.polyval(CENTRAL[0], near) / np.polyval(CENTRAL[1], near)
    outer = np.flatnonzero(np.abs(q) > 0.425)
    r = np.sqrt(-np.log(np.where(q[outer] <= 0, p[outer], 1.0 - p[outer])))
    value = np.polyval(MIDDLE[0], r - 1.6) / np.polyval(MIDDLE[1], r - 1.6)
    far = r > 5
    value[far] = np.polyval(FAR[0], r[far] - 5.0) / np.polyval(FAR[1], r[far] - 5.0)
    out[outer] = np.where(q[outer] < 0, -value, value)
    return out


def quantile_sql(p: str) -> str:
    """``p`` must be a plain column name."""
    q, r = f"({p} - 0.5::DOUBLE)", f"sqrt(-ln(CASE WHEN {p} <= 0.5 THEN {p} ELSE 1 - {p} END))"
    near = f"(0.180625::DOUBLE - {q} * {q})"

    def ratio(pair, x: str) -> str:
        return f"{_poly_sql(pair[0], x)} / {_poly_sql(pair[1], x)}"

    outer = f"(CASE WHEN {r} <= 5 THEN {ratio(MIDDLE, f'({r} - 1.6::DOUBLE)')} ELSE {ratio(FAR, f'({r} - 5::DOUBLE)')} END)"
    return (f"(CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio(CENTRAL, near)} "
            f"WHEN {q} < 0 THEN -{outer} ELSE {outer} END)")


def tail(z: Column) -> Column:
    """P(Z > z)."""
    x = F.abs(z)
    e = F.exp(-x * x / 2)
    far = e / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65))))) / ROOT_2PI
    half = F.when(x < SWITCH, e * _poly(TAIL[0], x) / _poly(TAIL[1], x)).otherwise(far)
    return F.when(z >= 0, half).otherwise(1.0 - half)


def tail_sql(z: str) -> str:
    """``z`` must be a plain column name."""
    x = f"abs({z})"
    e = f"exp(-{x} * {x} / 2)"
    far = f"{e} / ({x} + 1 / ({x} + 2 / ({x} + 3 / ({x} + 4 / ({x} + 0.65::DOUBLE))))) / {ROOT_2PI!r}::DOUBLE"
    half = f"(CASE WHEN {x} < {SWITCH!r} THEN {e} * {_poly_sql(TAIL[0], x)} / {_poly_sql(TAIL[1], x)} ELSE {far} END)"
    return f"(CASE WHEN {z} >= 0 THEN {half} ELSE 1 - {half} END)"


def log_cdf(z: Column) -> Column:
    """ln P(Z <= z), exact far into the left tail."""
    y = z * z
    far = -y / 2 - F.log(-z) - F.log(F.lit(ROOT_2PI)) + F.log1p(-1 / y + 3 / (y * y))
    return F.when(z < -35, far).when(z < 5, F.log(tail(-z))).otherwise(F.log1p(-tail(z)))


def log_cdf_sql(z: str) -> str:
    y = f"({z} * {z})"
    far = f"-{y} / 2 - ln(-{z}) - ln({ROOT_2PI!r}::DOUBLE) + ln(1 - 1 / {y} + 3 / ({y} * {y}))"
    # The lower tail is the upper tail of the mirrored value; above 5 the logarithm of 1 - t is -t - t^2 / 2.
    upper, lower = tail_sql(z), tail_sql(z).replace(f"CASE WHEN {z} >= 0 ", f"CASE WHEN {z} <= 0 ")
    return f"(CASE WHEN {z} < -35 THEN {far} WHEN {z} < 5 THEN ln({lower}) ELSE -{upper} - {upper} * {upper} / 2 END)"
