"""Describe table and moment-based tests; input ``(series, idx, value)`` with finite values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import normal_sf
from ..functions.transforms import is_finite
from .ordering import small_side
from .ranks import merged_values, quantiles_of_runs, value_runs

# Reported percentiles.
PERCENTILES = {"p01": 0.01, "p05": 0.05, "q25": 0.25, "median": 0.5, "q75": 0.75, "p95": 0.95, "p99": 0.99}


def moments(long: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """``n, mean, m2, skew_b, kurt_b`` (population moments, excess kurtosis) in one aggregate."""
    v = F.col("value")
    return long.groupBy(*keys).agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.var_pop(v).alias("m2"),
        F.skewness(v).alias("skew_b"),
        F.kurtosis(v).alias("kurt_b"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
    )


def unbiased_skew() -> Column:
    n = F.col("n")
    return F.when((n > 2) & (F.col("m2") > 0), F.col("skew_b") * F.sqrt(n * (n - 1.0)) / (n - 2.0))


def unbiased_kurtosis() -> Column:
    n = F.col("n")
    return F.when(
        (n > 3) & (F.col("m2") > 0),
        (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * F.col("kurt_b") + 6.0),
    )


def moments_of_runs(runs: DataFrame) -> DataFrame:
    """``series`` and the columns of ``moments`` from merged values ``(series, value, cnt)``: central sums around the mean."""
    v, c = F.col("value"), F.col("cnt")
    first = small_side(runs.groupBy("series").agg(
        F.sum(c).alias("n"), (F.sum(v * c) / F.sum(c)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")))
    d = v - F.col("mean")
    sums = runs.join(first, "series").groupBy("series").agg(*[F.sum(c * F.pow(d, F.lit(k))).alias(f"_s{k}") for k in (2, 3, 4)])
    n, m2 = F.col("n"), F.col("_s2") / F.col("n")
    return first.join(sums, "series").select(
        "series", "n", "mean", m2.alias("m2"), F.when(m2 > 0, F.col("_s3") / n / F.pow(m2, F.lit(1.5))).alias("skew_b"),
        F.when(m2 > 0, F.col("_s4") / n / (m2 * m2) - 3.0).alias("kurt_b"), "min", "max")


def describe_series(long: DataFrame) -> DataFrame:
    """Counts, moments and exact percentiles per series; ``missing`` counts unusable input rows. The rows are read once, all
    else comes from their merged values."""
    v = F.col("value")
    merged = merged_values(long.select("series", F.when(is_finite(v), v).alias("value")))
    raw = merged.groupBy("series").agg(F.coalesce(F.sum(F.when(v.isNull(), F.col("cnt"))), F.lit(0)).alias("missing"))
    usable = merged.filter(v.isNotNull())
    distinct = F.count(F.lit(1)).alias("unique")
    q = quantiles_of_runs(value_runs(usable, merged=usable), list(PERCENTILES.values()), extra=[distinct]).drop("n")
    n = F.col("n")
    return (
        raw.join(moments_of_runs(usable), "series", "left").join(q, "series", "left")
        .select(
            "series",
            F.coalesce(n, F.lit(0)).alias("n"),
            "missing",
            F.coalesce("unique", F.lit(0)).alias("unique"),
            (F.coalesce("unique", F.lit(0)) <= 1).alias("is_constant"),
            "mean",
            F.when(n > 1, F.sqrt(F.col("m2") * n / (n - 1.0))).alias("std"),
            unbiased_skew().alias("skew"),
            unbiased_kurtosis().alias("kurtosis_excess"),
            "min",
            *[F.get("q", i).alias(name) for i, name in enumerate(PERCENTILES)],
            "max",
        )
    )


def jarque_bera_of(m: DataFrame) -> DataFrame:
    """Add ``jb_stat, jb_p`` to a moments table."""
    stat = F.when(F.col("m2") > 0, F.col("n") / 6.0 * (F.pow("skew_b", F.lit(2)) + F.pow("kurt_b", F.lit(2)) / 4.0))
    return m.withColumn("jb_stat", stat).withColumn("jb_p", F.exp(-F.col("jb_stat") / 2.0))


def jarque_bera(long: DataFrame) -> DataFrame:
    return jarque_bera_of(moments(long)).select("series", "n", "jb_stat", "jb_p")


def k2_of(m: DataFrame) -> DataFrame:
    """D'Agostino-Pearson: squared normal scores of skewness and kurtosis added up (n >= 8)."""
    n = F.col("n").cast("double")
    g1, b2 = F.col("skew_b"), F.col("kurt_b") + 3.0
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + F.sqrt(2 * (beta - 1))
    ya = y / F.sqrt(2 / (w2 - 1))
    z1 = F.log(ya + F.sqrt(ya * ya + 1)) / F.sqrt(0.5 * F.log(w2))

    mean = 3 * (n - 1) / (n + 1)
    var = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (b2 - mean) / F.sqrt(var)
    rb = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / rb * (2 / rb + F.sqrt(1 + 4 / (rb * rb)))
    denom = 1 + x * F.sqrt(2 / (a - 4))
    root = F.signum(denom) * F.pow((1 - 2 / a) / F.abs(denom), F.lit(1 / 3))
    z2 = (1 - 2 / (9 * a) - root) / F.sqrt(2 / (9 * a))
    ok = (F.col("n") >= 8) & (F.col("m2") > 0)
    return m.withColumn("k2_stat", F.when(ok, z1 * z1 + z2 * z2)).withColumn("k2_p", F.exp(-F.col("k2_stat") / 2))


def k2_test(long: DataFrame) -> DataFrame:
    return k2_of(moments(long)).select("series", "n", "k2_stat", "k2_p")


def runs_test(long: DataFrame) -> DataFrame:
    """Runs of the non-zero signs around their mean (needs 50 of them)."""
    from .ordering import dense_series, shifted

    signs = long.filter(F.col("value") != 0).withColumn("value", F.signum("value"))
    rows = dense_series(signs)
    counted = rows.groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("cut"))
    steps = shifted(rows, ["series"], {"before": (F.col("value"), 1)})
    up = F.col("value") >= F.col("cut")
    agg = steps.join(small_side(counted), "series").groupBy("series", "n").agg(
        F.sum(F.when(up, 1.0).otherwise(0.0)).alias("pos"),
        (F.sum(F.when(up != (F.col("before") >= F.col("cut")), 1.0).otherwise(0.0)) + 1).alias("runs"),
    )
    n, pos = F.col("n").cast("double"), F.col("pos")
    two = 2 * pos * (n - pos)
    z = (F.col("runs") - (two / n + 1)) / F.sqrt(two * (two - n) / (n * n) / (n - 1))
    enough = F.col("n") >= 50
    out = agg.withColumn("z", F.when(enough & (two > n), z))
    return out.select(
        "series", "n", "runs", "z",
        (2.0 * normal_sf(F.abs("z"))).alias("p"),
        F.when(~enough, "not enough non-zero signs").otherwise("").alias("note"),
    )


def histogram(long: DataFrame, bins: int = 60) -> DataFrame:
    """Equal-width density histogram; empty bins are listed with 0."""
    span = long.groupBy("series").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count(F.lit(1)).alias("n")
    ).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    place = F.least(F.floor((F.col("value") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    counts = (
        long.join(small_side(span), "series")
        .groupBy("series", F.when(F.col("width") > 0, place).otherwise(0).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    grid = span.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    rows = F.coalesce("rows", F.lit(0))
    return grid.join(counts, ["series", "bin"], "left").select(
        "series", "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
        rows.alias("rows"),
        F.when(F.col("width") > 0, rows / (F.col("n") * F.col("width"))).alias("density"),
    )
