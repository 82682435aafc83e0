"""Shapiro-Wilk, Anderson-Darling and normal Q-Q points."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normal import log_cdf, once, quantile_array, tail, with_quantile
from .ordering import small_side
from .ranks import expand_runs, value_runs

# Royston's (1995) polynomial coefficients, constant term first.
LAST_WEIGHT = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
NEXT_WEIGHT = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
SMALL_MEAN = (0.544, -0.39978, 0.025054, -0.0006714)
SMALL_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
LARGE_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
LARGE_SD = (-0.4803, -0.082676, 0.0030302)

# Anderson-Darling critical values for 15, 10, 5, 2.5 and 1 percent.
ANDERSON_CRITICAL = (0.576, 0.656, 0.787, 0.918, 1.092)
ANDERSON_LEVELS = (15.0, 10.0, 5.0, 2.5, 1.0)
#: Places that a task holds at once.
PLACES = 1_000_000
SCORES = ("_mm", "_m", "_mi")


def _poly(coef: Sequence[float], x: Column) -> Column:
    out = F.lit(0.0)
    for c in reversed(coef):
        out = out * x + c
    return out


def _score_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the normal scores of the places that a piece of a run holds, at most about a million places at a time."""
    for batch in batches:
        below, cnt, n = (batch.column(c).to_numpy() for c in ("below", "cnt", "n"))
        sums = np.zeros((3, len(cnt)))
        upto = np.cumsum(cnt)
        a = 0
        while a < len(cnt):
            z = max(a + 1, int(np.searchsorted(upto, upto[a] - cnt[a] + PLACES, side="right")))
            many, starts = cnt[a:z], np.concatenate(([0], np.cumsum(cnt[a:z])[:-1]))
            i = np.repeat(below[a:z] - starts, many) + np.arange(int(many.sum())) + 1
            size = np.repeat(n[a:z], many)
            m = quantile_array((i - 0.375) / (size + 0.25))
            for j, x in enumerate((m * m, np.where((i > 1) & (i < size), m, 0.0), np.where((i > 2) & (i < size - 1), m, 0.0))):
                sums[j, a:z] = np.add.reduceat(x, starts)
            a = z
        yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x) for x in sums]], names=[*batch.schema.names, *SCORES])


def normal_scores(runs: DataFrame, piece: int = 65_536) -> DataFrame:
    """Value runs with the sums of their places' normal scores: squares (``_mm``), without the outermost places (``_m``) and without
    the two outermost on each side (``_mi``). A run of more than ``piece`` places is cut and its pieces are spread over all tasks."""
    cores = runs.sparkSession.sparkContext.defaultParallelism
    start = F.explode(F.sequence(F.lit(0), F.col("cnt") - 1, F.lit(piece))).alias("_from")
    rest = [c for c in runs.columns if c not in ("below", "cnt")]
    cut = runs.filter(F.col("cnt") > piece).select("*", start).repartition(2 * cores, "value", "_from").select(
        *rest, (F.col("below") + F.col("_from")).alias("below"), F.least(F.lit(piece), F.col("cnt") - F.col("_from")).alias("cnt"))
    rows = runs.filter(F.col("cnt") <= piece).select(*rest, "below", "cnt").unionByName(cut)
    schema = rows.select("*", *[F.lit(0.0).alias(c) for c in SCORES]).schema
    return rows.mapInArrow(_score_sums, schema)


def shapiro_sums(value: Column, mean: Column) -> list[Column]:
    """The sums over ``normal_scores`` rows that ``shapiro_of`` needs, for a value that never falls along the runs."""
    n, lo, cnt = F.col("n"), F.col("below"), F.col("cnt")

    def at(place: Column) -> Column:
        return F.max(F.when((lo < place) & (place <= lo + cnt), value))

    return [
        F.sum("_mm").alias("mm"), F.sum(F.col("_m") * value).alias("mx"), F.sum(F.col("_mi") * value).alias("mx_inner"),
        F.sum(cnt * (value - mean) * (value - mean)).alias("ss"),
        at(F.lit(1)).alias("x1"), at(F.lit(2)).alias("x2"), at(n - 1).alias("y2"), at(n).alias("y1"),
    ]


def shapiro(long: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """``keys, n, shapiro_stat, shapiro_p`` over all rows of every group, by Royston's (1995) approximation.

    W is a ratio of sums over the ordered values: value runs give every row its place and one aggregate adds up the
    normal scores, so a group of any size is spread over all tasks. NULL below three rows or without spread.
    """
    keys = list(keys)
    runs = value_runs(long, keys)
    means = runs.groupBy(*keys).agg((F.sum(F.col("cnt") * F.col("value")) / F.sum("cnt")).alias("_mean"))
    rows = normal_scores(runs).join(small_side(means), keys)
    return shapiro_of(rows.groupBy(*keys, "n").agg(*shapiro_sums(F.col("value"), F.col("_mean"))), keys)


def shapiro_of(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, n, shapiro_stat, shapiro_p`` from a table with ``keys``, ``n`` and ``shapiro_sums``."""
    n = F.col("n")
    for name, i in (("m1", n), ("m2", n - 1)):
        sums = with_quantile(sums.withColumn("_p", (i - 0.375) / (n + 0.25)), "_p", name)
    root = 1.0 / F.sqrt(n)
    weighted = sums.withColumn(
        "last", F.when(n == 3, math.sqrt(0.5)).otherwise(_poly(LAST_WEIGHT, root) + F.col("m1") / F.sqrt("mm"))
    ).withColumn("second", _poly(NEXT_WEIGHT, root) + F.col("m2") / F.sqrt("mm"))
    last, second, m1, m2, mm = (F.col(c) for c in ("last", "second", "m1", "m2", "mm"))
    scaled = weighted.withColumn(
        "phi", F.when(n > 5, (mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * last * last - 2 * second * second)).otherwise(
            (mm - 2 * m1 * m1) / (1 - 2 * last * last)))
    ends = last * (F.col("y1") - F.col("x1"))
    middle = F.when(n > 5, second * (F.col("y2") - F.col("x2")) + F.coalesce("mx_inner", F.lit(0.0)) / F.sqrt("phi")).when(
        n > 3, F.coalesce("mx", F.lit(0.0)) / F.sqrt("phi")).otherwise(0.0)
    w = F.least(F.lit(1.0), (ends + middle) ** 2 / F.col("ss"))
    stat = scaled.select(*keys, "n", F.when((n >= 3) & (F.col("y1") > F.col("x1")), w).alias("shapiro_stat"))
    return stat.select(*keys, "n", "shapiro_stat", shapiro_p(F.col("shapiro_stat"), n).alias("shapiro_p"))


def shapiro_p(w: Column, n: Column) -> Column:
    """Probability of a smaller W."""
    third = F.greatest(F.lit(0.0), 6 / math.pi * (F.asin(F.sqrt(w)) - math.asin(math.sqrt(0.75))))
    y, g, m = F.log(1 - w), 0.459 * n - 2.273, n.cast("double")
    small = (-F.log(g - y) - _poly(SMALL_MEAN, m)) / F.exp(_poly(SMALL_SD, m))
    large = once(F.log(n), lambda ln: (y - _poly(LARGE_MEAN, ln)) / F.exp(_poly(LARGE_SD, ln)))
    return F.when(n == 3, third).when(w >= 1, 1.0).when((n <= 11) & (y >= g), 1e-99).otherwise(
        once(F.when(n <= 11, small).otherwise(large), tail))


def anderson_normal(long: DataFrame) -> DataFrame:
    """A-squared against the fitted normal, its 5 % critical value and the decision.

    Both ranks a value needs come from its run (count and rows below), so ties collapse to a row.
    """
    runs = value_runs(long)
    fit = small_side(long.groupBy("series").agg(F.avg("value").alias("mu"), F.stddev_samp("value").alias("sd")))
    z = (F.col("value") - F.col("mu")) / F.col("sd")
    lo, hi, n = F.col("below"), F.col("below") + F.col("cnt"), F.col("n")
    weight_left = (hi * hi - lo * lo).cast("double")
    weight_right = ((n - lo) * (n - lo) - (n - hi) * (n - hi)).cast("double")
    summed = (
        runs.join(fit, "series")
        .filter("sd > 0")
        .groupBy("series", "n")
        .agg(F.sum(weight_left * log_cdf(z) + weight_right * log_cdf(-z)).alias("s"))
    )
    return with_anderson_decision(
        summed.select("series", "n", (-n - F.col("s") / n).alias("anderson_stat"))
    )


def with_anderson_decision(df: DataFrame) -> DataFrame:
    n = F.col("n")
    shrink = 1.0 + 4.0 / n - 25.0 / n / n
    values = [F.round(F.lit(c) / shrink, 3) for c in ANDERSON_CRITICAL]
    at5 = values[ANDERSON_LEVELS.index(5.0)]
    return df.select(
        "*",
        F.array(*values).alias("anderson_crit_vals"),
        at5.alias("anderson_crit_5pct"),
        (F.col("anderson_stat") > at5).alias("anderson_reject_5pct"),
    )


def qq_points(long: DataFrame) -> DataFrame:
    """``(series, place, theoretical, ordered)`` at Filliben's positions."""
    points = expand_runs(value_runs(long))
    n, i = F.col("n"), F.col("place") + 1
    edge = F.pow(F.lit(0.5), 1.0 / n)
    pos = F.when(i == n, edge).when(i == 1, 1.0 - edge).otherwise((i - 0.3175) / (n + 0.365))
    placed = points.select("series", "n", "place", pos.alias("position"), F.col("value").alias("ordered"))
    return with_quantile(placed, "position", "theoretical").select("series", "n", "place", "position", "theoretical", "ordered")
