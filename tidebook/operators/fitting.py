"""Choice and application of a normalizing transform per feature.

Fitting reads all rows given in long form ``(feature, value)``, a few aggregates in all; applying is one row-local projection over the whole table.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.transforms import apply_named, box_cox, is_finite, yeo_johnson
from ..schema import FWD_PREFIX, NOT_TRANSFORMED
from .normality import SCORES, normal_scores, shapiro, shapiro_of, shapiro_sums
from .ordering import materialized, small_side
from .packed import merged_of, packed, pieces
from .ranks import value_runs

# Candidate order decides ties.
CANDIDATES = ("identity", "asinh", "yeo-johnson", "log", "sqrt", "box-cox")
LAMBDA_GRID = tuple(round(-2.0 + 0.1 * i, 1) for i in range(41))
FAMILIES = {"yeo-johnson": "yj", "box-cox": "bc"}
#: Relative accuracy of lambda, the largest one, and most passes over the rows.
TOLERANCE, FARTHEST, PASSES = 1e-7, 1e13, 60
MIN_ROWS = 10


def select_features(
    df: DataFrame, exclude: Sequence[str] = NOT_TRANSFORMED, prefixes: Sequence[str] = (FWD_PREFIX,)
) -> list[str]:
    return [c for c in df.columns if c not in exclude and not c.startswith(tuple(prefixes))]


def feature_long(df: DataFrame, feats: Sequence[str]) -> DataFrame:
    """``(feature, value)`` of all finite values."""
    wide = df.select(*[F.col(f).cast("double").alias(f) for f in feats])
    return wide.unpivot([], list(feats), "feature", "value").filter(is_finite(F.col("value")))


def feature_stats(long: DataFrame) -> DataFrame:
    v = F.col("value")
    return long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.skewness(v).alias("skew"),
    )


def _log_offset(lo: Column) -> Column:
    return F.when(lo > 0, 0.0).when(lo >= -1e6, F.abs(lo) + 1.0)


def _sqrt_offset(lo: Column) -> Column:
    return F.when(lo >= 0, 0.0).when(lo >= -1e6, F.abs(lo) + 0.1)


def candidate_values(long: DataFrame, stats: DataFrame, lambdas: DataFrame | None = None, rest: Sequence[str] = ()) -> DataFrame:
    """Every value under every admissible candidate: ``(feature, candidate, lambda, offset, value)`` and the columns ``rest``.

    ``lambdas`` has ``(feature, yj_lambda, bc_lambda)``; without it the two power families are left
    out. A candidate with one non-finite value is dropped by ``score_candidates``.
    """
    x, lo = F.col("value"), F.col("min")
    none = F.lit(None).cast("double")
    side = stats.select("feature", "min")
    fitted = lambdas is not None
    if fitted:
        side = side.join(lambdas, "feature", "left")

    def entry(name: str, value: Column, lam: Column = none, off: Column = none) -> Column:
        return F.struct(
            F.lit(name).alias("candidate"), lam.alias("lambda"), off.alias("offset"), value.alias("value")
        )

    log_off, sqrt_off = _log_offset(lo), _sqrt_offset(lo)
    made = [
        entry("identity", x),
        entry("asinh", F.asinh(x)),
        F.when(log_off.isNotNull(), entry("log", F.log(x + log_off), off=log_off)),
        F.when(sqrt_off.isNotNull(), entry("sqrt", F.sqrt(x + sqrt_off), off=sqrt_off)),
    ]
    if fitted:
        yj, bc = F.col("yj_lambda"), F.col("bc_lambda")
        made += [
            F.when(yj.isNotNull(), entry("yeo-johnson", yeo_johnson(x, yj), lam=yj)),
            F.when((lo > 0) & bc.isNotNull(), entry("box-cox", box_cox(x, bc), lam=bc, off=F.lit(0.0))),
        ]
    return (
        long.join(small_side(side), "feature")
        .select("feature", *rest, F.explode(F.array_compact(F.array(*made))).alias("c"))
        .select("feature", "c.candidate", "c.lambda", "c.offset", "c.value", *rest)
    )


def _profile_rows(family: str):
    """Per packed row and lambda of its list ``_g``: rows, sum of the log terms, sums of the transformed values around a middle that
    all rows of a feature share, and of their squares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            middles, grids, names, out = batch.column("_middle"), batch.column("_g"), batch.column("feature"), []
            for i, x, c in pieces(batch):
                u = np.log(np.where(x > 0, x, np.nan)) if family == "box-cox" else np.log1p(np.abs(x))
                x0 = middles[i].as_py()
                u0 = (math.log(x0) if x0 > 0 else math.nan) if family == "box-cox" else math.log1p(abs(x0))
                terms = float(c @ (u if family == "box-cox" else np.sign(x) * u))
                for lam in grids[i].as_py():
                    y = _transformed(family, x >= 0, u, lam) - float(_transformed(family, np.array([x0 >= 0]), np.array([u0]), lam)[0])
                    out.append((names[i].as_py(), lam, float(c.sum()), terms, float(c @ y), float(c @ (y * y))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 6, (pa.string(), *[pa.float64()] * 5))],
                names=["feature", "lambda", "_n", "_t", "_y", "_yy"])

    return run


def _transformed(family: str, up: np.ndarray, u: np.ndarray, lam: float) -> np.ndarray:
    """Box-Cox or Yeo-Johnson values from the logarithms ``u``."""

    def power(g: float) -> np.ndarray:
        return u if g == 0 else np.expm1(g * u) / g

    with np.errstate(all="ignore"):
        if family == "box-cox" or up.all():
            return power(lam)
        return np.where(up, power(lam), -power(2.0 - lam))


def lambda_profile(long: DataFrame, family: str, grid: Column) -> DataFrame:
    """``(feature, lambda, llf)``: one aggregate over the sample for the whole grid.

    ``grid`` is an array column. Equal values are merged first, and a task holds the values of a packed row under one lambda at a time.
    """
    lam, n = F.col("lambda"), F.col("_n")
    rows = _with_middle(packed(long, "feature")).withColumn("_g", grid)
    parts = rows.mapInArrow(_profile_rows(family), "feature string, `lambda` double, _n double, _t double, _y double, _yy double")
    llf = -n / 2 * F.log(F.col("_yy") / n - F.col("_y") / n * F.col("_y") / n) + (lam - 1.0) * F.col("_t")
    return parts.groupBy("feature", "lambda").agg(*[F.sum(c).alias(c) for c in ("_n", "_t", "_y", "_yy")]).withColumn(
        "llf", llf).select("feature", "lambda", F.when(is_finite(F.col("llf")), F.col("llf")).alias("llf"))


def _with_middle(rows: DataFrame) -> DataFrame:
    """Packed rows with a value near the mean of their feature."""
    total = F.aggregate(F.zip_with("values", "counts", lambda v, c: v * c), F.lit(0.0), lambda s, x: s + x)
    many = F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x)
    middle = rows.groupBy("feature").agg((F.sum(total) / F.sum(many)).alias("_middle"))
    return rows.join(small_side(middle), "feature")


def _power(u: np.ndarray, g: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``expm1(g u) / g`` and its first two derivatives by g; by their series where g u is small."""
    t = g * u
    near = np.abs(t) < 1e-3
    if not near.all():
        e = np.expm1(t)
        y = e / g
        ue = u * (e + 1.0)
        d = (ue - y) / g
        c = (u * ue - 2.0 * d) / g
    else:
        y, d, c = np.empty_like(u), np.empty_like(u), np.empty_like(u)
    if near.any():
        v, t = u[near], t[near]
        y[near] = v * (1.0 + t * (0.5 + t * (1 / 6 + t * (1 / 24 + t / 120))))
        d[near] = v * v * (0.5 + t * (1 / 3 + t * (1 / 8 + t / 30)))
        c[near] = v * v * v * (1 / 3 + t * (1 / 4 + t * (1 / 10 + t / 36)))
    return y, d, c


def _slopes(family: str, up: np.ndarray, u: np.ndarray, lam: float) -> np.ndarray:
    """Transformed values and their first two derivatives by lambda, as three rows."""
    if family == "box-cox" or up.all():
        return np.array(_power(u, lam))
    y, d, c = _power(u, 2.0 - lam)
    return np.where(up, np.array(_power(u, lam)), np.array((-y, d, -c)))


SUMS = ("n", "s", "y", "d", "c", "yy", "yd", "dd", "yc")


def _search_sums(families: Sequence[str]):
    """Per packed row the sums that give the profiles' likelihood and its first two derivatives at the lambdas ``yj`` and ``bc``,
    around the values of the feature's middle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, middles, out = batch.column("feature"), batch.column("_middle"), []
            for i, x, k in pieces(batch):
                x0 = middles[i].as_py()
                for family in families:
                    lam = batch.column(FAMILIES[family])[i].as_py()
                    if lam is None:
                        continue
                    with np.errstate(all="ignore"):
                        u = np.log(np.append(x, x0)) if family == "box-cox" else np.log1p(np.abs(np.append(x, x0)))
                        all_ = _slopes(family, np.append(x, x0) >= 0, u, lam)
                        (y, d, c), u = all_[:, :-1] - all_[:, -1:], u[:-1]
                        terms = u if family == "box-cox" else np.sign(x) * u
                        ky, kd = k * y, k * d
                        out.append((names[i].as_py(), family, *map(float, (
                            k.sum(), k @ terms, ky.sum(), kd.sum(), k @ c, ky @ y, ky @ d, kd @ d, ky @ c))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 11, (pa.string(), pa.string(), *[pa.float64()] * 9))],
                names=["feature", "family", *SUMS])

    return run


class _Search:
    """The peak of one profile by Newton steps on its derivative, kept inside a bracket that every pass narrows."""

    def __init__(self):
        self.lam, self.lo, self.hi, self.good, self.llf, self.done = 1.0, -math.inf, math.inf, None, None, False

    def learn(self, n: float, s: float, v: float, vd: float, dd: float, vc: float) -> None:
        ok = all(x is not None and math.isfinite(x) for x in (s, v, vd, dd, vc)) and v > 0
        if not ok:
            self.stray()
            return
        slope = -n * vd / v + s
        bend = -n * ((dd + vc) / v - 2 * (vd / v) ** 2)
        self.good, self.llf = self.lam, -n / 2 * math.log(v) + (self.lam - 1) * s
        if slope > 0:
            self.lo = max(self.lo, self.lam)
        else:
            self.hi = min(self.hi, self.lam)
        step = -slope / bend if bend < 0 else math.copysign(max(1.0, abs(self.lam)), slope)
        limit = 10 * max(1.0, abs(self.lam))
        goal = self.lam + max(-limit, min(limit, step))
        if not self.lo < goal < self.hi:
            goal = (self.lo + self.hi) / 2 if math.isfinite(self.lo + self.hi) else self.lam + math.copysign(limit, slope)
        self.done = abs(goal - self.lam) <= TOLERANCE * max(1.0, abs(self.lam)) or abs(goal) > FARTHEST
        self.lam = goal

    def stray(self) -> None:
        """Values overflowed here: half way back to where they did not."""
        if self.good is None:
            self.done, self.lam = True, None
            return
        if self.lam > self.good:
            self.hi = self.lam
        else:
            self.lo = self.lam
        self.lam = (self.lam + self.good) / 2
        self.done = abs(self.lam - self.good) <= TOLERANCE * max(1.0, abs(self.good))


def fit_lambdas(
    long: DataFrame, families: Sequence[str] = ("yeo-johnson", "box-cox"), values: DataFrame | None = None
) -> DataFrame:
    """``(feature, family, lambda, llf)``: maximum-likelihood lambda, given to a thousandth, of every feature and family, and the
    profile's peak; Box-Cox for positive features.

    The profile has one peak. Every pass is one aggregate over the rows of the features that are still moving, for both families at once,
    and gives value, slope and curvature; about six passes are enough, without a grid. Only these few numbers per
    feature reach the driver. A feature without spread or usable values has no row. ``values``: the rows already ``packed``.
    """
    spark = long.sparkSession
    state: dict[tuple[str, str], _Search] = {}
    values = materialized(_with_middle(packed(long, "feature") if values is None else values))
    ends = values.groupBy("feature").agg(F.min(F.element_at("values", 1)).alias("lo"), F.max(F.element_at("values", -1)).alias("hi"))
    for r in ends.collect():
        for family in families:
            if r.lo is not None and r.lo < r.hi and (family != "box-cox" or r.lo > 0):
                state[r.feature, family] = _Search()
    schema = "feature string, family string, " + ", ".join(f"{c} double" for c in SUMS)
    for _ in range(PASSES):
        moving = {f for (f, _), search in state.items() if not search.done}
        if not moving:
            break
        at = [(f, *[state[f, k].lam if (f, k) in state and not state[f, k].done else None for k in FAMILIES]) for f in sorted(moving)]
        side = spark.createDataFrame(at, "feature string, yj double, bc double")
        parts = values.join(F.broadcast(side), "feature").mapInArrow(_search_sums(families), schema)
        for r in parts.groupBy("feature", "family").agg(*[F.sum(c).alias(c) for c in SUMS]).collect():
            n, y, d, c = r.n, r.y / r.n, r.d / r.n, r.c / r.n
            state[r.feature, r.family].learn(n, r.s, r.yy / n - y * y, r.yd / n - y * d, r.dd / n - d * d, r.yc / n - y * c)
    rows = [(f, k, round(search.lam, 3), search.llf) for (f, k), search in state.items() if search.lam is not None and search.good is not None]
    return spark.createDataFrame(rows, "feature string, family string, `lambda` double, llf double")


def fit_lambda(long: DataFrame, family: str) -> DataFrame:
    """``(feature, lambda, llf)`` of one family."""
    return fit_lambdas(long, [family]).drop("family")


def normality_score(values: DataFrame, keys: Sequence[str] = ("feature", "candidate")) -> DataFrame:
    """``shapiro p - 0.1 |skew| - 0.05 |excess kurtosis|`` per group; -999 for fewer than 3 values."""
    keys = list(keys)
    v = F.col("value")
    moments = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
        F.skewness(v).alias("skewness"),
        F.kurtosis(v).alias("excess_kurtosis"),
    )
    tested = shapiro(values, keys).select(*keys, F.col("shapiro_p").alias("shapiro_pvalue"))
    return _scores(moments, tested, keys)


def _scores(moments: DataFrame, tested: DataFrame, keys: Sequence[str]) -> DataFrame:
    few = F.col("n") < 3
    score = F.col("shapiro_pvalue") - 0.1 * F.abs("skewness") - 0.05 * F.abs("excess_kurtosis")
    return moments.join(tested, keys, "left").select(
        *keys, "n", "mean", "std",
        F.when(few, 999.0).otherwise(F.col("skewness")).alias("skewness"),
        F.when(few, 999.0).otherwise(F.col("excess_kurtosis")).alias("excess_kurtosis"),
        F.when(few, 0.0).otherwise(F.col("shapiro_pvalue")).alias("shapiro_pvalue"),
        F.when(few, -999.0).otherwise(score).alias("score"),
    )


def score_candidates(values: DataFrame, stats: DataFrame, lambdas: DataFrame) -> DataFrame:
    """From ``packed`` rows, the ``normality_score`` of every candidate without a single non-finite value, with its ``lambda`` and ``offset``.

    All candidates rise with the value, so the rows are merged, ordered and given their normal scores once for all of
    them, and the candidates are formed on the merged values.
    """
    merged = merged_of(values, "feature")
    runs = value_runs(merged, ["feature"], merged=merged)
    key = ["feature", "candidate"]
    x, cnt, n = F.col("value"), F.col("cnt"), F.col("n")
    rest = ("n", "below", "cnt")
    bad = F.max(F.when(is_finite(x), 0).otherwise(1)).alias("_bad")
    means = small_side(candidate_values(runs, stats, lambdas, rest).groupBy(*key).agg(
        bad, F.max("lambda").alias("lambda"), F.max("offset").alias("offset"),
        (F.sum(cnt * x) / F.sum(cnt)).alias("mean"), (F.min(x) < F.max(x)).alias("_spread")).filter("_bad = 0").drop("_bad"))
    rows = candidate_values(normal_scores(runs), stats, lambdas, (*rest, *SCORES)).drop("lambda", "offset").join(means, key)
    dev = x - F.col("mean")
    names = ["lambda", "offset", "mean", "_spread"]
    sums = rows.groupBy(*key, "n", *names).agg(
        F.sum(cnt * dev * dev * dev).alias("_c"), F.sum(cnt * dev * dev * dev * dev).alias("_d"), *shapiro_sums(x, F.col("mean")))
    sums = materialized(sums)
    tested = shapiro_of(sums, key).select(*key, F.col("shapiro_p").alias("shapiro_pvalue"))
    spread = F.when(F.col("_spread"), F.col("ss")).otherwise(0.0) / n
    wide = sums.withColumn("_m2", spread).select(
        *key, *names[:3], "n", F.sqrt("_m2").alias("std"),
        F.when(F.col("_m2") > 0, F.col("_c") / n / F.pow("_m2", F.lit(1.5))).alias("skewness"),
        F.when(F.col("_m2") > 0, F.col("_d") / n / (F.col("_m2") * F.col("_m2")) - 3.0).alias("excess_kurtosis"))
    return _scores(wide, tested, key).join(wide.select(*key, "lambda", "offset"), key)


def fit_transforms(df: DataFrame, feats: Sequence[str] | None = None) -> DataFrame:
    """One row per feature: the candidate with the highest score, ties to the earlier candidate."""
    feats = list(feats or select_features(df))
    long = feature_long(df, feats)
    stats, values = materialized(feature_stats(long)), packed(long, "feature")
    fitted = fit_lambdas(long, values=values)
    lambdas = fitted.groupBy("feature").agg(*[
        F.max(F.when(F.col("family") == family, F.col("lambda"))).alias(f"{tag}_lambda") for family, tag in FAMILIES.items()])
    scored = score_candidates(values, stats, lambdas)
    order = F.array_position(F.array(*[F.lit(c) for c in CANDIDATES]), F.col("candidate"))
    first = Window.partitionBy("feature").orderBy(F.col("score").desc_nulls_last(), order)
    chosen = scored.withColumn("_r", F.row_number().over(first)).filter("_r = 1").select(
        "feature", "candidate", "lambda", "offset", "score", "shapiro_pvalue", "skewness",
        "excess_kurtosis", F.col("mean").alias("new_mean"), F.col("std").alias("new_std"),
    )
    names = df.sparkSession.createDataFrame([(f,) for f in feats], "feature string")
    enough = F.coalesce(F.col("n") >= MIN_ROWS, F.lit(False))
    return names.join(stats, "feature", "left").join(chosen, "feature", "left").select(
        "feature",
        F.when(enough, F.col("candidate")).otherwise("identity").alias("transformation"),
        F.when(enough, F.col("lambda")).alias("lambda"),
        F.when(enough, F.col("offset")).alias("offset"),
        F.when(enough, F.col("score")).otherwise(-999.0).alias("normality_score"),
        "shapiro_pvalue", "skewness", "excess_kurtosis",
        "n", "mean", "std", "min", "max", "skew", "new_mean", "new_std",
    )


def transform_map(fitted: DataFrame) -> dict[str, dict]:
    """The fitted table as ``{feature: {transformation, parameters, ...}}`` (one entry per column)."""
    out = {}
    for r in fitted.collect():
        params = {k: r[k] for k in ("lambda", "offset") if r[k] is not None}
        out[r["feature"]] = {
            "transformation": r["transformation"],
            "rows": r["n"],
            "parameters": params,
            "normality_score": r["normality_score"],
            "normality_metrics": {
                "shapiro_pvalue": r["shapiro_pvalue"], "skewness": r["skewness"],
                "excess_kurtosis": r["excess_kurtosis"], "combined_score": r["normality_score"],
            },
            "original_stats": {k: r[k] for k in ("mean", "std", "min", "max", "skew")},
            "transformed_stats": {"mean": r["new_mean"], "std": r["new_std"], "skew": r["skewness"]},
        }
    return out


def apply_transforms(df: DataFrame, chosen: Mapping[str, Mapping]) -> DataFrame:
    """Replace features in place; identity, unknown names and absent columns change nothing."""
    known = set(CANDIDATES) - {"identity"}

    def column(c: str) -> Column:
        info = chosen.get(c)
        if info is None or info["transformation"] not in known:
            return F.col(c)
        params = info.get("parameters", {})
        value = apply_named(
            F.col(c), info["transformation"], F.lit(float(params.get("lambda", 1.0))),
            F.lit(float(params.get("offset", 0.0))),
        )
        return value.alias(c)

    return df.select(*[column(c) for c in df.columns])


def save_transforms(spark: SparkSession, chosen: Mapping[str, Mapping], path: str, sample_size: int | None = None) -> None:
    """Write the map as one JSON document to any file system Spark can reach. ``sample_size``: rows that the fit read
    (without it: the most of any feature)."""
    doc = {
        "created_at": datetime.now(timezone.utc).isoformat(),
        "sample_size": max((m.get("rows", 0) for m in chosen.values()), default=0) if sample_size is None else sample_size,
        "num_features": len(chosen),
        "context_included": True,
        "transformations": dict(chosen),
    }
    spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_transforms(spark: SparkSession, path: str) -> dict[str, dict]:
    text = "".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return json.loads(text)["transformations"]
