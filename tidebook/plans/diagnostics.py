"""Assembled test tables; input ``(series, idx, value)``."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dependence import lagged_mi, ljung_box, quantile_acf
from ..operators.moments import describe_series, jarque_bera_of, k2_of, moments, runs_test
from ..operators.moments import unbiased_kurtosis, unbiased_skew
from ..operators.normality import ANDERSON_LEVELS, anderson_normal, shapiro
from ..operators.ordering import dense_series
from ..operators.ranks import quantiles
from ..operators.regression import adf, arch_lm, arch_lm_many, kpss, tsay_test

# Column order of the overview.
FIRST_PATHS = (
    "normality.jb_p", "autocorr.ljung_box_returns.lags_20", "autocorr.ljung_box_squared.lags_20",
    "arch_lm.lags_10.LM_p", "stationarity.adf_p", "stationarity.kpss_p", "tsay.p", "runs.p",
)


def diagnose(long: DataFrame, arch_lags: int = 12) -> DataFrame:
    """One row per feature: description, normality, stationarity and heteroskedasticity.

    Tests of constant or short series are NULL.
    """
    rows = dense_series(long).checkpoint()
    shape = describe_series(long)
    m = k2_of(jarque_bera_of(moments(rows))).select("series", "k2_stat", "k2_p", "jb_stat", "jb_p")
    sh = shapiro(rows).drop("n")
    unit_root = adf(rows).drop("n")
    level = kpss(rows).drop("n")
    arch = arch_lm(rows, arch_lags).select("series", "arch_lm_stat", "arch_lm_p", "arch_lags")
    out = shape
    for part in (sh, m, unit_root, level, arch):
        out = out.join(part, "series", "left")
    tested = (~F.col("is_constant")) & (F.col("n") >= 8)
    names = ("shapiro_stat", "shapiro_p", "k2_stat", "k2_p", "jb_stat", "jb_p")
    return out.select(
        *shape.columns,
        *[F.when(tested, F.col(c)).alias({"shapiro_stat": "shapiro_W"}.get(c, c)) for c in names],
        "adf_stat", "adf_p", "adf_lags", "adf_nobs", "kpss_stat", "kpss_p", "kpss_lags",
        "arch_lm_stat", "arch_lm_p", F.coalesce("arch_lags", F.lit(arch_lags)).alias("arch_lags"),
    )


def interpret(diag: DataFrame) -> DataFrame:
    """Verdicts at 5 %; a missing p-value gives ``unknown``."""
    ps = [F.col(c) for c in ("shapiro_p", "k2_p", "jb_p")]
    worst = F.least(*ps)
    adf_ok, kpss_ok = F.col("adf_p") < 0.05, F.col("kpss_p") >= 0.05
    arch = F.col("arch_lm_p")
    return diag.select(
        "series", "n", "mean", "std", "skew", "kurtosis_excess",
        F.when(worst.isNull(), "unknown").when(worst < 0.05, "not normal").otherwise("normal").alias("normality"),
        F.when(F.col("adf_p").isNull() | F.col("kpss_p").isNull(), "unknown")
        .when(adf_ok & kpss_ok, "stationary")
        .when(~adf_ok & ~kpss_ok, "non-stationary")
        .otherwise("conflicting").alias("stationarity"),
        F.when(arch.isNull(), "unknown").when(arch < 0.05, "ARCH effects").otherwise("homoskedastic")
        .alias("heteroskedasticity"),
    )


def _horizon(series: str = "series") -> Column:
    return F.regexp_extract(series, r"(\d+)$", 1).cast("long")


def normality_report(long: DataFrame) -> DataFrame:
    """Moments and normality tests per return series, ordered by horizon."""
    m = jarque_bera_of(moments(long))
    shape = m.select(
        "series", "n", "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") * F.col("n") / (F.col("n") - 1.0))).alias("std"),
        unbiased_skew().alias("skew"), unbiased_kurtosis().alias("excess_kurtosis"),
        F.col("jb_stat").alias("jarque_bera_stat"), F.col("jb_p").alias("jarque_bera_p"),
    )
    sh = shapiro(long).drop("n")
    ad = anderson_normal(long).select("series", "anderson_stat", "anderson_crit_5pct", "anderson_reject_5pct")
    return (
        shape.join(sh, "series", "left").join(ad, "series", "left")
        .withColumn("horizon_n", _horizon()).orderBy("horizon_n", "series")
    )


def hetero_report(long: DataFrame, arch_lags: int = 10, lb_lags: Sequence[int] = (10, 20), min_n: int = 50) -> DataFrame:
    """ARCH-LM and Ljung-Box of squared deviations with decisions and a verdict."""
    least = max(min_n, arch_lags + 5)
    a, b = lb_lags
    arch = arch_lm(long, arch_lags, demean=False, min_n=least)
    lb = ljung_box(long, [1, a, b], of="demeaned_square")
    wide = lb.groupBy("series").agg(*[
        F.max(F.when(F.col("lags") == L, F.col("lb_p"))).alias(n)
        for L, n in ((1, "lb_sq_lag1_p"), (a, "lb_sq_laga_p"), (b, "lb_sq_lagb_p"))
    ])
    enough = F.col("n") >= least
    arch_hit = F.col("arch_lm_p") < 0.05
    lb_hit = F.least("lb_sq_lag1_p", "lb_sq_laga_p", "lb_sq_lagb_p") < 0.05
    found = F.concat_ws("+", F.when(arch_hit, "ARCH"), F.when(lb_hit, "LB(sq)"))
    return (
        arch.join(wide, "series", "left")
        .select(
            "series", _horizon().alias("horizon_n"), F.col("n").alias("n_stride"),
            "arch_lm_stat", "arch_lm_p", F.when(enough, arch_hit).alias("arch_reject_5pct"),
            *[F.when(enough, F.col(c)).alias(c) for c in ("lb_sq_lag1_p", "lb_sq_laga_p", "lb_sq_lagb_p")],
            F.when(enough, lb_hit).alias("lb_reject_any_5pct"),
            F.when(enough, "").otherwise(f"insufficient n (<{least})").alias("note"),
            F.when(~enough, "insufficient sample")
            .when(found == "", "no evidence at 5%")
            .otherwise(F.concat(F.lit("heteroskedasticity detected: "), found)).alias("verdict"),
        )
        .orderBy("horizon_n", "series")
    )


def _entries(df: DataFrame, pairs: Sequence[tuple[str, Column]]) -> DataFrame:
    """``(series, path, value, text)`` from columns of a table with one row per series."""
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    items = []
    for path, c in pairs:
        is_text = isinstance(path, tuple)
        items.append(F.struct(
            F.lit(path[0] if is_text else path).alias("path"),
            (none_d if is_text else c.cast("double")).alias("value"),
            (c.cast("string") if is_text else none_s).alias("text"),
        ))
    return df.select("series", F.explode(F.array(*items)).alias("e")).select("series", "e.*")


def _list_entry(df: DataFrame, path: Column, order: str, value: str) -> DataFrame:
    """Values along a lag as one text entry per series and path."""
    ordered = F.sort_array(F.collect_list(F.struct(order, value)))
    text = F.to_json(F.transform(ordered, lambda x: x[value]))
    return df.groupBy("series", path.alias("path")).agg(text.alias("text")).select(
        "series", "path", F.lit(None).cast("double").alias("value"), "text"
    )


def run_battery(
    long: DataFrame,
    lb_lags: Sequence[int] = (10, 20, 40),
    arch_lags: Sequence[int] = (5, 10, 20),
    tsay_p: int = 5,
    mi_max_lag: int = 20,
    taus: Sequence[float] = (0.01, 0.05, 0.10),
    qacf_max_lag: int = 20,
) -> DataFrame:
    """Every test of every series as long rows ``(series, path, value, text)``.

    The series are cleaned and written to the checkpoint folder once; each test reads that table. All Ljung-Box variants
    share one pass of lag products, all ARCH lag counts one pass of cross products.
    """
    rows = dense_series(long).checkpoint()
    m = jarque_bera_of(moments(rows))
    median = quantiles(rows, [0.5]).drop("n")
    shape = m.join(median, "series", "left")
    n = F.col("n")
    parts = [
        _entries(shape, [
            ("summary.n", n), ("summary.mean", F.col("mean")),
            ("summary.std", F.sqrt(F.col("m2") * n / (n - 1.0))),
            ("summary.skew", unbiased_skew()), ("summary.kurt", unbiased_kurtosis()),
            ("summary.min", F.col("min")), ("summary.max", F.col("max")), ("summary.median", F.get("q", 0)),
            ("normality.jb_stat", F.col("jb_stat")), ("normality.jb_p", F.col("jb_p")),
        ]),
        _entries(shapiro(rows), [
            ("normality.shapiro_stat", F.col("shapiro_stat")), ("normality.shapiro_p", F.col("shapiro_p")),
        ]),
        _entries(anderson_normal(rows), [
            ("normality.anderson_stat", F.col("anderson_stat")),
            (("normality.anderson_crit_vals",), F.to_json("anderson_crit_vals")),
            (("normality.anderson_signif",), F.lit(json.dumps(list(ANDERSON_LEVELS)))),
        ]),
        _entries(adf(rows, 4).join(kpss(rows, 4).drop("n"), "series"), [
            ("stationarity.adf_stat", F.col("adf_stat")), ("stationarity.adf_p", F.col("adf_p")),
            ("stationarity.kpss_stat", F.col("kpss_stat")), ("stationarity.kpss_p", F.col("kpss_p")),
        ]),
        _entries(tsay_test(rows, tsay_p), [
            (("tsay.method",), F.col("method")), ("tsay.F", F.col("tsay_f")),
            ("tsay.p", F.col("tsay_p")), ("tsay.df_diff", F.col("df_diff")),
        ]),
        _entries(runs_test(rows), [
            ("runs.z", F.col("z")), ("runs.p", F.col("p")),
            (("runs.error",), F.nullif(F.col("note"), F.lit(""))),
        ]),
        _list_entry(lagged_mi(rows, mi_max_lag), F.lit("mutual_information"), "lag", "mi"),
        _list_entry(
            quantile_acf(rows, taus, qacf_max_lag), F.concat(F.lit("qacf."), F.col("tau").cast("string")), "lag", "qacf"
        ),
    ]
    lb = ljung_box(rows, lb_lags, ["value", "square"])
    kind = F.when(F.col("of") == "value", "returns").otherwise("squared")
    parts.append(lb.select(
        "series", F.concat(F.lit("autocorr.ljung_box_"), kind, F.lit(".lags_"), "lags").alias("path"),
        F.col("lb_p").alias("value"), F.lit(None).cast("string").alias("text"),
    ))
    arch = arch_lm_many(rows, arch_lags, demean=False, min_n=0)
    parts.append(arch.select("series", F.explode(F.array(*[
        F.struct(F.concat(F.lit("arch_lm.lags_"), "arch_lags", F.lit(f".{name}")).alias("path"), F.col(c).alias("value"))
        for name, c in (("LM_p", "arch_lm_p"), ("F_p", "arch_f_p"))
    ])).alias("e")).select("series", "e.path", "e.value", F.lit(None).cast("string").alias("text")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter(F.col("value").isNotNull() | F.col("text").isNotNull())


def battery_overview(results: DataFrame, paths: Sequence[str] | None = None) -> DataFrame:
    """One row per series, one column per path (numbers as text), key p-values first."""
    if paths is None:
        found = [r.path for r in results.select("path").distinct().orderBy("path").collect()]
        paths = [p for p in FIRST_PATHS if p in found] + [p for p in found if p not in FIRST_PATHS]
    shown = results.withColumn("_v", F.coalesce(F.col("text"), F.col("value").cast("string")))
    return shown.groupBy("series").pivot("path", list(paths)).agg(F.first("_v")).select(
        "series", *[F.col(f"`{p}`") for p in paths]
    )
