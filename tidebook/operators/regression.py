"""Tests that rest on least squares over lags.

Each chunk of a series (with the edge rows it needs) gives the cross-product matrix of its design
rows; the matrices are summed per series and solved once. Nothing but matrices leaves the chunks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import adf_pvalue, chi2_sf, f_sf, kpss_pvalue
from .ordering import CHUNK, halo_chunks, materialized, small_side

SLICE = 4096


def _grams(long: DataFrame, params: DataFrame, back: Column, design) -> DataFrame:
    """Per series: ``gram`` (sum over chunks of D'D) and ``head`` (first ``back`` values).

    ``params`` has per series ``n, shift, scale, lags``; ``design(x, own, lags)`` returns the design
    rows of the owned positions, with the response as the last column.
    """
    rows = long.join(small_side(params), "series")
    chunks = halo_chunks(rows, "idx", CHUNK, back=back)

    def chunk_gram(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        lags = int(pdf["lags"].iloc[0])
        x = (pdf["value"].to_numpy() - pdf["shift"].iloc[0]) / pdf["scale"].iloc[0]
        own = np.flatnonzero(pdf["own"].to_numpy())
        first = int(pdf["idx"].iloc[0])
        total = None
        for part in np.array_split(own, max(1, math.ceil(len(own) / SLICE))):
            d = design(x, part, first, lags)
            g = d.T @ d
            total = g if total is None else total + g
        head = x[: lags + 3] if first == 0 and len(own) and own[0] == 0 else np.array([])
        return pd.DataFrame({"series": [key[0]], "gram": [total.ravel()], "head": [head]})

    parts = chunks.select("series", "chunk", "idx", "value", "own", "lags", "shift", "scale").groupBy(
        "series", "chunk"
    ).applyInPandas(chunk_gram, "series string, gram array<double>, head array<double>")
    return parts.groupBy("series").agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.col("gram")))).alias("gram"),
        F.max("head").alias("head"),
    )


def _params(long: DataFrame, lags: Column | int, scale: bool = True) -> DataFrame:
    lags = F.lit(lags) if isinstance(lags, int) else lags
    stats = long.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd")
    )
    return materialized(stats).select(
        "series", "n", "mean", lags.cast("int").alias("lags"),
        F.col("mean").alias("shift"),
        F.when(F.lit(scale) & (F.col("sd") > 0), F.col("sd")).otherwise(F.lit(1.0)).alias("scale"),
    )


def _lagged(x: np.ndarray, at: np.ndarray, lags: int) -> np.ndarray:
    return np.column_stack([x[at - k] for k in range(1, lags + 1)]) if lags else np.empty((len(at), 0))


def _rss(gram: np.ndarray, cols: list[int]) -> float:
    """Residual sum of squares of the last column on ``cols``, from the cross products."""
    a, b, yy = gram[np.ix_(cols, cols)], gram[cols, -1], gram[-1, -1]
    coef = np.linalg.lstsq(a, b, rcond=None)[0]
    return float(max(yy - b @ coef, 0.0))


def arch_lm(long: DataFrame, lags: int = 12, demean: bool = True, min_n: int | None = None) -> DataFrame:
    """Squared values regressed on their own lags: LM and F forms.

    Series shorter than ``min_n`` (default ``lags + 5``) get NULL.
    """
    return arch_lm_many(long, [lags], demean, min_n)


def arch_lm_many(long: DataFrame, lags: Sequence[int], demean: bool = True, min_n: int | None = None) -> DataFrame:
    """The rows of ``arch_lm`` for several lag counts, from one pass.

    The matrix of the largest count holds those of the smaller ones, but for the first rows, which come from the kept head of
    the series.
    """
    lags, most = sorted(lags), max(lags)
    base = _params(long, most)
    params = base.filter(F.col("n") >= 2 * lags[0] + 2)
    if not demean:
        params = params.withColumn("shift", F.lit(0.0))

    def rows(x, at, k):
        e = x * x
        return np.column_stack([np.ones(len(at)), _lagged(e, at, k), e[at]])

    def design(x, own, first, k):
        return rows(x, own[own + first >= k], k)

    @F.pandas_udf("array<struct<lags:int,lm:double,f:double,nobs:double>>")
    def solve(gram: pd.Series, head: pd.Series, size: pd.Series) -> pd.Series:
        out = []
        for g, h, n in zip(gram, head, size):
            g, h, found = np.asarray(g).reshape(most + 2, most + 2), np.asarray(h), []
            for k in lags:
                if n < max(k + 5 if min_n is None else min_n, 2 * k + 2):
                    continue
                own = g[np.ix_(keep := [*range(k + 1), most + 1], keep)]
                early = np.arange(k, min(most, len(h)))
                if len(early):
                    d = rows(h, early, k)
                    own = own + d.T @ d
                nobs, rss = own[0, 0], _rss(own, list(range(k + 1)))
                tss = own[-1, -1] - own[0, -1] ** 2 / nobs
                if tss <= 0:
                    found.append({"lags": k, "lm": None, "f": None, "nobs": nobs})
                    continue
                r2, rest = 1 - rss / tss, nobs - k - 1
                found.append({"lags": k, "lm": nobs * r2, "f": (r2 / k) / ((1 - r2) / rest) if rest > 0 and r2 < 1 else None, "nobs": nobs})
            out.append(found)
        return pd.Series(out)

    grams = _grams(long, params, F.col("lags"), design).join(params.select("series", "n"), "series")
    fitted = grams.select("series", F.explode(solve("gram", "head", "n")).alias("r")).select("series", "r.*")
    asked = base.select("series", "n", F.explode(F.array(*[F.lit(k) for k in lags])).alias("lags"))
    out = asked.join(fitted, ["series", "lags"], "left").select(
        "series", "n", F.col("lags").alias("arch_lags"), F.col("lm").alias("arch_lm_stat"), F.col("f").alias("arch_f_stat"), F.col("nobs").alias("_nobs"))
    return out.select(
        "series", "n", "arch_lags", "arch_lm_stat",
        chi2_sf(F.col("arch_lm_stat"), F.col("arch_lags")).alias("arch_lm_p"),
        "arch_f_stat",
        f_sf(F.col("arch_f_stat"), F.col("arch_lags"), F.col("_nobs") - F.col("arch_lags") - 1).alias("arch_f_p"),
    )


def adf_max_lag(n: Column) -> Column:
    wide = F.ceil(12.0 * F.pow(n / 100.0, F.lit(0.25)))
    return F.greatest(F.least(wide, F.floor(n / 2) - 2), F.lit(0))


def _adf_stat(gram: np.ndarray, lags: int) -> float:
    """t value of the level term in: difference ~ level + lagged differences + constant."""
    cols = list(range(lags + 2))
    a, b = gram[np.ix_(cols, cols)], gram[cols, -1]
    inv = np.linalg.pinv(a)
    coef = inv @ b
    nobs = gram[0, 0]
    s2 = max(gram[-1, -1] - b @ coef, 0.0) / (nobs - len(cols))
    return float(coef[1] / math.sqrt(s2 * inv[1, 1])) if s2 > 0 else math.nan


def _adf_rows(x: np.ndarray, at: np.ndarray, lags: int) -> np.ndarray:
    d = np.concatenate([[0.0], np.diff(x)])
    return np.column_stack([np.ones(len(at)), x[at - 1], _lagged(d, at, lags), d[at]])


def adf(long: DataFrame, min_n: int = 15) -> DataFrame:
    """Augmented Dickey-Fuller with constant, lag count by AIC.

    All lag choices are compared on one matrix. The chosen model uses the earlier rows too; those
    few rows come from the kept head of the series.
    """
    base = _params(long, adf_max_lag(F.col("n")))
    params = base.filter((F.col("n") >= min_n) & (F.col("scale") > 0))

    def design(x, own, first, k):
        return _adf_rows(x, own[own + first >= k + 1], k)

    @F.pandas_udf("struct<stat:double,lags:int,nobs:int>")
    def solve(gram: pd.Series, head: pd.Series, k: pd.Series) -> pd.DataFrame:
        out = []
        for g, h, m in zip(gram, head, k):
            g, h = np.asarray(g).reshape(m + 3, m + 3), np.asarray(h)
            nobs = g[0, 0]
            aic = []
            for lag in range(m + 1):
                rss = _rss(g, list(range(lag + 2)))
                aic.append(nobs * math.log(rss / nobs) + 2 * (lag + 2) if rss > 0 else -math.inf)
            used = int(np.argmin(aic))
            keep = [*range(used + 2), m + 2]
            best = g[np.ix_(keep, keep)]
            early = np.arange(used + 1, min(m + 1, len(h)))
            if len(early):
                d = _adf_rows(h, early, used)
                best = best + d.T @ d
            stat = _adf_stat(best, used)
            out.append((stat if math.isfinite(stat) else None, used, int(round(best[0, 0]))))
        return pd.DataFrame(out, columns=["stat", "lags", "nobs"])

    fitted = _grams(long, params, F.col("lags") + 1, design).join(params.select("series", "lags"), "series")
    solved = fitted.withColumn("r", solve("gram", "head", "lags"))
    out = base.select("series", "n").join(solved.select("series", "r"), "series", "left").select(
        "series", "n", F.col("r.stat").alias("adf_stat"), F.col("r.lags").alias("adf_lags"),
        F.col("r.nobs").alias("adf_nobs"),
    )
    return out.withColumn("adf_p", adf_pvalue(F.col("adf_stat")))


def tsay_test(long: DataFrame, p: int = 5) -> DataFrame:
    """Nested F test of adding squared lags to an autoregression of order ``p``.

    A constant, the lags and their squares span the same space whether or not the lags are
    standardized, so the fit needs no second pass.
    """
    base = _params(long, p)
    params = base.filter((F.col("n") - p >= p + 10) & (F.col("n") - p > 2 * p + 1))

    def design(x, own, first, k):
        at = own[own + first >= k]
        lag = _lagged(x, at, k)
        return np.column_stack([np.ones(len(at)), lag, lag * lag, x[at]])

    @F.pandas_udf("struct<f:double,nobs:double,diff:int>")
    def solve(gram: pd.Series) -> pd.DataFrame:
        out = []
        for g in gram:
            g = np.asarray(g).reshape(2 * p + 2, 2 * p + 2)
            lin, full = list(range(p + 1)), list(range(2 * p + 1))
            diff = int(np.linalg.matrix_rank(g[np.ix_(full, full)]) - np.linalg.matrix_rank(g[np.ix_(lin, lin)]))
            r1, r2, nobs = _rss(g, lin), _rss(g, full), g[0, 0]
            ok = diff == p and r2 > 0
            out.append(((r1 - r2) / p / (r2 / (nobs - 2 * p - 1)) if ok else None, nobs, diff if ok else None))
        return pd.DataFrame(out, columns=["f", "nobs", "diff"])

    fitted = _grams(long, params, F.col("lags"), design).withColumn("r", solve("gram"))
    out = base.select("series", "n").join(fitted.select("series", "r"), "series", "left").select(
        "series", "n", F.col("r.f").alias("tsay_f"), F.col("r.diff").alias("df_diff"), F.col("r.nobs").alias("_nobs")
    )
    return out.select(
        "series", "n",
        F.when(F.col("tsay_f").isNotNull(), "F-nested").otherwise("unavailable").alias("method"),
        "tsay_f", f_sf(F.col("tsay_f"), F.lit(p), F.col("_nobs") - 2 * p - 1).alias("tsay_p"), "df_diff",
    )


def kpss(long: DataFrame, min_n: int = 15) -> DataFrame:
    """Level-stationarity statistic with automatic lag count; p limited to [0.01, 0.1].

    First pass: lag products up to n^(2/9) choose the lag count (Hobijn et al.). Second pass: sums of
    squared partial sums (chunk sums plus what earlier chunks carry) and the Bartlett long-run
    variance, written as the mean of squared moving sums.
    """
    n = F.col("n")
    base = materialized(long.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd")
    ))
    params = base.filter((n >= min_n) & (F.col("sd") > 0)).withColumn(
        "cov", F.floor(F.pow(n.cast("double"), F.lit(2 / 9)) + 1e-9).cast("int")
    )

    def products(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        e = (pdf["value"].to_numpy() - pdf["mean"].iloc[0]) / pdf["sd"].iloc[0]
        own, first = np.flatnonzero(pdf["own"].to_numpy()), int(pdf["idx"].iloc[0])
        sums = []
        for k in range(int(pdf["cov"].iloc[0]) + 1):
            at = own[own + first >= k]
            sums.append(float(e[at] @ e[at - k]))
        return pd.DataFrame({"series": [key[0]], "s": [sums]})

    rows = long.join(small_side(params), "series")
    lagsums = (
        halo_chunks(rows, "idx", CHUNK, back=F.col("cov"))
        .groupBy("series", "chunk").applyInPandas(products, "series string, s array<double>")
        .groupBy("series").agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("s")))).alias("s"))
    )

    @F.pandas_udf("int")
    def pick(s: pd.Series, rows_n: pd.Series) -> pd.Series:
        out = []
        for v, m in zip(s, rows_n):
            r = 2 * np.asarray(v)[1:] / m
            s0 = v[0] / m + r.sum()
            s1 = (r * np.arange(1, len(r) + 1)).sum()
            gamma = 1.1447 * ((s1 / s0) ** 2) ** (1 / 3)
            out.append(min(int(gamma * m ** (1 / 3)), int(m) - 1))
        return pd.Series(out, dtype="int32")

    chosen = materialized(
        params.join(lagsums, "series").select("series", "n", "mean", "sd", pick("s", "n").alias("lags"))
    )

    def partials(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        e = (pdf["value"].to_numpy() - pdf["mean"].iloc[0]) / pdf["sd"].iloc[0]
        own_mask = pdf["own"].to_numpy()
        own, idx = np.flatnonzero(own_mask), pdf["idx"].to_numpy()
        lags, rows_n = int(pdf["lags"].iloc[0]), int(pdf["n"].iloc[0])
        s = np.cumsum(e[own])
        # moving sums of lags + 1 values ending at the owned rows, shorter at the series start
        c = np.concatenate([[0.0], np.cumsum(e)])
        start = np.maximum(own - lags, 0)
        window = c[own + 1] - c[start]
        squares = float(window @ window)
        if len(own) and idx[own[-1]] == rows_n - 1:
            tail = c[-1] - c[np.maximum(len(e) - np.arange(lags, 0, -1), 0)]
            squares += float(tail @ tail)
        return pd.DataFrame({
            "series": [key[0]], "chunk": [key[1]], "m": [len(own)], "total": [float(s[-1]) if len(own) else 0.0],
            "s1": [float(s.sum())], "s2": [float(s @ s)], "squares": [squares],
        })

    rows2 = long.join(small_side(chosen), "series")
    parts = halo_chunks(rows2, "idx", CHUNK, back=F.col("lags")).groupBy("series", "chunk").applyInPandas(
        partials,
        "series string, chunk long, m long, total double, s1 double, s2 double, squares double",
    )
    from pyspark.sql import Window

    before = Window.partitionBy("series").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = F.coalesce(F.sum("total").over(before), F.lit(0.0))
    summed = parts.withColumn("_c", carry).groupBy("series").agg(
        F.sum(F.col("m") * F.col("_c") * F.col("_c") + 2 * F.col("_c") * F.col("s1") + F.col("s2")).alias("eta"),
        F.sum("squares").alias("squares"),
    )
    stat = F.col("eta") / (n * n) / (F.col("squares") / (F.col("lags") + 1) / n)
    out = base.select("series", "n").join(
        chosen.join(summed, "series").select("series", stat.alias("kpss_stat"), F.col("lags").alias("kpss_lags")),
        "series", "left",
    )
    return out.withColumn("kpss_p", kpss_pvalue(F.col("kpss_stat")))
