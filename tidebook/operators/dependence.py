"""Autocorrelation, rank correlation, binned mutual information and quantile ACF."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tails import chi2_sf
from .ordering import CHUNK, halo_chunks, materialized, small_side, tasks_for
from .ranks import average_ranks, quantiles

MI_BINS = 10
MIN_PAIRS = 50


KINDS = ("value", "square", "demeaned_square")


def lag_products(long: DataFrame, max_lag: int, of: Sequence[str] = KINDS) -> DataFrame:
    """``(series, of, n, m2, lag, p)``: sums of products of deviations ``lag`` rows apart, for the values, their squares and
    their squared deviations at once.

    One aggregate gives all means; then one pass over chunks with copied edge rows, in which a chunk gives one number per kind and lag.
    """
    x = F.col("value")
    base = long.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.avg(x).alias("mean"), F.avg(x * x).alias("square"), F.var_pop(x).alias("demeaned_square"))
    rows = halo_chunks(long.select("series", "idx", "value").join(small_side(base), "series"), "idx", CHUNK, back=max_lag)
    kinds = tuple(of)

    def products(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(table["idx"].to_numpy())
        v, own = table["value"].to_numpy()[order], table["own"].to_numpy(zero_copy_only=False)[order]
        mean, square, spread = (table[c][0].as_py() for c in ("mean", "square", "demeaned_square"))
        first, sums = int(np.flatnonzero(own)[0]) if own.any() else len(v), []
        for kind in kinds:
            d = v - mean if kind == "value" else v * v - square if kind == "square" else (v - mean) ** 2 - spread
            for k in range(max_lag + 1):
                start = max(first, k)  # only the first chunk has rows without a row k before them
                sums.append(float(d[start:] @ d[start - k : len(d) - k]) if start < len(d) else 0.0)
        n = len(sums)
        return pa.table({
            "series": pa.array([key[0].as_py()] * n, pa.string()), "of": np.repeat(kinds, max_lag + 1).tolist(),
            "lag": np.tile(np.arange(max_lag + 1, dtype=np.int32), len(kinds)), "p": sums})

    parts = rows.groupBy("series", "chunk").applyInArrow(products, "series string, of string, lag int, p double")
    sums = parts.groupBy("series", "of", "lag").agg(F.sum("p").alias("p"))
    sizes = base.select("series", "n")
    whole = sums.filter("lag = 0").select("series", "of", F.col("p").alias("_p0"))
    return sums.filter("lag > 0").join(whole, ["series", "of"]).join(small_side(sizes), "series").select(
        "series", "of", "n", (F.col("_p0") / F.col("n")).alias("m2"), "lag", "p")


def autocorrelations(long: DataFrame, max_lag: int, of: str | Sequence[str] = "value") -> DataFrame:
    """``(series, n, lag, acf)`` for lags 1..max_lag of the values, their squares (``square``) or
    their squared deviations (``demeaned_square``); with several kinds, ``of`` is a column too."""
    kinds = [of] if isinstance(of, str) else list(of)
    named = [] if isinstance(of, str) else ["of"]
    return lag_products(long, max_lag, kinds).select(
        "series", *named, "n", "lag", F.when(F.col("m2") > 0, F.col("p") / (F.col("n") * F.col("m2"))).alias("acf"))


def ljung_box(long: DataFrame, lags: Sequence[int] = (10, 20, 40), of: str | Sequence[str] = "value") -> DataFrame:
    """``(series, n, lags, lb_stat, lb_p)``; a lag count the series is too short for gives NULL. Several kinds ``of`` share
    one pass and have a column ``of``."""
    acf = autocorrelations(long, max(lags), of)
    keys = ["series", "n"] if isinstance(of, str) else ["series", "of", "n"]
    n = F.col("n")
    term = F.col("acf") * F.col("acf") / (n - F.col("lag"))
    sums = acf.groupBy(*keys).agg(
        *[F.sum(F.when((F.col("lag") <= L) & (n > F.col("lag")), term)).alias(f"_q{L}") for L in lags]
    )
    entries = F.array(*[F.struct(F.lit(L).alias("lags"), F.col(f"_q{L}").alias("q")) for L in lags])
    stat = F.when(n > F.col("e.lags"), n * (n + 2.0) * F.col("e.q"))
    return sums.select(*keys, F.explode(entries).alias("e")).select(
        *keys, F.col("e.lags").alias("lags"), stat.alias("lb_stat")
    ).withColumn("lb_p", chi2_sf(F.col("lb_stat"), F.col("lags")))


def quantile_acf(long: DataFrame, taus: Sequence[float] = (0.01, 0.05, 0.10), max_lag: int = 20) -> DataFrame:
    """Correlation of the indicator ``value <= quantile(tau)`` with its own lags."""
    q = quantiles(long, taus)
    rows = halo_chunks(long.select("series", "idx", "value").join(small_side(q), "series"), "idx", CHUNK, back=max_lag)

    def counts(key: tuple, table: pa.Table) -> pa.Table:
        """Indicators are 0/1, so counts give the correlation exactly."""
        v, there, own = _chunk_in_order(table)
        first, found = int(np.flatnonzero(own)[0]) if own.any() else len(v), []
        for tau, cut in zip(taus, table["q"][0].as_py()):
            hit = there & (v <= cut)
            for k in range(1, max_lag + 1):
                start = max(first, k)  # only the first chunk has rows without a row k before them
                x, y, ok = hit[start:], hit[start - k : len(v) - k], there[start - k : len(v) - k]
                if start < len(v):
                    found.append((key[0].as_py(), float(tau), k, *(int(np.count_nonzero(c)) for c in (ok, x & ok, y, x & y))))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 7, (
            pa.string(), pa.float64(), pa.int32(), *[pa.int64()] * 4))], names=["series", "tau", "lag", "m", "sx", "sy", "sxy"])

    parts = rows.groupBy("series", "chunk").applyInArrow(
        counts, "series string, tau double, lag int, m long, sx long, sy long, sxy long")
    sums = parts.groupBy("series", "tau", "lag").agg(*[F.sum(c).cast("double").alias(c) for c in ("m", "sx", "sy", "sxy")]).filter("m > 0")
    m, sx, sy = F.col("m"), F.col("sx"), F.col("sy")
    denom = F.sqrt((m * sx - sx * sx) * (m * sy - sy * sy))
    return sums.select(
        "series", "tau", "lag", F.col("m").cast("long").alias("pairs"),
        F.when((m >= 10) & (denom > 0), (m * F.col("sxy") - sx * sy) / denom).alias("qacf"),
    )


def _chunk_in_order(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of a chunk along ``idx``, which of them are not null, and which rows are the chunk's own."""
    order = np.argsort(table["idx"].to_numpy())
    value = table["value"].combine_chunks()
    there = value.is_valid().to_numpy(zero_copy_only=False)
    return value.to_numpy(zero_copy_only=False)[order], there[order], table["own"].to_numpy(zero_copy_only=False)[order]


def _numbered_long(df: DataFrame, key: str, feats: Sequence[str]) -> DataFrame:
    """``(idx, series, value)`` of rows where all features are finite."""
    return df.dropna(subset=list(feats)).select(
        F.col(key).alias("idx"), *[F.col(f).cast("double").alias(f) for f in feats]
    ).unpivot(["idx"], list(feats), "series", "value")


def _pair_list(left: Sequence[str], right: Sequence[str] | None) -> list[tuple[str, str]]:
    if right is None:
        return [(a, b) for i, a in enumerate(left) for b in left[i + 1:]]
    return [(a, b) for a in left for b in right]


def _columns(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) if batch.num_columns else np.zeros((0, 0))


def _rank_products(names: Sequence[str], pairs: Sequence[tuple[str, str]], middle: float):
    """Sums of products of centred ranks: one matrix product per batch, one row per pair and task."""
    at = [(names.index(a), names.index(b)) for a, b in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((len(names), len(names)))
        for batch in batches:
            d = _columns(batch) - middle
            gram += d.T @ d
        yield pa.RecordBatch.from_pydict({
            "feature_a": [a for a, _ in pairs], "feature_b": [b for _, b in pairs],
            "ab": [gram[i, j] for i, j in at], "aa": [gram[i, i] for i, _ in at], "bb": [gram[j, j] for _, j in at]})

    return run


def _spearman(df: DataFrame, key: str, left: Sequence[str], right: Sequence[str] | None) -> DataFrame:
    names = list(dict.fromkeys([*left, *(right or [])]))
    n = df.dropna(subset=names).count()
    parts = tasks_for(df.sparkSession, n * len(names))
    ranks = average_ranks(_numbered_long(df, key, names), parts=parts)
    wide = ranks.repartition(parts, "idx").groupBy("idx").agg(
        *[F.max(F.when(F.col("series") == f, F.col("rank"))).alias(f) for f in names]
    ).drop("idx")
    # The mean of average ranks is (n + 1) / 2, so centred sums need no pass of their own.
    sums = wide.mapInArrow(
        _rank_products(names, _pair_list(left, right), (n + 1) / 2),
        "feature_a string, feature_b string, ab double, aa double, bb double",
    ).groupBy("feature_a", "feature_b").agg(*[F.sum(c).alias(c) for c in ("ab", "aa", "bb")])
    return sums.select("feature_a", "feature_b", F.when(
        (F.col("aa") > 0) & (F.col("bb") > 0), F.col("ab") / F.sqrt(F.col("aa") * F.col("bb"))).alias("rho"))


def spearman_matrix(df: DataFrame, key: str, feats: Sequence[str]) -> DataFrame:
    """Upper triangle ``(feature_a, feature_b, rho)`` of the Spearman matrix."""
    return _spearman(df, key, feats, None)


def spearman_targets(df: DataFrame, key: str, feats: Sequence[str], targets: Sequence[str]) -> DataFrame:
    return _spearman(df, key, feats, targets)


def top_pairs(pairs: DataFrame, value: str = "rho", k: int = 15) -> DataFrame:
    return pairs.filter(F.col(value).isNotNull()).orderBy(
        F.abs(value).desc(), "feature_a", "feature_b"
    ).limit(k)


def pair_summary(pairs: DataFrame, value: str = "rho") -> DataFrame:
    v = F.col(value)
    return pairs.filter(v.isNotNull()).agg(
        F.avg(v).alias("mean"), F.max(v).alias("max"), F.min(v).alias("min"),
        F.stddev_pop(v).alias("std"), F.avg(F.abs(v)).alias("abs_mean"),
    )


def _edges(long: DataFrame, bins: int) -> DataFrame:
    return quantiles(long, [i / bins for i in range(1, bins)]).drop("n")


def _mi_from_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plug-in estimate from joint counts ``(keys, x, y, c)``; the table has at most bins^2 rows a key."""
    c, n = F.col("c").cast("double"), F.col("n")
    total = counts.groupBy(*keys).agg(F.sum("c").cast("double").alias("n"))
    px = counts.groupBy(*keys, "x").agg(F.sum("c").cast("double").alias("cx"))
    py = counts.groupBy(*keys, "y").agg(F.sum("c").cast("double").alias("cy"))
    joined = counts.join(total, list(keys)).join(px, [*keys, "x"]).join(py, [*keys, "y"])
    return joined.groupBy(*keys, "n").agg(
        F.sum(c / n * F.log(c * n / (F.col("cx") * F.col("cy")))).alias("mi")
    )


def _joint_counts(names: Sequence[str], pairs: Sequence[tuple[str, str]], edges: dict[str, list[float]], bins: int):
    """Joint counts of all pairs: the rows' bins as 0/1 columns, one matrix product per batch, added up per task."""
    at = [(names.index(a), names.index(b)) for a, b in pairs]
    cuts = [np.array(edges[f]) for f in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names) * bins, len(names) * bins))
        for batch in batches:
            v = _columns(batch)
            marks = np.zeros((len(v), len(names) * bins), np.float32)  # whole numbers below 2^24 stay exact
            for j, cut in enumerate(cuts):
                marks[np.arange(len(v)), j * bins + np.searchsorted(cut, v[:, j], side="right")] = 1
            total += marks.T @ marks
        for (a, b), (i, j) in zip(pairs, at):
            part = total[i * bins : (i + 1) * bins, j * bins : (j + 1) * bins]
            x, y = np.nonzero(part)
            yield pa.RecordBatch.from_pydict({
                "feature_a": [a] * len(x), "feature_b": [b] * len(x), "x": x.astype(np.int32), "y": y.astype(np.int32), "c": part[x, y].astype(np.int64)})

    return run


def _mutual(df: DataFrame, left, right, bins: int) -> DataFrame:
    names = list(dict.fromkeys([*left, *(right or [])]))
    clean = df.dropna(subset=names).select(*[F.col(f).cast("double").alias(f) for f in names])
    # One row of bounds per column reaches the driver.
    edges = {r["series"]: r["q"] for r in _edges(clean.unpivot([], names, "series", "value"), bins).collect()}
    if not edges:
        edges = {f: [0.0] * (bins - 1) for f in names}
    counts = clean.mapInArrow(
        _joint_counts(names, _pair_list(left, right), edges, bins), "feature_a string, feature_b string, x int, y int, c long"
    ).groupBy("feature_a", "feature_b", "x", "y").agg(F.sum("c").alias("c"))
    return _mi_from_counts(materialized(counts), ["feature_a", "feature_b"]).drop("n")


def mi_matrix(df: DataFrame, feats: Sequence[str], bins: int = MI_BINS) -> DataFrame:
    """Upper triangle of mutual information on quantile bins; the diagonal is 0 by definition."""
    return _mutual(df, feats, None, bins)


def mi_targets(df: DataFrame, feats: Sequence[str], targets: Sequence[str], bins: int = MI_BINS) -> DataFrame:
    return _mutual(df, feats, targets, bins)


def lagged_mi(long: DataFrame, max_lag: int = 20, bins: int = MI_BINS) -> DataFrame:
    """Mutual information of a series with its own lags; NULL below 50 pairs."""
    edges = small_side(_edges(long, bins))
    rows = halo_chunks(long.select("series", "idx", "value").join(edges, "series"), "idx", CHUNK, back=max_lag)

    def joint(key: tuple, table: pa.Table) -> pa.Table:
        v, there, own = _chunk_in_order(table)
        b = np.where(there, np.searchsorted(np.array(table["q"][0].as_py(), float), v, side="right"), bins)  # ``bins``: no value
        first, lags, cells = int(np.flatnonzero(own)[0]) if own.any() else len(v), [], []
        for k in range(1, max_lag + 1):
            start = max(first, k)
            if start < len(v):
                cells.append(np.bincount(b[start - k : len(v) - k] * (bins + 1) + b[start:], minlength=(bins + 1) ** 2))
                lags.append(k)
        table = np.array(cells, np.int64).reshape(-1, (bins + 1) ** 2)
        row, cell = np.nonzero(table)
        kept = cell < bins * (bins + 1)
        row, cell = row[kept], cell[kept]
        y = cell % (bins + 1)
        return pa.table({
            "series": pa.array([key[0].as_py()] * len(row), pa.string()), "lag": pa.array(np.array(lags, np.int32)[row]),
            "x": pa.array((cell // (bins + 1)).astype(np.int32)), "y": pa.array(y.astype(np.int32), mask=y == bins), "c": pa.array(table[row, cell])})

    counts = rows.groupBy("series", "chunk").applyInArrow(joint, "series string, lag int, x int, y int, c long").groupBy(
        "series", "lag", "x", "y").agg(F.sum("c").alias("c"))
    return _mi_from_counts(counts, ["series", "lag"]).select(
        "series", "lag", F.col("n").cast("long").alias("pairs"),
        F.when(F.col("n") >= MIN_PAIRS, F.col("mi")).alias("mi"),
    )
