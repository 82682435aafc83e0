"""Price standardization, volume normalization, price bins and EWMA z-scores."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import BINS, CLIP, FWD_PREFIX, HALF_LIFE, NOT_SCALED
from .decay import HELPERS, decayed, with_decay
from .fitting import select_features

MIN_DENOM = 1e-6
PRICE_EPS = 1e-8
FLAT_RANGE = 1e-10


def standardize_prices(df: DataFrame) -> DataFrame:
    """``(p - mid) / (max(sqrt(var) * mid, 1e-6) + 1e-8)`` on both sides."""
    with_denom = df.withColumn(
        "_d", F.greatest(F.sqrt("variance_proxy") * F.col("mid_price"), F.lit(MIN_DENOM)) + PRICE_EPS
    )

    def side(c: str):
        return F.transform(c, lambda x: F.array((x[0] - F.col("mid_price")) / F.col("_d"), x[1]))

    return with_denom.withColumns({"bids": side("bids"), "asks": side("asks")}).drop("_d")


def normalize_volumes(df: DataFrame) -> DataFrame:
    """Each volume as a share of both sides; 0 when the book has no volume."""
    def volume(c: str):
        return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x[1])

    with_total = df.withColumn("_t", volume("bids") + volume("asks"))

    def side(c: str):
        return F.transform(c, lambda x: F.array(x[0], F.when(F.col("_t") == 0, 0.0).otherwise(x[1] / F.col("_t"))))

    return with_total.withColumns({"bids": side("bids"), "asks": side("asks")}).drop("_t")


def flatten_book(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("_pairs", F.concat("bids", "asks"))
        .withColumns({
            "prices": F.transform("_pairs", lambda x: x[0]),
            "volumes": F.transform("_pairs", lambda x: x[1]),
        })
        .drop("bids", "asks", "_pairs")
    )


def _bin_batch(prices: pa.ListArray, volumes: pa.ListArray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Negative and positive halves for all snapshots of an Arrow batch, as (rows, bins // 2)."""
    rows, half = len(prices), bins // 2
    np_len = np.array([0 if x is None else x for x in pa.compute.list_value_length(prices).to_pylist()], dtype=np.int64)
    nv_len = np.array([0 if x is None else x for x in pa.compute.list_value_length(volumes).to_pylist()], dtype=np.int64)

    def flat(arr, lens, keep):
        values = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        row = np.repeat(np.arange(rows), lens)
        place = np.arange(len(values)) - np.repeat(np.cumsum(lens) - lens, lens)
        mask = place < keep[row]
        return values[mask], row[mask]

    common = np.minimum(np_len, nv_len)
    p, row = flat(prices, np_len, common)
    v, _ = flat(volumes, nv_len, common)
    ok = np.isfinite(p) & np.isfinite(v) & (v > 0)
    p, v, row = p[ok], v[ok], row[ok]

    lo, hi = np.full(rows, np.inf), np.full(rows, -np.inf)
    np.minimum.at(lo, row, p)
    np.maximum.at(hi, row, p)
    used = np.isfinite(lo)
    lo, hi = np.where(used, lo, 0.0), np.where(used, hi, 0.0)
    flat_range = (hi - lo) < FLAT_RANGE
    step = np.where(flat_range, 1.0, (hi - lo) / bins)

    def edge(i, r):
        return np.where(i == bins, hi[r], i * step[r] + lo[r])

    # Floor gives the bin up to rounding; comparing with the edges settles it.
    idx = np.clip(np.floor((p - lo[row]) / step[row]), 0, bins - 1).astype(np.int64)
    idx -= (edge(idx, row) > p) & (idx > 0)
    idx += (edge(idx + 1, row) <= p) & (idx < bins - 1)
    idx = np.where(flat_range[row], bins // 2, idx)
    table = np.bincount(row * bins + idx, weights=v, minlength=rows * bins).reshape(rows, bins)

    # Number of edges below zero, then the first bin of the positive part.
    r = np.arange(rows)
    below = np.clip(np.ceil(-lo / step), 0, bins + 1).astype(np.int64)
    below -= (below > 0) & (edge(np.maximum(below - 1, 0), r) >= 0)
    below += (below <= bins) & (edge(np.minimum(below, bins), r) < 0)
    split = np.clip(below - 1, 0, bins)
    split = np.where(flat_range | ~used, half, split)

    # Pad with zeros on both sides so each half is one fixed-width slice around the split.
    wide = np.zeros((rows, bins + 2 * half))
    wide[:, half:half + bins] = table
    at = split[:, None] + half
    neg = np.take_along_axis(wide, at - half + np.arange(half), axis=1)
    pos = np.take_along_axis(wide, at + np.arange(half), axis=1)
    return neg, pos


def uniform_bins(df: DataFrame, bins: int = BINS) -> DataFrame:
    """Add ``neg_bins``/``pos_bins``: per-snapshot equal-width volume bins around zero.

    Row-local Arrow work: no shuffle and no exploded levels.
    """
    half = bins // 2

    @F.arrow_udf("struct<neg_bins:array<double>,pos_bins:array<double>>")
    def binned(prices: pa.Array, volumes: pa.Array) -> pa.Array:
        neg, pos = _bin_batch(prices, volumes, bins)
        offsets = pa.array(np.arange(len(prices) + 1, dtype=np.int32) * half)
        parts = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (neg, pos)]
        return pa.StructArray.from_arrays(parts, names=["neg_bins", "pos_bins"])

    return df.withColumn("_bins", binned("prices", "volumes")).select(
        *df.columns, F.col("_bins.neg_bins"), F.col("_bins.pos_bins")
    )


def ewma_scale(
    df: DataFrame,
    feats: Sequence[str] | None = None,
    half_life: float = HALF_LIFE,
    clip: float = CLIP,
    partition: Sequence[str] = ("symbol", "target_hour"),
    order: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Clipped EWMA z-score of all features, in batches of any length: one pass for the means, one for the variances."""
    feats = list(feats or select_features(df, NOT_SCALED, (FWD_PREFIX,)))
    rest = [c for c in df.columns if c not in feats]
    rows = with_decay(df.select(*rest, *[F.when(~F.isnan(f), F.col(f)).alias(f) for f in feats]), half_life, partition, order)
    means = decayed(rows, {f"_m_{f}": F.col(f) for f in feats}, partition, order)
    centred = means.select(*rest, *HELPERS, *[(F.col(f) - F.col(f"_m_{f}")).alias(f) for f in feats])
    squares = decayed(centred, {f"_v_{f}": F.col(f) * F.col(f) for f in feats}, partition, order)

    def scaled(f: str):
        z = F.col(f) / F.sqrt(F.col(f"_v_{f}") + 1e-12)
        return F.greatest(F.lit(-clip), F.least(F.lit(clip), z))

    out = squares.select(*rest, *[F.when(F.col(f).isNotNull(), scaled(f)).alias(f) for f in feats])
    return out.select(*df.columns)
