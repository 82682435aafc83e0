"""Split, transform and standardize: the steps around the feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import fitting as T
from ..operators import hours as H
from ..operators import standardize as Z
from ..operators.ordering import materialized
from ..schema import BINS, CLIP, FWD_PREFIX, HALF_LIFE, NOT_SCALED
from ..sources.snapshots import write_table


def run_split(
    raw: DataFrame, train_pct: float = 0.8, past: int = 3, future: int = 3, unit: str = "hour",
    path: str | None = None,
) -> DataFrame:
    """Train and test rows with their context. The contexts of the two splits overlap, as each must
    be complete on its own; ``is_context`` tells them apart."""
    split_hours = H.temporal_split(H.processable_hours(raw, past, future, unit), train_pct)
    out = H.split_range(raw, split_hours, past, future, unit)
    if path:
        write_table(out, path, "overwrite", by="split")
    return out


def run_transform(
    features: DataFrame, feats: Sequence[str] | None = None, chosen: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """Fit on all non-context rows (or take fitted transforms), apply to all rows. The feature columns are
    written once, as every step of the fit reads them; to fit on a part, fit on ``sample_rows`` and pass ``chosen``."""
    if chosen is None:
        feats = list(feats or T.select_features(features))
        own = features.filter(~F.coalesce("is_context", F.lit(False))) if "is_context" in features.columns else features
        chosen = T.transform_map(T.fit_transforms(materialized(own.select(*feats)), feats))
    return T.apply_transforms(features, chosen)


def run_standardize(
    features: DataFrame, bins: int = BINS, half_life: float = HALF_LIFE, clip: float = CLIP,
    past: int = 3, unit: str = "hour", feats: Sequence[str] | None = None,
) -> DataFrame:
    """Binned books and scaled features of every hour with enough hours before it.

    Books are standardized and binned row by row before the batches overlap and travel once; only
    the scalar features are copied into the batches that need them as warm-up.
    """
    feats = list(feats or T.select_features(features, NOT_SCALED, (FWD_PREFIX,)))
    targets = H.processable_hours(features, past, 0, unit)
    books = Z.flatten_book(Z.normalize_volumes(Z.standardize_prices(features)))
    binned = Z.uniform_bins(books, bins).drop("prices", "volumes", "mid_price", "variance_proxy")
    rows = H.with_trading_hour(binned, unit)
    fwd = [c for c in rows.columns if c.startswith(FWD_PREFIX)]
    extra = [c for c in ("trading_day",) if c in rows.columns]
    payload = ["neg_bins", "pos_bins", *fwd, *extra]
    flags = [c for c in ("is_context",) if c in rows.columns]
    narrow = rows.select("symbol", "timestamp", "trading_hour", *flags, *feats, *payload)
    copies = H.hour_batches(narrow, targets, past, 0, unit, payload)
    scaled = Z.ewma_scale(copies, feats, half_life, clip)
    kept = H.unpack_payload(H.target_rows(scaled))
    return kept.select("symbol", "timestamp", *extra, "trading_hour", "neg_bins", "pos_bins", *fwd, *feats)
