"""Feature derivation: raw snapshots to the wide feature table in one job and one shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import hours as H
from ..operators import returns as R
from ..operators.book import book_features
from ..schema import BANDS, FWD_HORIZONS, HALF_LIFE, PAST_HORIZONS


def derive_features(
    raw: DataFrame,
    past: int = 3,
    future: int = 3,
    unit: str = "hour",
    bands: Sequence[int] = BANDS,
    fwd: Sequence[int] = FWD_HORIZONS,
    back: Sequence[int] = PAST_HORIZONS,
    half_life: float = HALF_LIFE,
    keep_books: bool = True,
) -> DataFrame:
    """All features of every processable hour, plus the context hours of the first one.

    Book features are computed row by row before the batches overlap. Only ``(symbol, timestamp,
    mid_price)`` is copied into neighbouring batches; books and book features travel once.
    """
    targets = H.processable_hours(raw, past, future, unit)
    snaps = H.with_trading_hour(raw.select("symbol", "timestamp", "bids", "asks"), unit)
    featured = book_features(snaps, bands)
    narrow = ("symbol", "timestamp", "trading_hour", "mid_price")
    dropped = () if keep_books else ("bids", "asks")
    payload = [c for c in featured.columns if c not in narrow + dropped]
    copies = H.hour_batches(featured.drop(*dropped), targets, past, future, unit, payload, first_context=True)
    windowed = R.log_return(copies).select("*", *R.fwd_columns(fwd), *R.past_columns(back))
    priced = R.volatility(R.ewma_variance(windowed, half_life))
    out = H.flag_context(H.unpack_payload(H.select_batch_output(priced)))
    first = [c for c in ("bids", "asks") if keep_books]
    order = [
        "symbol", "timestamp", "trading_hour", *first, "mid_price", "log_return", "variance_proxy",
        "volatility", "spread", "microprice",
        *[f"fwd_logret_{n}" for n in fwd], *[f"past_logret_{n}" for n in back],
    ]
    bands_cols = [c for c in payload if c not in ("bids", "asks", "spread", "microprice")]
    return out.select(*order, *bands_cols, "is_context")


def minimum_slice(raw: DataFrame, half_life: float = HALF_LIFE, unit: str = "day") -> DataFrame:
    """Mid, spread, log return and volatility within each trading period."""
    from ..operators.book import mid_price, spread

    snaps = H.with_trading_hour(spread(mid_price(raw)), unit).drop("bids", "asks")
    part = ("symbol", "trading_hour")
    return R.volatility(R.ewma_variance(R.log_return(snaps, part), half_life, part)).select(
        "symbol", "timestamp", "trading_hour", "mid_price", "spread", "log_return",
        F.col("variance_proxy"), "volatility",
    )
