"""Features of nested book sides (row-local; no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import BANDS, band_suffix

EPS = 1e-12


def _total(side: Column) -> Column:
    return F.aggregate(side, F.lit(0.0), lambda acc, x: acc + x.v)


def sorted_sides(df: DataFrame) -> DataFrame:
    """Add ``_b``/``_a``: (p, v) structs, best level first. Each side is sorted once."""

    def levels(side: str) -> Column:
        return F.array_sort(F.transform(side, lambda x: F.struct(x[0].alias("p"), x[1].alias("v"))))

    return df.select("*", F.reverse(levels("bids")).alias("_b"), levels("asks").alias("_a"))


def _best(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.array_max(F.transform("bids", lambda x: x[0])).alias("_bb"),
        F.array_min(F.transform("asks", lambda x: x[0])).alias("_ba"),
    )


def mid_price(df: DataFrame) -> DataFrame:
    """Mean of best bid and best ask; NULL when a side is empty."""
    return _best(df).withColumn("mid_price", (F.col("_bb") + F.col("_ba")) / 2.0).drop("_bb", "_ba")


def spread(df: DataFrame) -> DataFrame:
    return _best(df).withColumn("spread", F.col("_ba") - F.col("_bb")).drop("_bb", "_ba")


def top_of_book(df: DataFrame) -> DataFrame:
    """Best bid, best ask and spread of sides that are already sorted."""
    bid, ask = F.get(F.get("bids", 0), 0), F.get(F.get("asks", 0), 0)
    both = bid.isNotNull() & ask.isNotNull()
    return df.select(
        "*",
        F.when(both, bid).alias("best_bid"),
        F.when(both, ask).alias("best_ask"),
        F.when(both, ask - bid).alias("top_spread"),
    )


def _micro(bb: Column, ba: Column, vb: Column, va: Column) -> Column:
    weight = vb + va
    return F.when(weight == 0.0, (bb + ba) / 2.0).otherwise((ba * vb + bb * va) / weight)


def microprice(df: DataFrame) -> DataFrame:
    """Best prices weighted by the volume on the other side (all levels at the best price)."""
    best = _best(df).select(
        "*",
        F.aggregate(F.filter("bids", lambda x: x[0] == F.col("_bb")), F.lit(0.0), lambda s, x: s + x[1]).alias("_vb"),
        F.aggregate(F.filter("asks", lambda x: x[0] == F.col("_ba")), F.lit(0.0), lambda s, x: s + x[1]).alias("_va"),
    )
    value = _micro(F.col("_bb"), F.col("_ba"), F.col("_vb"), F.col("_va"))
    return best.withColumn("microprice", value).drop("_bb", "_ba", "_vb", "_va")


def _band_parts(df: DataFrame, bands: Sequence[int]) -> DataFrame:
    """From sorted sides: per band the volumes, edge prices and matched-level sums."""
    nb, na = F.size("_b"), F.size("_a")
    out = [_total(F.col("_b")).alias("_vb"), _total(F.col("_a")).alias("_va")]
    for k in bands:
        s = band_suffix(k)
        kb = F.least(F.lit(k), nb) if k else nb
        ka = F.least(F.lit(k), na) if k else na
        km = F.least(kb, ka)
        pairs = F.zip_with(
            F.slice("_a", 1, km), F.slice("_b", 1, km),
            lambda a, b: F.struct((a.p - b.p).alias("d"), (a.v + b.v).alias("w")),
        )
        if k:
            out += [
                _total(F.slice("_b", 1, k)).alias(f"_vb_{s}"),
                _total(F.slice("_a", 1, k)).alias(f"_va_{s}"),
            ]
        out += [
            F.try_element_at("_b", F.nullif(kb, F.lit(0)))["p"].alias(f"_pb_{s}"),
            F.try_element_at("_a", F.nullif(ka, F.lit(0)))["p"].alias(f"_pa_{s}"),
            pairs.alias(f"_m_{s}"),
        ]
    return df.select("*", *out)


def _band_features(bands: Sequence[int], families: Sequence[str]) -> list[Column]:
    vb_all, va_all = F.col("_vb"), F.col("_va")
    out: list[Column] = []
    for k in bands:
        s = band_suffix(k)
        vb = F.col(f"_vb_{s}") if k else vb_all
        va = F.col(f"_va_{s}") if k else va_all
        depth = vb + va
        weight = F.aggregate(f"_m_{s}", F.lit(0.0), lambda acc, x: acc + x.w)
        moved = F.aggregate(f"_m_{s}", F.lit(0.0), lambda acc, x: acc + x.d * x.w)
        build = {
            "depth_imbalance": F.when(depth == 0.0, 0.0).otherwise((vb - va) / depth),
            "depth": depth,
            "liquidity_concentration": F.when(vb_all + va_all == 0.0, 0.0).otherwise(depth / (vb_all + va_all)),
            "price_impact_proxy": F.when(depth <= 0.0, 0.0).otherwise(
                (F.col(f"_pa_{s}") - F.col(f"_pb_{s}")) / (depth + EPS)
            ),
            "liquidity_spread": F.when(weight <= 0.0, 0.0).otherwise(moved / (weight + EPS)),
        }
        out += [build[f].alias(f"{f}_{s}") for f in families]
    return out


FAMILIES = ("depth_imbalance", "depth", "liquidity_concentration", "price_impact_proxy", "liquidity_spread")


def _banded(df: DataFrame, bands: Sequence[int], families: Sequence[str]) -> DataFrame:
    parts = _band_parts(sorted_sides(df), bands)
    return parts.select(*df.columns, *_band_features(bands, families))


def depth_imbalance(df: DataFrame, k: int) -> DataFrame:
    return _banded(df, [k], ["depth_imbalance"])


def market_depth(df: DataFrame, k: int) -> DataFrame:
    return _banded(df, [k], ["depth"])


def liquidity_concentration(df: DataFrame, k: int) -> DataFrame:
    return _banded(df, [k], ["liquidity_concentration"])


def price_impact(df: DataFrame, k: int) -> DataFrame:
    return _banded(df, [k], ["price_impact_proxy"])


def liquidity_spread(df: DataFrame, k: int) -> DataFrame:
    return _banded(df, [k], ["liquidity_spread"])


def book_features(df: DataFrame, bands: Sequence[int] = BANDS) -> DataFrame:
    """Mid, spread, microprice and all five families for all bands in one pass over each row."""
    parts = _band_parts(sorted_sides(df), bands)
    at_best = parts.select(
        "*",
        F.get("_b", 0)["p"].alias("_bb"),
        F.get("_a", 0)["p"].alias("_ba"),
    )
    volumes = at_best.select(
        "*",
        _total(F.filter("_b", lambda x: x.p == F.col("_bb"))).alias("_bbv"),
        _total(F.filter("_a", lambda x: x.p == F.col("_ba"))).alias("_bav"),
    )
    return volumes.select(
        *df.columns,
        ((F.col("_bb") + F.col("_ba")) / 2.0).alias("mid_price"),
        (F.col("_ba") - F.col("_bb")).alias("spread"),
        _micro(F.col("_bb"), F.col("_ba"), F.col("_bbv"), F.col("_bav")).alias("microprice"),
        *_band_features(bands, FAMILIES),
    )


def book_sides(levels: DataFrame, keys: Sequence[str] = ("symbol", "tick")) -> DataFrame:
    """Rows ``(keys, price, size, side)`` to one row per key with sorted ``[price, size]`` sides.

    A group is one book at one moment, so it holds as many rows as the book has levels.
    """
    entry = F.struct(F.col("price").alias("p"), F.col("size").alias("v"))
    is_bid = F.col("side") == "Buy"

    def pairs(side: Column) -> Column:
        return F.transform(side, lambda x: F.array(x.p, x.v))

    return (
        levels.groupBy(*keys)
        .agg(
            F.sort_array(F.collect_list(F.when(is_bid, entry)), asc=False).alias("_b"),
            F.sort_array(F.collect_list(F.when(~is_bid, entry))).alias("_a"),
        )
        .select(*keys, pairs(F.col("_b")).alias("bids"), pairs(F.col("_a")).alias("asks"))
    )
