"""Hand-made books: empty sides, ties, zero volume, unsorted levels; binning rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebook.operators import book as K
from tidebook.operators import standardize as Z

BOOKS = [
    ("empty", [], []),
    ("bid_only", [[10.0, 2.0]], []),
    ("tie", [[10.0, 1.0], [10.0, 2.0], [9.0, 5.0]], [[11.0, 4.0]]),
    ("zero", [[10.0, 0.0]], [[12.0, 0.0]]),
    ("unsorted", [[8.0, 1.0], [10.0, 2.0], [9.0, 3.0]], [[13.0, 1.0], [11.0, 2.0], [12.0, 3.0]]),
    ("sorted", [[10.0, 2.0], [9.0, 3.0], [8.0, 1.0]], [[11.0, 2.0], [12.0, 3.0], [13.0, 1.0]]),
]


@pytest.fixture(scope="module")
def books(spark):
    df = spark.createDataFrame(BOOKS, "name string, bids array<array<double>>, asks array<array<double>>")
    return {r["name"]: r for r in K.book_features(df, (2, 0)).collect()}


def test_empty_sides(books):
    e = books["empty"]
    assert e.mid_price is None and e.spread is None and e.microprice is None
    assert (e.depth_all, e.depth_imbalance_all, e.liquidity_concentration_top_2, e.liquidity_spread_all) == (0, 0, 0, 0)
    b = books["bid_only"]
    assert b.mid_price is None and b.depth_imbalance_all == 1.0
    assert b.price_impact_proxy_all is None and b.liquidity_spread_all == 0.0


def test_ties_and_zero_volume(books):
    t = books["tie"]
    assert t.microprice == pytest.approx((11 * 3 + 10 * 4) / 7)
    z = books["zero"]
    assert z.microprice == z.mid_price == 11.0
    assert z.depth_imbalance_all == z.price_impact_proxy_all == z.liquidity_spread_all == 0.0


def test_order_does_not_matter_and_values(books):
    u, s = books["unsorted"].asDict(), books["sorted"].asDict()
    for c in u:
        if c not in ("name", "bids", "asks"):
            assert u[c] == s[c], c
    assert s["depth_top_2"] == 10.0 and s["depth_all"] == 12.0
    assert s["liquidity_concentration_top_2"] == pytest.approx(10 / 12)
    assert s["liquidity_concentration_all"] == 1.0
    assert s["price_impact_proxy_top_2"] == pytest.approx((12 - 9) / 10)
    assert s["liquidity_spread_top_2"] == pytest.approx((1 * 4 + 3 * 6) / 10)


def test_single_features_agree_with_all_features(spark, books):
    df = spark.createDataFrame(BOOKS, "name string, bids array<array<double>>, asks array<array<double>>")
    one = K.liquidity_spread(K.price_impact(K.microprice(K.spread(K.mid_price(df))), 2), 0)
    for r in one.collect():
        want = books[r["name"]]
        for c in ("mid_price", "spread", "microprice", "price_impact_proxy_top_2", "liquidity_spread_all"):
            assert r[c] == want[c], (r["name"], c)


def plain_bins(p, v, bins):
    """Plain restatement of the binning rules for one snapshot."""
    half = bins // 2
    p, v = np.asarray(p, float), np.asarray(v, float)
    ok = np.isfinite(p) & np.isfinite(v) & (v > 0)
    p, v = p[ok], v[ok]
    out = np.zeros(bins)
    if len(p) == 0:
        return out[:half], out[half:]
    if p.max() - p.min() < 1e-10:
        out[half] = v.sum()
        return out[:half], out[half:]
    edges = np.linspace(p.min(), p.max(), bins + 1)
    for x, w in zip(p, v):
        out[min(max(int((edges <= x).sum()) - 1, 0), bins - 1)] += w
    z = min(max(int((edges < 0).sum()) - 1, 0), bins)
    neg = np.concatenate([np.zeros(half), out[:z]])[-half:]
    pos = np.concatenate([out[z:], np.zeros(half)])[:half]
    return neg, pos


def test_uniform_bins(spark):
    rng = np.random.default_rng(3)
    cases = [
        ([], []), ([1.0], [2.0]), ([3.0, 3.0], [1.0, 2.0]), ([-1.0, 0.0, 1.0], [1.0, 2.0, 3.0]),
        ([1.0, 2.0, 5.0], [1.0, 1.0, 1.0]), ([-5.0, -2.0, -1.0], [1.0, 1.0, 1.0]),
        ([-10.0, -9.0, 0.5], [1.0, 1.0, 1.0]), ([float("nan"), 1.0, -1.0], [1.0, 0.0, 2.0]),
        ([1.0, -1.0, 2.0], [1.0, 1.0]),
    ]
    cases += [(rng.normal(size=40).tolist(), rng.random(40).tolist()) for _ in range(20)]
    cases += [(np.round(rng.normal(size=30), 1).tolist(), rng.random(30).tolist()) for _ in range(20)]
    rows = [(i, p, v) for i, (p, v) in enumerate(cases)] + [(len(cases), None, None)]
    df = spark.createDataFrame(rows, "i int, prices array<double>, volumes array<double>")
    for bins in (10, 6):
        for r in Z.uniform_bins(df, bins).collect():
            p, v = cases[r.i] if r.i < len(cases) else ([], [])
            n = min(len(p), len(v))
            neg, pos = plain_bins(p[:n], v[:n], bins)
            assert np.allclose(r.neg_bins, neg) and np.allclose(r.pos_bins, pos), (bins, r.i)
            assert sum(r.neg_bins) + sum(r.pos_bins) <= sum(x for x in v if x == x) + 1e-9


def test_scaling_ignores_nan_and_clips(spark):
    rows = [("a", 1, i, float("nan") if i == 3 else (1000.0 if i == 20 else float(i % 3))) for i in range(25)]
    df = spark.createDataFrame(rows, "symbol string, target_hour int, timestamp int, f double")
    got = [r.f for r in Z.ewma_scale(df, ["f"]).orderBy("timestamp").collect()]
    assert got[3] is None and got[20] == 3.0
    assert all(g is not None and abs(g) <= 3 for i, g in enumerate(got) if i != 3)


def test_property_bounds(spark, sf):
    from tidebook.contract.fixtures import snapshots

    df = K.book_features(snapshots(spark, sf), (2, 5, 0))
    bad = df.filter(
        (F.abs("depth_imbalance_top_2") > 1) | (F.col("liquidity_concentration_all") != 1.0)
        | (F.col("depth_top_2") > F.col("depth_top_5")) | (F.col("depth_top_5") > F.col("depth_all"))
    )
    assert bad.count() == 0
