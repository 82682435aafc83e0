"""Hour batches against a plain loop, splits, transforms and the ingest steps."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidebook.contract import fixtures as fx
from tidebook.operators import fitting as T
from tidebook.operators import hours as H
from tidebook.plans import diagnostics as X
from tidebook.plans import features as PF
from tidebook.plans import preparation as PP
from tidebook.sources import snapshots as I


@pytest.fixture(scope="module")
def raw(spark):
    """Two symbols, one with a gap; about six snapshots an hour."""
    rng = np.random.default_rng(11)
    rows = []
    for symbol, skip in (("A", ()), ("B", (5, 6))):
        for i in range(6 * 12):
            hour = i // 6
            if hour in skip:
                continue
            ts = pd.Timestamp("2024-03-01") + pd.Timedelta(minutes=10 * i, seconds=int(rng.integers(0, 60)))
            mid = 100 + rng.normal()
            bids = [[mid - 0.5 - 0.1 * j, float(rng.integers(1, 9))] for j in range(4)]
            asks = [[mid + 0.5 + 0.1 * j, float(rng.integers(1, 9))] for j in range(3)]
            rows.append((symbol, ts.to_pydatetime(), [[float(x) for x in b] for b in bids], [[float(x) for x in a] for a in asks]))
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp, bids array<array<double>>, asks array<array<double>>")


def loop_features(pdf, past, future, half_life=20):
    """One batch after the other on one machine, for one symbol."""
    pdf = pdf.sort_values("timestamp").reset_index(drop=True)
    pdf["hour"] = pdf.timestamp.dt.floor("h")
    hours = sorted(pdf.hour.unique())
    targets = [h for i, h in enumerate(hours) if i >= past and len(hours) - i - 1 >= future]
    a = 1 - 2 ** (-1 / half_life)
    out = []
    for t in targets:
        b = pdf[(pdf.timestamp >= t - pd.Timedelta(hours=past)) & (pdf.timestamp < t + pd.Timedelta(hours=future + 1))].copy()
        m = np.log(b.mid)
        b["log_return"], b["fwd"], b["past"] = m.diff(), m.shift(-4) - m.shift(-1), m - m.shift(5)
        var, seen, acc = [], False, 0.0
        for r in b.log_return:
            acc *= 1 - a
            if r == r:
                acc, seen = acc + a * r * r, True
            var.append(acc if seen else math.nan)
        b["variance"] = var
        b["is_context"] = b.hour < t
        keep = b.timestamp < t + pd.Timedelta(hours=1) if t == targets[0] else b.hour == t
        out.append(b[keep])
    return pd.concat(out)


@pytest.mark.parametrize("past,future", [(3, 3), (2, 1)])
def test_one_job_equals_hour_loop(raw, past, future):
    got = PF.derive_features(raw, past, future, bands=(2, 0), fwd=(3,), back=(5,)).toPandas()
    mids = raw.select("symbol", "timestamp", ((F.array_max(F.transform("bids", lambda x: x[0])) + F.array_min(F.transform("asks", lambda x: x[0]))) / 2).alias("mid")).toPandas()
    for symbol, part in mids.groupby("symbol"):
        want = loop_features(part, past, future).sort_values("timestamp")
        have = got[got.symbol == symbol].sort_values("timestamp")
        assert list(have.timestamp) == list(want.timestamp)
        assert list(have.is_context) == list(want.is_context)
        for c, w in (("log_return", "log_return"), ("fwd_logret_3", "fwd"), ("past_logret_5", "past"), ("variance_proxy", "variance")):
            assert np.allclose(have[c].astype(float), want[w].astype(float), equal_nan=True), (symbol, c)
        assert have.bids.notna().all() and have.depth_all.notna().all()


def test_gap_counts_by_position(raw):
    hours = H.processable_hours(raw, 3, 3).filter("symbol = 'B'").orderBy("trading_hour").collect()
    assert [h.trading_hour.hour for h in hours] == [3, 4, 7, 8]


def test_split_ranges(raw):
    out = PP.run_split(raw.filter("symbol = 'A'"), 0.5)
    rows = {(r.split, r.is_context): r for r in out.groupBy("split", "is_context").agg(
        F.min("trading_hour").alias("a"), F.max("trading_hour").alias("z")).collect()}
    assert (rows["train", False].a.hour, rows["train", False].z.hour) == (3, 5)
    assert (rows["train", True].a.hour, rows["train", True].z.hour) == (0, 8)
    assert (rows["test", False].a.hour, rows["test", False].z.hour) == (6, 8)
    assert (rows["test", True].a.hour, rows["test", True].z.hour) == (3, 11)


def test_standardize_output(raw):
    feats = PF.derive_features(raw, 2, 2, bands=(2, 0), fwd=(3,), back=(2,))
    got = PP.run_standardize(feats, bins=20, past=2).toPandas()
    assert len(got) and {"neg_bins", "pos_bins", "fwd_logret_3", "spread"} <= set(got.columns)
    assert not {"mid_price", "bids", "is_context", "variance_proxy"} & set(got.columns)
    assert (got.neg_bins.map(len) == 10).all()
    assert (got.neg_bins.map(sum) + got.pos_bins.map(sum) <= 1 + 1e-9).all()
    assert (got.spread.abs() <= 3).all()


def test_fit_and_apply(spark, tmp_path):
    rng = np.random.default_rng(4)
    z = rng.normal(size=800)
    pdf = pd.DataFrame({"lognormal": np.exp(z), "square": (z + 6) ** 2, "plain": z, "tiny": np.nan})
    pdf.loc[:4, "tiny"] = 1.0
    df = spark.createDataFrame(pdf)
    chosen = T.transform_map(T.fit_transforms(df, list(pdf.columns)))
    assert chosen["lognormal"]["transformation"] in ("log", "box-cox")
    assert chosen["square"]["transformation"] in ("sqrt", "box-cox", "yeo-johnson")
    assert chosen["tiny"]["transformation"] == "identity" and chosen["tiny"]["normality_score"] == -999.0
    path = str(tmp_path / "map")
    T.save_transforms(spark, chosen, path)
    again = T.load_transforms(spark, path)
    assert again == chosen
    out = T.apply_transforms(df, again).toPandas()
    assert abs(out.lognormal.skew()) < 0.2


def test_fitted_lambda_is_the_maximum(spark):
    rng = np.random.default_rng(8)
    x = np.exp(rng.normal(size=400) * 0.5 + 1)
    df = spark.createDataFrame(pd.DataFrame({"feature": "x", "value": x}))

    def llf(lam):
        y = np.log(x) if lam == 0 else (x**lam - 1) / lam
        return -len(x) / 2 * math.log(y.var()) + (lam - 1) * np.log(x).sum()

    grid = np.round(np.arange(-2, 2, 0.001), 3)
    want = grid[np.argmax([llf(g) for g in grid])]
    assert T.fit_lambda(df, "box-cox").first()["lambda"] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("name,x,params,want", [
    ("log", -1.0, {"offset": 1.0}, None), ("log", 0.0, {"offset": 1.0}, 0.0), ("sqrt", -0.2, {"offset": 0.1}, None),
    ("asinh", float("inf"), {}, None), ("asinh", float("nan"), {}, None),
    ("yeo-johnson", 3.0, {"lambda": 0.0}, math.log(4)), ("yeo-johnson", -3.0, {"lambda": 2.0}, -math.log(4)),
    ("yeo-johnson", -3.0, {"lambda": 1.0}, -3.0), ("box-cox", 5.0, {"lambda": 0.0}, math.log(5)),
    ("box-cox", 0.0, {"lambda": 0.5}, None), ("box-cox", 1e200, {"lambda": 3.0}, None), ("other", 2.0, {}, 2.0),
])
def test_transform_edges(spark, name, x, params, want):
    df = spark.createDataFrame([(x,)], "f double")
    got = T.apply_transforms(df, {"f": {"transformation": name, "parameters": params}}).first().f
    assert got is None if want is None else got == pytest.approx(want)


def test_identity_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),)], "f double")
    assert math.isnan(T.apply_transforms(df, {"f": {"transformation": "identity", "parameters": {}}}).first().f)


def test_candidate_offsets(spark):
    rows = [("zero", 0.0), ("zero", 1.0), ("neg", -2.0), ("neg", 1.0), ("far", -2e6), ("far", 1.0)]
    long = spark.createDataFrame(rows, "feature string, value double")
    got = T.candidate_values(long, T.feature_stats(long)).select("feature", "candidate", "offset").distinct().collect()
    off = {(r.feature, r.candidate): r.offset for r in got}
    assert off["zero", "log"] == 1.0 and off["zero", "sqrt"] == 0.0
    assert off["neg", "log"] == 3.0 and off["neg", "sqrt"] == 2.1
    assert ("far", "log") not in off and ("far", "sqrt") not in off and ("far", "asinh") in off


def test_parse_keeps_malformed_as_null(spark):
    df = spark.createDataFrame([("a", "2024-01-01T00:00:00+00:00", "[[1.0,2.0]]", "oops"), ("a", "no", "[]", "[]")],
                               "symbol string, timestamp string, bids string, asks string")
    a, b = I.parse_lob(df).collect()
    assert a.bids == [[1.0, 2.0]] and a.asks is None and b.timestamp is None


def test_ingest_is_repeatable(spark, tmp_path):
    src, table, log = (str(tmp_path / x) for x in ("src", "raw", "log"))
    rows = [("a", f"2024-01-0{d}T00:00:0{s}+00:00", "[[1.0,2.0]]", "[[2.0,1.0]]") for d in (1, 2) for s in range(3)]
    df = spark.createDataFrame(rows, "symbol string, timestamp string, bids string, asks string")
    I.write_daily(df.filter("timestamp < '2024-01-02'"), src)
    first = I.ingest(spark, src, table, log)
    assert I.read_log(spark, log).agg(F.sum("record_count")).first()[0] == 3
    I.write_daily(df.filter("timestamp >= '2024-01-02'"), src)
    fx.write_bytes(spark, f"{src}/date=2024-01-03/broken.parquet", b"PAR1")
    I.ingest(spark, src, table, log)
    assert spark.read.parquet(table).count() == 6
    logged = [r.filename for r in I.read_log(spark, log).collect()]
    assert len(logged) == len(set(logged)) and not any("broken" in f for f in logged)
    assert first.columns == ["filename", "type", "record_count"]


def test_interpret(spark):
    cols = "series string, n long, mean double, std double, skew double, kurtosis_excess double, shapiro_p double, k2_p double, jb_p double, adf_p double, kpss_p double, arch_lm_p double"
    rows = [("a", 9, 0.0, 1.0, 0.0, 0.0, 0.5, 0.01, 0.5, 0.01, 0.1, 0.01), ("b", 9, 0.0, 1.0, 0.0, 0.0, None, None, None, None, 0.1, None),
            ("c", 9, 0.0, 1.0, 0.0, 0.0, 0.5, 0.5, None, 0.5, 0.01, 0.5), ("d", 9, 0.0, 1.0, 0.0, 0.0, 0.5, 0.5, 0.5, 0.01, 0.01, 0.5)]
    got = {r.series: (r.normality, r.stationarity, r.heteroskedasticity) for r in X.interpret(spark.createDataFrame(rows, cols)).collect()}
    assert got["a"] == ("not normal", "stationary", "ARCH effects")
    assert got["b"] == ("unknown", "unknown", "unknown")
    assert got["c"] == ("normal", "non-stationary", "homoskedastic")
    assert got["d"][1] == "conflicting"
