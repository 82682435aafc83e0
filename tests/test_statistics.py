"""Regression and normality tests against direct numpy restatements and published values."""

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from tidebook.functions import normal, tails
from tidebook.operators import densities as P
from tidebook.operators import fitting as T
from tidebook.operators import moments as S
from tidebook.operators import normality as N
from tidebook.operators import regression as G


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    walk = np.cumsum(rng.normal(size=700)) + 1e4
    ar = np.zeros(900)
    for i in range(1, 900):
        ar[i] = 0.6 * ar[i - 1] + rng.normal()
    heavy = rng.standard_t(4, size=1500) * 2 + 1
    return {"walk": walk, "ar": ar, "heavy": heavy, "flat": np.full(60, 3.0), "short": rng.normal(size=9)}


@pytest.fixture(scope="module")
def long(spark, data):
    parts = [pd.DataFrame({"series": k, "idx": np.arange(len(v)), "value": v}) for k, v in data.items()]
    return spark.createDataFrame(pd.concat(parts)).repartition(8)


@pytest.fixture(autouse=True)
def small_chunks(monkeypatch):
    """Force several chunks per series."""
    monkeypatch.setattr(G, "CHUNK", 128)


def by_series(df):
    return {r["series"]: r for r in df.collect()}


def ols(x, y):
    coef, *_ = np.linalg.lstsq(x, y, rcond=None)
    res = y - x @ coef
    return coef, float(res @ res)


def lagmat(x, lags):
    return np.column_stack([x[lags - k:len(x) - k] for k in range(1, lags + 1)])


def test_arch_lm(long, data):
    got = by_series(G.arch_lm(long, 12))
    for k in ("walk", "ar", "heavy"):
        e = (data[k] - data[k].mean()) ** 2
        y = e[12:]
        _, rss = ols(np.column_stack([np.ones(len(y)), lagmat(e, 12)]), y)
        r2 = 1 - rss / ((y - y.mean()) ** 2).sum()
        assert got[k].arch_lm_stat == pytest.approx(len(y) * r2, rel=1e-6)
        assert got[k].arch_lm_p == pytest.approx(tails.chi2_tail(len(y) * r2, 12), abs=1e-9)
    assert got["short"].arch_lm_stat is None and got["flat"].arch_lm_stat is None


def test_adf(long, data):
    got = by_series(G.adf(long))
    for k in ("walk", "ar", "heavy"):
        x, n = data[k], len(data[k])
        d = np.diff(x)
        m = int(math.ceil(12 * (n / 100) ** 0.25))

        def design(lags, first):
            t = np.arange(first, len(d))
            cols = [np.ones(len(t)), x[t]] + [d[t - j] for j in range(1, lags + 1)]
            return np.column_stack(cols), d[t]

        aic = []
        for lags in range(m + 1):
            a, y = design(lags, m)
            _, rss = ols(a, y)
            aic.append(len(y) * math.log(rss / len(y)) + 2 * a.shape[1])
        used = int(np.argmin(aic))
        a, y = design(used, used)
        coef, rss = ols(a, y)
        se = math.sqrt(rss / (len(y) - a.shape[1]) * np.linalg.inv(a.T @ a)[1, 1])
        r = got[k]
        assert (r.adf_lags, r.adf_nobs) == (used, len(y))
        assert r.adf_stat == pytest.approx(coef[1] / se, rel=1e-5)
    assert got["short"].adf_stat is None
    assert got["ar"].adf_p < 0.01 < got["walk"].adf_p


def test_kpss(long, data):
    got = by_series(G.kpss(long))
    for k in ("walk", "ar", "heavy"):
        e = data[k] - data[k].mean()
        n = len(e)
        cov = int(n ** (2 / 9))
        s0, s1 = (e @ e) / n, 0.0
        for i in range(1, cov + 1):
            c = 2 * (e[i:] @ e[:n - i]) / n
            s0 += c
            s1 += i * c
        lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
        lrv = e @ e + 2 * sum((e[i:] @ e[:n - i]) * (1 - i / (lags + 1)) for i in range(1, lags + 1))
        stat = (np.cumsum(e) ** 2).sum() / n**2 / (lrv / n)
        assert got[k].kpss_lags == lags
        assert got[k].kpss_stat == pytest.approx(stat, rel=1e-8)


def test_tsay(long, data):
    got = by_series(G.tsay_test(long))
    for k in ("walk", "ar", "heavy"):
        y, lag = data[k][5:], lagmat(data[k], 5)
        z = (lag - lag.mean(0)) / lag.std(0)
        one = np.ones((len(y), 1))
        _, r1 = ols(np.hstack([one, z]), y)
        _, r2 = ols(np.hstack([one, z, z * z]), y)
        f = (r1 - r2) / 5 / (r2 / (len(y) - 11))
        assert got[k].tsay_f == pytest.approx(f, rel=1e-4)
        assert got[k].df_diff == 5 and got[k].method == "F-nested"
    assert got["flat"].method == "unavailable" and got["short"].method == "unavailable"


def test_tails():
    assert tails.chi2_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert tails.chi2_tail(18.307038053275146, 10) == pytest.approx(0.05)
    assert tails.f_tail(2.866081, 5, 24) == pytest.approx(0.0363, abs=2e-4)
    assert tails.f_tail(3.325834530413011, 5, 10) == pytest.approx(0.05, abs=1e-6)
    # Published table values.
    assert tails.adf_p(-2.2093665236058193) == pytest.approx(0.2028635299401234, rel=1e-9)
    assert tails.adf_p(-4.4844868670012294) == pytest.approx(0.0002097288560941275, rel=1e-9)
    assert tails.kpss_p(0.96) == 0.01 and tails.kpss_p(0.1) == 0.1


def test_published_moment_identities(spark):
    """n, unbiased skew and kurtosis of published rows give their published statistics."""
    n = 353
    g1, g2 = -1.6354702432199593, 2.792430346408736
    skew = g1 * (n - 2) / math.sqrt(n * (n - 1))
    kurt = (g2 * (n - 2) * (n - 3) / (n - 1) - 6) / (n + 1)
    df = spark.createDataFrame([("depth_all", n, 1.0, skew, kurt)], "series string, n long, m2 double, skew_b double, kurt_b double")
    r = S.k2_of(S.jarque_bera_of(df)).first()
    assert r.jb_stat == pytest.approx(266.13804899141843, rel=1e-9)
    assert r.k2_stat == pytest.approx(114.26711101557754, rel=1e-9)


def plain_shapiro(x):
    """W by Royston's weights, one value at a time."""
    x, n = np.sort(x), len(x)
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    mm, root = m @ m, n**-0.5
    last = sum(c * root**i for i, c in enumerate(N.LAST_WEIGHT)) + m[-1] / mm**0.5
    second = sum(c * root**i for i, c in enumerate(N.NEXT_WEIGHT)) + m[-2] / mm**0.5
    a = m / ((mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2)) ** 0.5
    a[[0, 1, -2, -1]] = -last, -second, second, last
    return (a @ x) ** 2 / ((x - x.mean()) ** 2).sum()


def frame(spark, groups):
    parts = [pd.DataFrame({"series": k, "idx": np.arange(len(v)), "value": v}) for k, v in groups.items()]
    return spark.createDataFrame(pd.concat(parts)).repartition(4)


def test_shapiro_known_values(spark):
    # Weights of men, a published textbook sample.
    men = np.array([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], dtype=float)
    rng = np.random.default_rng(0)
    groups = {f"n{i}": rng.normal(size=200) for i in range(200)} | {"men": men, "three": np.array([1.0, 2.0, 4.0]), "flat": np.ones(9), "two": np.arange(2.0)}
    got = by_series(N.shapiro(frame(spark, groups)))
    assert got["men"].shapiro_stat == pytest.approx(0.79, abs=0.005) and got["men"].shapiro_p == pytest.approx(0.0067, abs=0.0006)
    assert got["three"].shapiro_stat == pytest.approx(0.9643, abs=1e-4) and got["three"].shapiro_p == pytest.approx(0.637, abs=1e-3)
    assert got["flat"].shapiro_stat is None and got["two"].shapiro_p is None
    ps = np.array([got[f"n{i}"].shapiro_p for i in range(200)])
    assert 0.01 < np.mean(ps < 0.05) < 0.11


def test_shapiro_uses_all_rows(spark):
    rng = np.random.default_rng(4)
    few = rng.integers(0, 11, 60_000) / 10.0  # eleven values only
    got = by_series(N.shapiro(frame(spark, {"few": few, "long": rng.normal(size=20_000)})))
    for name, x in (("few", few), ("long", None)):
        if x is not None:
            assert got[name].n == 60_000 and got[name].shapiro_stat == pytest.approx(plain_shapiro(x), abs=1e-9)
    assert got["few"].shapiro_p < 1e-6 and got["long"].shapiro_p > 1e-3


def test_normal_functions(spark):
    ps = [1e-300, 1e-20, 1e-6, 0.01, 0.074, 0.075, 0.3, 0.5, 0.8, 0.925, 0.999999, 0.0, 1.0]
    zs = [-60.0, -36.0, -34.0, -8.0, -7.07, -1.0, 0.0, 0.5, 4.9, 5.1, 7.2, 30.0]
    q = normal.with_quantile(spark.createDataFrame([(p,) for p in ps], "p double"), "p", "q").collect()
    assert all(r.q == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-12) if 0 < r.p < 1 else r.q is None for r in q)
    t = spark.createDataFrame([(z,) for z in zs], "z double").select("z", normal.tail(F.col("z")).alias("t"), normal.log_cdf(F.col("z")).alias("l")).collect()
    for r in t:
        assert r.t == pytest.approx(0.5 * math.erfc(r.z / math.sqrt(2)), rel=1e-7, abs=1e-300)
        want = math.log(0.5 * math.erfc(-r.z / math.sqrt(2))) if -35 < r.z < 5 else (math.log1p(-0.5 * math.erfc(r.z / math.sqrt(2))) if r.z > 0 else None)
        assert want is None or r.l == pytest.approx(want, rel=1e-8)
        assert r.l < 0


@pytest.mark.parametrize("scale", [1e-4, 1.0, 1e6])
def test_lambda_is_not_bounded(spark, scale):
    """Against a dense search in numpy, also where the best lambda is in the thousands."""
    x = np.exp(np.random.default_rng(3).normal(size=3000)) * scale
    got = T.fit_lambda(spark.createDataFrame([("f", float(v)) for v in x], "feature string, value double"), "yeo-johnson").first()
    logs = np.log1p(x)

    def llf(lam):
        y = np.expm1(lam * logs) / lam if lam else logs
        return -len(x) / 2 * np.log(y.var()) + (lam - 1) * logs.sum()

    lam = got["lambda"]
    near = [lam * (1 + d) for d in np.linspace(-0.5, 0.5, 201)]
    assert llf(lam) >= max(map(llf, near)) - 1e-4 * abs(llf(lam)) * 1e-3
    assert (abs(lam) > 1000) == (scale == 1e-4)


def test_anderson(long, data):
    got = by_series(N.anderson_normal(long))
    for k in ("ar", "heavy", "short"):
        x = np.sort(data[k])
        n = len(x)
        z = (x - x.mean()) / x.std(ddof=1)
        cdf = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
        i = np.arange(1, n + 1)
        a2 = -n - np.mean((2 * i - 1) * (np.log(cdf) + np.log(1 - cdf[::-1])))
        assert got[k].anderson_stat == pytest.approx(a2, rel=1e-8)
    assert "flat" not in got


def test_anderson_constants(spark):
    df = spark.createDataFrame([("a", 880, 4.74)], "series string, n long, anderson_stat double")
    r = N.with_anderson_decision(df).first()
    assert list(r.anderson_crit_vals) == [0.573, 0.653, 0.783, 0.914, 1.087] and r.anderson_reject_5pct


def test_fits(long, data):
    normal = by_series(P.fit_normal(long))
    t = by_series(P.fit_student_t(long))
    x = data["heavy"]
    sd = x.std(ddof=1)
    ll = float(np.sum(-0.5 * math.log(2 * math.pi) - math.log(sd) - (x - x.mean()) ** 2 / (2 * sd * sd)))
    assert normal["heavy"].loglik == pytest.approx(ll, rel=1e-10)
    r = t["heavy"]

    def at(nu, mu, sigma):
        c = math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2) - 0.5 * math.log(nu * math.pi) - math.log(sigma)
        return float(np.sum(c - (nu + 1) / 2 * np.log1p(((x - mu) / sigma) ** 2 / nu)))

    assert r.loglik == pytest.approx(at(r.nu, r.mu, r.sigma), rel=1e-9) and r.loglik > ll
    # A maximum: neither parameter can move and gain.
    for f in (0.93, 1.07):
        assert at(r.nu * f, r.mu, r.sigma) <= r.loglik + 0.05
        assert at(r.nu, r.mu, r.sigma * f) < r.loglik
        assert at(r.nu, r.mu + (f - 1), r.sigma) < r.loglik


def test_gmm(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(-3, 0.5, 600), rng.normal(2, 1.0, 400)])
    df = spark.createDataFrame(pd.DataFrame({"series": "m", "idx": np.arange(1000), "value": x}))
    r = P.fit_gmm(df, (2,)).first()
    order = np.argsort(r.m)
    assert np.allclose(np.array(r.m)[order], [-3, 2], atol=0.15)
    assert np.allclose(np.array(r.w)[order], [0.6, 0.4], atol=0.03)
    assert r.k == 5 and r.model == "GMM(K=2)"
    ranked = P.model_ranking(
        P.fit_normal(df).select("series", "n", "model", "k", "loglik").unionByName(
            P.fit_gmm(df, (2,)).select("series", "n", "model", "k", "loglik"))
    ).collect()
    assert ranked[0].model == "GMM(K=2)"


def test_runs_p_and_short(long, data):
    got = by_series(S.runs_test(long))
    assert got["short"].note and got["short"].z is None
    s = np.sign(data["ar"])
    s = s[s != 0]
    up = s >= s.mean()
    runs = 1 + (up[1:] != up[:-1]).sum()
    pos, n = up.sum(), len(up)
    mean = 2 * pos * (n - pos) / n + 1
    var = (mean - 1) * (2 * pos * (n - pos) - n) / n / (n - 1)
    z = (runs - mean) / math.sqrt(var)
    assert got["ar"].z == pytest.approx(z) and got["ar"].p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))


def test_pair_matrices_make_no_pair_rows(spark):
    from tidebook.operators import dependence as D

    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 6)).cumsum(1)
    names = [f"c{j}" for j in range(6)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["idx", *names]).repartition(5)
    rho = D.spearman_matrix(df, "idx", names)
    assert "Generate" not in rho._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[0]
    ranks = np.argsort(np.argsort(x, axis=0), axis=0)
    want = np.corrcoef(ranks.T)
    got = {(r.feature_a, r.feature_b): r.rho for r in rho.collect()}
    assert len(got) == 15
    for (a, b), v in got.items():
        assert v == pytest.approx(want[names.index(a), names.index(b)], abs=1e-12)
    counted = D.mi_matrix(df, names)
    cut = [np.quantile(x[:, j], [i / 10 for i in range(1, 10)]) for j in range(6)]
    bins = np.column_stack([np.searchsorted(cut[j], x[:, j], side="right") for j in range(6)])
    for r in counted.collect():
        joint = np.zeros((10, 10))
        np.add.at(joint, (bins[:, names.index(r.feature_a)], bins[:, names.index(r.feature_b)]), 1)
        p = joint / joint.sum()
        outer = p.sum(1)[:, None] * p.sum(0)[None, :]
        assert r.mi == pytest.approx((p[p > 0] * np.log(p[p > 0] / outer[p > 0])).sum(), abs=1e-10)


def test_lag_products_of_all_kinds_in_one_pass(spark, monkeypatch):
    from tidebook.operators import dependence as D

    monkeypatch.setattr(D, "CHUNK", 50)
    rng = np.random.default_rng(8)
    x = rng.normal(size=333) + 40
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)], "series string, idx long, value double")
    kinds = {"value": x, "square": x * x, "demeaned_square": (x - x.mean()) ** 2}
    got = {(r.of, r.lag): r for r in D.lag_products(df, 120).collect()}
    assert len(got) == 360
    for (of, k), r in got.items():
        d = kinds[of] - kinds[of].mean()
        assert r.p == pytest.approx(d[k:] @ d[:-k], rel=1e-9, abs=1e-7) and r.n == 333 and r.m2 == pytest.approx(d @ d / 333)


def test_density_from_cell_moments(spark):
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(size=4000), rng.normal(size=500) * 0.01 + 3, np.full(300, 1.25), [40.0]])
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)], "series string, idx long, value double")
    got = P.gaussian_kde(df, 150).orderBy("point").toPandas()
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-((got["x"].to_numpy()[:, None] - x[None, :]) / h) ** 2 / 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.allclose(got["density"], want, rtol=1e-12, atol=1e-15 * want.max())
    plan = P.gaussian_kde(df, 150)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 2 and plan.index("_m9") > 0


def test_mixture_keeps_the_best_start(spark, monkeypatch):
    rng = np.random.default_rng(21)
    x = np.concatenate([rng.normal(0, 1, 900), rng.normal(9, 0.2, 60), rng.normal(10.5, 0.2, 60)])
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)], "series string, idx long, value double")
    whole = P.fit_gmm(df, (3,)).first()
    monkeypatch.setattr(P, "STARTS", 1)
    one = P.fit_gmm(df, (3,)).first()
    assert whole.loglik >= one.loglik - 1e-6 and whole.converged
    w, m, v = (np.array(whole[c]) for c in ("w", "m", "v"))
    each = np.log((w * np.exp(-((x[:, None] - m) ** 2) / v / 2) / np.sqrt(2 * np.pi * v)).sum(1)).sum()
    assert whole.loglik == pytest.approx(each, rel=1e-9)
