import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebook.contract import fixtures as fx
from tidebook.operators import densities as P
from tidebook.operators import dependence as D
from tidebook.operators import fitting as T
from tidebook.operators import normality as N
from tidebook.operators.ordering import ROWS_PER_TASK, tasks_for
from tidebook.operators.packed import packed


def _long(spark, groups, key="feature"):
    return spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x], f"{key} string, value double")


def test_packed_merges_equal_values_and_keeps_all_rows(spark):
    rows = packed(_long(spark, {"a": [2.0, 1.0] * 500, "b": [3.0]}).coalesce(1), "feature").collect()
    assert {r.feature: (r["values"], r.counts) for r in rows} == {"a": ([1.0, 2.0], [500, 500]), "b": ([3.0], [1])}


def test_candidates_are_scored_as_their_own_values(spark):
    """F1, F2: the shared runs of a feature give every candidate the score that its own sorted values have."""
    rng = np.random.default_rng(5)
    long = _long(spark, {"p": np.round(np.exp(rng.normal(size=400)), 2) + 0.01, "n": np.round(rng.normal(size=300), 1)})
    stats, fitted = T.feature_stats(long), T.fit_lambdas(long)
    lambdas = fitted.groupBy("feature").agg(*[
        F.max(F.when(F.col("family") == k, F.col("lambda"))).alias(f"{t}_lambda") for k, t in T.FAMILIES.items()])
    want = {(r.feature, r.candidate): r for r in T.normality_score(T.candidate_values(long, stats, lambdas)).collect()}
    got = T.score_candidates(packed(long, "feature"), stats, lambdas).collect()
    assert {(r.feature, r.candidate) for r in got} == set(want) and len(got) == 11
    for r in got:
        for c in ("n", "mean", "std", "skewness", "excess_kurtosis", "shapiro_pvalue", "score"):
            assert r[c] == pytest.approx(want[r.feature, r.candidate][c], rel=1e-8, abs=1e-10)


def test_a_long_run_is_cut_for_its_normal_scores(spark):
    """F1: 1,000 equal values are scored in several pieces, whose sums are those of the whole run."""
    runs = spark.createDataFrame([("s", 1.0, 1000, 0, 1001), ("s", 2.0, 1, 1000, 1001)], "series string, value double, cnt long, below long, n long")
    cut, whole = N.normal_scores(runs, 64), N.normal_scores(runs)
    assert cut.count() == 17 and whole.count() == 2
    for c in N.SCORES:
        a, b = (d.agg(F.sum(c)).first()[0] for d in (cut, whole))
        assert a == pytest.approx(b, abs=1e-9)


def test_lambda_profile_weighs_merged_values(spark):
    """F11, F13."""
    x = np.array([1.0, 2.0, 2.0, 5.0, 5.0, 5.0, 9.0])
    got = {r["lambda"]: r.llf for r in T.lambda_profile(_long(spark, {"f": x}), "box-cox", F.array(F.lit(0.0), F.lit(0.5))).collect()}
    for lam, y in ((0.0, np.log(x)), (0.5, (x**0.5 - 1) / 0.5)):
        assert got[lam] == pytest.approx(-len(x) / 2 * math.log(y.var()) + (lam - 1) * np.log(x).sum(), rel=1e-12)


def test_tasks_grow_with_the_rows(spark):
    """an exchange of more rows has more tasks, not larger ones."""
    assert tasks_for(spark, 100 * ROWS_PER_TASK) == 100 and tasks_for(spark, 1) == 8
    df = spark.range(50).select(F.col("id").alias("idx"), (F.col("id") % 7).alias("a"), (F.col("id") * 3 % 11).alias("b"))
    assert D.spearman_matrix(df, "idx", ["a", "b"]).count() == 1


def test_mixture_and_t_fit_of_repeated_values(spark):
    """every value twice moves a maximum-likelihood fit by nothing and doubles its likelihood."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(-2, 0.5, 150), rng.normal(2, 0.7, 150)])
    long = _long(spark, {"one": x, "two": np.repeat(x, 2)}, "series")
    for fit, names in ((P.fit_student_t, ("nu", "mu", "sigma")), (lambda d: P.fit_gmm(d, (1,)), ())):
        r = {row.series: row for row in fit(long).collect()}
        assert r["two"].loglik == pytest.approx(2 * r["one"].loglik, rel=1e-9) and r["two"].n == 600
        for c in names:
            assert r["two"][c] == pytest.approx(r["one"][c], rel=1e-9)


def _events(spark, folder, ids):
    rows = [(i, 1_700_000_000 + i, i % 5, ("insert", "view", "click")[i % 3], float(i % 9)) for i in ids]
    df = spark.createDataFrame(rows, "event_id long, t long, user_id long, event_type string, value double")
    df.select("event_id", F.timestamp_seconds("t").alias("ts"), "user_id", "event_type", "value").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_delayed_files_keep_messages_beyond_a_gap(spark, tmp_path):
    """message numbers far above the number of events are delivered too."""
    sf = _events(spark, tmp_path, [*range(100), *range(5000, 5100)])
    path = fx.delayed_files(spark, sf)
    assert spark.read.json(path).count() == fx.messages(spark, sf).count()


def test_snapshot_levels_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    """rows of a snapshot from several files in any order make one and the same book."""
    ids = list(range(40))
    np.random.default_rng(1).shuffle(ids)
    a, b = (sorted(fx.snapshots(spark, _events(spark, tmp_path / str(i), x)).collect()) for i, x in enumerate((ids, sorted(ids))))
    assert a == b
