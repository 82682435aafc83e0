"""Order and rank primitives against pandas, including hot keys and hot values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidebook.operators import returns as R
from tidebook.operators.ordering import blocked_window, dense_series, halo_chunks, positions, shifted
from tidebook.operators.ranks import average_ranks, expand_runs, quantiles, sorted_blocks, value_runs


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(1)
    n = 3000
    # One key holds most rows.
    pdf = pd.DataFrame({"k": np.where(rng.random(n) < 0.7, "hot", "cold"), "t": np.arange(n), "v": rng.normal(size=n)})
    pdf["flag"] = rng.random(n) < 0.05
    return pdf


@pytest.mark.parametrize("fan", [4, 10_000])
def test_blocked_window_equals_plain_window(spark, frame, fan):
    df = spark.createDataFrame(frame).withColumn("b", F.expr("t div 100"))
    marked = F.when(F.col("flag"), F.col("t"))
    got = blocked_window(
        df, ["k"], ["t"], "b", sums={"s": F.col("v")}, lasts={"l": marked}, nexts={"x": marked}, fan=fan
    ).toPandas().sort_values("t").reset_index(drop=True)
    g = frame.assign(m=frame.t.where(frame.flag)).groupby("k")
    assert np.allclose(got.s, frame.groupby("k").v.cumsum())
    pd.testing.assert_series_equal(got.l.astype(float), g.m.ffill(), check_names=False)
    later = frame.assign(m=frame.t.where(frame.flag)).groupby("k").m.transform(lambda s: s.shift(-1).bfill())
    pd.testing.assert_series_equal(got.x.astype(float), later, check_names=False)


def test_positions_and_shift_across_chunks(spark, frame):
    df = spark.createDataFrame(frame).withColumn("b", F.expr("t div 250"))
    numbered = positions(df, ["k"], ["t"], "b")
    got = shifted(numbered, ["k"], {"back": (F.col("v"), 7), "ahead": (F.col("v"), -30)}, size=64).toPandas()
    got = got.sort_values("t").reset_index(drop=True)
    g = frame.groupby("k").v
    assert (got.idx == frame.groupby("k").cumcount()).all()
    assert np.allclose(got.back, g.shift(7), equal_nan=True)
    assert np.allclose(got.ahead, g.shift(-30), equal_nan=True)


def test_halo_chunks_bound_group_size(spark):
    df = spark.range(1000).select(F.col("id").alias("idx"))
    sizes = halo_chunks(df, size=100, back=10, ahead=5).groupBy("chunk").count().agg(F.max("count")).first()[0]
    assert sizes == 115
    assert halo_chunks(df, size=100, back=250).filter("own").count() == 1000


def test_dense_series_drops_unusable_values(spark):
    rows = [("a", 0, 1.0), ("a", 1, float("nan")), ("a", 2, None), ("a", 3, float("inf")), ("a", 9, 2.0)]
    got = dense_series(spark.createDataFrame(rows, "series string, idx long, value double")).orderBy("idx").collect()
    assert [(r.idx, r.value) for r in got] == [(0, 1.0), (1, 2.0)]


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(size=1500), np.full(700, 0.25), [1e9, -1e9], np.round(rng.normal(size=300), 1)])
    pdf = pd.DataFrame({"series": "x", "idx": np.arange(len(v)), "value": v})
    return pdf, spark.createDataFrame(pdf)


def test_runs_quantiles_and_ranks(skewed):
    pdf, df = skewed
    runs = value_runs(df).toPandas().sort_values("value")
    assert runs.cnt.sum() == len(pdf)
    assert (runs.below.to_numpy() == np.concatenate([[0], runs.cnt.cumsum().to_numpy()[:-1]])).all()
    probs = [0.0, 0.01, 0.37, 0.5, 0.99, 1.0]
    q = quantiles(df, probs).first()
    assert q.n == len(pdf)
    assert np.allclose(q.q, np.quantile(pdf.value, probs))
    ranks = average_ranks(df).toPandas().sort_values("idx")
    assert np.allclose(ranks["rank"], pdf.value.rank())
    places = expand_runs(value_runs(df), piece=64).toPandas().sort_values("place")
    assert (places.place.to_numpy() == np.arange(len(pdf))).all()
    assert np.allclose(places.value, np.sort(pdf.value))


def test_ewma_series_over_many_chunks(spark):
    n, hl = 5000, 2
    x = np.sin(np.arange(n)) + 2
    df = spark.createDataFrame(pd.DataFrame({"symbol": "a", "idx": np.arange(n), "x": x}))
    got = R.ewma_series(df, "x", hl).toPandas().sort_values("idx").ewma.to_numpy()
    a, want, s = 1 - 2 ** (-1 / hl), [], 0.0
    for v in x:
        s = a * v + (1 - a) * s
        want.append(s)
    assert np.allclose(got, want, rtol=1e-12)


def test_blocks_stay_small_under_several_scales(spark):
    """Most values crowd together; others lie at 1e3 and 1e12, and one value fills a third of all rows."""
    i = F.col("id")
    value = F.when(i % 3 == 0, F.lit(0.5)).when(i % 1000 == 1, i * 1e12).when(i % 1000 == 2, i + 1e3).otherwise(F.rand(3) * 1e-6)
    long = spark.range(600_000).select(F.lit("s").alias("series"), value.alias("value"))
    sizes = sorted_blocks(long, rows=20_000).groupBy("_block").agg(F.count(F.lit(1)).alias("runs")).toPandas()["runs"]
    assert len(sizes) >= 8 and sizes.max() < 100_000 and sizes.max() < 4 * sizes.mean()
    runs = value_runs(long, rows=20_000)
    got = runs.agg(F.sum("cnt"), F.max("n"), F.max("below"), F.max("value")).first()
    assert got[0] == got[1] == 600_000 and got[2] == 599_999
    bad = runs.orderBy("value").toPandas()
    assert (bad["below"].to_numpy() == bad["cnt"].cumsum().shift(fill_value=0).to_numpy()).all()


def test_one_scan_of_the_rows(spark, tmp_path):
    from tidebook.operators import moments as S

    path = str(tmp_path / "long")
    spark.range(1000).selectExpr("'s' AS series", "id AS idx", "CAST(id AS DOUBLE) AS value").write.parquet(path)
    plan = value_runs(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert path not in plan  # the merged runs are read, not the rows again
    described = S.describe_series(spark.read.parquet(path))
    assert path not in described._jdf.queryExecution().executedPlan().toString() and described.count() == 1
