"""Exponential weights over batches far longer than a thousand half-lives, against a plain loop."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebook.operators import returns as R
from tidebook.operators import standardize as Z

N, HALF = 100_000, 20.0
A = 1.0 - 2.0 ** (-1.0 / HALF)


@pytest.fixture(scope="module")
def batch(spark):
    """One batch of 100,000 rows: null values, NaN, and 30,000 rows in which nothing moves."""
    i = F.col("id")
    x = F.sin(i * 0.7) + F.sin(i * 0.013) * 3
    value = F.when(i % 97 == 5, None).when(i % 89 == 7, F.lit(float("nan"))).when(i.between(40_000, 70_000), 2.5).otherwise(x)
    rows = spark.range(N).select(
        F.lit("A").alias("symbol"), F.timestamp_seconds(i).alias("timestamp"), F.timestamp_seconds(F.lit(0)).alias("target_hour"),
        F.when((i > 0) & ~i.between(40_000, 70_000), F.cos(i * 0.3) * 1e-3).alias("log_return"), value.alias("f"), i.alias("n"))
    return rows.repartition(7).persist()


def test_variance_of_a_long_batch(batch):
    got = R.ewma_variance(batch, HALF).orderBy("n").select("log_return", "variance_proxy").collect()
    v = None
    for r in got:
        x = r.log_return
        v = v if v is None and x is None else (1 - A) * (v or 0.0) + (0.0 if x is None else A * x * x)
        if v is None:
            assert r.variance_proxy is None
        else:
            assert r.variance_proxy == pytest.approx(v, rel=1e-9, abs=1e-100)
    assert "_block" not in R.ewma_variance(batch, HALF).columns


def test_scale_of_a_long_batch(batch):
    given = batch.orderBy("n").select("f").collect()
    m = v = 0.0
    want = []
    for (x,) in given:
        x = None if x is None or np.isnan(x) else x
        m = (1 - A) * m + (0.0 if x is None else A * x)
        d = None if x is None else x - m
        v = (1 - A) * v + (0.0 if d is None else A * d * d)
        want.append(None if d is None else max(-3.0, min(3.0, d / np.sqrt(v + 1e-12))))
    got = [r.f for r in Z.ewma_scale(batch, ["f"], HALF).orderBy("n").collect()]
    assert all((g is None) == (w is None) for g, w in zip(got, want))
    assert np.allclose([g for g in got if g is not None], [w for w in want if w is not None], rtol=1e-7, atol=1e-7)


def test_no_further_shuffle(batch):
    plan = R.ewma_variance(batch, HALF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
