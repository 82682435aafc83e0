"""Hard negatives against brute force."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidebook.llm import hard_negatives

VECTOR = "vec_id long, embedding array<double>, label int, id string, part int, block int, score double"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) + 2).tolist(), int(rng.integers(0, 4))) for i in range(400)]
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(120)]  # ties
    rows += [(500, None, 1), (600, [float("nan")] * 6, 1), (700, [None] * 6, 1), (800, [], 1), (900, rows[1][1], None), (None, rows[1][1], 1),
             (2000, [1.0, 2.0], 1), (100, rows[100][1], rows[100][2]), (2100, rows[5][1], 77)]
    return spark.createDataFrame([(i, v, y, "x", 0, 0, 0.5) for i, v, y in rows], VECTOR)


def plain(df, k=5, n=10):
    rows = {}
    for r in df.collect():
        v = r.embedding
        if r.vec_id is not None and r.label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            own = (str(r.label), [int(np.floor(256 * x)) for x in v])
            rows[r.vec_id] = min(own, rows.get(r.vec_id, own))
    out = []
    for a, (y, v) in rows.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, (z, w) in rows.items() if i != a)
        for ps, p, _ in [s for s in scored if s[2] == y][:k]:
            hits = [s for s in scored if s[2] != y and 30 * -ps <= 100 * -s[0] <= 90 * -ps][:n]
            out += [(a, p, r + 1, i, -ps, -s) for r, (s, i, _) in enumerate(hits)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{}, {"block": 50, "chunk": 3}])
def test_equals_brute_force(vectors, sizes):
    got = hard_negatives.mine(hard_negatives.whole_vectors(vectors), F.col("id") % 100 == 0, **sizes).collect()
    want = plain(vectors)
    assert sorted(tuple(r) for r in got) == want and len(want) > 100


def test_none_and_alone(spark, vectors):
    none = hard_negatives.whole_vectors(vectors.filter("vec_id in (500, 800)"))
    assert hard_negatives.mine(none, F.col("id") % 100 == 0).count() == 0
    alone = hard_negatives.whole_vectors(vectors.filter("vec_id in (200, 2100)"))
    assert hard_negatives.mine(alone, F.col("id") % 100 == 0).count() == 0
    assert hard_negatives.mine(alone, F.col("id") % 1000 == 999).count() == 0


def test_large_components(spark):
    """Scores that no double holds, and components beyond 64 bits."""
    rows = [(100, [3e6, 1.0], 1), (1, [2e6, 0.0], 1), (2, [1e6, 5.0], 2), (3, [1e300, -1e300], 2)]
    df = spark.createDataFrame([(i, v, y, "x", 0, 0, 0.5) for i, v, y in rows], VECTOR)
    got = hard_negatives.mine(hard_negatives.whole_vectors(df), F.col("id") == 100).collect()
    scores = 768_000_000 * 512_000_000, 768_000_000 * 256_000_000 + 256 * 1280
    assert [tuple(r) for r in got] == [(100, 1, 1, 2, *scores)]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 1 << 40), st.integers(0, 9), st.integers(0, 70), st.integers(1, 9), st.integers(0, 1000))
def test_packed_products_are_exact(most, a, c, dim, seed):
    rng = np.random.default_rng(seed)
    x, y = rng.integers(-most, most, (a, dim)), rng.integers(-most, most, (c, dim))
    want = [[max(min(int(p.astype(object) @ q.astype(object)), 2**63 - 1), -(2**63)) for q in y] for p in x]
    assert hard_negatives.packed_products(x, y).tolist() == want
