"""Exact searches against brute force."""

import numpy as np
import pytest

from tidebook.llm import ann, topk

VECTOR = "vec_id long, embedding array<float>, label int, id string, v string, block int"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(250)]  # one vector repeated
    rows += [(2000, None), (2020, [float("nan")] * 8), (2040, [None] * 8), (2060, [float("inf")] + [0.0] * 7), (2080, []),
             (None, rows[1][1]), (2100, [0.0] * 8), (3, rows[3][1])]
    return spark.createDataFrame([(i, v, 1, "x", "y", 0) for i, v in rows], VECTOR)


def plain(vectors):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in vectors.collect()
            if r.vec_id is not None and r.embedding and all(x is not None for x in r.embedding)]
    return [(i, v) for i, v in rows if np.isfinite(v).all()]


def in_order(a, b):
    total = 0.0
    for x, y in zip(a.tolist(), b.tolist()):
        total += x * y
    return total


def test_top_k(vectors, monkeypatch):
    monkeypatch.setattr(topk, "LEAST_ROWS", 32)
    rows = [(i, np.floor(256 * v).astype(np.int64)) for i, v in plain(vectors)]
    whole = topk.integer_vectors(vectors)
    got = {}
    for r in topk.top_k(whole, whole.filter("id % 50 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for i, q in rows:
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for j, v in rows if j != i)[:5]
            assert sorted(got[i]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]


def test_top_k_of_few_and_none(spark, vectors):
    few = topk.integer_vectors(vectors.filter("vec_id in (50, 51)"))
    assert [(r.query_id, r.rank, r.vec_id) for r in topk.top_k(few, few.filter("id = 50"), 5).collect()] == [(50, 1, 51)]
    none = topk.integer_vectors(vectors.filter("vec_id = 2000"))
    assert topk.top_k(none, none, 5).count() == 0
    assert topk.top_k(few, few.filter("id = 7"), 5).count() == 0


def test_repeated_queries_and_huge_components(spark):
    rows = [(50, [1.0, 2.0]), (50, [3.0, 0.0]), (51, [2e8, 1.0]), (52, [-1e300, 1.0]), (53, [1.0, 1.0]), (100, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = topk.integer_vectors(df)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(whole, whole.filter("id % 50 = 0"), 5).collect())
    most, near = 2**63 - 1, [51, 53, 52]
    of_50 = [most, 256 * 51_200_000_000 + 512 * 256, 256 * 256 * 3, -(2**63)]
    assert got[:4] == [(50, n + 1, j, s) for n, (j, s) in enumerate(zip([100, *near], of_50))]
    assert [r[1:3] for r in got[4:]] == [(1, 50), (2, 50), (3, 51), (4, 53), (5, 52)] and got[4][3] == got[6][3] == most
    sound = ann.sound_vectors(df.filter("vec_id < 52"))
    assert [(r.rank, r.vec_id, r.score) for r in ann.nearest(sound, sound.filter("id = 50"), 3).collect()] == [(1, 51, 2e8 + 2)]


def test_large_components_stay_exact():
    huge = np.array([[1 << 62, 1 << 62], [-(1 << 62), 5]])
    assert topk.products(huge, huge[:1]).tolist() == [[2**63 - 1], [-(2**63)]]
    q = np.array([[2**29, 3], [1, -(2**29)]])
    assert topk.products(q, q[:, ::-1]).tolist() == [[int(a @ b) for b in q[:, ::-1].astype(object)] for a in q.astype(object)]


@pytest.mark.parametrize("rows", [64, 4096])
def test_nearest(vectors, monkeypatch, rows):
    monkeypatch.setattr(ann, "BLOCK_ROWS", (rows, rows))
    monkeypatch.setattr(ann, "CHUNK", 16)
    whole = ann.sound_vectors(vectors)
    kept = [(i, v) for i, v in plain(vectors) if v.any()]
    got = {}
    for r in ann.nearest(whole, whole.filter("id % 20 = 0"), 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for i, q in kept:
        if i % 20 == 0:
            best = sorted((-in_order(q, v), j) for j, v in kept if j != i)[:20]
            assert sorted(got[i]) == [(n + 1, j, -s) for n, (s, j) in enumerate(best)]


def test_nearest_of_none(vectors):
    none = ann.sound_vectors(vectors.filter("vec_id in (2000, 2100)"))
    assert none.count() == 0 and ann.nearest(none, none).count() == 0
