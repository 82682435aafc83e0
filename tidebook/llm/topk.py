"""Exact top-k by inner product with a pivot-distance index.

Inner products become distances by one more coordinate: with M the largest norm, a vector gets
``sqrt(M^2 - |v|^2)`` and a query 0, and then ``|q - v|^2 = |q|^2 + M^2 - 2 q.v``. Every vector is keyed by its
nearest pivot and by its distance from it (a ring); the rings of a cell, cut into blocks of bounded size, are its
sorted annuli.

1. A query is scored on the blocks of nearest lower bound until these hold ``k`` rows; that gives it a bound.
2. By the triangle inequality a block whose ring is ``[lo, hi]`` around pivot p holds nothing nearer than
   ``max(lo - d(q, p), d(q, p) - hi)``; only blocks below the query's bound are scored. All other blocks are passed
   over, so the result is exact whatever the data.

Pivots (from a bounded sample) and the ring table (pivots x rings rows at most) are the only things that reach
the driver. A ring that holds many rows, such as one vector repeated, is cut into blocks by a hash of its id, and
queries are dealt in chunks, so no group grows with the data.

Components are integers here (``floor(scale * x)``, at most the largest long); scores are exact: float64 products while
sums stay below 2^53, integers beyond; a score beyond 64 bits counts as the largest or smallest long. Vectors that are null, empty or hold null or non-finite components take no part; vectors of
another length than most are compared on what both have (missing components count as 0). Rows with a null id take no
part. Equal scores rank by smaller id; rows repeated under one id are candidates each, except for the query's own id,
and one query: the least vector by components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .words import saved

PIVOTS, RINGS = 16, 16
#: Most and least rows of a block (between them, 1 / 128 of all rows), and queries of a chunk.
BLOCK_ROWS, LEAST_ROWS, CHUNK = 4096, 256, 512
SAMPLE = 4096
LEAST = -(1 << 63)


def integer_vectors(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, v`` of all vectors that take part, as integers."""
    v = F.transform(vec_col, lambda x: x.cast("double"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x * scale))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)).filter(sound).select(
        F.col(id_col).cast("long").alias("id"), whole.alias("v"))


def matrix(lists: list, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim), np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; those beyond 64 bits become the largest or smallest long."""
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(v.astype(np.float64)).max(initial=0)) * q.shape[1]
    if most < 2.0**53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    if most < 2.0**62:
        return q @ v.T
    return np.clip(q.astype(object) @ v.astype(object).T, LEAST, -LEAST - 1).astype(np.int64)


class Index:
    """Pivots in the widened space, ring width and norm bound; a few kilobytes that travel with the tasks."""

    def __init__(self, pivots: np.ndarray, dim: int, norm2: float, rings: int):
        self.pivots, self.dim, self.norm2, self.rings = pivots, dim, norm2, rings
        self.width = max(2.0 * float(np.sqrt(norm2)) / rings, 1e-9)

    def distances(self, v: np.ndarray, stored: bool) -> np.ndarray:
        v = v.astype(np.float64)
        square = (v * v).sum(1)
        last = np.sqrt(np.maximum(self.norm2 - square, 0)) if stored else np.zeros(len(v))
        wide = np.concatenate([v, last[:, None]], 1)
        gap = (wide * wide).sum(1)[:, None] + (self.pivots**2).sum(1)[None, :] - 2 * wide @ self.pivots.T
        return np.sqrt(np.maximum(gap, 0))

    def place(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        d = self.distances(v, True)
        cell = d.argmin(1)
        near = d[np.arange(len(v)), cell]
        return cell, np.minimum((near / self.width).astype(np.int64), self.rings - 1), near


def _placed(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").to_pylist()
            if lists:
                cell, ring, near = index.place(matrix(lists, index.dim))
                yield pa.RecordBatch.from_pydict({
                    "id": batch.column("id"), "v": batch.column("v"), "ring": cell * index.rings + ring, "near": near})

    return run


def _wanted(index: Index, rings: pd.DataFrame, k: int, first: bool):
    """For each query the blocks to score: with ``first`` the nearest that hold k + 1 rows, else all that its
    bound leaves and that were not scored before."""
    ring, parts, n = (rings[c].to_numpy(np.int64) for c in ("ring", "parts", "n"))
    lo, hi = rings["lo"].to_numpy(), rings["hi"].to_numpy()
    cell, slack = ring // index.rings, 1e-6 * (1 + float(np.sqrt(index.norm2)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v").to_pylist()
            if not lists:
                continue
            q = matrix(lists, index.dim)
            d = index.distances(q, False)[:, cell]
            least = np.maximum(np.maximum(lo - d, d - hi), 0)
            at, to = [], []
            for i in range(len(q)):
                order = np.argsort(least[i], kind="stable")
                held = np.cumsum(n[order])
                start = order[: int(np.searchsorted(held, k + 1)) + 1]
                if not first:
                    bound = batch.column("bound")[i].as_py()
                    if bound is None or bound == LEAST:
                        own = order
                    else:
                        wide = q[i].astype(np.float64)
                        reach = np.sqrt(max(float(wide @ wide) + index.norm2 - 2.0 * bound, 0.0))
                        own = np.flatnonzero(least[i] <= reach + slack)
                    start = np.setdiff1d(own, start)
                at.append(np.full(len(start), i))
                to.append(start)
            at, to = np.concatenate(at), np.concatenate(to)
            each = parts[to]
            row = np.repeat(at, each)
            part = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            yield pa.RecordBatch.from_pydict({
                "ring": np.repeat(ring[to], each), "part": part,
                "query_id": batch.column("id").take(pa.array(row)), "q": batch.column("v").take(pa.array(row))})

    return run


def _scored(dim: int, k: int):
    """The k best of one block for each query of one chunk."""

    def run(key: tuple, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(block):
            ids = block["id"].to_numpy(np.int64)
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            scores = products(matrix(list(queries["q"]), dim), matrix([block["v"].iloc[i] for i in order], dim))
            for q, row in zip(queries["query_id"].to_numpy(np.int64), scores):
                best = np.argsort(~row, kind="stable")  # like -row, without overflow
                best = best[ids[best] != q][:k]
                out.append(pd.DataFrame({"query_id": q, "vec_id": ids[best], "score": row[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS, rings: int = RINGS, seed: int = 1) -> DataFrame:
    """``query_id, rank, vec_id, score`` for queries ``(id, v)`` on vectors ``(id, v)`` of integers."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score long"
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    queries = saved(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    shape = vectors.agg(F.max(square).alias("m"), F.max(F.size("v")).alias("d"), F.count(F.lit(1)).alias("n")).first()
    if not shape.n:
        return spark.createDataFrame([], result)
    # The sample only places pivots: any choice gives exact results.
    share = min(1.0, 2 * SAMPLE / shape.n)
    sample = vectors.filter(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) <= share * (1 << 20)).limit(SAMPLE).collect()
    dim = max(shape.d, queries.agg(F.max(F.size("v"))).first()[0] or 0)
    points = np.unique(matrix([r.v for r in sample], dim), axis=0) if sample else np.zeros((1, dim), np.int64)
    chosen = points[np.random.default_rng(seed).permutation(len(points))[:pivots]].astype(np.float64)
    last = np.sqrt(np.maximum(shape.m - (chosen**2).sum(1), 0))
    index = Index(np.concatenate([chosen, last[:, None]], 1), dim, shape.m, rings)

    placed = saved(vectors.mapInArrow(_placed(index), "id long, v array<long>, ring long, near double"), "placed")
    table = placed.groupBy("ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("near").alias("lo"), F.max("near").alias("hi")).toPandas()
    table["parts"] = -(-table["n"] // min(BLOCK_ROWS, max(LEAST_ROWS, int(shape.n) // 128)))
    parts = spark.createDataFrame(table[["ring", "parts"]])
    blocks = placed.join(F.broadcast(parts), "ring").withColumn("part", F.pmod(F.xxhash64("id", F.lit(2)), F.col("parts")))
    blocks = blocks.select("ring", "part", "id", "v")
    chunks = max(1, -(-queries.count() // CHUNK))
    wanted_schema = "ring long, part long, query_id long, q array<long>"

    def score(wanted: DataFrame) -> DataFrame:
        wanted = saved(wanted.withColumn("chunk", F.pmod(F.xxhash64("query_id", F.lit(3)), F.lit(chunks))), "wanted")
        keys = ["ring", "part", "chunk"]
        used = wanted.select(*keys).distinct()
        copies = blocks.join(used, ["ring", "part"]).select("ring", "part", "chunk", "id", "v").toDF("r", "p", "c", "id", "v")
        best = wanted.groupBy(*keys).cogroup(copies.groupBy("r", "p", "c")).applyInPandas(
            _scored(dim, k), "query_id long, vec_id long, score long")
        return saved(best, "scored")

    def ranked(scores: DataFrame) -> DataFrame:
        place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return scores.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)

    start = score(queries.mapInArrow(_wanted(index, table, k, True), wanted_schema))
    bounds = ranked(start).filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
    bounded = queries.join(bounds, "id", "left").select("id", "v", "bound")
    rest = score(bounded.mapInArrow(_wanted(index, table, k, False), wanted_schema))
    return ranked(start.unionByName(rest)).select("query_id", "rank", "vec_id", "score")
