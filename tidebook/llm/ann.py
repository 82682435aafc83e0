"""Nearest neighbours by inner product: block matrix join of int8 tiles with error bounds.

Vectors and queries are dealt in blocks of bounded size; each pair of blocks is one tile. Inside a tile every vector is
``scale * int8 + error``; one product of the int8 tiles gives all inner products up to
``|q error| |v| + |q int8| |v error|`` (norms of the actual errors, not worst cases). Pairs whose upper end is below the
k-th best lower end of their query in the tile cannot be among its k nearest and are dropped; the others are computed
again in double precision from the original components, and a heap per query keeps the k best. The tiles' short lists
are merged per query. The bounds hold for any data, so the result is exact (recall 1).

The int8 tiles are multiplied as float32 matrices: every sum of up to 1,000 products stays below 2^24 and so is exact
(longer vectors use float64). The queries are a stated set against all rows, in blocks.

Vectors that are null, empty, zero or hold null or non-finite components take no part; neither do rows with a null id.
Vectors of different length are compared on what both have. Equal scores rank by smaller id.
Rows repeated under one id are candidates each, except for the query's own id, and one query: the least vector by components.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import saved

#: Rows of a block: a sixteenth of all, within these bounds; and queries of a chunk.
BLOCK_ROWS, CHUNK = (2048, 32_768), 256


def sound_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id, v`` of all vectors that take part, in double precision."""
    v = F.transform(vec_col, lambda x: x.cast("double"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter(sound)
        .filter(F.exists(v, lambda x: x != 0))
        .select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    )


def _matrix(lists: list, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim))
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales, the norms of the int8 parts and of what they leave out (rounded up)."""
    scale = np.maximum(np.abs(v).max(1) / 127.0, 1e-300)
    whole = np.rint(v / scale[:, None]).astype(np.int8)
    part = whole.astype(np.float64) * scale[:, None]
    up = 1 + 1e-12
    return whole, scale, np.sqrt((part * part).sum(1)) * up, np.sqrt(((v - part) ** 2).sum(1)) * up


def exact_products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component in order."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * v[:, d]
    return total


def tile_nearest(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """``(query, vector, score)``: the k nearest of one tile for each of its queries."""
    (qi, qs, qn, qe), (vi, vs, vn, ve) = quantised(q), quantised(v)
    kind = np.float32 if q.shape[1] <= 1000 else np.float64
    near = (qi.astype(kind) @ vi.astype(kind).T).astype(np.float64) * qs[:, None] * vs[None, :]
    slack = qe[:, None] * (vn + ve)[None, :] + qn[:, None] * ve[None, :]
    slack += 1e-9 * (qn + qe)[:, None] * (vn + ve)[None, :]
    own = qid[:, None] == vid[None, :]
    near[own] = -np.inf
    low = near - slack
    floor = np.full(len(qid), -np.inf)
    if len(vid) > k:
        floor = np.partition(low, len(vid) - k, axis=1)[:, len(vid) - k]
    at, to = np.nonzero((near + slack >= floor[:, None]) & ~own)
    score = exact_products(q[at], v[to])
    out, ids = [], vid[to].tolist()
    cuts = np.searchsorted(at, np.arange(len(qid) + 1))
    for i, query in enumerate(qid.tolist()):
        pairs = zip(score[cuts[i] : cuts[i + 1]].tolist(), [-x for x in ids[cuts[i] : cuts[i + 1]]])
        out += [(query, -x, s) for s, x in heapq.nlargest(k, pairs)]
    return out


def _tiles(k: int):
    def run(key: tuple, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(queries) and len(block):
            dim = max(queries["v"].map(len).max(), block["v"].map(len).max())
            rows = tile_nearest(
                queries["id"].to_numpy(np.int64), _matrix(list(queries["v"]), dim),
                block["id"].to_numpy(np.int64), _matrix(list(block["v"]), dim), k)
        lists: dict[int, list[dict]] = {}
        for query, vec, score in rows:
            lists.setdefault(query, []).append({"loss": -score, "vec_id": vec})
        return pd.DataFrame({"query_id": np.array(list(lists), np.int64), "best": list(lists.values())})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` for queries ``(id, v)`` on vectors ``(id, v)``."""
    queries = saved(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")  # one row per query
    n, m = vectors.count(), queries.count()
    rows = min(max(-(-n // 16), BLOCK_ROWS[0]), BLOCK_ROWS[1])
    blocks, chunks = max(1, -(-n // rows)), max(1, -(-m // CHUNK))
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    chunk = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(chunks)).cast("int").alias("chunk")
    left = queries.select("id", "v", chunk, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = vectors.select("id", "v", block, F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    right = right.select("block", "chunk", "id", "v").toDF("b", "c", "id", "v")
    best = "array<struct<loss: double, vec_id: long>>"
    lists = saved(
        left.groupBy("block", "chunk").cogroup(right.groupBy("b", "c")).applyInPandas(_tiles(k), f"query_id long, best {best}"),
        "tiles",
    )
    # One short sorted list per query and block; the loss is the negative score, so lists sort by score, then id.
    merged = lists.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    return merged.select("query_id", F.posexplode("best").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.loss")).alias("score"))
