"""Hard negatives of anchors, by Kronecker-packed products.

Components are whole numbers. Several candidates' components of one dimension, biased to be non-negative, lie side by side in the fields of
one wide integer; it is multiplied once by the anchor's (also biased) component, and the products of all dimensions are
added. With bias A for anchors, B for candidates, n dimensions and no field overflowing, a field holds
``a.c + B sum(a) + A sum(c) + n A B``, so every score is unpacked exactly. The field is as wide as the data need: where two or more
fields fit into 53 bits the wide integers travel as doubles, whose sums below 2^53 are exact; else they are Python
integers of ``WIDE`` fields.

Anchors are dealt in chunks and rows in blocks, each of a proven size, and every chunk meets every block:

1. Positives: a chunk meets the blocks of its own label part only. A block gives the best rows of an anchor's label, and these merge.
2. Negatives: for each positive a score must lie in its band; every block gives the first rows of another label, and these merge.

A row travels as packed bytes of the narrowest integer type that holds the table. Labels share 64 parts by hash, so any number of labels works, and a hot
label is many blocks.

Defined results: rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part. Of
rows repeated under one id the first by (label, vector) takes part. Missing components of shorter vectors count as 0. Components
beyond 64 bits are cut to that range, and scores too, before they are ranked. Equal scores rank by smaller id. An anchor without
positives, or a positive without negatives, gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .words import saved

POSITIVES, NEGATIVES = 5, 10
#: The band: ``LOW * positive <= 100 * negative <= HIGH * positive``.
LOW, HIGH = 30, 90
BLOCK, CHUNK, PARTS = 4096, 2048, 64
#: Fields of a wide Python integer, anchors whose scores are ranked at once.
WIDE, ROWS = 32, 256
LONG = np.iinfo(np.int64)


def packed_products(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows, from wide integers that hold several rows of ``c``."""
    n, dim = len(c), c.shape[1]
    if not len(a) or not n:
        return np.zeros((len(a), n), np.int64)
    high_a, high_c = max(abs(int(a.min())), abs(int(a.max()))), max(abs(int(c.min())), abs(int(c.max())))
    field = max(1, (4 * max(1, high_a) * max(1, high_c) * dim).bit_length())
    fields = 53 // field
    kind = np.float64 if fields >= 2 else object
    fields = fields if fields >= 2 else WIDE
    groups = -(-n // fields)
    padded = np.zeros((groups * fields, dim), np.int64 if kind is np.float64 else object)
    padded[:n] = c
    biased = (padded + high_c).astype(kind).reshape(groups, fields, dim)
    wide = biased[:, 0].copy()
    for i in range(1, fields):
        wide += biased[:, i] * kind(1 << field * i) if kind is np.float64 else biased[:, i] * (1 << field * i)
    sums = (a + high_a if kind is np.float64 else a.astype(object) + high_a).astype(kind) @ wide.T
    exact = np.int64 if kind is np.float64 else object
    sums, mask = sums.astype(exact), (1 << field) - 1
    out = np.empty((len(a), groups, fields), exact)
    for i in range(fields):
        out[:, :, i] = sums >> field * i & mask
    out = out.reshape(len(a), -1)[:, :n]
    own_a, own_c = a.astype(exact).sum(1)[:, None], c.astype(exact).sum(1)[None, :]
    out = out - high_c * own_a - high_a * own_c - dim * high_a * high_c
    return out if kind is np.float64 else np.clip(out, LONG.min, LONG.max).astype(np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, column)`` of the k highest allowed scores of each row, in order; columns are in order of ids."""
    n = scores.shape[1]
    rows, columns = [], []
    for i in range(0, len(scores), ROWS):
        own, may = scores[i : i + ROWS], allowed[i : i + ROWS]
        if n > k:
            floor = np.partition(np.where(may, own, LONG.min), n - k, axis=1)[:, n - k]
            may = may & (own >= floor[:, None])
        at, to = np.nonzero(may)
        order = np.lexsort((to, -own[at, to].astype(np.float64), at)) if len(at) and abs(own[at, to]).max() < 1 << 53 else (
            np.array(sorted(range(len(at)), key=lambda j: (at[j], -int(own[at[j], to[j]]), to[j])), np.int64))
        at, to = at[order], to[order]
        first = np.searchsorted(at, at)
        kept = np.arange(len(at)) - first < k
        rows.append(at[kept] + i)
        columns.append(to[kept])
    return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *columns])


def whole_vectors(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", label: str | Column = "label") -> DataFrame:
    """``id, label, v`` of the rows that take part, with whole components."""
    x = F.transform(vec_col, lambda e: e.cast("double"))
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    label = F.col(label) if isinstance(label, str) else label
    whole = F.transform(x, lambda e: F.floor(e * scale))
    taken = rows.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & label.isNotNull()).filter(sound)
    one = taken.select(F.col(id_col).cast("long").alias("id"), F.struct(label.cast("string").alias("label"), whole.alias("v")).alias("r"))
    return one.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.v")


def _matrix(frame: pd.DataFrame, kind: str, dim: int) -> np.ndarray:
    out = np.zeros((len(frame), dim), np.int64)
    for i, x in enumerate(frame["v"]):
        own = np.frombuffer(x, kind)
        out[i, : len(own)] = own
    return out


def _packer(kind: str):
    def run(batches):
        for frame in batches:
            frame["v"] = [np.asarray(x, np.int64).astype(kind).tobytes() for x in frame["v"]]
            yield frame

    return run


def _positives(kind: str, dim: int, k: int):
    def run(key: tuple, anchors: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("id")
        scores = packed_products(_matrix(anchors, kind, dim), _matrix(block, kind, dim))
        own, ids = anchors["id"].to_numpy(np.int64), block["id"].to_numpy(np.int64)
        codes, _ = pd.factorize(pd.concat([anchors["label"], block["label"]]))
        alike = codes[: len(own), None] == codes[None, len(own) :]
        at, to = best(scores, alike & (own[:, None] != ids[None, :]), k)
        return pd.DataFrame({"anchor_id": own[at], "positive_id": ids[to], "score": scores[at, to]})

    return run


def _negatives(kind: str, dim: int, k: int, low: int, high: int):
    def run(key: tuple, anchors: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("id")
        scores = packed_products(_matrix(anchors, kind, dim), _matrix(block, kind, dim))
        own, ids = anchors["id"].to_numpy(np.int64), block["id"].to_numpy(np.int64)
        codes, _ = pd.factorize(pd.concat([anchors["label"], block["label"]]))
        other = codes[: len(own), None] != codes[None, len(own) :]
        out = []
        for place in range(int(anchors["positives"].map(len).max()) if len(anchors) else 0):
            row = np.flatnonzero(anchors["positives"].map(len) > place)
            hits = [anchors["positives"].iloc[i][place] for i in row]
            # Whole-number bounds, in Python integers, as a hundredfold score may pass 64 bits.
            least = np.array([-(-low * h["score"] // 100) for h in hits], np.int64)
            most = np.array([high * h["score"] // 100 for h in hits], np.int64)
            part = scores[row]
            at, to = best(part, other[row] & (part >= least[:, None]) & (part <= most[:, None]), k)
            out.append(pd.DataFrame({
                "anchor_id": own[row[at]], "positive_id": np.array([h["id"] for h in hits], np.int64)[at],
                "negative_id": ids[to], "positive_score": np.array([h["score"] for h in hits], np.int64)[at],
                "negative_score": part[at, to]}))
        return pd.concat(out) if out else pd.DataFrame(
            {c: [] for c in ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")}, dtype=np.int64)

    return run


def mine(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``vectors`` are ``(id, label, v)`` with
    one row per id, ``anchors`` says which of them are anchors."""
    part = F.pmod(F.xxhash64("label"), F.lit(PARTS)).cast("int").alias("part")
    rows = saved(vectors.select("id", "label", "v", part, anchors.alias("anchor")), "vectors")
    peak = F.greatest(F.abs(F.array_max("v").cast("decimal(19,0)")), F.abs(F.array_min("v").cast("decimal(19,0)")))
    shape = rows.agg(F.max(peak).alias("m"), F.max(F.size("v")).alias("d")).first()
    kind = next(k for k, most in (("<i2", 2**15), ("<i4", 2**31), ("<i8", None)) if most is None or (shape.m or 0) < most)
    dim = shape.d or 1
    rows = saved(rows.mapInPandas(_packer(kind), "id long, label string, v binary, part int, anchor boolean"), "packed")
    # At most ``PARTS`` rows: how many blocks and chunks each part of the labels needs.
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("m")).select(
        "part", F.ceil(F.col("n") / block).alias("blocks"), F.ceil(F.col("m") / chunk).alias("chunks")).collect()
    blocks, chunks = {r.part: r.blocks for r in sizes}, {r.part: r.chunks for r in sizes if r.chunks}
    if not chunks:
        return rows.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

    def counts(of: dict[int, int]) -> Column:
        return F.create_map(*[F.lit(int(x)) for pair in of.items() for x in pair])[F.col("part")]

    def upto(n: Column) -> Column:
        return F.sequence(F.lit(0), n.cast("int") - 1)

    def dealt(of: dict[int, int], seed: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), counts(of)).cast("int")

    marks = ["part", "block", "chunk"]
    asked = rows.filter("anchor").select("id", "label", "v", "part", dealt(chunks, 1).alias("chunk"), F.explode(upto(counts(blocks))).alias("block"))
    given = rows.filter(counts(chunks).isNotNull()).select("id", "label", "v", "part", dealt(blocks, 2).alias("block"), F.explode(upto(counts(chunks))).alias("chunk"))
    found = saved(
        asked.groupBy(*marks).cogroup(given.groupBy(*marks)).applyInPandas(
            _positives(kind, dim, positives), "anchor_id long, positive_id long, score long"), "positives")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    kept = found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= positives)
    lists = kept.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), "score")).alias("positives"))

    n_blocks, n_chunks = sum(blocks.values()), sum(chunks.values())
    starts, total = {}, 0
    for p, n in blocks.items():
        starts[p], total = total, total + n
    place = (dealt(blocks, 2) + counts(starts)).alias("block")
    spot = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(n_chunks)).cast("int").alias("chunk")
    asked = rows.filter("anchor").join(lists.withColumnRenamed("anchor_id", "id"), "id").select(
        "id", "label", "v", "positives", spot, F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))
    given = rows.select("id", "label", "v", place, F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk")).toDF("id", "label", "v", "block", "chunk")
    marks = ["block", "chunk"]
    hits = saved(
        asked.groupBy(*marks).cogroup(given.groupBy(*marks)).applyInPandas(
            _negatives(kind, dim, negatives, low, high),
            "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"), "negatives")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
