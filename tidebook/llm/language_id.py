"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text's vector counts its letter n-grams (1 to 3 UTF-8 bytes, ASCII letters lowered, all else one space) in ``DIM`` hashed
places, damped by a logarithm, weighted by inverse document frequency and normalised. Each language has several
centroids, found by spherical k-means; a text gets the language of the centroid with the largest cosine. It is marked
as rejected if that cosine is below what all but ``REJECT`` of the centroid's own training texts reach.

* Document frequencies cover all training rows: one fixed-size counter per task, added up.
* Clusters are fitted on at most ``SAMPLE`` training rows per language, chosen by a hash of their text
  (a documented bound); one group per language.
* The model (centroids, weights, limits) is a few hundred kilobytes per ten languages and travels with the tasks.

Defined results: a text that is null or has no letter gets ``und`` with score 0. Rows without a language teach
nothing. If no row teaches, all texts get ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import carried, free_name, slices, text_bytes, tidy

DIM, CENTROIDS, SAMPLE = 4096, 3, 1500
REJECT, SHARPNESS, SEED = 0.002, 25.0, 1
LETTER = r"\p{L}"


class Grams:
    """Hashed n-gram counts of texts."""

    def __init__(self, dim: int):
        self.dim = dim
        fold = np.full(256, 0x20, np.uint32)
        fold[0x61:0x7B] = np.arange(0x61, 0x7B)
        fold[0x41:0x5B] = np.arange(0x61, 0x7B)
        fold[0x80:] = np.arange(0x80, 0x100)
        self.fold = fold

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        codes = self.fold[data]
        shift = np.uint32(32 - int(self.dim).bit_length() + 1)
        hashed, value = [], np.zeros(len(codes), np.uint32)
        for n, factor in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
            value = value[: len(codes) - n + 1] * np.uint32(257) + codes[n - 1 :] if len(codes) >= n else value[:0]
            hashed.append(((value + np.uint32(n)) * np.uint32(factor) >> shift).astype(np.int64))
        out = np.zeros((len(offsets) - 1, self.dim), np.float32)
        for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if b > a:
                own = [h[a : max(a, b - n)] for n, h in enumerate(hashed)]
                out[r] = np.bincount(np.concatenate(own), minlength=self.dim)
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.log1p(counts) * idf)


def _frequencies(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, found, n = Grams(dim), np.zeros(dim, np.int64), 0
        for batch in batches:
            for part in slices(batch):
                counts = grams.counts(*text_bytes(part.column("text")))
                found += (counts > 0).sum(0)
                n += len(counts)
        place = np.append(np.flatnonzero(found), dim)
        yield pa.RecordBatch.from_pydict({"place": place, "n": np.append(found, n)[place]})

    return tidy(run)


def spherical_kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and each row's nearest."""
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centres = x[[int(rng.integers(len(x)))]]
    while len(centres) < k:  # the row farthest from all centres so far
        centres = np.concatenate([centres, x[[int((x @ centres.T).max(1).argmin())]]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        sums = np.stack([x[own == j].sum(0) if (own == j).any() else centres[j] for j in range(k)])
        centres = _unit(sums).astype(np.float32)
    return centres, (x @ centres.T).argmax(1)


def _clusters(idf: np.ndarray, centroids: int, sample: int, seed: int, reject: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rank", "text"]).head(sample)
        data, offsets = text_bytes(pa.array(pdf["text"].tolist(), pa.large_string()))
        x = vectors(Grams(len(idf)).counts(data, offsets), idf).astype(np.float32)
        centres, own = spherical_kmeans(x, centroids, seed)
        near = (x * centres[own]).sum(1)
        return pd.DataFrame({
            "lang": key[0], "centre": [c.tobytes() for c in centres],
            "limit": [float(np.quantile(near[own == j], reject)) if (own == j).any() else 1.0 for j in range(len(centres))]})

    return run


class Model:
    """Languages, centroids, rejection limits and weights."""

    def __init__(self, langs: list[str], centres: np.ndarray, limits: np.ndarray, idf: np.ndarray):
        self.langs, self.centres, self.limits, self.idf = langs, centres, limits, idf

    def predict(self, counts: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        cosine = vectors(counts, self.idf).astype(np.float32) @ self.centres.T
        names = sorted(set(self.langs))
        by_lang = np.stack([cosine[:, [i for i, x in enumerate(self.langs) if x == n]].max(1) for n in names], 1)
        best = by_lang.argmax(1)
        share = np.exp(SHARPNESS * (by_lang - by_lang.max(1, keepdims=True)))
        nearest = cosine.argmax(1)
        return [names[i] for i in best], 1 / share.sum(1), cosine[np.arange(len(cosine)), nearest] < self.limits[nearest]


def fit(train: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE, dim: int = DIM, seed: int = SEED) -> Model | None:
    """A model of ``train(text, lang)``."""
    train = train.select("text", "lang").filter(F.col("lang").isNotNull() & F.coalesce(F.col("text").rlike(LETTER), F.lit(False)))
    found = np.zeros(dim + 1)
    for place, n in train.select("text").mapInArrow(_frequencies(dim), "place long, n long").groupBy("place").agg(F.sum("n")).collect():
        found[place] = n
    if not found[dim]:
        return None
    idf = (np.log((1 + found[dim]) / (1 + found[:dim])) + 0.1).astype(np.float32)
    sizes = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # A little more than the bound is drawn by hash; the group keeps the first.
    rank = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 30))
    drawn = train.join(F.broadcast(sizes), "lang").withColumn("rank", rank).filter(
        F.col("rank") * F.col("n") <= F.lit(1.2 * sample + 50) * F.lit(float(1 << 30)))
    rows = drawn.dropDuplicates(["lang", "text"]).groupBy("lang").applyInPandas(
        _clusters(idf, centroids, sample, seed, REJECT), "lang string, centre binary, limit double").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["centre"])))
    return Model([r["lang"] for r in rows], np.stack([np.frombuffer(r["centre"], np.float32) for r in rows]),
                 np.array([r["limit"] for r in rows]), idf)


def _predict(model: Model | None, names: list[str], lettered: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(len(model.idf)) if model else None
        for batch in batches:
            for part in slices(batch):
                known = pc.fill_null(part.column(lettered), False).to_numpy(zero_copy_only=False)
                langs, score, far = ["und"] * len(known), np.zeros(len(known)), np.ones(len(known), bool)
                if model:
                    langs, score, far = model.predict(grams.counts(*text_bytes(part.column("text"))))
                    langs = [x if k else "und" for x, k in zip(langs, known)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(langs, pa.string()), pa.array(np.where(known, score, 0.0).astype(float)),
                     pa.array(far | ~known)],
                    names=[*names, "lang_pred", "score", "rejected"])

    return tidy(run)


def identify(docs: DataFrame, model: Model | None, columns: list[str] | None = None) -> DataFrame:
    """All rows with ``lang_pred``, ``score`` (the language's share against the others, by cosine) and ``rejected``.
    Columns of these names, whatever their case, are replaced."""
    added = T.StructType.fromDDL("lang_pred string, score double, rejected boolean")
    names = carried(columns or docs.columns, added.names)
    need = list(dict.fromkeys([*names, "text"]))
    lettered = free_name("lettered", need)
    rows = docs.select(*need, F.col("text").rlike(LETTER).alias(lettered))
    return rows.mapInArrow(_predict(model, names, lettered), T.StructType([*(docs.schema[c] for c in names), *added.fields]))


def crc_part(parts: int, id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))
