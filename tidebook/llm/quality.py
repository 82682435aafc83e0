"""Quality classification by co-training of two views of a page.

* Content view: hashed n-gram profile, word repetition, word length, line layout and character classes of the text.
* Metadata view: the columns source, language and stated length (smooth and in steps of half an octave). It never reads
  the text, so the views share no feature.

Each view has a logistic classifier (Newton steps with a ridge), calibrated on labelled rows that no classifier learns
from. In every round each classifier labels the unlabelled rows that it is most sure of by its calibrated score, as many
good as bad in proportion to the labelled ones, and hands them to the other. A last logistic step combines both calibrated scores. The combined score is the probability of label 1 (good), for every document.

The fit uses bounded samples, chosen by hash: at most ``LABELLED`` rows of each label and ``POOL`` unlabelled rows (documented
bounds), in one task; everything else is row by row. The model is a few kilobytes and travels with the tasks.

Defined results: a null or empty text is scored by its metadata and an empty profile, a very long one as a whole. Null source, language or length
have their own values. Rows labelled twice count twice. Without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .language_id import Grams
from .sampling import labelled_sample
from .words import carried, Hasher, slices, text_bytes, tidy, word_spans

DIM, SOURCES, LANGS, LENGTHS = 256, 32, 16, 48
LABELLED, POOL, ROUNDS, SHARE, SURE = 3000, 4000, 4, 0.05, 0.9
RIDGE, SEED = 1.0, 1


class Views:
    """Feature matrices of both views; made once per task."""

    def __init__(self):
        self.grams, self.hasher = Grams(DIM), Hasher()
        kind = np.full(256, 5, np.int64)  # symbols
        kind[0x61:0x7B], kind[0x41:0x5B], kind[0x30:0x3A], kind[0x80:] = 0, 1, 2, 6
        kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]], kind[0x0A] = 3, 4
        self.kind = kind

    def __call__(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(batch.column("text"))
        n, sizes = len(offsets) - 1, np.diff(offsets)
        row = np.repeat(np.arange(n), sizes)
        kinds = np.bincount(row * 7 + self.kind[data], minlength=7 * n).reshape(n, 7).astype(float)
        starts, ends, first = word_spans(data, offsets)
        words = self.hasher.spans(data, starts, ends)
        count = np.diff(first)
        same = np.zeros(len(words) + 1)
        same[1:] = np.cumsum(np.concatenate([[0], words[1:] == words[:-1]])) if len(words) else []
        again = np.array([same[b] - same[a + 1] if b > a else 0.0 for a, b in zip(first[:-1], first[1:])]).reshape(n)
        distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(first[:-1], first[1:])]).reshape(n)
        letters = np.maximum(kinds[:, 0] + kinds[:, 1] + kinds[:, 6], 1)
        some, size, lines = np.maximum(count, 1), np.maximum(sizes, 1), kinds[:, 4] + 1
        ones = np.ones(n)

        counts = self.grams.counts(data, offsets)
        profile = np.log1p(counts)
        profile /= np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-9)
        content = np.column_stack([
            ones, profile, again / some, np.log1p(again), distinct / some, np.log1p(distinct), letters / some / 10,
            kinds[:, 1] / letters, np.log1p(lines), np.log1p(sizes / lines), np.log1p(count / lines), kinds[:, [1, 2, 3, 5]] / size[:, None],
            kinds[:, 5] / some])

        source = [zlib.crc32(x.encode()) % (SOURCES - 1) + 1 if x is not None else 0 for x in batch.column("source").to_pylist()]
        lang = [zlib.crc32(x.encode()) % (LANGS - 1) + 1 if x is not None else 0 for x in batch.column("lang").to_pylist()]
        told = np.array([x if x is not None else -1 for x in batch.column("n_chars").to_pylist()], float).reshape(n)
        length = np.log1p(np.maximum(told, 0))
        step = np.where(told < 0, 0, np.minimum(2 * length / np.log(2), LENGTHS - 2).astype(np.int64) + 1)
        meta = np.column_stack([
            ones, np.eye(SOURCES)[source].reshape(n, SOURCES), np.eye(LANGS)[lang].reshape(n, LANGS), length,
            np.eye(LENGTHS)[step].reshape(n, LENGTHS)])
        return content, meta


def _chance(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, alike: bool = True, ridge: float = RIDGE, steps: int = 12) -> np.ndarray:
    """Weights by Newton steps; with ``alike`` both classes count alike, whatever their numbers."""
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6) if alike else 0.5
    weight = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share))
    w, eye = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    for _ in range(steps):
        p = _chance(x @ w)
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + eye
        step = np.linalg.solve(curve, x.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


class Model:
    """Weights and calibration of both views, and of their combination."""

    def __init__(self, views: list[np.ndarray], scales: list[np.ndarray], last: np.ndarray):
        self.views, self.scales, self.last = views, scales, last

    def scores(self, both: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Content, metadata and combined score."""
        z = [s[0] + s[1] * (x @ w) for x, w, s in zip(both, self.views, self.scales)]
        return _chance(z[0]), _chance(z[1]), _chance(self.last[0] + self.last[1] * z[0] + self.last[2] * z[1])


def cotrain(both: tuple[np.ndarray, np.ndarray], y: np.ndarray, rounds: int = ROUNDS, share: float = SHARE) -> Model | None:
    """``y``: 1, 0, or -1 where unlabelled. A quarter of the labelled rows is kept for calibration."""
    known = np.flatnonzero(y >= 0)
    kept, seen = known[3::4], np.setdiff1d(known, known[3::4])
    if len({*y[seen].tolist()}) < 2:
        return None
    if len({*y[kept].tolist()}) < 2:
        kept = seen
    truth = y[kept].astype(float)

    def scale(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Offset and factor (not below 0) that turn a view's values into log-odds."""
        return np.maximum(logistic(np.column_stack([np.ones(len(kept)), x[kept] @ w]), truth, False), [-np.inf, 0])

    label = [y.astype(float).copy(), y.astype(float).copy()]
    usable = [np.isin(np.arange(len(y)), seen) for _ in range(2)]
    views: list[np.ndarray] = []
    scales: list[np.ndarray] = []
    for turn in range(rounds + 1):
        views = [logistic(x[u], t[u]) for x, u, t in zip(both, usable, label)]
        scales = [scale(x, w) for x, w in zip(both, views)]
        if turn == rounds:
            break
        for me, other in ((0, 1), (1, 0)):
            free = np.flatnonzero((y < 0) & ~usable[other])
            p = _chance(scales[me][0] + scales[me][1] * (both[me][free] @ views[me]))
            good = max(1, round(len(np.flatnonzero(y < 0)) * share * y[seen].mean()))
            bad = max(1, round(len(np.flatnonzero(y < 0)) * share * (1 - y[seen].mean())))
            order = np.argsort(p, kind="stable")
            for own, mark in ((order[::-1][:good], 1.0), (order[:bad], 0.0)):
                own = own[(p[own] >= SURE) if mark else (p[own] <= 1 - SURE)]
                label[other][free[own]] = mark
                usable[other][free[own]] = True
    calibrated = [s[0] + s[1] * (x[kept] @ w) for x, w, s in zip(both, views, scales)]
    last = logistic(np.column_stack([np.ones(len(truth)), *calibrated]), truth, False)
    return Model(views, scales, last)


INPUTS = ["text", "source", "lang", "n_chars"]


def _fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["rank", "text", "label"], na_position="first").reset_index(drop=True)
    bound = pdf["label"].map({1: LABELLED, 0: LABELLED}).fillna(POOL)
    pdf = pdf[pdf.groupby(pdf["label"].fillna(-1)).cumcount() < bound]
    views, parts = Views(), []
    batch = pa.RecordBatch.from_pydict({
        "text": pa.array(pdf["text"].tolist(), pa.large_string()), "source": pa.array(pdf["source"].tolist(), pa.string()),
        "lang": pa.array(pdf["lang"].tolist(), pa.string()),
        "n_chars": pa.array([None if pd.isna(x) else int(x) for x in pdf["n_chars"]], pa.int64())})
    for part in slices(batch):
        parts.append(views(part))
    both = tuple(np.concatenate([p[i] for p in parts]) for i in range(2))
    model = cotrain(both, pdf["label"].fillna(-1).to_numpy().astype(int))
    if model is None:
        return pd.DataFrame({"part": [], "values": []})
    return pd.DataFrame({"part": range(5), "values": [w.tolist() for w in (*model.views, *model.scales, model.last)]})


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, seed: int = SEED) -> Model | None:
    """A model from ``docs`` and ``labels(doc_id, quality)``. Rows outside ``train`` teach nothing, not even unlabelled."""
    rows = docs if train is None else docs.filter(train)
    known = labels.filter("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("label"))
    drawn = labelled_sample(rows, known, INPUTS, {0: LABELLED, 1: LABELLED, None: POOL}, seed)
    found = drawn.groupBy(F.lit(1).alias("all")).applyInPandas(_fit, "part int, values array<double>").collect()
    if not found:
        return None
    values = [np.array(r["values"]) for r in sorted(found, key=lambda r: r["part"])]
    return Model(values[:2], values[2:4], values[4])


def _score(model: Model | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views = Views()
        for batch in batches:
            for part in slices(batch):
                half = np.full(part.num_rows, 0.5)
                content, meta, score = model.scores(views(part)) if model else (half, half, half)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), *map(pa.array, (content, meta, score))],
                    names=[*names, "content_score", "meta_score", "score"])

    return tidy(run)


def score(docs: DataFrame, model: Model | None, columns: list[str] | None = None) -> DataFrame:
    """All rows with ``content_score``, ``meta_score`` and the combined ``score``; columns of these names, whatever their case, are replaced."""
    added = T.StructType.fromDDL("content_score double, meta_score double, score double")
    names = carried(columns or docs.columns, added.names)
    need = list(dict.fromkeys([*names, *INPUTS]))
    schema = T.StructType([*(docs.schema[c] for c in names), *added.fields])
    return docs.select(*need).mapInArrow(_score(model, names), schema)
