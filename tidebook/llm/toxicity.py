"""Toxicity by compression distance: one zstandard dictionary of toxic, one of ordinary text.

A window is one word between spaces, in lower case; short windows give the sharpest contrast. Each window is compressed
with both dictionaries; the difference of the lengths says how much better toxic text explains it. A text's evidence is
how many of its windows reach each threshold difference, against its length; a logistic step, calibrated on training
rows that built no dictionary, turns that into the probability of label 1.

Training (bounded samples, at most ``SAMPLE`` rows of each label by hash, in one task):
* the toxic dictionary holds the words and word beginnings that are most over-represented in toxic documents, as far as
  chance does not explain them;
* the ordinary dictionary holds frequent words of ordinary documents, and then those of their words that the toxic
  dictionary would still explain better (``ROUNDS`` of hard cases), so that shared word parts cancel out.

Equal windows are compressed once per task (a bounded cache). Whole texts are scored, row by row; the model is a few
kilobytes. The contents of the dictionaries are chosen by contrast of the classes, not by ``zstandard.train_dictionary``: that one
covers what is frequent in each class, which is largely the same in both. In the few settings tried it found at most a quarter of
the held-out toxic texts at one percent of false alarms (README).
Defined results: null and empty texts get the score of a text without evidence; a row repeated is scored each time. Without training rows of
both labels every score is 0.5.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import logistic
from .sampling import labelled_sample
from .words import Hasher, carried, slices, text_bytes, tidy, word_spans

SAMPLE, TOXIC_WORDS, ORDINARY_WORDS, HARD_WORDS, ROUNDS, SEED = 5000, 80, 100, 150, 4, 1
THRESHOLDS = (2, 3, 4, 5)
RIDGE = 0.1
#: Lengths of word beginnings that compete with whole words for a place in the toxic dictionary.
STEMS = (4, 5, 6, 7)
TOXIC_STEMS, LEAST_DOCS, CHANCE, CACHE = 24, 3, 20, 1_000_000
#: Ends every window, as matches are not looked for in the last bytes of a block. Its first byte occurs nowhere else, so no
#: match of a word runs into it and leaves bytes that cannot be matched any more.
TAIL = b"\x01the of and to"


class Windows:
    """Words of texts as byte spans: runs of letters and of bytes beyond ASCII, in lower case."""

    def __init__(self):
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[0x41:0x5B] += 0x20
        self.keep = np.zeros(256, bool)
        self.keep[0x41:0x5B] = self.keep[0x61:0x7B] = self.keep[0x80:] = True
        self.hasher = Hasher(3)

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        data = self.fold[data]
        starts, ends, first = word_spans(data, offsets, self.keep)
        return data.tobytes(), starts, ends, first, self.hasher.spans(data, starts, ends)


class Contrast:
    """Length with the ordinary dictionary less length with the toxic one, per window."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        settings = zstandard.ZstdCompressionParameters(
            format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0, window_log=14,
            hash_log=12, chain_log=13, search_log=4, min_match=4, target_length=32, strategy=zstandard.STRATEGY_GREEDY)
        self.toxic, self.ordinary = (self._packer(d, settings) for d in (toxic, ordinary))
        self.known: dict[int, int] = {}

    @staticmethod
    def _packer(content: bytes, settings: zstandard.ZstdCompressionParameters):
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings).compress

    def of(self, word: bytes) -> int:
        window = b" " + word + b" " + TAIL
        return len(self.ordinary(window)) - len(self.toxic(window))

    def __call__(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        unique, place, back = np.unique(hashes, return_index=True, return_inverse=True)
        known, out = self.known, np.zeros(len(unique), np.int64)
        if len(known) > CACHE:
            known.clear()
        for i, (h, a, b) in enumerate(zip(unique.tolist(), starts[place].tolist(), ends[place].tolist())):
            value = known.get(h)
            if value is None:
                value = known[h] = self.of(raw[a:b])
            out[i] = value
        return out[back]


def dictionary(words: list[bytes]) -> bytes:
    """Dictionary content: the most telling words last, where matches are cheapest."""
    return b" " + b" ".join(reversed(words)) + b" " + TAIL


def evidence(differences: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: counts of windows at each threshold, plain and against the number of words."""
    n = np.diff(first)
    cols = [np.ones(len(n))]
    for t in THRESHOLDS:
        total = np.concatenate([[0], np.cumsum(differences >= t)])
        hits = total[first[1:]] - total[first[:-1]]
        cols += [np.log1p(hits), np.log1p(1000.0 * hits / np.maximum(n, 20)) / 4, np.minimum(hits, 3) / 3]
    return np.column_stack([*cols, np.log1p(n) / 8])


class Model:
    def __init__(self, toxic: bytes, ordinary: bytes, weights: np.ndarray):
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights


def _surprise(n: int, of: int, part: float) -> float:
    """Chernoff bound of n or more of ``of`` draws that each hit with chance ``part``, as a negative logarithm."""
    q = n / of
    return 0.0 if q <= part else of * (q * np.log(q / part) + ((1 - q) * np.log((1 - q) / (1 - part)) if q < 1 else 0.0))


def _document_words(texts: list[str]) -> list[set[bytes]]:
    out = []
    for start in range(0, len(texts), 200):
        data, offsets = text_bytes(pa.array(texts[start : start + 200], pa.large_string()))
        raw, starts, ends, first, _ = Windows()(data, offsets)
        spans = list(zip(starts.tolist(), ends.tolist()))
        out += [{raw[a:b] for a, b in spans[x:y]} for x, y in zip(first[:-1], first[1:])]
    return out


def train(texts: list[str], labels: np.ndarray) -> Model | None:
    """Dictionaries from two thirds of the texts, calibration on the others."""
    labels = np.asarray(labels)
    build = np.arange(len(texts)) % 3 != 2
    if len({*labels[build].tolist()}) < 2:
        return None
    sets = _document_words(texts)
    # Near copies would repeat the words of one text: documents that share most words with an earlier one are left out.
    counts, sizes, seen, own_words = (Counter(), Counter()), [0, 0], (set(), set()), (set(), set())
    for words, y in ((sets[i], int(labels[i])) for i in np.flatnonzero(build)):
        long = sorted(w for w in words if len(w) > 8)[:40:8]
        if long and sum(w in seen[y] for w in long) * 2 > len(long) and y:
            continue
        seen[y].update(long)
        counts[y].update(words | {w[:k] for w in words for k in STEMS if len(w) > k})
        sizes[y] += 1
        own_words[y].update(words)
    toxic, ordinary = counts[1], counts[0]
    ordinary_words, toxic_words = own_words

    def contrast(w: bytes, n: int) -> float:
        return np.log((n / sizes[1]) / ((ordinary[w] + 0.5) / sizes[0])) * np.sqrt(n)

    # Only words that chance does not explain: of the documents with the word, so many toxic ones would be drawn once in
    # ``CHANCE`` trials, all candidate words counted.
    part = sizes[1] / (sizes[0] + sizes[1])
    candidates = [(w, n) for w, n in toxic.items() if n >= LEAST_DOCS and len(w) >= 4]
    least = np.log(max(1, len(candidates)) * CHANCE)
    ranked = sorted(((contrast(w, n), w) for w, n in candidates if _surprise(n, n + ordinary[w], part) >= least), reverse=True)
    ranked = [w for c, w in ranked if c > 0]
    telling = [w for w in ranked if w in toxic_words][:TOXIC_WORDS]
    # Beginnings that no single word accounts for stand for their rarer words.
    stems: list[bytes] = []
    for w in ranked:
        if len(stems) < TOXIC_STEMS and w not in toxic_words and not any(
                x.startswith(w) and toxic[x] >= 0.7 * toxic[w] for x in telling + stems) and not any(w.startswith(x) for x in stems):
            stems.append(w)
    telling = stems + telling
    whole = Counter({w: n for w, n in ordinary.items() if w in ordinary_words})
    common = [w for w, _ in sorted(whole.items(), key=lambda x: (-x[1], x[0]))[:ORDINARY_WORDS]]
    hard: list[bytes] = []
    # Ordinary words with a telling beginning are left to the thresholds: in the dictionary they would cancel the beginning.
    rest = [w for w in whole if w not in set(telling) and not w.startswith(tuple(stems))]
    for _ in range(ROUNDS):
        judge = Contrast(dictionary(telling + common), dictionary(hard + common))
        worst = [(judge.of(w), ordinary[w], w) for w in rest]
        worst = sorted(((d * n, w) for d, n, w in worst if d >= THRESHOLDS[0]), reverse=True)
        hard += [w for _, w in worst[: HARD_WORDS // ROUNDS]]
        near = {w for _, w in worst}
        rest = [w for w in rest if w in near]
    model = Model(dictionary(telling + common), dictionary(hard + common), np.zeros(0))
    held = ~build if len({*labels[~build].tolist()}) == 2 else build
    judge, windows, x = Contrast(model.toxic, model.ordinary), Windows(), []
    for i in np.flatnonzero(held):
        raw, starts, ends, first, hashes = windows(*text_bytes(pa.array([texts[i]], pa.large_string())))
        x.append(evidence(judge(raw, starts, ends, hashes), first))
    x = np.concatenate(x)
    model.weights = logistic(x, labels[held].astype(float), False, ridge=RIDGE)
    return model


def _fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.dropna(subset=["text"]).drop_duplicates(["text", "label"]).sort_values(["rank", "text"]).reset_index(drop=True)
    pdf = pdf[pdf.groupby("label").cumcount() < SAMPLE]
    model = train(pdf["text"].tolist(), pdf["label"].to_numpy())
    if model is None:
        return pd.DataFrame({"toxic": [], "ordinary": [], "weights": []})
    return pd.DataFrame({"toxic": [model.toxic], "ordinary": [model.ordinary], "weights": [model.weights.tolist()]})


def fit(docs: DataFrame, labels: DataFrame, where: Column | None = None, seed: int = SEED) -> Model | None:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``; rows outside ``where`` teach nothing."""
    rows = docs if where is None else docs.filter(where)
    known = labels.filter("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("label"))
    drawn = labelled_sample(rows, known, ["text"], {0: SAMPLE, 1: SAMPLE}, seed, once=True)
    found = drawn.groupBy(F.lit(1).alias("all")).applyInPandas(_fit, "toxic binary, ordinary binary, weights array<double>").collect()
    return Model(bytes(found[0]["toxic"]), bytes(found[0]["ordinary"]), np.array(found[0]["weights"])) if found else None


def _score(model: Model | None, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, judge = Windows(), Contrast(model.toxic, model.ordinary) if model else None
        for batch in batches:
            for part in slices(batch):
                score = np.full(part.num_rows, 0.5)
                if model:
                    raw, starts, ends, first, hashes = windows(*text_bytes(part.column("text")))
                    score = 1 / (1 + np.exp(-np.clip(evidence(judge(raw, starts, ends, hashes), first) @ model.weights, -30, 30)))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(score)], names=[*names, "score"])

    return tidy(run)


def score(docs: DataFrame, model: Model | None, columns: list[str] | None = None) -> DataFrame:
    """All rows with ``score``; a column of this name, whatever its case, is replaced."""
    names = carried(columns or docs.columns, ["score"])
    need = list(dict.fromkeys([*names, "text"]))
    return docs.select(*need).mapInArrow(_score(model, names), T.StructType([*(docs.schema[c] for c in names), T.StructField("score", T.DoubleType())]))
