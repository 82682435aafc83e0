"""Vectorised word handling for Arrow batches of texts, and small helpers shared by the operators.

Words are maximal runs of bytes outside ``0x20`` and ``0x09-0x0D``; the separators are ASCII, so the
rule can be applied to UTF-8 bytes. A null text counts as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

#: Bytes of text handled at once inside a task (a longer document is a slice of its own).
SLICE_BYTES = 1 << 20
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(base: str, taken: list[str]) -> str:
    """A column name that none of ``taken`` has, whatever its case."""
    name = f"_{base}"
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def carried(columns: Iterable[str], own: Iterable[str]) -> list[str]:
    """``columns`` without those that a result of ``own`` names would hide, whatever their case."""
    taken = {c.lower() for c in own}
    return [c for c in columns if c.lower() not in taken]


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: computed once, cut from its lineage and
    kept when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Hand freed memory back to the system: workers outlive their tasks, and several share an executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library frees by itself
        pass


def tidy(run: Callable) -> Callable:
    """A batch function that releases what it freed once its task is done."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (public constants of the splitmix64 generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column; row r is ``bytes[offsets[r]:offsets[r + 1]]``."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of text; no row is left out."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        base = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def word_spans(
    data: np.ndarray, offsets: np.ndarray, keep: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: byte spans of all words, and where each row's words begin in them
    (``first`` has one entry more than there are rows). ``keep``: bytes that belong to words."""
    if keep is None:
        keep = np.ones(256, bool)
        keep[list(SPACES)] = False
    inside = keep[data]
    before, after = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    before[1:], after[: len(data)] = inside, inside
    before[offsets] = False
    after[offsets] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Hasher:
    """64-bit hashes of byte spans by prefix sums of a polynomial; made once per task."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.codes = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        self.back = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            for name, b in (("up", self.base), ("down", self.back)):
                have = getattr(self, name)
                setattr(self, name, np.concatenate([have, have * np.uint64(pow(b, k, 1 << 64))]))

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of spans in rising order; about ``SLICE_BYTES`` are worked on at once."""
        out, i = np.zeros(len(starts), np.uint64), 0
        while i < len(starts):
            base = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
            own = data[base : int(ends[j - 1])]
            self._powers(len(own) + 1)
            sums = np.zeros(len(own) + 1, np.uint64)
            np.cumsum(self.codes[own] * self.up[: len(own)], out=sums[1:])
            a, b = starts[i:j] - base, ends[i:j] - base
            out[i:j] = mix((sums[b] - sums[a]) * self.down[a])
            i = j
        return out


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on; runs over row ends, so use places inside rows only."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[j : j + n]
    return mix(out)


def joined_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same rows with their words separated by exactly one space and nothing around them."""
    starts, ends, first = word_spans(data, offsets)
    lengths = ends - starts
    total = np.concatenate([[0], np.cumsum(lengths + 1)])
    inside = np.ones(256, bool)
    inside[list(SPACES)] = False
    out = np.full(int(total[-1]), 0x20, np.uint8)
    place = np.ones(len(out), bool)
    place[total[1:] - 1] = False
    out[place] = data[inside[data]]
    begin = total[first[:-1]]
    finish = np.maximum(total[first[1:]] - 1, begin)
    # Rows stay in place inside ``out``; the separating space after a row belongs to none.
    return out, np.stack([begin, finish])
