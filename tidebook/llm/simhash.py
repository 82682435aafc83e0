"""SimHash near-duplicate components by pivot distance tables.

A fingerprint bit is 1 if it is set in over half of the hashes of a text's shingles. Fingerprints that differ in at
most ``NEAR`` = 2 bits are linked.

References are fixed fingerprints: zero, and for each of four groups of 16 bits sixteen seeded masks inside the group.
A row of the table holds the Hamming distances of a fingerprint to all 65. Two fingerprints within two bits leave two of
the four groups alone, and there the distances, less the distance to zero, are equal. So each of the six pairs of groups
keys every fingerprint by its distances, and only fingerprints that meet under a key (a cell) are compared:

1. pairs whose table rows differ by more than 2 in any coordinate are discarded (the cell is sorted by the first
   coordinate, the others are taken one after the other);
2. survivors are verified bit by bit, and a cell gives a spanning forest of its links, never all pairs.

A cell of more than ``CELL`` fingerprints, such as the loose copies of one text, is keyed again in the same way: the
masks of a group are independent, so the key fixes its 32 bits, and the other 32 are cut into groups of 8, then of 4. At the third
level a cell has 8 free bits, thus 256 fingerprints at most. So no cell is unbounded and no pair is lost.

Equal fingerprints are one node; nodes are counted and linked in Spark, documents never. Defined results: a null text
is empty; texts without words have fingerprint zero and are linked like any other. Long texts are hashed in slices and
whole. Rows repeated under one id are rows each. A null ``doc_id`` keeps its row and takes the least id of its component (null if
that has none). Columns of the input that have a result's name, whatever the case, are left out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components
from .words import carried, mix, saved, slices, text_bytes, tidy, word_spans

NEAR = 2
WORDS = 3
SEED = 42
#: Fingerprints of one cell that are compared; more of them are keyed again.
CELL = 4096
#: Hashes, and pairs, worked on at once.
HASHES, PAIRS = 1 << 16, 1 << 20
TABLES = tuple(combinations(range(4), 2))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle (repeats included, words joined by one space), and where each row's begin."""
    data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    size = ends - starts
    put = np.concatenate([[0], np.cumsum(size + 1)])
    joined = np.full(int(put[-1]), 0x20, np.uint8)
    inside = np.ones(len(joined), bool)
    inside[put[1:] - 1] = False
    belongs = np.zeros(len(data) + 1, np.int8)
    belongs[starts] += 1
    belongs[ends] -= 1
    joined[inside] = data[np.cumsum(belongs[:-1]) > 0] if len(data) else data
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(n)), count)
    at = first[row] + np.arange(len(row)) - begin[row]
    stop = put[at + np.minimum(n, k)[row]] - 1
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    return np.fromiter((digest(view[a:b], SEED) for a, b in zip(put[at].tolist(), stop.tolist())), np.uint64, len(row)), begin


def majority(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """One fingerprint per row: the bits that over half of its hashes have."""
    ones = np.zeros((len(begin) - 1, 64), np.int64)
    for a in range(0, len(hashes), HASHES):
        own = hashes[a : a + HASHES]
        bits = np.unpackbits(own.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows = np.searchsorted(begin, np.arange(a, a + len(own)), side="right") - 1
        new = np.flatnonzero(np.diff(rows, prepend=-1))
        ones[rows[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    over = 2 * ones > np.diff(begin)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, columns: Sequence[str] | None = None, text: str = "text") -> DataFrame:
    """``columns`` and ``bits``, the fingerprint as a signed long."""
    columns = carried(docs.columns if columns is None else columns, ["bits", "fingerprint", "component_id"])
    frame = docs.select(*columns, F.col(text).alias("_text_"))
    schema = frame.drop("_text_").withColumn("bits", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text_"):
                got = majority(*shingle_hashes(*text_bytes(part.column("_text_"))))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(got.view(np.int64))], names=[*columns, "bits"])

    return frame.mapInArrow(tidy(run), schema)


@cache
def level(path: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """``(masks, group)``: the references and their groups for the bits that the tables of ``path`` leave free."""
    rng = np.random.default_rng([SEED, *path])
    free = np.random.default_rng(SEED).permutation(64)
    for turn in path:
        groups = free.reshape(4, -1)
        free = np.concatenate([groups[g] for g in range(4) if g not in TABLES[turn]])
    masks, group = [], []
    for g, places in enumerate(free.reshape(4, -1)):
        n = len(places)
        while np.linalg.matrix_rank(chosen := rng.integers(0, 2, (n, n))) < n:
            pass
        masks += [int(sum(1 << int(p) for p in places[row > 0])) for row in chosen]
        group += [g] * n
    return np.array(masks, np.uint64), np.array(group)


def distances(bits: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """The table: Hamming distances of every fingerprint to zero and to all references."""
    out = np.empty((len(bits), len(masks) + 1), np.int16)
    out[:, 0] = np.bitwise_count(bits)
    for j, mask in enumerate(masks):
        out[:, j + 1] = np.bitwise_count(bits ^ mask)
    return out


def _keyed(depth: int):
    """Six keys of each fingerprint; a key holds the cell that the fingerprint came from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column("bits").to_numpy(zero_copy_only=False).view(np.uint64)
            cell = batch.column("cell").to_numpy(zero_copy_only=False).view(np.uint64)
            path = batch.column("path").to_numpy(zero_copy_only=False).astype(np.int64)
            for p in np.unique(path).tolist():
                own = path == p
                way = tuple(p // 6**i % 6 for i in reversed(range(depth)))
                masks, group = level(way)
                table = distances(bits[own], masks)
                less = (table[:, 1:] - table[:, :1]).astype(np.int64).view(np.uint64)
                for t, pair in enumerate(TABLES):
                    key = cell[own] + np.uint64(t + 1)
                    for j in np.flatnonzero(np.isin(group, pair)):
                        key = key * np.uint64(0x9E3779B97F4A7C15) + less[:, j]
                    yield pa.RecordBatch.from_pydict({
                        "cell": pa.array(mix(key).view(np.int64)), "path": pa.array(np.full(len(key), 6 * p + t)),
                        "bits": pa.array(bits[own].view(np.int64))})

    return run


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the sets of ``a`` and ``b``; a label is the least place of its set."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (label[label] != label).any():
            label = label[label]


def cell_links(cells: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each cell."""
    masks, _ = level(())
    table = distances(bits, masks)
    # Rows of a cell by their first coordinate; cells lie further apart than any distance.
    place = cells * 1000 + table[:, 0]
    order = np.argsort(place, kind="stable")
    place, bits, table = place[order], bits[order], np.ascontiguousarray(table[order].T)
    stop = np.searchsorted(place, place + NEAR, side="right")
    each = stop - np.arange(len(bits)) - 1
    upto = np.cumsum(each)
    label, i = np.arange(len(bits)), 0
    while i < len(bits):
        j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS, side="right")))
        n = each[i:j]
        a = np.repeat(np.arange(i, j), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
        for row in table[1:]:
            left = np.abs(row[a] - row[b]) <= NEAR
            a, b = a[left], b[left]
        near = np.bitwise_count(bits[a] ^ bits[b]) <= NEAR
        label = unite(label, a[near], b[near])
        i = j
    own = label != np.arange(len(bits))
    return bits[own], bits[label[own]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("members")
        offsets = lists.offsets.to_numpy()
        bits = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
        i = 0
        while i < len(lists):  # cells of about 64 thousand fingerprints at once
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + (1 << 16), side="right")) - 1)
            cells = np.repeat(np.arange(j - i), np.diff(offsets[i : j + 1]))
            a, b = cell_links(cells, bits[offsets[i] : offsets[j]])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})
            i = j


def links(nodes: DataFrame, cell: int = CELL) -> DataFrame:
    """``(a, b)``: links that join all distinct ``bits`` within two bits of each other."""
    found, rows = None, nodes.select(F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("path"), "bits")
    for depth in range(3):
        keyed = saved(rows.mapInArrow(_keyed(depth), "cell long, path long, bits long"), "keyed")
        sizes = saved(keyed.groupBy("cell", "path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "sizes")
        fit = sizes if depth == 2 else sizes.filter(F.col("n") <= cell)
        cells = keyed.join(fit, ["cell", "path"]).groupBy("cell", "path").agg(F.collect_list("bits").alias("members"))
        own = saved(cells.select("members").mapInArrow(tidy(_links), "a long, b long").distinct(), "links")
        found = own if found is None else found.unionByName(own)
        crowded = sizes.filter(F.col("n") > cell)
        if depth == 2 or crowded.isEmpty():
            return found
        rows = keyed.join(crowded.select("cell", "path"), ["cell", "path"]).select("cell", "path", "bits")


def near_duplicates(docs: DataFrame, columns: Sequence[str] | None = None, id_col: str = "doc_id", text: str = "text",
                    cell: int = CELL) -> DataFrame:
    """``columns``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the least id that is reachable."""
    rows = saved(fingerprints(docs.withColumn("component", F.col(id_col)), [*carried(
        docs.columns if columns is None else columns, ["component", "bits", "fingerprint", "component_id"]), "component"], text), "fingerprints")
    nodes = saved(rows.groupBy("bits").agg(F.min("component").alias("least")), "nodes")
    joined = components(links(nodes, cell)).toDF("bits", "root")
    roots = joined.join(nodes, "bits")
    first = roots.groupBy("root").agg(F.min("least").alias("first"))
    moved = roots.join(first, "root").select("bits", "first")
    # Written, so that the join below shuffles both of its sides and the planner can split a hot fingerprint.
    to = saved(nodes.join(moved, "bits", "left").select("bits", F.coalesce("first", "least").alias("component_id")), "component-ids")
    return rows.join(to, "bits").select(
        *[c for c in rows.columns if c not in ("bits", "component")],
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
