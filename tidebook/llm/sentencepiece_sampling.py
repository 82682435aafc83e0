"""SentencePiece segmentation sampled by forward filtering and backward sampling, and lossless decoding.

The vocabulary comes from a model file (a parameter; never trained or copied here). A text gets the usual leading space,
and its lattice holds every piece that fits plus, for characters without a piece, their bytes. No piece holds a space
after another character, so units (spaces, then what follows up to the next space) are independent lattices:

1. Forward: for each distinct unit of a slice of rows the log weights of all prefixes (sum over all segmentations).
2. Backward: for each occurrence, from its end, a last piece is drawn in proportion to the weight of everything before it.
   The uniform numbers are hashes of (seed, row key, unit, step), so a row's sample does not depend on partitions, order or
   reruns.

A piece's weight is ``(1 / (rank + 10)) ** alpha`` for models whose scores are ranks (byte-pair models), else
``exp(alpha * score)``. Small ``alpha`` gives more varied samples.

Decoding concatenates the pieces' bytes and drops the leading space; it gives back every valid text, also with repeated
spaces, line ends, control characters and the piece sign itself (which is encoded as bytes). A null text has null pieces,
an empty text none. A null row key counts as 0; rows with equal key and text get equal samples.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import Hasher, carried, free_name, mix, slices, text_bytes, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA, SEED = 1.0, 1
SIGN = "▁"
#: Steps of a uniform number, and nodes of the tables that a task keeps of units met before.
GRAIN, NODES = 1 << 32, 1_000_000


class Vocabulary:
    """Pieces as bytes (the sign is a space) with log weights; read on the driver, travels with the tasks."""

    def __init__(self, path: str = MODEL, alpha: float = ALPHA):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.surface: list[bytes] = []
        self.plain, scores, self.byte_ids = [], [], np.full(256, -1, np.int64)
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:-1], 16)
                self.byte_ids[value] = i
                self.surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                self.surface.append(model.id_to_piece(i).replace(SIGN, " ").encode())
                self.plain.append(i)
                scores.append(model.get_score(i))
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no byte pieces, so decoding could not be lossless")
        if any(b" " in s.lstrip(b" ") for s in self.surface):
            raise ValueError("a piece holds a space after another character")
        scores = np.array(scores)
        ranks = bool(len(scores)) and bool((scores == np.rint(scores)).all()) and scores.min() < -1000
        weight = -np.log(-scores - scores.max() * -1 + 10) if ranks else scores
        self.logs = alpha * weight
        self.byte_log = float(alpha * (weight.min() - 2.0)) if len(weight) else -10.0


class Sampler:
    """Encodes slices of rows; made once per task."""

    def __init__(self, vocabulary: Vocabulary, seed: int):
        self.v, self.seed = vocabulary, seed
        self.units, self.hasher = Hasher(5), Hasher(9)
        raw = [vocabulary.surface[i] for i in vocabulary.plain]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        keys = self.hasher.spans(data, np.concatenate([[0], ends[:-1]]), ends)
        order = np.argsort(keys)
        self.keys, self.ids, self.logs = keys[order], np.array(vocabulary.plain)[order], vocabulary.logs[order]
        self.sizes = np.array([len(r) for r in raw])[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[keys >> np.uint64(44)] = True
        self.longest = int(self.sizes.max(initial=1))
        self._empty()

    def _edges(self, data: np.ndarray, offsets: np.ndarray):
        """All pieces in distinct units: end node, length in bytes, piece id (-1: bytes of one character), log weight."""
        n = len(data)
        head = np.append((data & 0xC0) != 0x80, True)  # a character starts here, or the data ends
        place = np.arange(n + 1)
        begin = np.repeat(offsets[:-1], np.diff(offsets))
        self.hasher._powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.hasher.codes[data] * self.hasher.up[:n], out=sums[1:])
        tops = place[1:][head[1:]]
        reach = tops - begin[tops - 1]  # bytes of the unit up to here
        found = []
        char_at = np.flatnonzero(head[:n])
        width = np.diff(np.append(char_at, n))  # bytes of each character
        width_at, single = np.zeros(n, np.int8), np.zeros(n, bool)
        width_at[char_at] = width
        for size in range(1, min(self.longest, int(reach.max(initial=0))) + 1):
            e = tops[reach >= size]
            e = e[head[e - size]]
            if not len(e):
                continue
            keys = mix((sums[e] - sums[e - size]) * self.hasher.down[e - size])
            likely = self.maybe[keys >> np.uint64(44)]
            e, keys = e[likely], keys[likely]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = (self.keys[at] == keys) & (self.sizes[at] == size)
            e, at = e[hit], at[hit]
            found.append((e, np.full(len(e), size), self.ids[at], self.logs[at]))
            if size <= 4:
                single[(e - size)[width_at[e - size] == size]] = True
        lone = ~single[char_at]
        e = (char_at + width)[lone]
        found.append((e, width[lone], np.full(len(e), -1), self.v.byte_log * width[lone]))
        return tuple(np.concatenate([f[i] for f in found]) for i in range(4))

    def _forward(self, data: np.ndarray, offsets: np.ndarray):
        """Edges by end node with, per node, cumulative shares (in ``GRAIN`` steps) of the weight that arrives there."""
        end, size, piece, log = self._edges(data, offsets)
        unit = np.searchsorted(offsets, end - 1, side="right") - 1
        node = end + unit  # every unit has one node more than bytes
        step = end - offsets[unit]
        order = np.argsort(node, kind="stable")
        node, size, piece, log, step = (x[order] for x in (node, size, piece, log, step))
        short = step.astype(np.uint16) if step.max(initial=0) < 1 << 16 else step
        turn = np.argsort(short, kind="stable")  # by place in the unit, equal nodes side by side
        to, back, gain = node[turn], node[turn] - size[turn], log[turn]
        alpha = np.full(len(data) + len(offsets), -np.inf)
        alpha[offsets[:-1] + np.arange(len(offsets) - 1)] = 0.0
        cuts = np.searchsorted(short[turn], np.arange(1, int(step.max(initial=0)) + 2))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            own = to[a:b]
            heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            value = alpha[back[a:b]] + gain[a:b]
            top = np.maximum.reduceat(value, heads)
            each = np.diff(np.append(heads, b - a))
            alpha[own[heads]] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, each)), heads))
        share = np.exp(alpha[node - size] + log - alpha[node])
        heads = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        each = np.diff(np.append(heads, len(node)))
        # Summed edge by edge within each node, so a unit's figures do not depend on its neighbours in the slice.
        for k in range(1, int(each.max(initial=1))):
            at = heads[each > k] + k
            share[at] += share[at - 1]
        ends = heads + each - 1
        part = np.minimum((share / np.repeat(share[ends], each) * GRAIN).astype(np.int64), GRAIN)
        part[ends] = GRAIN
        return node * GRAIN + part, size, piece

    def _tables(self, text: np.ndarray, starts: np.ndarray, length: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Slots of distinct units in the task's tables; units not met before are added (bounded by ``NODES``)."""
        if self.nodes > NODES:
            self._empty()
        at = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[at] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            size = length[new]
            offsets = np.concatenate([[0], np.cumsum(size)])
            own = text[np.repeat(starts[new] - offsets[:-1], size) + np.arange(offsets[-1])]
            shares, sizes, pieces = self._forward(own, offsets)
            self.shares = np.concatenate([self.shares, shares + self.nodes * GRAIN])
            self.edge_size, self.edge_piece = np.concatenate([self.edge_size, sizes]), np.concatenate([self.edge_piece, pieces])
            low = offsets[:-1] + np.arange(len(new)) + self.nodes
            slots = np.arange(len(self.low), len(self.low) + len(new))
            self.low, self.length = np.concatenate([self.low, low]), np.concatenate([self.length, size])
            known, slot = np.concatenate([self.known, hashes[new]]), np.concatenate([self.slot, slots])
            order = np.argsort(known, kind="stable")
            self.known, self.slot = known[order], slot[order]
            self.nodes += int(offsets[-1]) + len(new)
        return self.slot[np.searchsorted(self.known, hashes)]

    def _empty(self) -> None:
        none = np.zeros(0, np.int64)
        self.known, self.nodes = np.zeros(0, np.uint64), 0
        self.slot = self.low = self.length = self.shares = self.edge_size = self.edge_piece = none

    def encode(self, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all rows, one after the other, and the rows' bounds in them."""
        rows, sizes = len(offsets) - 1, np.diff(offsets)
        some = sizes > 0
        bounds = np.concatenate([[0], np.cumsum(sizes + some)])
        text = np.full(int(bounds[-1]), 0x20, np.uint8)
        body = np.ones(len(text), bool)
        body[bounds[:-1][some]] = False
        text[body] = data
        if not len(text):
            return np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
        space = text == 0x20
        fresh = space & ~np.concatenate([[False], space[:-1]])
        fresh[bounds[:-1][some]] = True
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(text))
        row = np.searchsorted(bounds, starts, side="right") - 1
        number = np.arange(len(starts)) - np.searchsorted(starts, bounds[:-1])[row]

        hashes, first, kind = np.unique(self.units.spans(text, starts, ends), return_index=True, return_inverse=True)
        slot = self._tables(text, starts[first], (ends - starts)[first], hashes)[kind]
        size, piece = self.edge_size, self.edge_piece

        # Backward from the last node of every occurrence's unit.
        stop = self.low[slot]
        at = stop + self.length[slot]
        live = np.argsort(slot, kind="stable")  # equal units side by side: their draws look at neighbouring edges
        base = mix(keys.astype(np.uint64)[row] ^ np.uint64(self.seed * 0x9E3779B97F4A7C15 % (1 << 64))) + number.astype(np.uint64)
        chosen, step, used = [], 0, np.zeros(len(starts), np.int64)
        while len(live):
            u = (mix(base[live] * np.uint64(0xD1342543DE82EF95) + np.uint64(step)) % np.uint64(GRAIN)).astype(np.int64)
            edge = np.searchsorted(self.shares, at[live] * GRAIN + u, side="right")
            chosen.append((live, edge))
            used[live] += 1
            at[live] -= size[edge]
            live = live[at[live] > stop[live]]
            step += 1
        # Drawn from the back, so turned round within each unit.
        after = np.cumsum(used)
        path = np.zeros(int(after[-1]), np.int64)
        for k, (who, edge) in enumerate(chosen):
            path[after[who] - 1 - k] = edge
        ids, width = piece[path], np.where(piece[path] < 0, size[path], 1)
        count = np.add.reduceat(width, after - used)
        out = np.repeat(ids, width)
        spread = np.flatnonzero(out < 0)
        if len(spread):  # pieces and their bytes lie in text order
            reach = np.cumsum(size[path]) - size[path]
            inner = np.arange(len(out)) - np.repeat(np.cumsum(width) - width, width)
            out[spread] = self.v.byte_ids[text[(np.repeat(reach, width) + inner)[spread]]]
        totals = np.concatenate([[0], np.cumsum(count)])
        return out, totals[np.searchsorted(starts, bounds)]


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.data = np.frombuffer(b"".join(vocabulary.surface), np.uint8)
        self.size = np.array([len(s) for s in vocabulary.surface])
        self.start = np.cumsum(self.size) - self.size

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows and the rows' bounds in them; the leading space is dropped."""
        size = self.size[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        out = self.data[np.repeat(self.start[ids] - total[:-1], size) + np.arange(total[-1])]
        at = total[bounds]
        keep = np.ones(len(out), bool)
        keep[at[:-1][at[1:] > at[:-1]]] = False
        return out[keep], at - np.concatenate([[0], np.cumsum(at[1:] > at[:-1])])


def _as_lists(values: np.ndarray, bounds: np.ndarray, known: np.ndarray) -> pa.Array:
    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))
    return pc.if_else(pa.array(known), lists, pa.scalar(None, lists.type))


def _as_texts(data: np.ndarray, bounds: np.ndarray, known: np.ndarray) -> pa.Array:
    texts = pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
    return pc.if_else(pa.array(known), texts, pa.scalar(None, pa.large_string())).cast(pa.string())


def _encode(vocabulary: Vocabulary, names: list[str], key: str, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(vocabulary, seed)
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                ids, bounds = sampler.encode(data, offsets, part.column(key).to_numpy(zero_copy_only=False).astype(np.int64))
                known = pc.is_valid(part.column("text")).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), _as_lists(ids, bounds, known), pa.array(np.diff(bounds))],
                    names=[*names, "pieces", "n_pieces"])

    return tidy(run)


def encode(docs: DataFrame, vocabulary: Vocabulary, seed: int = SEED, columns: list[str] | None = None) -> DataFrame:
    """All rows with ``pieces`` (ids) and ``n_pieces``; columns of these names, whatever their case, are replaced."""
    added = T.StructType.fromDDL("pieces array<int>, n_pieces long")
    names = carried(columns or docs.columns, added.names)
    need = list(dict.fromkeys([*names, "text"]))
    key = free_name("key", docs.columns)
    rows = docs.select(*need, F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias(key))
    return rows.mapInArrow(_encode(vocabulary, names, key, seed), T.StructType([*(docs.schema[c] for c in names), *added.fields]))


def _decode(vocabulary: Vocabulary, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lists = part.column("pieces")
                known = pc.is_valid(lists).to_numpy(zero_copy_only=False)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                ids = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64)
                data, bounds = decoder.decode(ids, np.concatenate([[0], np.cumsum(sizes)]))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), _as_texts(data, bounds, known)], names=[*names, "decoded"])

    return tidy(run)


def decode(encoded: DataFrame, vocabulary: Vocabulary, columns: list[str] | None = None) -> DataFrame:
    """All rows with ``decoded``, the text of ``pieces``; a column of this name, whatever its case, is replaced."""
    names = carried(columns or encoded.columns, ["decoded"])
    need = list(dict.fromkeys([*names, "pieces"]))
    return encoded.select(*need).mapInArrow(
        _decode(vocabulary, names), T.StructType([*(encoded.schema[c] for c in names), T.StructField("decoded", T.StringType())]))
