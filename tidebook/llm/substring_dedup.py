"""Removal of passages that an earlier document already has, by super-k-mer partitioning.

A window is ``k`` consecutive words. Its minimiser is the least hash among its runs of ``m`` words, so
equal windows have equal minimisers. Consecutive windows of a document that share their minimiser
travel together, as one packed string of words, to the bucket of that minimiser; there the windows are
sorted and compared word by word, which decides exactly which of them start in a smaller document.

* Buckets are bounded: a first pass counts super-k-mers per class of minimisers (a fixed number of
  counters per task, summed map-side). Classes far above the mean are left out of the buckets; their
  windows are dealt by their own words instead, with the least document found by a map-side
  aggregate and the way back salted. Nothing is dropped, whatever repeats.
* The classes' counts stay a table; the driver gets their sum and the hot classes alone (fewer than one in eight by
  their definition, in practice a handful). Where buckets outnumber the classes, every class is dealt into several.
* Only documents that may lose words meet their ranges in a shuffle; a bounded table of hashed document numbers lets
  the others pass where they are.

Defined results: a null text has no words. A null ``doc_id`` counts as larger than all others, and
rows with equal ``doc_id`` are not earlier than each other. A text below ``k`` words loses nothing.
Columns named like the results are replaced, all others are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import (
    Hasher, carried, free_name, gram_hashes, joined_words, mix, release_memory, saved, slices, text_bytes, tidy, word_spans,
)

LAST = (1 << 63) - 1
SPOTS = 1 << 20
FLUSH_BYTES, LEVEL = 10 << 20, 3
SALTS = 32
#: Super-k-mers of a bucket and of a class, about, and of a class at which it is hot.
BUCKET, CLASS, HOT = 30_000, 4096, 65_536


def _key() -> tuple[Column, Column]:
    """Document number (null last), and a mark of 64 bits that tells rows with equal numbers apart by their text."""
    return F.coalesce("doc_id", F.lit(LAST)), F.xxhash64("text")


def _super_kmers(batch: pa.RecordBatch, hasher: Hasher, k: int, m: int):
    """Per slice: joined bytes, word spans in them, and for each super-k-mer its row, first word,
    number of windows and minimiser."""
    data, offsets = text_bytes(batch.column("text"))
    data, spans = joined_words(data, offsets)
    bounds = np.concatenate([spans[0], [len(data)]])
    starts, ends, first = word_spans(data, bounds)
    if len(starts) < k:
        return None
    grams = gram_hashes(hasher.spans(data, starts, ends), m)
    # Least of the k - m + 1 hashes from each place on, by doubling.
    width, least, have = k - m + 1, grams, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    valid = np.zeros(len(starts) + 1, np.int32)
    has = np.diff(first) >= k
    np.add.at(valid, first[:-1][has], 1)
    np.add.at(valid, first[1:][has] - k + 1, -1)
    valid = np.cumsum(valid[: len(least)]) > 0
    fresh = valid.copy()
    fresh[1:] &= ~(valid[:-1] & (least[1:] == least[:-1]))
    heads = np.flatnonzero(fresh)
    if not len(heads):
        return None
    total = np.concatenate([[0], np.cumsum(valid)])
    counts = np.diff(np.concatenate([total[heads], [total[-1]]]))
    rows = np.searchsorted(first, heads, side="right") - 1
    return data, starts, ends, heads, counts, rows, heads - first[rows], least[heads]


def _class(minimiser: np.ndarray, classes: int) -> np.ndarray:
    return (mix(minimiser) % np.uint64(classes)).astype(np.int64)


def _count_classes(k: int, m: int, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = Hasher(), np.zeros(classes, np.int64)
        for batch in batches:
            for part in slices(batch):
                if (found := _super_kmers(part, hasher, k, m)) is not None:
                    counts += np.bincount(_class(found[-1], classes), minlength=classes)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"class": seen, "n": counts[seen]})

    return tidy(run)


def _bucket(minimiser: np.ndarray, classes: int, buckets: int) -> np.ndarray:
    """Up to ``classes`` buckets join whole classes; beyond, each class is dealt into several by its minimisers."""
    kind = _class(minimiser, classes)
    if buckets <= classes:
        return kind % buckets
    deal = mix(minimiser) // np.uint64(classes) % np.uint64(-(-buckets // classes))
    return kind + classes * deal.astype(np.int64)


def _packs(k: int, m: int, classes: int, buckets: int, hot: np.ndarray):
    """Super-k-mers of all classes that are not hot, packed per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, packer = Hasher(), zstandard.ZstdCompressor(level=LEVEL)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            to = np.concatenate([h[0] for h in held])
            order = np.argsort(to, kind="stable")
            docs, marks, places, windows = (np.concatenate([h[i] for h in held])[order] for i in (1, 2, 3, 4))
            texts = [t for h in held for t in h[5]]
            cuts = np.flatnonzero(np.diff(to[order], prepend=-1))
            out = []
            for a, b in zip(cuts, [*cuts[1:], len(order)]):
                own = [texts[i] for i in order[a:b]]
                out.append(packer.compress(b"".join([
                    np.int32(b - a).tobytes(), docs[a:b].tobytes(), marks[a:b].tobytes(), places[a:b].tobytes(),
                    windows[a:b].tobytes(), b"\n".join(own),
                ])))
            ids = to[order][cuts]
            held.clear()
            return pa.RecordBatch.from_pydict({"bucket": ids, "pack": pa.array(out, pa.binary())})

        for batch in batches:
            for part in slices(batch):
                if (found := _super_kmers(part, hasher, k, m)) is None:
                    continue
                data, starts, ends, heads, counts, rows, places, least = found
                cold = np.flatnonzero(~np.isin(_class(least, classes), hot))
                if not len(cold):
                    continue
                raw, a = data.tobytes(), starts[heads[cold]].tolist()
                b = ends[heads[cold] + counts[cold] + k - 2].tolist()
                doc, mark = (part.column(c).to_numpy(zero_copy_only=False)[rows[cold]] for c in ("doc", "mark"))
                held.append((
                    _bucket(least[cold], classes, buckets), doc.astype(np.int64), mark.astype(np.int64),
                    places[cold].astype(np.int32), counts[cold].astype(np.int32),
                    [raw[x:y] for x, y in zip(a, b)],
                ))
                size += sum(b) - sum(a)
                if size > FLUSH_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return tidy(run)


def _ranges(doc, mark, place, k: int) -> dict:
    """Removed windows of documents, sorted by place within each, as ranges of words."""
    order = np.lexsort((place, mark, doc))
    doc, mark, place = doc[order], mark[order], place[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (place[1:] > place[:-1] + k)
    heads = np.flatnonzero(fresh)
    tails = np.concatenate([heads[1:], [len(doc)]]) - 1 if len(heads) else heads
    return {"doc": doc[heads], "mark": mark[heads], "from": place[heads], "to": place[tails] + k}


def _settle(k: int):
    """One bucket: sort all its windows, compare equal hashes word by word, return what goes."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        opener, parts, texts = zstandard.ZstdDecompressor(), [], []
        for pack in pdf["pack"]:
            raw = opener.decompress(pack)
            n = int(np.frombuffer(raw, np.int32, 1)[0])
            parts.append((
                np.frombuffer(raw, np.int64, n, 4), np.frombuffer(raw, np.int64, n, 4 + 8 * n),
                np.frombuffer(raw, np.int32, n, 4 + 16 * n), np.frombuffer(raw, np.int32, n, 4 + 20 * n),
            ))
            texts.append(raw[4 + 24 * n :])
        doc, mark, place, windows = (np.concatenate([p[i] for p in parts]) for i in range(4))
        raw = b"\n".join(texts)
        data = np.frombuffer(raw, np.uint8)
        rows = np.concatenate([[0], np.flatnonzero(data == 0x0A) + 1, [len(data)]])
        starts, ends, first = word_spans(data, rows)
        hashes = gram_hashes(Hasher(11).spans(data, starts, ends), k)
        row = np.repeat(np.arange(len(doc)), windows)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = first[row] + inner
        h, d = hashes[at], doc[row]
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        head = np.repeat(heads, np.diff(np.concatenate([heads, [len(h)]])))
        later = np.flatnonzero(d > d[head])
        ats, ate = starts[at], ends[at + k - 1]
        gone, doubtful = [], set()
        for i, j in zip(order[later].tolist(), order[head[later]].tolist()):
            if raw[ats[i] : ate[i]] == raw[ats[j] : ate[j]]:
                gone.append(i)
            else:
                doubtful.add(j)
        if doubtful:  # different windows under one hash: settle these groups by the words themselves
            gone = [i for i, j in zip(order[later].tolist(), order[head[later]].tolist()) if j not in doubtful]
            least: dict[bytes, int] = {}
            members = [i for i, j in zip(order.tolist(), order[head].tolist()) if j in doubtful]
            for i in members:
                w = raw[ats[i] : ate[i]]
                least[w] = min(least.get(w, LAST), int(doc[row[i]]))
            gone += [i for i in members if doc[row[i]] > least[raw[ats[i] : ate[i]]]]
        gone = np.array(gone, np.int64)
        out = pd.DataFrame(_ranges(doc[row[gone]], mark[row[gone]], place[row[gone]] + inner[gone], k))
        release_memory()
        return out

    return run


def _hot_windows(k: int, m: int, classes: int, hot: np.ndarray):
    """Each window of a hot class as a row of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in slices(batch):
                if (found := _super_kmers(part, hasher, k, m)) is None:
                    continue
                data, starts, ends, heads, counts, rows, places, least = found
                own = np.flatnonzero(np.isin(_class(least, classes), hot))
                if not len(own):
                    continue
                n = counts[own]
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(heads[own], n) + inner
                raw = data.tobytes()
                doc, mark = (part.column(c).to_numpy(zero_copy_only=False)[rows[own]] for c in ("doc", "mark"))
                yield pa.RecordBatch.from_pydict({
                    "window": pa.array([raw[x:y] for x, y in zip(starts[at].tolist(), ends[at + k - 1].tolist())], pa.binary()),
                    "doc": np.repeat(doc.astype(np.int64), n), "mark": np.repeat(mark.astype(np.int64), n),
                    "place": (np.repeat(places[own], n) + inner).astype(np.int32),
                })

    return tidy(run)


RANGES = "doc long, mark long, from int, to int"


def _hot_ranges(rows: DataFrame, k: int, m: int, classes: int, hot: np.ndarray) -> DataFrame:
    """The least document of each hot window by a map-side aggregate; the way back is salted."""
    windows = saved(
        rows.mapInArrow(_hot_windows(k, m, classes, hot), "window binary, doc long, mark long, place int"), "windows"
    )
    least = windows.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    least = least.filter("least < most").select("window", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("doc", "mark"), F.lit(SALTS)).cast("int").alias("salt")
    return (
        windows.select("*", salt).join(least, ["window", "salt"]).filter("doc > least")
        .select("doc", "mark", F.col("place").alias("from"), (F.col("place") + k).alias("to"))
    )


def repeated_ranges(docs: DataFrame, k: int = 13, m: int = 2, hot_from: int = HOT) -> DataFrame:
    """``doc, mark, ranges`` of all documents that lose words; ranges count words from 0, end excluded.

    A class of minimisers is hot above ``hot_from`` super-k-mers or eight times the mean class, whichever is more;
    all others together with their bucket fit easily into a task.
    """
    doc, mark = _key()
    rows = docs.select(doc.alias("doc"), mark.alias("mark"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = size // 40 + 1
    classes = 1 << min(24, max(10, int(expected // CLASS).bit_length()))
    counts = saved(
        rows.select("text").mapInArrow(_count_classes(k, m, classes), "class long, n long").groupBy("class").agg(F.sum("n").alias("n")),
        "classes",
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(hot_from, 8 * total / classes)
    hot = np.array([r["class"] for r in counts.filter(F.col("n") > limit).select("class").collect()], np.int64)
    buckets = max(256, total // BUCKET)
    packs = rows.mapInArrow(_packs(k, m, classes, buckets, hot), "bucket long, pack binary")
    ranges = packs.groupBy("bucket").applyInPandas(_settle(k), RANGES)
    if len(hot):
        ranges = ranges.unionByName(_hot_ranges(rows, k, m, classes, hot))
    return ranges.groupBy("doc", "mark").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))


def _without(names: list[str], ranges: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = text_bytes(part.column("text"))
                data, (begin, finish) = joined_words(data, offsets)
                raw = data.tobytes()
                kept, n_words, n_removed, digests = [], [], [], []
                for a, b, r in zip(begin.tolist(), finish.tolist(), part.column(ranges).to_pylist()):
                    own = raw[a:b]
                    n = own.count(b" ") + 1 if own else 0
                    gone = 0
                    if r:
                        out = np.zeros(n, bool)
                        for x in r:
                            out[x["from"] : x["to"]] = True
                        gone = int(out.sum())
                        own = b" ".join([w for w, o in zip(own.split(b" "), out.tolist()) if not o])
                    kept.append(own.decode("utf-8", "replace"))
                    n_words.append(n)
                    n_removed.append(gone)
                    digests.append(hashlib.sha256(own).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(kept, pa.string()), pa.array(digests, pa.string())],
                    names=[*names, "n_words", "n_removed", "kept_text", "kept_sha256"],
                )

    return tidy(run)


def remove_repeats(
    docs: DataFrame, k: int = 13, m: int = 2, columns: list[str] | None = None, hot_from: int = HOT
) -> DataFrame:
    """All rows with ``n_words``, ``n_removed``, ``kept_text`` (the words left, joined by one space) and
    its ``kept_sha256``. ``columns``: which columns of ``docs`` to keep (default: all);
    those of a result's name, whatever their case, are replaced."""
    added = T.StructType.fromDDL("n_words long, n_removed long, kept_text string, kept_sha256 string")
    names = carried(columns or docs.columns, added.names)
    need = list(dict.fromkeys([*names, "doc_id", "text"]))
    own = [free_name(c, docs.columns) for c in ("doc", "mark", "ranges")]
    ranges = saved(repeated_ranges(docs, k, m, hot_from).toDF(*own), "ranges")
    spot = F.pmod(F.xxhash64(*own[:2]), F.lit(SPOTS)).alias(free_name("spot", [*docs.columns, *own]))
    # At most SPOTS rows, so safe to broadcast; documents without a hit there need not be moved.
    spots = F.broadcast(ranges.select(spot).distinct())
    keyed = docs.select(*need, *[c.alias(n) for c, n in zip(_key(), own)]).select("*", spot)
    met = spots.columns
    schema = T.StructType([*(docs.schema[c] for c in names), *added.fields])
    moved = keyed.join(spots, met, "left_semi").join(ranges, own[:2], "left").select(*need, own[2])
    clean = keyed.join(spots, met, "left_anti").select(*need, F.lit(None).cast(ranges.schema[own[2]].dataType).alias(own[2]))
    return moved.unionByName(clean).mapInArrow(_without(names, own[2]), schema)
