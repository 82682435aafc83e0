"""Source divergence audit: how the sources of a language differ in their terms, from one sort of term pointers.

Terms are the runs of bytes outside ``0x00-0x40, 0x5B-0x60, 0x7B-0x7F`` with A-Z lower-cased.

1. A shard is a slice of Arrow text buffers. Pointers to all its term starts are sorted by multikey quicksort: eight bytes at
   a time, three-way partitions of large runs around a pivot, small runs together; equal runs go on to the next eight.
   Equal pointers are one term; their rows give its document frequency and its count by language and source. A document
   lies in one shard, so frequencies of shards can be added.
2. Spark adds the shards up by (lang, source, term), keeps the terms with enough documents, and has totals by group.
3. Smoothed shares are whole numbers, ``p = 1 + floor(10^9 (count + 1) / (N + V))``, and the divergence of a term is
   ``floor((p - q)^2 / q)``, so all sums are exact.
4. Part ``term``: the terms that a group uses more than its language. Part ``pair``: every other source of the language, summed over all
   kept terms. Terms are dealt to buckets, sources to tiles of ``TILE``; a bucket of a pair of tiles is a small dense
   product, and terms that neither tile has are one number times their count. So neither a common term, nor a hot source, nor
   many sources meet in one task.

Defined results: null text, lang and source are ''. A row is a document, whatever its id. A group without terms, or a language
with V = 0, has its pairs with value 0 and no terms. A source that is alone in its language has no pairs. Very long texts are shards of their own,
very long terms are compared to their end. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .words import saved, slices, text_bytes, tidy, word_spans

#: Bytes of text of a shard, and the length of runs that are sorted together.
SHARD_BYTES, SMALL = 2 << 20, 1 << 13
#: Bytes of a term that are sorted eight at a time; longer terms are compared as a whole from there.
DEEP = 64
LEAST_DOCS, TOP = 3, 200
WHOLE = 1_000_000_000
#: Sources of a tile, terms of a bucket.
TILE, BUCKET = 64, 512

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
TERM = np.zeros(256, bool)
TERM[0x41:0x5B] = TERM[0x61:0x7B] = TERM[0x80:] = True
GROUP = ["lang", "source"]


def _chunk(words: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Eight bytes from each pointer on, as a number in byte order; zero behind the end of the term."""
    gone = 8 - np.minimum(ends - at, 8)
    key = words[at].astype(np.uint64)
    short = gone > 0
    key[short] &= ~np.uint64(0) << (np.uint64(8) * gone[short].astype(np.uint64))
    key[gone == 8] = 0
    return key


def _partitioned(order: np.ndarray, key: np.ndarray, run: np.ndarray, rng: np.random.Generator) -> None:
    """Sort ``order`` by ``key`` inside every run, in place: quicksort with three-way partitions until runs are small,
    and small runs all at once."""
    edges = np.flatnonzero(np.diff(run, prepend=-1, append=-2))
    open_ = [(a, z) for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()) if z - a > SMALL]
    piece = run.copy() * (len(run) + 1)
    while open_:
        a, z = open_.pop()
        own = key[a:z]
        pivot = np.sort(rng.choice(own, 9))[4]
        less, same = own < pivot, own == pivot
        parts = [np.flatnonzero(less), np.flatnonzero(same), np.flatnonzero(~less & ~same)]
        moved = np.concatenate(parts)
        order[a:z], key[a:z] = order[a:z][moved], own[moved]
        x, y = a + len(parts[0]), a + len(parts[0]) + len(parts[1])
        piece[x:y] += x - a
        piece[y:z] += y - a
        open_ += [(s, e) for s, e in ((a, x), (y, z)) if e - s > SMALL]
    done = np.lexsort((key, piece))
    order[:], key[:] = order[done], key[done]


def pointer_sort(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, run)``: the terms' places in byte order, and the number of the run of equal terms of each place."""
    rng = np.random.default_rng(0)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray((len(data) + 1,), ">u8", buffer=padded, strides=(1,))
    order, run = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    live, depth = np.arange(len(starts)), 0
    while len(live) and depth < DEEP:
        # ``live`` are the places whose runs go on; their order changes inside runs only.
        own = order[live]
        key = _chunk(words, np.minimum(starts[own] + depth, ends[own]), ends[own])
        _partitioned(own, key, run[live], rng)
        order[live] = own
        fresh = np.zeros(len(order), bool)
        fresh[live[1:]] = (key[1:] != key[:-1]) & (run[live[1:]] == run[live[:-1]])
        run = run + np.cumsum(fresh)
        depth += 8
        # A run goes on if any of its terms does; those that have ended come first then.
        held, more = run[live], ends[own] - starts[own] > depth
        live = live[(np.bincount(held)[held] > 1) & (np.bincount(held, more)[held] > 0)]
    if len(live):
        fresh = np.zeros(len(order), bool)
        edges = np.flatnonzero(np.diff(run[live], prepend=-1, append=-2))
        for a, z in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = sorted((data[starts[i] + depth : ends[i]].tobytes(), i) for i in order[live[a:z]].tolist())
            order[live[a:z]] = [i for _, i in own]
            fresh[live[a + 1 : z]] = [x[0] != y[0] for x, y in zip(own, own[1:])]
        run = run + np.cumsum(fresh)
    return order, run


def _shard(part: pa.RecordBatch) -> pa.RecordBatch:
    """``lang, source, term, n, docs`` of one shard."""
    data, offsets = text_bytes(part.column("text"))
    starts, ends, first = word_spans(data, offsets, TERM)
    data = LOWER[data]
    langs, sources = (part.column(c).dictionary_encode() for c in GROUP)
    width = max(1, len(sources.dictionary))
    code = langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy()
    groups = max(1, len(langs.dictionary)) * width
    order, run = pointer_sort(data, starts, ends)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[order]
    # Counts by (run, row), then by (run, group of the row).
    pairs, count = np.unique(run * len(offsets) + row, return_counts=True)
    term, doc = np.divmod(pairs, len(offsets))
    keys, inverse = np.unique(term * groups + code[doc], return_inverse=True)
    n = np.bincount(inverse, weights=count, minlength=len(keys)).astype(np.int64)
    docs = np.bincount(inverse, minlength=len(keys))
    term, group = np.divmod(keys, groups)
    at = order[np.flatnonzero(np.diff(run, prepend=-1))][term]
    sizes = ends[at] - starts[at]
    put = np.concatenate([[0], np.cumsum(sizes)])
    taken = np.repeat(starts[at] - put[:-1], sizes) + np.arange(put[-1])
    texts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(put.astype(np.int64)), pa.py_buffer(data[taken].tobytes()))
    lang, source = langs.dictionary.take(pa.array(group // width)), sources.dictionary.take(pa.array(group % width))
    return pa.RecordBatch.from_pydict({"lang": lang, "source": source, "term": texts.cast(pa.string()), "n": n, "docs": docs})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, size=SHARD_BYTES):
            if part.num_rows:
                yield _shard(part)


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents of every term in every group."""
    shards = docs.select(*GROUP, "text").mapInArrow(tidy(_counted), "lang string, source string, term string, n long, docs long")
    return shards.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, v: Column) -> Column:
    """Smoothed share in parts of 10^9, a whole number."""
    up = (count + 1).cast("decimal(19,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    return (F.call_function("div", up, (total + v).cast("decimal(19,0)")) + 1).cast("long")


def divergence(p: Column, q: Column) -> Column:
    d = (p - q).cast("decimal(19,0)")
    return F.call_function("div", d * d, q.cast("decimal(19,0)")).cast("long")


def _tile_sums(key: tuple, left: pd.DataFrame, sizes: pd.DataFrame) -> pd.DataFrame:
    """Sums of the divergence over the terms of one bucket, for every source of one tile against every one of another.

    ``left``: ``term, sid, p`` of the terms that either tile has; ``sizes``: ``sid, side, none`` with the share of an absent term.
    """
    term, terms = pd.factorize(left["term"])
    tables, ids = [], []
    for side in (0, 1):
        own = sizes[sizes["side"] == side]
        sid, none = own["sid"].to_numpy(np.int64), own["none"].to_numpy(np.int64)
        table = np.repeat(none[None, :], len(terms), 0)
        at = pd.Index(sid).get_indexer(left["sid"])
        table[term[at >= 0], at[at >= 0]] = left["p"].to_numpy(np.int64)[at >= 0]
        tables.append(table)
        ids.append(sid)
    p, q = tables
    totals = [((gap := p[:, i : i + 1] - q) * gap // q).sum(0) for i in range(len(ids[0]))]
    return pd.DataFrame({
        "lang": key[0], "i": np.repeat(ids[0], len(ids[1])), "j": np.tile(ids[1], len(ids[0])),
        "value": np.concatenate([np.zeros(0, np.int64), *totals]), "seen": len(terms)})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, lang: str = "lang", source: str = "source",
          text: str = "text", tile: int = TILE, bucket: int = BUCKET) -> DataFrame:
    """``lang, source, part, item, value, rank``."""
    none = F.lit("")
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), none).alias("lang"), F.coalesce(F.col(source).cast("string"), none).alias("source"), F.col(text).alias("text"))
    counts = saved(term_counts(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("d")).filter(F.col("d") >= least_docs).drop("d")
    rows = saved(counts.drop("docs").join(kept, ["lang", "term"]), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = rows.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = saved(
        docs.select(*GROUP).distinct().join(totals, GROUP, "left").join(langs, "lang", "left").select(
            *GROUP, *[F.coalesce(c, zero).alias(c) for c in ("total", "v", "lang_total")], place.cast("long").alias("sid")),
        "groups")

    p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    shares = saved(rows.join(groups, GROUP).select(*GROUP, "term", "sid", "v", p.alias("p"), q.alias("q")), "shares")

    order = [F.desc("value"), "item"]
    over = shares.filter("p > q").select(*GROUP, F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    # The best of each deal of a group first, so a group of many terms is not ranked in one task.
    deal = F.pmod(F.xxhash64("item"), F.lit(256)).alias("deal")
    best = over.select("*", deal).withColumn("r", F.row_number().over(Window.partitionBy(*GROUP, "deal").orderBy(*order))).filter(F.col("r") <= top)
    terms = best.withColumn("rank", F.row_number().over(Window.partitionBy(*GROUP).orderBy(*order))).filter(F.col("rank") <= top)

    pairs = _pairs(shares, groups, tile, bucket).withColumn("rank", F.row_number().over(Window.partitionBy(*GROUP).orderBy(*order)))
    result = [*GROUP, "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank")]
    return pairs.withColumn("part", F.lit("pair")).select(*result).unionByName(terms.withColumn("part", F.lit("term")).select(*result))


def _pairs(shares: DataFrame, groups: DataFrame, tile: int, bucket: int) -> DataFrame:
    """``lang, source, item, value`` for every two sources of a language."""
    absent = F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("total"), F.greatest("v", F.lit(1)))).otherwise(F.lit(1).cast("long"))
    known = groups.select(*GROUP, "sid", "v", absent.alias("none"), F.floor(F.col("sid") / tile).alias("tile"))
    tiles = known.groupBy("lang").agg(F.max("tile").alias("last"), F.max("v").alias("v"))
    buckets = F.ceil(F.col("v") / bucket)
    # Every term of a tile goes to all pairs of its tile with another, on either side.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("other")
    own = F.floor(F.col("sid") / tile)
    sent = shares.join(tiles.drop("v"), "lang").select(
        "lang", "term", "sid", "p", own.alias("tile"), F.pmod(F.xxhash64("term"), buckets).alias("bucket"), other)
    both = F.explode(F.when(F.col("tile") == F.col("other"), F.array(F.struct(F.col("tile").alias("ti"), F.col("other").alias("tj")))).otherwise(F.array(
        F.struct(F.col("tile").alias("ti"), F.col("other").alias("tj")), F.struct(F.col("other").alias("ti"), F.col("tile").alias("tj")))))
    sent = sent.select("lang", "bucket", "term", "sid", "p", both.alias("t")).select("lang", "t.*", "bucket", "term", "sid", "p")
    key = ["lang", "ti", "tj", "bucket"]
    seen = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(buckets - 1, F.lit(0)))).alias("bucket")
    side = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("tile").alias("ti"), F.col("other").alias("tj")),
                             F.struct(F.lit(1).alias("side"), F.col("other").alias("ti"), F.col("tile").alias("tj")))).alias("t")
    sizes = known.join(tiles.drop("v"), "lang").select("lang", "sid", "none", "v", "tile", other).select("lang", "sid", "none", "v", side).select(
        "lang", "t.*", seen, "sid", "none")
    sums = sent.groupBy(*key).cogroup(sizes.groupBy(*key)).applyInPandas(_tile_sums, "lang string, i long, j long, value long, seen long")
    sums = saved(sums.groupBy("lang", "i", "j").agg(F.sum(F.col("value").cast("decimal(28,0)")).alias("value"), F.sum("seen").alias("seen")), "tile-sums")
    # Terms that a pair of tiles has not seen are absent from both sources.
    a = known.select("lang", F.col("sid").alias("i"), "source", "v", F.col("none").alias("p"))
    b = known.select("lang", F.col("sid").alias("j"), F.col("source").alias("item"), F.col("none").alias("q"))
    rest = (F.col("v") - F.col("seen")).cast("decimal(19,0)") * divergence(F.col("p"), F.col("q")).cast("decimal(19,0)")
    return (
        sums.filter("i <> j").join(a, ["lang", "i"]).join(b, ["lang", "j"])
        .select("lang", "source", "item", (F.col("value") + rest).alias("value"))
    )
