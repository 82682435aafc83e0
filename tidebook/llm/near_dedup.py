"""Near-duplicate components by MinHash with tensored banding.

A document's set holds the hashes of its distinct runs of five words (all its words as one run, if
fewer). Two small collections of ``bands`` half-keys, each mixed from ``rows`` minhashes, are made per set;
a table key joins one half-key of either collection, so ``2 * bands * rows`` minhashes serve
``bands ** 2`` tables of ``2 * rows`` minhashes. At the threshold 0.75 the defaults (3 rows, 20 bands) miss a pair
with probability 3.5e-5, at 0.8 with 6e-7.

1. Signatures and set sizes, row by row (numpy on Arrow batches), written once.
2. Rows with equal sets form a class, represented by its least document.
3. Half-keys that occur once cannot meet; only representatives with live half-keys on both sides get table
   keys, so unique documents never reach the tables.
4. Each table's members are linked with its least member first (never all pairs); the pairs are confirmed
   on full sets, and confirmed links are contracted to components.
5. Members of one table that are still in different components are compared as well, and the components are
   contracted again. Left out are pairs already refused, and those that cannot reach the threshold: every document of a
   crowd is compared with one home H, a text from the middle of the crowd, and two sets of one home share at most
   ``min(|x & H|, |y & H|)`` elements inside H (fewer, where they lack different ones), plus those outside H that another
   document of H has. Where a whole table has one home, that refuses loose copies one row each, before pairs are made.
   So every pair of different sets that meets in a table is either confirmed or refused on full sets, or joined through
   others. Each document has one home at most, so what is counted for the bounds is never more than its own set.

Defined results: texts without words have empty sets and link with nothing. A null ``doc_id`` keeps its
row, with null ``component_id`` and ``kept`` false. Rows with equal ``doc_id`` count as linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .words import Hasher, gram_hashes, mix, saved, slices, text_bytes, tidy, word_spans

SHINGLE, PERCENT = 5, 75
#: A least member of more partners than this is the lead of a crowd, unless all are linked with it.
CROWD = 16
#: Words of 64 bits that say what a document lacks of its home.
MASKS = 16
MASK_NAMES = [f"mask{w}" for w in range(MASKS)]


def _lowered(data: np.ndarray) -> np.ndarray:
    fold = np.arange(256, dtype=np.uint8)
    fold[0x41:0x5B] += 0x20
    return fold[data]


def _sets(batch: pa.RecordBatch, hasher: Hasher, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, one row after the other, and the rows' bounds in them."""
    data, offsets = text_bytes(batch.column("text"))
    data = _lowered(data)
    starts, ends, first = word_spans(data, offsets)
    words = hasher.spans(data, starts, ends)
    grams = gram_hashes(words, shingle)
    out, sizes = [], np.zeros(len(offsets), np.int64)
    for r, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b - a >= shingle:
            own = grams[a : b - shingle + 1]
            own = np.unique(own)
        elif b > a:
            own = gram_hashes(words[a:b], b - a)
        else:
            continue
        out.append(own)
        sizes[r + 1] = len(own)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.cumsum(sizes)


def _signatures(shingle: int, rows: int, bands: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rng = Hasher(), np.random.default_rng(seed)
        flips, factors = (rng.integers(0, 1 << 63, 2 * bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))
        for batch in batches:
            for part in slices(batch):
                grams, bounds = _sets(part, hasher, shingle)
                sizes = np.diff(bounds)
                full = np.flatnonzero(sizes)
                prints = np.zeros((2, len(sizes)), np.uint64)
                keys = np.zeros((len(sizes), 2 * bands), np.uint64)
                if len(full):
                    heads = bounds[:-1][full]
                    for i in range(2):
                        prints[i, full] = np.add.reduceat(mix(grams ^ np.uint64(i * 0x5851F42D4C957F2D + 1)), heads)
                    for b in range(2 * bands):
                        own = np.full(len(full), b, np.uint64)
                        for j in range(b * rows, (b + 1) * rows):
                            least = np.minimum.reduceat((grams ^ flips[j]) * factors[j], heads)
                            own = mix(own * np.uint64(0x9E3779B97F4A7C15) + least)
                        keys[full, b] = own
                flat = keys.view(np.int64).ravel()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "n_shingles": sizes,
                    "print1": prints[0].view(np.int64), "print2": prints[1].view(np.int64),
                    "keys": pa.FixedSizeListArray.from_arrays(pa.array(flat), 2 * bands).cast(pa.list_(pa.int64())),
                })

    return tidy(run)


def _full_sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in slices(batch):
                grams, bounds = _sets(part, hasher, shingle)
                grams = pa.array(grams.view(np.int64))
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("doc_id"),
                    "grams": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), grams),
                })

    return tidy(run)


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b, shared, linked`` of all pairs, by their full sets."""
    left, right = sets.select("id", "grams").toDF("a", "_ga"), sets.select("id", "grams").toDF("b", "_gb")
    shared = F.size(F.array_intersect("_ga", "_gb"))
    union = F.size("_ga") + F.size("_gb") - shared
    return saved(
        pairs.join(left, "a").join(right, "b").select("a", "b", shared.alias("shared"), (100 * shared >= percent * union).alias("linked")),
        "compared",
    )


def _homes(tested: DataFrame) -> DataFrame:
    """``id, home``, one row for each document of a crowd. A lead's home is the partner that shares most with it; a
    document gets that of the lead of most partners among its own leads, its partners' and its leads' ones, so a
    crowd has few homes."""
    leads = saved(
        tested.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("linked").alias("all_linked"),
                                F.min(F.struct((-F.col("shared")).alias("less"), "b")).alias("m"))
        .filter(F.col("n") > CROWD).filter(~F.col("all_linked"))
        .select(F.col("a").alias("id"), F.struct("n", "a", F.col("m.b").alias("home")).alias("lead")),
        "leads",
    )
    best, pairs = leads, tested.select("a", "b")
    for known, other in (("a", "b"), ("b", "a"), ("a", "b")):
        met = pairs.join(best.withColumnRenamed("id", known), known).select(F.col(other).alias("id"), "lead")
        best = saved(best.unionByName(met).groupBy("id").agg(F.max("lead").alias("lead")), "best")
    return best.select("id", F.col("lead.home").alias("home"))


def _at_home(tested: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of each document with a home: ``shared`` elements and ``linked`` with it, ``common`` elements outside it that another
    document of this home has, and which of MASKS * 64 hashed places of the home's elements it lacks something at."""
    own, home = sets.select("id", F.col("grams").alias("_g")), sets.select(F.col("id").alias("home"), F.col("grams").alias("_gh"))
    gone = F.array_except("_gh", "_g")
    shared = F.col("home_n") - F.size("_gone")
    met = saved(
        _homes(tested).join(own, "id").join(home, "home")
        .select("id", "home", F.size("_g").alias("n"), F.size("_gh").alias("home_n"), gone.alias("_gone"), F.array_except("_g", "_gh").alias("outside"))
        .select("id", "home", "home_n", shared.alias("shared"), (100 * shared >= percent * (F.col("n") + F.col("home_n") - shared)).alias("linked"),
                *[_mask(F.col("_gone"), w).alias(m) for w, m in enumerate(MASK_NAMES)], "outside"),
        "at-home",
    )
    outside = saved(
        met.select("id", "home", F.explode("outside").alias("gram"))
        .select("id", F.xxhash64("home", "gram").alias("gram")),  # equal hashes can only loosen the bound
        "outside",
    )
    twice = outside.groupBy("gram").agg(F.min("id").alias("id1"), F.max("id").alias("id2")).filter("id1 < id2").select("gram")
    common = outside.join(twice, "gram").groupBy("id").agg(F.count(F.lit(1)).alias("common"))
    return saved(met.drop("outside").join(common, "id", "left").withColumn("common", F.coalesce("common", F.lit(0))), "homes")


def _mask(grams: Column, word: int) -> Column:
    def add(bits: Column, gram: Column) -> Column:
        place = F.pmod(gram, F.lit(MASKS * 64))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
        return F.when(F.floor(place / 64) == word, bits.bitwiseOR(bit)).otherwise(bits)

    return F.aggregate(grams, F.lit(0).cast("long"), add)


def _near_sizes(a: Column, b: Column, percent: int) -> Column:
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rows: int = 3, bands: int = 20, seed: int = 1
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``."""
    signatures = saved(
        docs.select("doc_id", "text").mapInArrow(
            _signatures(shingle, rows, bands, seed),
            "doc_id long, n_shingles long, print1 long, print2 long, keys array<long>"),
        "signatures",
    )
    prints = ["print1", "print2", "n_shingles"]
    known = signatures.filter("n_shingles > 0 and doc_id is not null")
    classes = saved(known.groupBy(*prints).agg(F.min("doc_id").alias("id")), "classes")
    keyed = known.join(classes.withColumnRenamed("id", "doc_id"), ["doc_id", *prints], "left_semi")

    # Half-keys that at least two representatives have, first of one collection, then of the other.
    def live(rows_: DataFrame, half: Column) -> DataFrame:
        each = rows_.select("id", F.explode(half).alias("key"))
        twice = each.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
        return each.join(twice, "key").groupBy("id").agg(F.collect_list("key").alias("half"))

    slim = saved(keyed.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "keys").dropDuplicates(["id"]), "keys")
    first = saved(live(slim, F.slice("keys", 1, bands)), "half")
    second = live(slim.join(first, "id", "left_semi"), F.slice("keys", bands + 1, bands))
    entries = (
        first.withColumnRenamed("half", "half_a").join(second.withColumnRenamed("half", "half_b"), "id")
        .join(slim.select("id", "n"), "id")
        .select("id", "n", F.explode("half_a").alias("ka"), "half_b")
        .select("id", "n", "ka", F.explode("half_b").alias("kb"))
        .select("id", "n", F.xxhash64("ka", "kb").alias("key"))
    )
    entries = saved(entries, "entries")
    met = saved(
        entries.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("id", "n")).alias("lead"))
        .filter("m > 1").select("key", "lead"),
        "tables",
    )
    entries = entries.join(met, "key")
    stars = saved(
        entries.filter(F.col("id") != F.col("lead.id")).filter(_near_sizes(F.col("n"), F.col("lead.n"), percent))
        .select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct(),
        "stars",
    )
    ids = entries.select("id").distinct().withColumnRenamed("id", "doc_id")
    texts = docs.select("doc_id", "text").join(ids, "doc_id", "left_semi")
    sets = saved(
        texts.mapInArrow(_full_sets(shingle), "id long, grams array<long>").dropDuplicates(["id"])
        .withColumn("n", F.size("grams")), "sets")
    tested = _compared(stars, sets, percent)
    homes = _at_home(tested, sets, percent)
    links = tested.filter("linked").select("a", "b").unionByName(
        homes.filter("linked and id <> home").select(F.col("home").alias("a"), F.col("id").alias("b")))
    found = saved(components(links), "components")

    # Tables whose members (their least one, which all were compared with, left aside) are not all in one component yet.
    members = entries.filter(F.col("id") != F.col("lead.id")).select("key", "id", "n")
    placed = (
        members.join(found.withColumnRenamed("node", "id"), "id", "left")
        .join(homes.select("id", "home", "home_n", "shared", "common", *MASK_NAMES), "id", "left")
        .withColumn("component", F.coalesce("component", "id"))
    )
    split = (
        placed.groupBy("key").agg(
            F.min("component").alias("c1"), F.max("component").alias("c2"), F.min("n").alias("least_n"),
            ((F.min("home") == F.max("home")) & (F.count("home") == F.count(F.lit(1)))).alias("one_home"))
        .filter("c1 <> c2").select("key", "least_n", "one_home")
    )
    # Two sets share at most what either shares with a third set, and elements outside it that others have, too.
    partner = F.greatest(F.col("least_n"), F.ceil(F.col("n") * percent / 100))
    reach = F.col("shared") + F.col("common")
    hopeless = F.col("one_home") & ((100 + percent) * reach < percent * (F.col("n") + partner))
    rest = placed.join(split, "key").filter(~F.coalesce(hopeless, F.lit(False)))
    rest = saved(rest.select("key", "id", "n", "component", "home", "home_n", "shared", "common", *MASK_NAMES), "rest")
    names = ("id", "n", "c", "h", "u", "s", "q", *MASK_NAMES)
    one, two = (rest.toDF("key", *[f"{x}{side}" for x in names]) for side in "ab")
    # What either lacks of its home is not shared; hashed places can only hide that, so the bound is safe.
    lost = sum(F.bit_count(F.col(f"{m}a").bitwiseOR(F.col(f"{m}b"))) for m in MASK_NAMES)
    most = F.when(F.col("ha") == F.col("hb"), F.least(F.col("ua") - lost, "sa", "sb") + F.least("qa", "qb"))
    short = (100 + percent) * most < percent * (F.col("na") + F.col("nb"))
    more = (
        one.join(two, "key").filter("ida < idb and ca <> cb")
        .filter(_near_sizes(F.col("na"), F.col("nb"), percent)).filter(~F.coalesce(short, F.lit(False)))
        .select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct()
        .join(tested.select("a", "b"), ["a", "b"], "left_anti")
    )
    more = saved(more, "more")
    if not more.isEmpty():
        late = _compared(more, sets, percent).filter("linked").select("a", "b")
        found = components(links.unionByName(late))
    named = classes.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        *prints, F.coalesce("component", "id").alias("component_id"))
    return (
        signatures.select("doc_id", *prints).join(named, prints, "left")
        .select(
            "doc_id", "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    )


def drop_near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that represent their component, with all their columns; of rows with equal ``doc_id`` and
    text one stays, different texts under one ``doc_id`` all stay, and so do rows without ``doc_id``."""
    found = near_duplicates(docs, **params)
    gone = saved(found.filter("not kept and doc_id is not null").select("doc_id").distinct(), "gone")
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    twice = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("doc_id")
    twice = saved(twice, "twice")
    if twice.isEmpty():
        return left
    once = left.join(twice, "doc_id", "left_anti").select(*docs.columns)
    return once.unionByName(left.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select(*docs.columns))
