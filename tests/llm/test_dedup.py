"""Near-duplicate and substring removal against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebook.llm import near_dedup, substring_dedup
from tidebook.llm.graph import components
from tidebook.llm.near_dedup import drop_near_duplicates, near_duplicates
from tidebook.llm.substring_dedup import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
                links.append((a, b))
    return roots(ids, links), sets


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 150)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for a, b in links for x in (a, b) if a != b}
    assert got == roots(nodes, [(a, b) for a, b in links if a != b])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def crowd(n, length=120):
    """Copies of one text with few to many changed words: some link, some only nearly do."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(length)]
    texts = {}
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(length)] = f"c{rng.randrange(10**6)}"
        texts[i * 3] = " ".join(own)
    return texts


def test_near_duplicates_equal_brute_force(spark):
    texts = crowd(90)
    texts.update({1: texts[0], 4: texts[0].upper(), 2: "", 5: None, 7: "one", 8: "ONE", 10: "one two", 11: "alone here"})
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want, sets = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i in texts}
    kept = {r.doc_id for r in drop_near_duplicates(df).collect()}
    assert kept == {i for i in texts if want[i] == i}


def test_crowds_are_counted_once_per_document(spark, monkeypatch):
    """What is counted for the bounds of a crowd with many leads stays below the documents' own sets."""
    rows, write = [], near_dedup.saved

    def counted(df, name):
        out = write(df, name)
        if name == "outside":
            rows.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "saved", counted)
    rng = random.Random(6)
    texts = {}
    for i in range(300):
        own = [f"b{j}" for j in range(120)]
        for _ in range(rng.randrange(0, 14)):
            own[rng.randrange(120)] = f"c{rng.randrange(10**6)}"
        texts[i * 3] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want, sets = brute_components(texts)
    assert {r.doc_id: r.component_id for r in near_duplicates(df).collect()} == want
    assert 0 < sum(rows) <= sum(map(len, sets.values()))


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got}
    assert by[None].component_id is None and not by[None].kept and by[None].n_shingles == 36
    assert by[2].n_shingles == by[3].n_shingles == by[4].n_shingles == 0 and by[3].component_id == 3
    assert by[7].component_id == 6 and not by[7].kept and by[6].kept
    kept = drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("doc_id = 7").count() == 0
    assert kept.filter("doc_id is null").count() == 1
    assert near_duplicates(no_docs).count() == 0 and drop_near_duplicates(no_docs).count() == 0


def test_different_texts_under_one_number_stay(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (1, " ".join(words)), (1, "another text under the same number"), (1, None), (2, " ".join(words)), (3, "alone")]
    kept = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted({rows[0], rows[2], rows[3], rows[5]}, key=str)


def brute_repeats(rows, k=13):
    """By (number, text): words, removed words and digest; null numbers are the largest."""
    key = lambda i: (i is None, i)
    first, parts = {}, [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in parts:
        for j in range(len(w) - k + 1):
            win = tuple(w[j : j + k])
            first[win] = min(first.get(win, key(i)), key(i))
    out = []
    for i, w in parts:
        gone = set()
        for j in range(len(w) - k + 1):
            if first[tuple(w[j : j + k])] < key(i):
                gone.update(range(j, j + k))
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


def compare_repeats(df, **params):
    got = remove_repeats(df, **params).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute_repeats(
        [(r.doc_id, r.text) for r in df.collect()])
    return got


@pytest.mark.parametrize("hot_from", [0, 5, 10**9])
def test_repeats_equal_brute_force(spark, odd_docs, hot_from):
    rng = random.Random(1)
    passage, short = " ".join(f"p{i}" for i in range(30)), " ".join(f"s{i}" for i in range(12))
    rows = [(i, " ".join([*(f"r{rng.randrange(40)}" for _ in range(30)), passage if i % 3 else short, f"end{i}"]),) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))
    got = compare_repeats(df, hot_from=hot_from)
    assert sum(r.n_removed for r in got) > 1000


def test_buckets_beyond_the_classes():
    minimisers = np.random.default_rng(1).integers(0, 1 << 63, 20000, dtype=np.uint64)
    kind = substring_dedup._class(minimisers, 64)
    few, many = (substring_dedup._bucket(minimisers, 64, n) for n in (16, 1000))
    assert (few == kind % 16).all() and (many % 64 == kind).all()
    assert 1000 <= len(set(many.tolist())) <= 1024 and np.bincount(many).max() < 60
    assert (substring_dedup._bucket(minimisers, 64, 1000) == many).all()


def test_repeats_in_more_buckets_than_classes(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BUCKET", 1)
    rng = random.Random(4)
    passages = [" ".join(f"p{j}x{i}" for i in range(20)) for j in range(40)]
    rows = [(i, " ".join([passages[i % 40], *(f"r{rng.randrange(400)}" for _ in range(40)), passages[rng.randrange(40)]])) for i in range(200)]
    compare_repeats(spark.createDataFrame(rows, "doc_id long, text string"))


def test_rows_without_number_keep_their_own_ranges(spark):
    """Many texts without ``doc_id``: none may lose what only another one repeats."""
    passage = " ".join(f"p{i}" for i in range(20))
    docs = spark.range(100_000).selectExpr(
        "cast(null as long) as doc_id",
        f"case when id % 1000 = 0 then concat('u', id, ' {passage} v', id) else concat_ws(' ', transform(sequence(0, 24), i -> concat(id, 'w', i))) end as text")
    first = spark.createDataFrame([(1, passage)], "doc_id long, text string")
    out = remove_repeats(docs.unionByName(first)).filter("n_removed > 0")
    got = out.select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert len(got) == 100 and all((r.doc_id, r.n_words, r.n_removed) == (None, 22, 20) for r in got)
    assert {r.kept_text for r in got} == {f"u{i} v{i}" for i in range(0, 100_000, 1000)}


def test_repeats_keep_columns(odd_docs, no_docs):
    out = remove_repeats(odd_docs)
    assert [c for c in odd_docs.columns if c != "n_words"] + ["n_words", "n_removed", "kept_text", "kept_sha256"] == out.columns
    assert out.count() == odd_docs.count() and out.filter("doc = 'clash' and mark = 'clash'").count() == out.count()
    assert remove_repeats(no_docs).count() == 0


def test_repeats_on_given_documents(docs):
    compare_repeats(docs.select("doc_id", F.col("text")))
