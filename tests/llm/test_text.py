"""Classifiers, scans, mixing and pieces: brute force, round trips and held-out accuracy."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidebook.llm import language_id, license_scan, mixing, quality, sentencepiece_sampling, toxicity
from tidebook.llm.queries import REGISTRY
from tidebook.llm.substring_dedup import remove_repeats

BIG = "/root/testdata/sf0.01"


# mixing

def test_targets():
    got = mixing.targets([("b", 100), ("a", 1000), (None, 100), ("c", 0)])
    assert [s for s, _, _ in got] == ["a", "b", "c", None]
    target = {s: t for s, _, t in got}
    # Weights 5, 2, 1, 5: null and c stop at three times their size, the others share what is left 5 to 2.
    assert target == {"a": pytest.approx(900 * 5 / 7), "b": pytest.approx(900 * 2 / 7), "c": 0, None: 300}
    assert mixing.targets([]) == []


@pytest.mark.parametrize("seed", range(12))
def test_fit_counts_is_the_best_subset(seed):
    rng = random.Random(seed)
    sizes = np.array(rng.sample(range(1, 40), 5))
    counts = np.array([rng.randrange(1, 4) for _ in sizes])
    budget = rng.randrange(0, int((sizes * counts).sum()) + 5)
    take = mixing.fit_counts(sizes, counts, budget, np.arange(len(sizes)))
    assert (take >= 0).all() and (take <= counts).all()
    got = int((sizes * take).sum())
    # The equal share is taken first; what is left is fitted exactly.
    whole = int((sizes * counts).sum())
    share = counts * min(budget, whole) // whole
    ways = itertools.product(*[range(s, c + 1) for s, c in zip(share.tolist(), counts.tolist())])
    best = max(t for w in ways if (t := int((sizes * np.array(w)).sum())) <= budget)
    assert got == best


def test_names_that_differ_in_case(odd_docs, vocabulary):
    """Columns that have a result's name in another case are replaced, as those of the same case are."""
    added = {"Score": "score", "Size": "size", "N_Words": "n_words", "COPIES": "copies", "Pieces": "kept", "Decoded": "mark"}
    docs = odd_docs.withColumnsRenamed({own: name for name, own in added.items()})
    pieces = sentencepiece_sampling.decode(sentencepiece_sampling.encode(docs, vocabulary), vocabulary)
    results = [
        (mixing.mix_sources(docs), ["size", "copies"]), (language_id.identify(docs, None), ["score"]),
        (quality.score(docs, None), ["score"]), (remove_repeats(docs), ["n_words"]), (pieces, ["pieces", "decoded"]),
    ]
    for out, names in results:
        assert out.select(*names).count() == odd_docs.count()
        assert all(n in out.columns for n in names) and len({c.lower() for c in out.columns}) == len(out.columns)


def test_mix_of_odd_rows(odd_docs, no_docs):
    out = mixing.mix_sources(odd_docs)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(r.taken == r.size * r.copies <= 3 * r.size for r in rows)
    assert {r.size for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.repeated(out, ["doc_id"]).count() == sum(r.copies for r in rows)
    assert mixing.mix_sources(no_docs).count() == 0


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    out = mixing.mix_sources(docs).groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("want"), F.max("copies").alias("c"))
    assert all(abs(r.t - r.want) <= max(2, 0.02 * r.want) and r.c <= 3 for r in out.collect())
    again = mixing.mix_sources(docs.repartition(5)).select("doc_id", "taken")
    assert again.exceptAll(mixing.mix_sources(docs).select("doc_id", "taken")).count() == 0


# license scan

def test_license_scan(spark):
    texts = {
        1: "Licensed under CC BY-NC 4.0. All rights reserved; ALL RIGHTS RESERVED",
        2: "GNU General Public License", 3: "general public the license", 4: None, 5: "cc\nby cc by",
        6: "Licensed under (the) Apache License, as Version 2.0", 7: "licensed under the something else entirely here",
    }
    rows = [(i, t, "x") for i, t in texts.items()] + [(5, "cc\nby cc by", "x"), (None, "cc by", "x")]
    out = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, label string"))
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in out.collect()), key=str)
    want = [
        (1, 13, 3, 2, 10, "cc-by,reserved", "cc-by,cc-by-nc,reserved"), (2, 4, 1, 1, 1, "gpl", "gpl"), (3, 4, 0, None, None, "", ""),
        (4, 0, 0, None, None, "", ""), (5, 4, 2, 0, 2, "cc-by", "cc-by"), (5, 4, 2, 0, 2, "cc-by", "cc-by"),
        (6, 9, 0, None, None, "", "apache-2.0"), (7, 7, 0, None, None, "", ""), (None, 2, 1, 0, 0, "cc-by", "cc-by"),
    ]
    assert got == sorted(want, key=str)
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_license_scan_of_repeated_notices(spark):
    """Repeated beginnings and repeated notices chain into spans that are too long as a whole."""
    notice, start = "licensed under the apache license version 2 0", "licensed under the "
    texts = {1: start * 3 + notice, 2: f"{notice} {notice} {notice}", 3: start * 9 + "gpl", 4: notice, 5: start * 5 + "apache license as version 2 0"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(docs).collect()}
    assert got == {1: ("apache-2.0", 1.0), 2: ("apache-2.0", 1.0), 3: ("", 0.0), 4: ("apache-2.0", 1.0), 5: ("apache-2.0", 6 / 7)}
    first = {r.doc_id: (r.start, r.stop) for r in license_scan.spans(docs).filter("template is not null").collect()}
    assert first[1] == (9, 16) and first[4] == (0, 7)


def test_license_scan_of_odd_rows(odd_docs):
    assert license_scan.scan(odd_docs).count() == odd_docs.count()


# pieces

@pytest.fixture(scope="module")
def vocabulary():
    return sentencepiece_sampling.Vocabulary()


def test_pieces_round_trip(odd_docs, no_docs, vocabulary):
    encoded = sentencepiece_sampling.encode(odd_docs, vocabulary)
    rows = sentencepiece_sampling.decode(encoded, vocabulary).collect()
    assert all(r.decoded == r.text for r in rows) and len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[2].pieces is None and by[3].pieces == [] and by[9].n_pieces == len(by[9].pieces) > 0
    again = sentencepiece_sampling.encode(odd_docs.repartition(7), vocabulary).select("doc_id", "pieces")
    assert again.exceptAll(encoded.select("doc_id", "pieces")).count() == 0
    assert sentencepiece_sampling.decode(sentencepiece_sampling.encode(no_docs, vocabulary), vocabulary).count() == 0


def test_pieces_follow_the_lattice(vocabulary):
    """Sample frequencies of one short text against all its segmentations."""
    log = dict(zip(vocabulary.plain, vocabulary.logs.tolist()))
    surface = {vocabulary.surface[i]: i for i in vocabulary.plain}
    text = b" then"

    def ways(rest):
        if not rest:
            return [()]
        return [(surface[rest[:n]], *w) for n in range(1, len(rest) + 1) if rest[:n] in surface for w in ways(rest[n:])]

    weight = {w: np.exp(sum(log[i] for i in w)) for w in ways(text)}
    total, n = sum(weight.values()), 4000
    data, offsets = np.frombuffer(b"then" * n, np.uint8), np.arange(n + 1) * 4
    ids, bounds = sentencepiece_sampling.Sampler(vocabulary, 3).encode(data, offsets, np.arange(n))
    counts = {}
    for a, b in zip(bounds[:-1], bounds[1:]):
        counts[tuple(ids[a:b].tolist())] = counts.get(tuple(ids[a:b].tolist()), 0) + 1
    assert set(counts) <= set(weight)
    for w, x in weight.items():
        p = x / total
        assert abs(counts.get(w, 0) - n * p) <= 5 * np.sqrt(n * p * (1 - p)) + 2


def test_long_unit(vocabulary):
    data = np.frombuffer(("ab" * 20_000).encode(), np.uint8)
    ids, bounds = sentencepiece_sampling.Sampler(vocabulary, 1).encode(data, np.array([0, len(data)]), np.array([1]))
    out, _ = sentencepiece_sampling.Decoder(vocabulary).decode(ids, bounds)
    assert (out == data).all()


# classifiers

def test_language_of_odd_rows(odd_docs, no_docs):
    model = language_id.fit(odd_docs)
    rows = language_id.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4)} == {"und"}
    assert {r.lang_pred for r in rows if r.doc_id == 10} == {"ja"}
    assert language_id.fit(no_docs) is None and language_id.identify(no_docs, model).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd_docs, None).collect()} == {"und"}


def test_kmeans_separates():
    rng = np.random.default_rng(0)
    x = np.concatenate([np.eye(6)[[i] * 30] + 0.05 * rng.random((30, 6)) for i in range(3)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    _, own = language_id.spherical_kmeans(x.astype(np.float32), 3, 1)
    assert [len({*own[i * 30 : i * 30 + 30].tolist()}) for i in range(3)] == [1, 1, 1] and len({*own.tolist()}) == 3


def test_language_held_out(spark):
    got = REGISTRY["op5_language_id"](spark, BIG).join(spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right > 0.98 and n > 200


def test_quality_of_odd_rows(odd_docs, no_docs, labels):
    model = quality.fit(odd_docs, labels)
    rows = quality.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality.fit(no_docs, labels) is None and quality.score(no_docs, None).count() == 0
    assert {r.score for r in quality.score(odd_docs, None).collect()} == {0.5}


def test_quality_views_share_nothing():
    def views(texts, source, lang, n):
        return quality.Views()(pa.RecordBatch.from_pydict({
            "text": pa.array(texts, pa.large_string()), "source": pa.array(source, pa.string()),
            "lang": pa.array(lang, pa.string()), "n_chars": pa.array(n, pa.int64())}))

    one = views(["Some text.\nMore of it!", None, ""], ["a", None, "b"], ["en", "de", None], [22, None, 0])
    text = views(["1 2 3 !!", "Words", "x " * 5000], ["a", None, "b"], ["en", "de", None], [22, None, 0])
    columns = views(["Some text.\nMore of it!", None, ""], ["c", "c", "c"], [None, "en", "fr"], [1 << 60, -1, 5])
    assert (one[1] == text[1]).all() and (one[0] == columns[0]).all()
    assert (one[0] != text[0]).any(axis=1).all() and (one[1] != columns[1]).any(axis=1).all()
    assert all(np.isfinite(x).all() for pair in (one, text, columns) for x in pair)


@pytest.mark.parametrize("alike", [True, False])
def test_logistic_is_the_best_by_its_slope(alike):
    rng = np.random.default_rng(3)
    x = np.column_stack([np.ones(300), rng.normal(size=(300, 4))])
    y = (x @ [-1, 2, 0, -1, 0.5] + rng.normal(size=300) > 0).astype(float)
    w = quality.logistic(x, y, alike)
    weight = np.where(y > 0.5, 0.5 / y.mean(), 0.5 / (1 - y.mean())) if alike else np.ones(300)

    def loss(v):
        z = x @ v
        return (weight * (np.logaddexp(0, z) - y * z)).sum() + quality.RIDGE / 2 * (v @ v)

    assert all(loss(w) < loss(w + d * step) for step in np.eye(5) for d in (-1e-2, 1e-2))


def test_cotraining_equals_a_plain_restatement():
    """Rounds written out with sets and lists: who labels what, then calibration and combination."""
    rng = np.random.default_rng(6)
    truth = (rng.random(900) < 0.6).astype(int)
    both = tuple(np.column_stack([np.ones(900), rng.normal(size=(900, 6)) + 0.9 * (truth * 2 - 1)[:, None] * rng.random(6)]) for _ in range(2))
    y = np.where(rng.random(900) < 0.1, truth, -1)
    model = quality.cotrain(both, y)

    known = [i for i in range(900) if y[i] >= 0]
    kept = known[3::4]
    seen = [i for i in known if i not in set(kept)]
    unknown = [i for i in range(900) if y[i] < 0]
    learned = [{i: float(y[i]) for i in seen} for _ in range(2)]
    pace = {1: round(len(unknown) * quality.SHARE * np.mean(y[seen])), 0: round(len(unknown) * quality.SHARE * (1 - np.mean(y[seen])))}
    handed = 0
    for turn in range(quality.ROUNDS + 1):
        fits, logits = [], []
        for x, own in zip(both, learned):
            rows = sorted(own)
            w = quality.logistic(x[rows], np.array([own[i] for i in rows]))
            a, b = quality.logistic(np.array([[1.0, x[i] @ w] for i in kept]), y[kept].astype(float), False)
            fits.append(w)
            logits.append(a + max(b, 0) * (x @ w))
        if turn == quality.ROUNDS:
            break
        for me in (0, 1):
            free = [i for i in unknown if i not in learned[1 - me]]
            chance = {i: 1 / (1 + np.exp(-logits[me][i])) for i in free}
            for mark in (1, 0):
                best = sorted(free, key=lambda i: -chance[i] if mark else chance[i])[: max(1, pace[mark])]
                sure = [i for i in best if (chance[i] if mark else 1 - chance[i]) >= quality.SURE]
                learned[1 - me].update((i, float(mark)) for i in sure)
                handed += len(sure)
    last = quality.logistic(np.array([[1.0, logits[0][i], logits[1][i]] for i in kept]), y[kept].astype(float), False)
    want = 1 / (1 + np.exp(-(last[0] + last[1] * logits[0] + last[2] * logits[1])))
    assert handed > 100
    assert np.abs(model.scores(both)[2] - want).max() < 1e-9
    assert ((model.scores(both)[2] > 0.5) == truth).mean() > 0.85


def test_quality_held_out(spark):
    got = REGISTRY["op8_quality"](spark, BIG).join(spark.read.parquet(f"{BIG}/labels.parquet"), "doc_id")
    assert got.filter("held_out").agg(F.avg((F.col("quality") == F.col("predicted")).cast("int"))).first()[0] > 0.95


def test_toxicity_of_odd_rows(odd_docs, no_docs, labels):
    model = toxicity.fit(odd_docs, labels)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.fit(no_docs, labels) is None and toxicity.score(no_docs, model).count() == 0
    assert {r.score for r in toxicity.score(odd_docs, None).collect()} == {0.5}


def test_toxicity_separates():
    rng = random.Random(2)
    plain = ["alpha", "river", "stone", "garden", "window", "paper", "silver", "morning", "table", "letter"]
    texts, marks = [], []
    for i in range(600):
        words = ["".join(rng.choice("aeiou" if j % 2 else "rstlnm") for j in range(rng.randrange(3, 9))) for _ in range(60)] + plain
        if i % 3 == 0:
            words += rng.choices(["vilefool", "grubhead", "muckwit"], k=3)
        rng.shuffle(words)
        texts.append(" ".join(words))
        marks.append(int(i % 3 == 0))
    model = toxicity.train(texts[:450], np.array(marks[:450]))
    batch = pa.RecordBatch.from_pydict({"text": texts[450:]})
    score = pa.Table.from_batches(list(toxicity._score(model, [])(iter([batch])))).column("score").to_numpy()
    assert ((score >= 0.7) == (np.array(marks[450:]) == 1)).mean() > 0.98


@pytest.mark.parametrize("sf_dir,least,false", [("/root/testdata/sf0.01", 14, 1), ("/root/testdata/sf0.1", 75, 12)])
def test_toxicity_of_rows_that_taught_nothing(spark, sf_dir, least, false):
    from tidebook.llm.queries import REGISTRY

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = REGISTRY["op1_toxicity"](spark, sf_dir).filter("held_out").join(labels, "doc_id").filter("toxic is not null").collect()
    assert all((r.predicted == 1) == (r.score >= 0.7) for r in rows)
    assert sum(r.predicted for r in rows if r.toxic == 1) >= least
    assert sum(r.predicted for r in rows if r.toxic == 0) <= false


def test_toxicity_of_repeated_ids(spark, labels):
    rows = [(i % 10 + 1, f"text {i} of many") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Score", F.lit("clash"))
    out = toxicity.score(docs, toxicity.fit(docs, labels))
    assert out.count() == 30 and out.columns == ["doc_id", "text", "score"]


# pipeline

def test_pipeline(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    out = corpus_pipeline.run(spark, BIG)
    n, whole = out.agg(F.count("*"), F.min("lossless")).first()
    assert 0 < n and whole
    assert out.join(docs, "doc_id", "left_anti").count() == 0 and [n for n, _ in corpus_pipeline.STAGES][1] == "near duplicates"


def test_pipeline_of_odd_rows(odd_docs, no_docs, spark, tmp_path, labels):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (odd_docs, no_docs):
        kept = rows.select(*corpus_pipeline.COLUMNS)
        for _, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, str(tmp_path))
            assert kept.count() <= 3 * odd_docs.count()
