"""Registered queries of the operators on whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann, divergence, hard_negatives, language_id, license_scan, mixing, near_dedup, quality, sentencepiece_sampling, simhash, topk, toxicity,
)
from .substring_dedup import remove_repeats
from .words import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return remove_repeats(docs, columns=["doc_id"]).drop("kept_text")


ORACLE["op10_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d WHERE len(w) >= 13),
v AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS win FROM p),
f AS (SELECT win, min(doc_id) AS least FROM v GROUP BY win),
g AS (SELECT DISTINCT doc_id, i + j AS pos
      FROM v JOIN f USING (win), (SELECT unnest(generate_series(0, 12)) AS j) WHERE doc_id > least),
a AS (SELECT doc_id, list(pos) AS gone FROM g GROUP BY doc_id),
k AS (SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
             CASE WHEN gone IS NULL THEN w
                  ELSE list_transform(list_filter(generate_series(1, len(w)), lambda x: NOT list_contains(gone, x)),
                                      lambda x: w[x]) END AS kept
      FROM d LEFT JOIN a USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k"""


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op2_near_dedup"] = r"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT a AS node, b AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reach),
c AS (SELECT node, min(reach) AS least FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(least, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id"""


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter("id % 50 = 0"), 5)


SOUND = """vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
ORACLE["op7_exact_topk"] = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE {SOUND}),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score
      FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


@query
def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.sound_vectors(table(spark, sf_dir, "embeddings"))
    return ann.nearest(vectors, vectors.filter("id % 20 = 0"), 20)


ORACLE["op9_nearest"] = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
           WHERE {SOUND} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.v, v.v) AS score
      FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


ORACLE["op6_license_scan"] = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '{license_scan.WORD}') AS w FROM documents),
t(template, label, base, pairs, off, w1, w2) AS (VALUES {license_scan.values_sql()}),
p AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 1)) AS i FROM d WHERE len(w) > 1),
h AS (SELECT doc_id, template, label, base, pairs, off, i - 1 AS i
      FROM (SELECT doc_id, i, w[i] AS w1, w[i + 1] AS w2 FROM p) JOIN t USING (w1, w2)),
v AS (SELECT doc_id, template, label, base, pairs, i - off AS diagonal, bit_or(1::BIGINT << off) AS bits,
             min(i) AS low, max(i) AS high FROM h GROUP BY ALL),
f AS (SELECT *, CASE WHEN base OR diagonal - lag(diagonal) OVER a <= {license_scan.GAP} IS NOT TRUE THEN 1 ELSE 0 END AS fresh
      FROM v WINDOW a AS (PARTITION BY doc_id, template ORDER BY diagonal)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM f),
m AS (SELECT doc_id, template, label, base, pairs, span, bit_count(bit_or(bits)) AS n, min(low) AS start, max(high) + 1 AS stop
      FROM g GROUP BY ALL),
e(reach) AS (VALUES {', '.join(f'({reach})' for reach in license_scan.REACH)}),
o AS (SELECT g.doc_id, g.template, g.span, reach, g.diagonal, bit_count(bit_or(x.bits)) AS n, min(x.low) AS start, max(x.high) + 1 AS stop
      FROM g, e, g x WHERE NOT g.base AND x.doc_id = g.doc_id AND x.template = g.template AND x.span = g.span
        AND x.diagonal BETWEEN g.diagonal AND g.diagonal + reach GROUP BY ALL),
w AS (SELECT doc_id, template, span, max(n) AS best FROM o JOIN (SELECT DISTINCT template, pairs FROM t) USING (template)
      WHERE n >= {license_scan.SHARE} * pairs AND stop - start <= 1.5 * (pairs + 1) GROUP BY ALL),
k AS (SELECT * EXCLUDE (n), CASE WHEN fits THEN n ELSE best END / pairs::DOUBLE AS share
      FROM (SELECT m.*, best, CASE WHEN base THEN n = pairs
              ELSE n >= {license_scan.SHARE} * pairs AND stop - start <= 1.5 * (pairs + 1) END AS fits
            FROM m LEFT JOIN w USING (doc_id, template, span)) WHERE fits OR best IS NOT NULL),
s AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN s USING (doc_id)"""


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(language_id.crc_part(4) == 2, F.lit(False))
    model = language_id.fit(docs.filter(~held_out))
    out = language_id.identify(docs.withColumn("held_out", held_out), model, columns=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(language_id.crc_part(5) == 0, F.lit(False))
    model = quality.fit(docs, labels, ~held_out)
    out = quality.score(docs.withColumn("held_out", held_out), model, columns=["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(language_id.crc_part(3) == 1, F.lit(False))
    model = toxicity.fit(docs, labels, ~held_out)
    out = toxicity.score(docs.withColumn("held_out", held_out), model, columns=["doc_id", "held_out"])
    return out.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentencepiece_sampling.Vocabulary()
    docs = table(spark, sf_dir, "documents")
    pieces = sentencepiece_sampling.encode(docs, vocabulary, columns=["doc_id", "text"])
    back = sentencepiece_sampling.decode(pieces, vocabulary)
    return back.select(
        "doc_id", "n_pieces", F.xxhash64("pieces").alias("pieces_hash"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), columns=["doc_id"])


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLE["op12_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT doc, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             CAST(1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (coalesce(s.total, 0) + l.v) AS HUGEINT) AS p,
             CAST(1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.v) AS HUGEINT) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN s ON s.lang = g.lang AND s.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
a AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(a.value, 0) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o
WHERE part = 'pair' OR rank <= 200"""


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = hard_negatives.whole_vectors(table(spark, sf_dir, "embeddings"), label=label)
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


ORACLE["op13_hard_negatives"] = f"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE label IS NOT NULL AND {SOUND}),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE alike
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             CAST(row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
