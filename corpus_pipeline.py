"""Corpus pipeline: stages of (name, function), each applied to what its predecessor kept.

Each function takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import mixing, near_dedup, quality, sentencepiece_sampling
from tidebook.llm.substring_dedup import remove_repeats
from tidebook.llm.words import saved, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents below this chance of being good are rejected.
LEAST_QUALITY = 0.5


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Co-trained quality classifier; documents that it rejects go."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, columns=COLUMNS).filter(F.col("score") >= LEAST_QUALITY).select(*COLUMNS)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least document of each near-duplicate component stays."""
    return near_dedup.drop_near_duplicates(docs.select(*COLUMNS))


def _substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; documents that lose nothing keep their text as it is, and documents that
    lose every word go."""
    out = remove_repeats(docs, columns=COLUMNS)
    less = F.col("n_removed") > 0
    return (
        out.filter(~less | (F.col("n_removed") < F.col("n_words")))
        .withColumn("text", F.when(less, F.col("kept_text")).otherwise(F.col("text")))
        .withColumn("n_chars", F.when(less, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*COLUMNS)
    )


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.repeated(mixing.mix_sources(docs, columns=COLUMNS), COLUMNS)


def _pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled SentencePiece ids, and whether they decode to the text."""
    vocabulary = sentencepiece_sampling.Vocabulary()
    out = sentencepiece_sampling.decode(sentencepiece_sampling.encode(docs, vocabulary, columns=COLUMNS), vocabulary)
    return out.withColumn("lossless", F.col("decoded").eqNullSafe(F.col("text"))).drop("decoded")


STAGES = [
    ("quality", _quality),
    ("near duplicates", _near_dedup),
    ("substring dedup", _substring_dedup),
    ("mixing", _mix),
    ("sentencepiece", _pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, name.replace(" ", "-"))
    return docs
