import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, start=0, stem="w"):
    return " ".join(f"{stem}{i}" for i in range(start, start + n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and columns with clashing names."""
    rows = [
        (1, "The plain text of a first document, long enough to be a document.", "en", "a", 64),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n ", "de", "b", 4),
        (5, words(60_000), "en", "b", None),
        (6, words(40, 7), None, "b", 200),
        (7, words(40, 7), "en", None, 200),
        (7, words(40, 7), "en", None, 200),
        (None, words(40, 7), "fr", "c", 200),
        (8, "x" * 30_000, "en", "c", 30_000),
        (9, "two words", "en", "a", 9),
        (10, "日本語の文 ▁ naïve\r\n\ttab  spaces 😀", "ja", "a", 30),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "size", "key", "doc", "mark", "n", "id", "rank", "label", "copies", "kept", "component_id", "n_words"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 11)] + [(1, None, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
