"""Source of L2 messages, batch or streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.messages import flatten_messages
from ..schema import L2_MESSAGE


MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def read_l2_messages(spark: SparkSession, path: str, streaming: bool = False, fmt: str = "json", **options) -> DataFrame:
    """Flattened book entries from a folder of message files (``json`` or ``parquet``).

    A stream takes at most ``maxFilesPerTrigger`` (default 1,000) files at a time, so a backlog is worked off in bounded triggers.
    """
    reader = spark.readStream if streaming else spark.read
    options = {"timestampFormat": MICROS, **({"maxFilesPerTrigger": 1000} if streaming else {}), **options}
    return flatten_messages(reader.schema(L2_MESSAGE).format(fmt).options(**options).load(path))
