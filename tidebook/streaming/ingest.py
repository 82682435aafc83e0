"""Snapshot files as a stream: every new file is added to the raw table and to the log once.

The file source finds new files and keeps in its checkpoint which batch holds which file. A batch is loaded by ``foreachBatch`` into
partitions that carry the number of the batch, and its log rows as well; a batch that is run again, after a stop at any
place, has the same files and replaces its own partitions. So nothing is compared with stored rows, equal rows of a file are all
kept, and the counts of the log are those of the table.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import materialized
from ..schema import INGESTION_LOG
from ..sources.snapshots import LABEL, _reader, _relative, bad_files, file_counts, parse_lob, pending_files, read_log

LISTED = "path string, modificationTime timestamp, length long, content binary"


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives and ends with the checkpoint: batch numbers start anew with a new one."""
    path = f"{checkpoint.rstrip('/')}/ingest-id"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException:
        spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.text(path)
        return spark.read.text(path).first()[0]


def _replace(df: DataFrame, path: str, by: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def load_batch(files: DataFrame, source: str, table: str, log_path: str, batch: str, label: str = LABEL) -> None:
    """Load the files ``(filename, path, length)`` of one batch.

    Damaged files are neither loaded nor logged as loaded; they are listed under ``<log>-rejected``. Files that another
    batch or the batch form of the ingestion has logged are left out.
    """
    spark = files.sparkSession
    mark = F.lit(batch).alias("batch")
    logged = read_log(spark, log_path)
    others = logged.filter(F.coalesce(F.col("batch"), F.lit("")) != batch) if "batch" in logged.columns else logged
    pending = materialized(pending_files(files, others, label))
    bad = materialized(bad_files(spark, source, pending))
    good = materialized(pending.join(bad, "filename", "left_anti"))
    paths = [r["path"] for r in good.select("path").collect()]
    if paths:
        rows = _reader(spark, paths, False).select("*", _relative(F.col("_metadata.file_path"), source).alias("_file")).dropna()
        typed = parse_lob(rows)
        _replace(typed.drop("_file").select("*", mark, F.to_date("timestamp").alias("date")), table, ["batch", "date"])
        entries = file_counts(good, rows, good.select("filename"), label)
        _replace(entries.select("*", mark), log_path, ["batch"])
    _replace(bad.select("filename", F.lit(label).alias("type"), mark), f"{log_path}-rejected", ["batch"])


def ingest_stream(
    spark: SparkSession, source: str, table: str, log_path: str, checkpoint: str, label: str = LABEL, max_files: int = 1000,
) -> None:
    """Add all files that have come since the last call, at most ``max_files`` a batch, and stop."""
    run = _run_id(spark, checkpoint)
    files = (
        spark.readStream.schema(LISTED).format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(source)
        .select(_relative(F.col("path"), source).alias("filename"), "path", "length")
    )

    def load(batch: DataFrame, number: int) -> None:
        load_batch(batch, source, table, log_path, f"{run}-{number:09d}", label)

    files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The log of the streamed files, without the batch."""
    return read_log(spark, log_path).select(*INGESTION_LOG.fieldNames())
