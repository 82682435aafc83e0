"""Snapshot files, ingestion log and tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from io import BytesIO

import pandas as pd
import pyarrow.parquet as pq
from pyarrow.lib import ArrowException
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import materialized
from ..schema import INGESTION_LOG, PAIRS, SNAPSHOT_FILE

LABEL = "Raw LOB"
#: A Parquet file without rows has a footer and no pages, so a longer file that gives no rows is damaged.
EMPTY_BYTES = 1 << 20


def write_daily(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append encoded snapshots under one folder per UTC day; nothing is read back or rewritten."""
    day = F.to_date(F.substring("timestamp", 1, 10))
    df.withColumn("date", day).write.partitionBy("date").mode(mode).parquet(path)


def scan_snapshots(spark: SparkSession, path: str | Sequence[str], skip_bad: bool = False) -> DataFrame:
    """Parquet scan without rows that have a NULL; ``skip_bad`` passes over damaged files."""
    return _reader(spark, path, skip_bad).dropna()


def _reader(spark: SparkSession, path: str | Sequence[str], skip_bad: bool) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return (
        spark.read.schema(SNAPSHOT_FILE)
        .option("ignoreCorruptFiles", str(skip_bad).lower())
        .option("recursiveFileLookup", "true")
        .parquet(*paths)
    )


def parse_lob(df: DataFrame) -> DataFrame:
    """Text to timestamp, JSON sides to arrays; text that cannot be read becomes NULL."""
    return df.withColumns({
        "timestamp": F.col("timestamp").try_cast("timestamp"),
        "bids": F.from_json(F.col("bids").cast("string"), PAIRS),
        "asks": F.from_json(F.col("asks").cast("string"), PAIRS),
    })


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(filename, path, length)`` of the Parquet files in a folder, read by the file source itself (which passes over
    files of zero bytes)."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").load(path)
    )
    return files.select(_relative(F.col("path"), path).alias("filename"), "path", "length")


def _relative(file: Column, folder: str) -> Column:
    """Path below the folder: the same file name may occur under several days."""
    return F.substring_index(file, "/" + folder.rstrip("/").rsplit("/", 1)[-1] + "/", -1)


def pending_files(files: DataFrame, log: DataFrame, label: str = LABEL) -> DataFrame:
    """Files whose name is not logged for the label."""
    return files.join(log.filter(F.col("type") == label).select("filename").distinct(), "filename", "left_anti")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The ingestion log; an empty one when it does not exist yet."""
    try:
        return spark.read.schema(INGESTION_LOG).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], INGESTION_LOG)


def file_counts(files: DataFrame, rows: DataFrame, readable: DataFrame, label: str = LABEL) -> DataFrame:
    """Log rows for the readable files, 0 for files without usable rows."""
    counts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows")).withColumnRenamed("_file", "filename")
    return files.join(readable, "filename", "left_semi").join(counts, "filename", "left").select(
        "filename", F.lit(label).alias("type"), F.coalesce("_rows", F.lit(0)).cast("int").alias("record_count")
    )


def _opens(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whether each small file is a Parquet file without rows."""
    for pdf in frames:
        ok = []
        for content in pdf["content"]:
            try:
                ok.append(pq.ParquetFile(BytesIO(content)).metadata.num_rows == 0)
            except (ArrowException, OSError, EOFError):
                ok.append(False)
        yield pd.DataFrame({"filename": pdf["filename"], "ok": ok})


def bad_files(spark: SparkSession, path: str, files: DataFrame | None = None, empty_bytes: int = EMPTY_BYTES) -> DataFrame:
    """``(filename)`` of files that are cut off, damaged inside or no Parquet files.

    Only ``files`` (default: all of the folder) are opened, by Spark's own reader, so any file system that Spark
    reads will do and a file of any length is read in splits and row batches: once for the row counts in the footers (no
    column is read), once for all rows. A file is whole if both agree. Files that gave no row are either empty, which only files up to
    ``empty_bytes`` can be, or damaged. Only file names reach the driver.
    """
    known = materialized((list_files(spark, path) if files is None else files).select("filename", "path", "length"))
    names = [r["path"] for r in known.select("path").collect()]
    if not names:
        return spark.createDataFrame([], "filename string")
    rows = _reader(spark, names, True).withColumn("filename", _relative(F.col("_metadata.file_path"), path))
    promised = rows.groupBy("filename").agg(F.count(F.lit(1)).alias("promised"))
    # The digest makes every column be decoded.
    read = rows.groupBy("filename").agg(
        F.count(F.lit(1)).alias("read"), F.max(F.xxhash64(*SNAPSHOT_FILE.fieldNames())).alias("_digest"))
    counted = materialized(known.join(promised, "filename", "left").join(read, "filename", "left"))
    differ = counted.filter("promised > 0 AND NOT (promised <=> read)").select("filename")
    silent = counted.filter("promised IS NULL")
    small = [r["path"] for r in silent.filter(F.col("length") <= empty_bytes).select("path").collect()]
    bad = differ.unionByName(silent.filter(F.col("length") > empty_bytes).select("filename"))
    if small:
        contents = spark.read.format("binaryFile").load(small).select(_relative(F.col("path"), path).alias("filename"), "content")
        bad = bad.unionByName(contents.mapInPandas(_opens, "filename string, ok boolean").filter(~F.col("ok")).select("filename"))
    return bad


def ingest(spark: SparkSession, source: str, table: str, log_path: str, label: str = LABEL) -> DataFrame:
    """Append all pending day files to the raw table and log them; returns the new log rows.

    Only pending files are opened. Damaged files are neither loaded nor logged, so they are tried again next time, and
    an unreadable part fails the run rather than being passed over. Rows already in the table are left out, so a
    run that stopped between the data and the log does not load rows twice.
    """
    pending = materialized(pending_files(list_files(spark, source), read_log(spark, log_path), label))
    good = materialized(pending.join(bad_files(spark, source, pending), "filename", "left_anti"))
    paths = [r["path"] for r in good.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], INGESTION_LOG)
    rows = _reader(spark, paths, False).select("*", _relative(F.col("_metadata.file_path"), source).alias("_file")).dropna()
    # Counted first: once the log is written, the same files are no longer pending.
    entries = materialized(file_counts(good, rows, good.select("filename"), label))
    append_raw(parse_lob(rows).drop("_file"), table)
    entries.write.mode("append").parquet(log_path)
    return entries


def append_raw(df: DataFrame, table: str) -> None:
    """Append typed snapshots by date, without rows that are already stored.

    Rows count as equal only if all their columns are; so rows without timestamp and different books of one moment
    stay, and a rerun adds nothing. Only the stored rows of the same dates are read.
    """
    spark = df.sparkSession
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256).alias("_row")
    fresh = materialized(df.select("*", F.to_date("timestamp").alias("date"), row).dropDuplicates(["_row"]))
    try:
        stored = spark.read.parquet(table)
    except AnalysisException:
        stored = None
    if stored is not None:
        dates = fresh.select(F.col("date").alias("_d")).distinct()
        known = stored.join(F.broadcast(dates), F.col("date").eqNullSafe(F.col("_d")), "left_semi").select(row)
        fresh = fresh.join(known, "_row", "left_anti")
    fresh.drop("_row").write.partitionBy("date").mode("append").parquet(table)


def load_raw(spark: SparkSession, table: str, cols: Sequence[str] | None = None, where: Column | str | None = None) -> DataFrame:
    """Read a table with the filter and the columns pushed to the scan."""
    df = spark.read.parquet(table)
    df = df.filter(where) if where is not None else df
    return df.select(*cols) if cols else df


def sample_rows(df: DataFrame, n: int = 10_000, seed: int = 0, key: Sequence[str] = ("symbol", "timestamp")) -> DataFrame:
    """Uniform, repeatable sample of ``n`` rows outside the context: the smallest keyed digests.

    Rows are cut by digest to slightly more than ``n`` before the final ordering, so no task sorts
    the table.
    """
    rows = df.filter(~F.col("is_context")) if "is_context" in df.columns else df
    total = rows.count()
    share = min(1.0, (n + 10 * n**0.5 + 50) / max(total, 1))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    marked = rows.withColumn("_d", digest)
    if share < 1.0:
        marked = marked.filter(F.col("_d") < f"{int(share * (1 << 48)):012x}")
    return marked.orderBy("_d", *key).limit(n).drop("_d")


def write_table(df: DataFrame, path: str, mode: str = "append", by: str | None = "trading_hour") -> None:
    """Append, or overwrite only the partitions present in ``df`` (safe to repeat)."""
    writer = df.write.mode(mode)
    if by:
        writer = writer.partitionBy(by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
