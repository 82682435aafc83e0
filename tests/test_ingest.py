"""Ingestion of damaged, repeated and odd files."""

import os

from pyspark.sql import functions as F

from tidebook.sources import snapshots as I
from tidebook.streaming import ingest as SI


def day(spark, path, date, n, first=0):
    rows = [("A", f"{date}T{(first + i) // 60:02d}:{(first + i) % 60:02d}:00+00:00", f"[[{i}.0, 1.0]]", "[]") for i in range(n)]
    spark.createDataFrame(rows, "symbol string, timestamp string, bids string, asks string").coalesce(1).write.parquet(f"{path}/date={date}")


def spoil(path, date):
    """Overwrite the middle of the only part file, and its checksum file."""
    folder = f"{path}/date={date}"
    name = next(x for x in os.listdir(folder) if x.endswith(".parquet"))
    with open(f"{folder}/{name}", "r+b") as f:
        whole = f.read()
        f.seek(4)
        f.write(b"\xff" * (len(whole) // 2))
    if os.path.exists(f"{folder}/.{name}.crc"):
        os.remove(f"{folder}/.{name}.crc")
    return name, whole


def test_damaged_file_is_neither_loaded_nor_logged(spark, tmp_path):
    src, table, log = str(tmp_path / "src"), str(tmp_path / "raw"), str(tmp_path / "log")
    day(spark, src, "2024-01-01", 60)
    day(spark, src, "2024-01-02", 60)
    name, whole = spoil(src, "2024-01-01")
    assert [r.filename for r in I.bad_files(spark, src).collect()] == [f"date=2024-01-01/{name}"]
    assert [r.record_count for r in I.ingest(spark, src, table, log).collect()] == [60]
    assert spark.read.parquet(table).count() == 60
    assert I.ingest(spark, src, table, log).count() == 0
    with open(f"{src}/date=2024-01-01/{name}", "wb") as f:  # delivered again, now whole
        f.write(whole)
    assert [r.record_count for r in I.ingest(spark, src, table, log).collect()] == [60]
    assert spark.read.parquet(table).count() == 120 and I.read_log(spark, log).count() == 2


def test_rerun_before_the_log_adds_nothing(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "raw")
    day(spark, src, "2024-01-01", 30)
    for log in ("log1", "log2"):
        I.ingest(spark, src, table, str(tmp_path / log))
    assert spark.read.parquet(table).count() == 30


def test_append_keeps_odd_rows(spark, tmp_path):
    table = str(tmp_path / "raw")
    rows = [("A", None, "[[1.0, 1.0]]", "[]"), ("A", None, "[[2.0, 1.0]]", "[]"), ("A", "2024-01-01T00:00:00Z", "[[1.0, 1.0]]", "[]"),
            ("A", "2024-01-01T00:00:00Z", "[[3.0, 1.0]]", "[]"), ("A", "2024-01-01T00:00:00Z", "[[3.0, 1.0]]", "[]")]
    df = I.parse_lob(spark.createDataFrame(rows, "symbol string, timestamp string, bids string, asks string"))
    I.append_raw(df, table)
    I.append_raw(df, table)
    stored = spark.read.parquet(table)
    assert stored.count() == 4 and stored.filter(F.col("timestamp").isNull()).count() == 2


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    import pytest

    from tidebook import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": lambda self, key, default=None: default})()

    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_files_of_any_length_are_judged_without_loading_them(spark, tmp_path):
    src = str(tmp_path / "src")
    day(spark, src, "2024-01-01", 20)
    day(spark, src, "2024-01-02", 0)
    for name, size in (("long", 3 << 30), ("short", 40)):
        with open(f"{src}/{name}.parquet", "wb") as f:
            f.write(b"PAR1"[:size])
            f.truncate(size)
    assert sorted(r.filename for r in I.bad_files(spark, src).collect()) == ["long.parquet", "short.parquet"]
    assert I.bad_files(spark, src, I.list_files(spark, src).filter("filename like 'date%'")).count() == 0


def counts(spark, log):
    return sorted((r.filename[:15], r.record_count) for r in SI.stream_log(spark, log).collect())


def test_stream_adds_each_file_once(spark, tmp_path, monkeypatch):
    src, table, log, cp = (str(tmp_path / x) for x in ("src", "raw", "log", "cp"))
    day(spark, src, "2024-01-01", 30)
    day(spark, src, "2024-01-02", 10)
    SI.ingest_stream(spark, src, table, log, cp)
    SI.ingest_stream(spark, src, table, log, cp)
    assert counts(spark, log) == [("date=2024-01-01", 30), ("date=2024-01-02", 10)]
    # Equal rows of one file are all kept; a run that stops between the data and the log is run again.
    twice = spark.read.parquet(f"{src}/date=2024-01-01")
    twice.unionByName(twice).coalesce(1).write.parquet(f"{src}/date=2024-01-03")
    day(spark, src, "2024-01-04", 5)
    name, whole = spoil(src, "2024-01-04")

    def stopped(*args):
        raise RuntimeError("stopped before the log")

    with monkeypatch.context() as m:
        m.setattr(SI, "file_counts", stopped)
        try:
            SI.ingest_stream(spark, src, table, log, cp)
        except Exception as e:
            assert "stopped before the log" in str(e)
    assert spark.read.parquet(table).count() == 100 and len(counts(spark, log)) == 2
    SI.ingest_stream(spark, src, table, log, cp)
    assert counts(spark, log) == [("date=2024-01-01", 30), ("date=2024-01-02", 10), ("date=2024-01-03", 60)]
    assert spark.read.parquet(table).count() == 100
    assert [r.filename for r in spark.read.parquet(f"{log}-rejected").collect()] == [f"date=2024-01-04/{name}"]
    # A new checkpoint starts its numbers anew, and finds the files in the log; the repaired one is loaded.
    with open(f"{src}/date=2024-01-04/{name}", "wb") as f:
        f.write(whole)
    SI.ingest_stream(spark, src, table, log, str(tmp_path / "cp2"), max_files=1)
    assert spark.read.parquet(table).count() == 105 and len(counts(spark, log)) == 4
