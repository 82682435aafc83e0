"""Order-book and trade inputs derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import returns as R
from ..operators.ordering import materialized, positions, spread, tasks_for
from ..session import scratch_path
from ..sources.messages import MICROS

BANDS = (2, 3, 5, 0)
FWD = (2, 3, 5, 10)
PAST = (1, 2, 5, 10)
STRIDES = (2, 5, 10)
LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.lit(1000.0) + (F.col("event_id") % 97) * 0.5 + F.col("value") * 0.01
    return events(spark, sf_dir).select(
        F.concat(F.lit("S"), F.col("user_id") % 3).alias("symbol"),
        F.col("ts").alias("timestamp"), "event_id", price.alias("last_traded_price"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten events make one snapshot; even events are bids, odd ones asks. Levels stand in the events' order, so every run gives the same rows."""
    sid = F.expr("event_id div 10")
    base = F.lit(1000.0) + (sid % 97) * 0.5
    off = F.col("value") * 0.01
    is_bid = F.col("event_id") % 2 == 0
    volume = (F.lit(1) + F.col("user_id") % 50).cast("double")
    pair = F.array(F.when(is_bid, base - 0.5 - off).otherwise(base + 0.5 + off), volume)
    level = F.struct("event_id", pair.alias("pair"))
    return (
        events(spark, sf_dir)
        .groupBy(sid.alias("sid"))
        .agg(
            F.max("ts").alias("timestamp"),
            *[F.transform(F.sort_array(F.collect_list(F.when(own, level))), lambda e: e["pair"]).alias(side)
              for side, own in (("bids", is_bid), ("asks", ~is_bid))],
        )
        .select(F.concat(F.lit("S"), F.col("sid") % 2).alias("symbol"), "timestamp", "bids", "asks")
    )


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened L2 messages: every fiftieth group of ten events is one ``partial`` message."""
    block = F.expr("event_id div 10")
    partial = block % 50 == 0
    first = F.min("ts").alias("first_ts")
    ev = events(spark, sf_dir).withColumn("_b", block)
    starts = ev.filter(partial).groupBy("_b").agg(first)
    kind = F.col("event_type")
    action = (
        F.when(partial, "partial").when(kind.isin("signup", "view"), "insert")
        .when(kind.isin("click", "error"), "update").otherwise("delete")
    )
    return ev.join(starts, "_b", "left").select(
        F.lit("X").alias("symbol"),
        F.when(partial, block * 10).otherwise(F.col("event_id")).alias("seq"),
        F.when(partial, F.col("event_id") - block * 10).otherwise(0).cast("int").alias("pos"),
        F.when(partial, F.col("first_ts")).otherwise(F.col("ts")).alias("ts"),
        action.alias("action"),
        F.col("user_id").alias("id"),
        (F.lit(1000.0) + (F.col("event_id") % 40) * 0.5).alias("price"),
        F.col("value").alias("size"),
        F.when(F.col("user_id") % 2 == 0, "Buy").otherwise("Sell").alias("side"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages unflattened, with a message of another table for every symbol."""
    entry = F.struct("pos", "id", "price", "size", "side")
    data = F.transform(
        F.sort_array(F.collect_list(entry)), lambda e: F.struct(e.id, e.price, e.size.alias("size"), e.side)
    )
    book = entries(spark, sf_dir).groupBy("symbol", "seq", "ts", "action").agg(data.alias("data"))
    book = book.select(F.lit("orderBookL2").alias("table"), "symbol", "seq", "ts", "action", "data")
    other = book.filter("action = 'partial'").withColumn("table", F.lit("trade"))
    return book.unionByName(other)


def message_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "messages")
    messages(spark, sf_dir).write.option("timestampFormat", MICROS).json(path)
    return path


def delayed_files(spark: SparkSession, sf_dir: str, files: int = 5, delay: int = 40) -> str:
    """The messages in files of arrival order; a seventh of them arrives ``delay`` message numbers later."""
    path = scratch_path(spark, "delayed")
    rows = materialized(messages(spark, sf_dir))
    share = events(spark, sf_dir).count() // files + 1
    arrival = F.col("seq") + F.when(F.col("seq") % 7 == 0, delay).otherwise(0)
    # One after the other, as files are read by their time. Message numbers may have gaps, so the files are those that occur.
    found = rows.select(F.floor(arrival / share).alias("k")).filter("k IS NOT NULL").distinct().orderBy("k").collect()
    for k in [r.k for r in found]:
        own = rows.filter(F.floor(arrival / share) == k)
        own.coalesce(1).write.mode("append").option("timestampFormat", MICROS).json(path)
    return path


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four numeric columns as a feature table with a dense row number."""
    columns = list(dict.fromkeys([*LINE_ORDER, *LINE_FEATURES]))
    items = table(spark, sf_dir, "lineitem").select(*columns)
    keyed = items.withColumn("_all", F.lit(0)).withColumn("_block", F.expr("l_orderkey div 50000")).repartition(
        tasks_for(spark, items.count()), "_all", "_block")
    return materialized(positions(keyed, ["_all"], list(LINE_ORDER), "_block").select("idx", *LINE_FEATURES))


def line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four columns alone, over all cores."""
    return spread(table(spark, sf_dir, "lineitem").select(*LINE_FEATURES))


def line_long(spark: SparkSession, sf_dir: str, name: str = "series") -> DataFrame:
    return line_table(spark, sf_dir).unpivot([], list(LINE_FEATURES), name, "value")


def numbered_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = R.number_series(trades(spark, sf_dir), ["symbol"], ["timestamp", "event_id"])
    return R.series_fwd_logret(numbered, FWD)


def return_series(spark: SparkSession, sf_dir: str, strided: bool = True) -> DataFrame:
    """``(series, idx, value)`` of the strided forward returns, written once per query."""
    cols = [f"fwd_logret_{n}" for n in FWD]
    long = R.stride_sample(numbered_returns(spark, sf_dir), cols, strided=strided)
    wanted = [f"fwd_logret_{n}" for n in STRIDES]
    return R.as_series(long.filter(F.col("column").isin(wanted))).transform(materialized)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Put a small raw file on the file system the session uses (a damaged day file)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()
