"""L2 messages to book intervals and periodic snapshots, as batch jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .book import book_sides
from .ordering import FAN, carried, in_blocks, materialized, small_side

KEYS = ["symbol", "id"]


def flatten_messages(messages: DataFrame) -> DataFrame:
    """Keep the order-book table; one row per entry with its place ``pos`` in the message.

    A ``partial`` without entries still clears the book, so it stays as one row without ``id``.
    """
    rows = messages.filter(F.col("table") == "orderBookL2").select(
        "symbol", "seq", "ts", "action", F.posexplode_outer("data").alias("pos", "e")
    )
    return rows.filter(F.col("pos").isNotNull() | (F.col("action") == "partial")).select(
        "symbol", "seq", F.coalesce("pos", F.lit(0)).alias("pos"), "ts", "action", "e.id", "e.price", "e.size", "e.side")


def book_intervals(entries: DataFrame, block: int = 10_000, fan: int = FAN) -> DataFrame:
    """``(symbol, id, price, size, side, valid_from, valid_to)``: when each level had which size.

    ``partial`` clears the book and loads; ``insert`` sets a level; ``update`` changes the size of a
    live level; ``delete`` removes it. An open end is NULL. The feed is read once and cut into blocks of ``block``
    message numbers by one exchange. What a block settles by itself is written; the last clear and the last opening
    entry go forward, the next clear and the next entry of a level backward, over blocks and ranges of ``fan``
    blocks. So a busy symbol or level is spread over many tasks and no task holds more than a block or a range of it.
    """
    by, order = "_block", ["seq", "pos"]
    action, moment = F.col("action"), F.struct("seq", "ts")
    clears = (action == "partial") & (F.col("pos") == 0)
    # The clear before an entry and the one after it; an opener is void if a clear stands between it and the entry.
    began, ends = {"_began": F.when(clears, F.col("seq"))}, {"_ends": F.when(clears, moment)}
    opener = {"_open": F.when(action != "update", F.struct((action != "delete").alias("live"), "seq", "price", "side"))}
    follows = {"_next": moment}

    rows = entries.withColumn(by, F.floor(F.col("seq") / block)).repartition("symbol", by)
    rows = in_blocks(rows, ["symbol", by], order, lasts=began, nexts=ends)
    rows = materialized(in_blocks(rows, ["symbol", by, "id"], order, lasts=opener, nexts=follows))
    levels = rows.filter(F.col("id").isNotNull())  # empty partials only clear
    by_symbol = small_side(carried(rows, ["symbol"], order, by, lasts=began, nexts=ends, fan=fan).withColumnsRenamed(
        {"_began": "_began_before", "_ends": "_ends_after"}))
    by_level = carried(levels, KEYS, order, by, lasts=opener, nexts=follows, fan=fan).withColumnsRenamed(
        {"_open": "_open_before", "_next": "_next_after"})
    lines = levels.join(by_symbol, ["symbol", by]).join(by_level, [*KEYS, by]).select(
        "symbol", "id", "size", "ts",
        F.coalesce("_began", "_began_before").alias("began"), F.coalesce("_ends", "_ends_after").alias("ends"),
        F.coalesce("_open", "_open_before").alias("open"), F.coalesce("_next", "_next_after").alias("next"),
    )
    live = F.col("open.live") & (F.col("began").isNull() | (F.col("open.seq") >= F.col("began")))
    return lines.filter(live).select(
        "symbol", "id", F.col("open.price").alias("price"), "size", F.col("open.side").alias("side"),
        F.col("ts").alias("valid_from"), F.least("next", "ends")["ts"].alias("valid_to"),
    )


def book_at_end(intervals: DataFrame) -> DataFrame:
    """The book after the last message."""
    return intervals.filter(F.col("valid_to").isNull()).drop("valid_from", "valid_to")


def sample_levels(intervals: DataFrame, until, every: str = "30 seconds") -> DataFrame:
    """``(symbol, tick, id, price, size, side)`` of the levels live at each tick.

    Ticks are multiples of ``every``; a level lists the ticks its interval covers, so no join is
    needed. ``until`` ends intervals that are still open.
    """
    width = F.expr(f"INTERVAL {every}")
    span = _micros(every)
    end = F.coalesce(F.col("valid_to"), F.lit(until) + F.expr("INTERVAL 1 MICROSECOND"))
    first = F.ceil(F.unix_micros("valid_from") / span)
    last = F.ceil(F.unix_micros(end) / span) - 1
    kept = _pieces(intervals.withColumn("_a", first).withColumn("_z", last).filter("_a <= _z"))
    return kept.select("symbol", F.explode(_ticks(span, width)).alias("tick"), "id", "price", "size", "side")


def _pieces(ranges: DataFrame, size: int = 4096) -> DataFrame:
    """Cut ranges of tick numbers ``[_a, _z]``, so no row lists more than ``size`` ticks."""
    starts = ranges.withColumn("_a", F.explode(F.sequence("_a", "_z", F.lit(size).cast("long"))))
    return starts.withColumn("_z", F.least(F.col("_z"), F.col("_a") + size - 1))


def _ticks(span: int, width: Column) -> Column:
    return F.sequence(F.timestamp_micros(F.col("_a") * span), F.timestamp_micros(F.col("_z") * span), width)


def sample_snapshots(intervals: DataFrame, until, every: str = "30 seconds", entries: DataFrame | None = None) -> DataFrame:
    """One row per symbol and tick with sorted sides; an unchanged book is repeated, and an empty one has empty sides.

    Ticks run from a symbol's first message in ``entries`` (without them: from its first level) to ``until``.
    """
    span, width = _micros(every), F.expr(f"INTERVAL {every}")
    began = intervals.select("symbol", F.col("valid_from").alias("ts")) if entries is None else entries.select("symbol", "ts")
    ranges = began.groupBy("symbol").agg(F.ceil(F.unix_micros(F.min("ts")) / span).alias("_a")).withColumn(
        "_z", F.floor(F.unix_micros(F.lit(until)) / span)).filter("_a <= _z")
    ticks = _pieces(ranges).select("symbol", F.explode(_ticks(span, width)).alias("tick"))
    sides = book_sides(sample_levels(intervals, until, every))
    none = F.array().cast(sides.schema["bids"].dataType)
    filled = {c: F.coalesce(c, none) for c in ("bids", "asks")}
    return ticks.join(sides, ["symbol", "tick"], "left").withColumns(filled)


def _micros(every: str) -> int:
    n, unit = every.split()
    return int(n) * {"s": 1, "m": 60, "h": 3600, "d": 86400}[unit[0].lower()] * 1_000_000


def last_time(entries: DataFrame):
    """Timestamp of the last message (a single value)."""
    return entries.agg(F.max("ts")).first()[0]


def encode_snapshots(df: DataFrame, ts: str = "tick") -> DataFrame:
    """ISO-8601 UTC text and JSON sides, the shape of the daily files."""
    return df.select(
        "symbol",
        F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        F.to_json("bids").alias("bids"),
        F.to_json("asks").alias("asks"),
    )
