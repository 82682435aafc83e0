"""Book maintenance as a stateful stream.

State is kept per ``(symbol, bucket)`` where the bucket is a hash of the level id, so a busy symbol is
maintained by many tasks. A ``partial`` message clears the whole symbol, hence its clear marker is
sent to every bucket. Each level is one entry of a ``MapState``: a trigger reads the levels that its entries name and writes
those that changed, whatever the size of the book. The state store is RocksDB, on disk.

Entries at or before the last applied ``(seq, pos)`` of their bucket are late: they change nothing and are given out as rows with
``late``, so that they can be counted. In snapshot mode Spark itself removes entries behind the watermark before the
operator sees them; ``run_available`` reports how many.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.messages import _micros

BUCKETS = 16
#: Rows of an output frame.
FRAME = 50_000
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SEEN = "seq long, pos long, tick long"
LEVEL = "price double, size double, side string"
OUT = "symbol string, bucket long, seq long, pos long, us long, id long, price double, size double, side string, live boolean, late boolean"
NAMES = [c.split()[0] for c in OUT.split(", ")]


def _keyed(entries: DataFrame, buckets: int) -> DataFrame:
    cols = ["symbol", "seq", "pos", "ts", "action", "id", "price", "size", "side"]
    starts = (F.col("action") == "partial") & (F.col("pos") == 0)
    own = F.pmod(F.xxhash64("id"), F.lit(buckets))
    none = F.lit(None)
    marker = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long")),
        lambda b: F.struct(b.alias("bucket"), F.lit("clear").alias("action"), F.lit(-1).cast("long").alias("pos")),
    )
    entry = F.array(F.struct(own.alias("bucket"), F.col("action").alias("action"), F.col("pos").cast("long").alias("pos")))
    sent = entries.select(*cols, F.explode(
        F.when(starts & F.col("id").isNull(), marker).when(starts, F.concat(marker, entry)).otherwise(entry)).alias("e"))
    cleared = F.col("e.action") == "clear"
    return sent.select(
        "symbol", F.col("e.bucket").alias("bucket"), "seq", F.col("e.pos").alias("pos"), "ts", F.unix_micros("ts").alias("us"),
        F.col("e.action").alias("action"),
        *[F.when(cleared, none).otherwise(F.col(c)).alias(c) for c in ("id", "price", "size", "side")],
    )


def _in_order(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """``seq, pos, us, action, id, price, size, side`` of all frames by (seq, pos).

    Frames are taken one at a time and kept as plain columns, each in order, and merged; how many one trigger brings is set by
    the source's ``maxFilesPerTrigger``.
    """
    parts = []
    for frame in frames:
        order = np.lexsort((frame["pos"].to_numpy(), frame["seq"].to_numpy()))
        ids = frame["id"].fillna(-1).to_numpy(np.int64)
        columns = [frame["seq"].to_numpy(np.int64), frame["pos"].to_numpy(np.int64), frame["us"].to_numpy(np.int64),
                   frame["action"].to_numpy(object), ids, frame["price"].to_numpy(float), frame["size"].to_numpy(float), frame["side"].to_numpy(object)]
        parts.append([c[order] for c in columns])

    def rows(part: list[np.ndarray]) -> Iterator[tuple]:
        for a in range(0, len(part[0]), 4096):
            yield from zip(*[c[a : a + 4096].tolist() for c in part])

    return heapq.merge(*[rows(p) for p in parts], key=lambda r: r[:2])


class _Levels:
    """The levels of one bucket: read from the state when first named, written back when changed."""

    def __init__(self, state):
        self.state, self.known, self.changed, self.whole = state, {}, set(), False

    def get(self, k: int) -> tuple | None:
        if k not in self.known:
            self.known[k] = None if self.whole else self.state.getValue((k,))
        return self.known[k]

    def put(self, k: int, level: tuple | None) -> None:
        self.known[k] = level
        self.changed.add(k)

    def live(self) -> list[tuple[int, tuple]]:
        if not self.whole:
            for (k,), level in self.state.iterator():
                self.known.setdefault(k, level)
            self.whole = True
        return [(k, v) for k, v in self.known.items() if v is not None]

    def clear(self) -> list[tuple[int, tuple]]:
        gone = self.live()
        self.state.clear()
        self.known, self.changed = {}, set()
        return gone

    def write(self) -> None:
        for k in self.changed:
            if self.known[k] is None:
                self.state.removeKey((k,))
            else:
                self.state.updateValue((k,), self.known[k])


class BookKeeper(StatefulProcessor):
    """Applies entries in order; gives level changes, or the live levels at every tick that has passed."""

    def __init__(self, width: int, snapshots: bool, timed: bool):
        self.width, self.snapshots, self.timed = width, snapshots, timed

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", SEEN)
        self.state = handle.getMapState("levels", "id long", LEVEL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._run(key, _in_order(rows), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._run(key, iter(()), timerValues)

    def close(self) -> None:
        pass

    def _run(self, key, rows: Iterator[tuple], timer) -> Iterator[pd.DataFrame]:
        out = []
        for row in self._rows(rows, timer):
            out.append((*key, *row))
            if len(out) == FRAME:
                yield pd.DataFrame(out, columns=NAMES)
                out = []
        yield pd.DataFrame(out, columns=NAMES)

    def _rows(self, rows: Iterator[tuple], timer) -> Iterator[tuple]:
        levels = _Levels(self.state)
        seq, pos, tick = self.seen.get() if self.seen.exists() else (-1, -1, -1)
        for s, p, us, action, k, price, size, side in rows:
            if (s, p) <= (seq, pos):
                if p >= 0:
                    yield s, p, us, None if k < 0 else k, price, size, side, None, True
                continue
            if self.snapshots:  # ticks strictly before this entry saw the book as it was
                upto = -(-us // self.width)
                yield from self._ticks(levels, tick, upto)
                tick = max(tick, upto)
            if action == "clear":
                changes = [(i, v, False) for i, v in levels.clear()]
            elif action == "delete":
                old = levels.get(k)
                changes = [(k, old, False)] if old else []
                if old:
                    levels.put(k, None)
            elif action == "update" and levels.get(k) is None:
                changes = []
            else:
                old = levels.get(k) if action == "update" else None
                level = (old[0], size, old[2]) if old else (price, size, side)
                levels.put(k, level)
                changes = [(k, level, True)]
            if not self.snapshots:
                for i, v, live in changes:
                    yield s, p, us, i, *v, live, False
            seq, pos = s, p
        if self.timed and tick >= 0:
            # Everything before the watermark has arrived, so ticks up to it are final even in a silent bucket.
            now = timer.getCurrentWatermarkInMs()
            upto = -(-now * 1000 // self.width)
            if now > 0 and upto > tick:
                yield from self._ticks(levels, tick, upto)
                tick = upto
            if levels.live():
                self.handle.registerTimer(max(tick * self.width // 1000, now) + 1)
        levels.write()
        self.seen.update((seq, pos, tick))

    def _ticks(self, levels: _Levels, tick: int, upto: int) -> Iterator[tuple]:
        if 0 <= tick < upto:
            live = levels.live()
            for t in range(tick, upto) if live else ():
                for k, v in live:
                    yield None, None, t * self.width, k, *v, True, False


def use_rocksdb(spark: SparkSession) -> None:
    """States of this kind need a store with column families; other streams of the session work with it too."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def maintain_book(
    entries: DataFrame, emit_kind: str = "changes", every: str = "30 seconds", delay: str = "1 minute",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Apply flattened entries to the live book.

    ``emit_kind="changes"`` gives every level change; ``emit_kind="snapshots"`` gives, for each tick that has
    passed, the levels live at it. Rows with ``late`` are entries that came too late to be applied.
    """
    snapshots = emit_kind == "snapshots"
    timed = snapshots and entries.isStreaming
    use_rocksdb(entries.sparkSession)
    keyed = _keyed(entries.withWatermark("ts", delay) if timed else entries, buckets)
    rows = keyed.groupBy("symbol", "bucket").transformWithStateInPandas(
        BookKeeper(_micros(every), snapshots, timed), OUT, "append", "EventTime" if timed else "None")
    at = F.timestamp_micros("us")
    if snapshots:
        return rows.select("symbol", "bucket", at.alias("tick"), "id", "price", "size", "side", "late")
    return rows.select("symbol", "bucket", "seq", "pos", at.alias("ts"), "id", "price", "size", "side", "live", "late")


def _late() -> Column:
    """As a folder name the flag is read back as text."""
    return F.col("late").cast("boolean")


def current_book(changes: DataFrame) -> DataFrame:
    """The live levels from a table of changes: the last change of each level."""
    last = F.max_by(F.struct("price", "size", "side", "live"), F.struct("seq", "pos", "live")).alias("l")
    return changes.filter(~_late()).groupBy("symbol", "id").agg(last).filter("l.live").select(
        "symbol", "id", "l.price", "l.size", "l.side"
    )


def late_entries(table: DataFrame) -> DataFrame:
    """``(symbol, late_entries, levels)``: how many entries came too late, and how many levels they named."""
    return table.filter(_late()).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("late_entries"), F.count_distinct("id").alias("levels"))


def run_available(stream: DataFrame, path: str, checkpoint: str) -> dict[str, int]:
    """Process everything available into a Parquet table and stop. Late rows of a book go to a folder of their own.

    Returns the number of rows read and of those that Spark left out behind the watermark.
    """
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy("late") if "late" in stream.columns else writer
    query = writer.outputMode("append").trigger(availableNow=True).start()
    seen: dict[int, dict] = {}
    running = True
    while running:  # only the latest hundred reports are kept by Spark
        running = not query.awaitTermination(1)
        seen.update({p["batchId"]: p for p in query.recentProgress})
    return {
        "rows": sum(p["numInputRows"] for p in seen.values()),
        "behind_watermark": sum(s["numRowsDroppedByWatermark"] for p in seen.values() for s in p["stateOperators"]),
    }
