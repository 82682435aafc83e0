"""Ordered computations that never put a whole series into one task.

A window partitioned only by ``symbol`` or ``series`` sends a hot key to a single task. The
helpers here split every key further:

* ``blocked_window`` cuts a key into blocks that follow the order (for example one day of
  time), computes inside each block and adds what earlier or later blocks carry over. Blocks are
  scanned within ranges of blocks, and only one row per range takes part in the key-wide window.
* ``halo_chunks`` cuts a densely numbered series into equal chunks and copies the few edge rows
  a lag or lead needs, so every group has a fixed number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_dir

CHUNK = 16_384
BROADCAST_ROWS = 200_000
#: Rows that one task sorts or joins where the number of tasks is set by the rows.
ROWS_PER_TASK = 500_000
#: Block numbers that are carried together.
FAN = 10_000


def materialized(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the checkpoint folder, so it is computed once and survives
    lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A join side that is expected to be small: computed once, counted, and broadcast only if the
    count is within ``max_rows``. A larger side is left to a shuffled join under AQE."""
    table = materialized(df)
    return F.broadcast(table) if table.count() <= max_rows else table


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for heavy per-row work on a table that comes in few splits; a table with enough
    splits is left as it is. For plain scans (the splits are known without running anything)."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * 2 <= cores else scan


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks of an exchange of so many rows: more rows give more tasks, not larger ones."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


def in_blocks(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    nexts: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The part of ``blocked_window`` that each block settles by itself: ``group`` is the key with its block."""
    ahead = Window.partitionBy(*group).orderBy(*order)
    upto = ahead.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = Window.partitionBy(*group).orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    return df.select(
        "*",
        *[F.sum(e).over(upto).alias(n) for n, e in (sums or {}).items()],
        *[F.last(e, ignorenulls=True).over(upto).alias(n) for n, e in (lasts or {}).items()],
        *[F.last(e, ignorenulls=True).over(after).alias(n) for n, e in (nexts or {}).items()],
    )


def carried(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: str,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    nexts: Mapping[str, Column] | None = None,
    fan: int = FAN,
) -> DataFrame:
    """One row per key and block with what earlier blocks (``sums``, ``lasts``) and later ones (``nexts``) bring to it.

    Two levels: blocks are scanned within ranges of ``fan`` block numbers, and one row per range within the key. Only
    one row per block is exchanged, once and by key; every further step finds its rows where they are.
    """
    sums, lasts, nexts = dict(sums or {}), dict(lasts or {}), dict(nexts or {})
    wide = "_range"

    def merged(place: Column, s, las, nex) -> list[Column]:
        return [
            *[F.sum(e).alias(n) for n, e in s.items()],
            *[F.max_by(e, F.when(e.isNotNull(), place)).alias(n) for n, e in las.items()],
            *[F.min_by(e, F.when(e.isNotNull(), place)).alias(n) for n, e in nex.items()],
        ]

    def brought(group: Sequence[str], by: str, suffix: str) -> list[Column]:
        window = Window.partitionBy(*group)
        prior = window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        later = window.orderBy(F.col(by).desc()).rowsBetween(Window.unboundedPreceding, -1)
        return [
            *[F.sum(n).over(prior).alias(n + suffix) for n in sums],
            *[F.last(n, ignorenulls=True).over(prior).alias(n + suffix) for n in lasts],
            *[F.last(n, ignorenulls=True).over(later).alias(n + suffix) for n in nexts],
        ]

    totals = (
        df.groupBy(*keys, block).agg(*merged(F.struct(*order), sums, lasts, nexts))
        .withColumn(wide, F.floor(F.col(block) / fan)).repartition(*keys)
    )
    same = [{n: F.col(n) for n in part} for part in (sums, lasts, nexts)]
    ranges = totals.groupBy(*keys, wide).agg(*merged(F.col(block), *same))
    far = ranges.select(*keys, wide, *brought(keys, wide, "_far"))
    near = totals.select(*keys, wide, block, *brought([*keys, wide], block, "_near"))
    return near.join(far, [*keys, wide]).select(
        *keys, block,
        *[
            F.when(F.col(f"{n}_near").isNotNull() | F.col(f"{n}_far").isNotNull(),
                   F.coalesce(f"{n}_near", F.lit(0)) + F.coalesce(f"{n}_far", F.lit(0))).alias(n)
            for n in sums
        ],
        *[F.coalesce(f"{n}_near", f"{n}_far").alias(n) for n in (*lasts, *nexts)],
    )


def blocked_window(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: str,
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Column] | None = None,
    nexts: Mapping[str, Column] | None = None,
    fan: int = FAN,
) -> DataFrame:
    """Running sums, last non-null values (current row included) and next non-null values
    (strictly after the row) over ``order`` within ``keys``.

    ``block`` is a column of whole numbers that never decreases along ``order`` within a key; ``fan`` block numbers
    are carried together. Keys are not null.
    """
    sums, lasts, nexts = dict(sums or {}), dict(lasts or {}), dict(nexts or {})
    sides = [{f"{side}{n}": e for n, e in part.items()} for side in ("_in_", "_by_") for part in (sums, lasts, nexts)]
    rows = in_blocks(df, [*keys, block], order, *sides[:3])
    return rows.join(carried(df, keys, order, block, *sides[3:], fan=fan), [*keys, block]).select(
        *df.columns,
        *[
            F.when(F.col(f"_in_{n}").isNotNull() | F.col(f"_by_{n}").isNotNull(),
                   F.coalesce(f"_in_{n}", F.lit(0)) + F.coalesce(f"_by_{n}", F.lit(0))).alias(n)
            for n in sums
        ],
        *[F.coalesce(f"_in_{n}", f"_by_{n}").alias(n) for n in (*lasts, *nexts)],
    )


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: str, name: str = "idx"
) -> DataFrame:
    """Dense 0-based row number along ``order`` within ``keys``."""
    group = [*keys, block]
    rn = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    prior = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
        .select(*group, F.coalesce(F.sum("_rows").over(prior), F.lit(0)).alias("_offset"))
    )
    return (
        df.withColumn("_rn", rn)
        .join(offsets, group)
        .select(*df.columns, (F.col("_offset") + F.col("_rn") - 1).alias(name))
    )


def time_block(ts: Column | str, length: str = "day") -> Column:
    """Block number of a timestamp; a block never grows with the length of the history."""
    return F.unix_micros(F.date_trunc(length, F.col(ts) if isinstance(ts, str) else ts))


def halo_chunks(
    df: DataFrame,
    pos: str = "idx",
    size: int = CHUNK,
    back: int | Column = 0,
    ahead: int | Column = 0,
) -> DataFrame:
    """Give each row to its own chunk and to the chunks that need it as context.

    ``back``/``ahead`` say how many earlier/later rows an owned row looks at. Adds ``chunk`` and
    ``own``; keep the rows where ``own`` holds after the windowed work.
    """
    back = F.lit(back) if isinstance(back, int) else back
    ahead = F.lit(ahead) if isinstance(ahead, int) else ahead
    p = F.col(pos)
    first = F.greatest(F.floor((p - ahead) / size), F.lit(0)).cast("long")
    last = F.floor((p + back) / size).cast("long")
    return df.withColumn("chunk", F.explode(F.sequence(first, last))).withColumn(
        "own", F.col("chunk") == F.floor(p / size)
    )


def shifted(
    df: DataFrame,
    keys: Sequence[str],
    lags: Mapping[str, tuple[Column, int]],
    pos: str = "idx",
    size: int = CHUNK,
) -> DataFrame:
    """Add ``name -> (expr, k)``: the value of ``expr`` k rows earlier (k < 0: later)."""
    back = max([k for _, k in lags.values() if k > 0], default=0)
    ahead = max([-k for _, k in lags.values() if k < 0], default=0)
    w = Window.partitionBy(*keys, "chunk").orderBy(pos)
    return (
        halo_chunks(df, pos, size, back, ahead)
        .select(
            *df.columns, "own",
            *[F.lag(e, k).over(w).alias(n) for n, (e, k) in lags.items()],
        )
        .filter("own")
        .drop("own")
    )


def dense_series(long: DataFrame, keys: Sequence[str] = ("series",), size: int = 1 << 20) -> DataFrame:
    """Drop null, NaN and infinite values of ``(series, idx, value)`` and renumber ``idx``."""
    v = F.col("value")
    clean = long.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    blocks = clean.withColumn("_block", F.floor(F.col("idx") / size))
    return (
        positions(blocks.withColumnRenamed("idx", "_idx"), keys, ["_idx"], "_block", "idx")
        .select(*keys, "idx", "value")
    )
