"""Order statistics over any number of rows: sorted value runs, quantiles, average ranks.

Equal values are merged first, in one pass over the rows, so a value that fills a third of a series is one row. The merged values are sorted by
range partitions: bounds are drawn from the values themselves, so outliers, several scales and crowded places give blocks of like
size. Block totals give every run the number of rows below it. Runs are written once; nothing is approximated.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import materialized, small_side

ROWS_PER_BLOCK = 50_000


def _counted_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the running count within the partition."""
    total = 0
    for batch in batches:
        upto = total + np.cumsum(batch.column("cnt").to_numpy(zero_copy_only=False))
        total = int(upto[-1]) if len(upto) else total
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto, pa.int64())], names=[*batch.schema.names, "_upto"])


def merged_values(long: DataFrame, keys: Sequence[str] = ("series",)) -> DataFrame:
    """``(keys, value, cnt)``: equal values merged, in one pass over the rows, and written."""
    return materialized(long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("cnt")))


def sorted_blocks(
    long: DataFrame, keys: Sequence[str] = ("series",), rows: int = ROWS_PER_BLOCK, merged: DataFrame | None = None
) -> DataFrame:
    """``(keys, value, cnt, _block, _upto)``: distinct values in ordered blocks of about ``rows`` runs, with the running count
    inside a block. ``merged``: the values already merged by ``merged_values``."""
    merged = (merged_values(long, keys) if merged is None else merged).filter(F.col("value").isNotNull())
    least = int(merged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(least, -(-merged.count() // rows))
    ordered = merged.repartitionByRange(blocks, *keys, "value").sortWithinPartitions(*keys, "value").withColumn(
        "_block", F.spark_partition_id())
    schema = ordered.withColumn("_upto", F.lit(0).cast("long")).schema
    return materialized(ordered.mapInArrow(_counted_up, schema))


def value_runs(
    long: DataFrame, keys: Sequence[str] = ("series",), rows: int = ROWS_PER_BLOCK, merged: DataFrame | None = None
) -> DataFrame:
    """``(keys, value, cnt, below, n)``: distinct values with the number of rows strictly below. Nulls are left out."""
    keys = list(keys)
    placed = sorted_blocks(long, keys, rows, merged)
    # One row per block, and one more for each key that begins inside a block.
    totals = placed.groupBy(*keys, "_block").agg(F.sum("cnt").alias("_rows"), F.min(F.col("_upto") - F.col("cnt")).alias("_start"))
    prior = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_block", (F.coalesce(F.sum("_rows").over(prior), F.lit(0)) - F.col("_start")).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy(*keys)).alias("n"),
    )
    return placed.join(small_side(offsets), [*keys, "_block"]).select(
        *keys, "value", "cnt", (F.col("_offset") + F.col("_upto") - F.col("cnt")).alias("below"), "n")


def quantiles_of_runs(
    runs: DataFrame, probs: Sequence[float], keys: Sequence[str] = ("series",), extra: Sequence[Column] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation, one array ``q`` per key, and any ``extra``
    aggregates of the runs. The runs that hold the wanted ranks are picked in one aggregate."""
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    below, value = F.col("below"), F.col("value")

    def held(rank: Column) -> Column:
        return F.max(F.when((rank >= below) & (rank < below + F.col("cnt")), value))

    picked = runs.groupBy(*keys, "n").agg(
        *[held(f(a)).alias(f"_v{i}{s}") for i, a in enumerate(at) for s, f in (("a", F.floor), ("z", F.ceil))],
        *extra,
    )
    given = [c for c in picked.columns if c not in (*keys, "n") and not c.startswith("_v")]
    return picked.select(
        *keys,
        "n",
        *given,
        F.array(*[
            F.col(f"_v{i}a") + (F.col(f"_v{i}z") - F.col(f"_v{i}a")) * (a - F.floor(a))
            for i, a in enumerate(at)
        ]).alias("q"),
    )


def quantiles(long: DataFrame, probs: Sequence[float], keys: Sequence[str] = ("series",)) -> DataFrame:
    return quantiles_of_runs(value_runs(long, keys), probs, keys)


def average_ranks(long: DataFrame, row_key: str = "idx", keys: Sequence[str] = ("series",), parts: int | None = None) -> DataFrame:
    """Add ``rank`` (1-based, ties share their mean rank).

    A value held by more than one row in 2,000 is hot; there are at most 2,000 hot values per
    series and their ranks come from a size-checked side table, so they are never shuffled by value.
    ``parts``: tasks of the join of rows with ranks (default: the session's).
    """
    keys = list(keys)
    runs = value_runs(long, keys).withColumn("rank", F.col("below") + (F.col("cnt") + 1) / 2)
    hot = runs.filter(F.col("cnt") * 2000 > F.col("n")).select(*keys, "value", F.col("rank").alias("_hot"))
    spread = F.pmod(F.xxhash64(F.col(row_key)), F.lit(4096)) + 1
    rows = long.join(small_side(hot), [*keys, "value"], "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), spread).otherwise(F.lit(0))
    )
    cold = runs.select(*keys, "value", F.lit(0).cast("long").alias("_salt"), "rank")
    by = [*keys, "value", "_salt"]
    if parts:
        rows, cold = rows.repartition(parts, *by), cold.repartition(parts, *by)
    return rows.join(cold, by, "left").select(
        *long.columns, F.coalesce("_hot", "rank").alias("rank")
    )


def expand_runs(runs: DataFrame, keys: Sequence[str] = ("series",), piece: int = 65_536) -> DataFrame:
    """One row per original row with its 0-based place in value order; long runs are cut first."""
    start = F.explode(F.sequence(F.lit(0), F.col("cnt") - 1, F.lit(piece))).alias("_from")
    cut = runs.select(*keys, "value", "n", "below", "cnt", start)
    return cut.select(
        *keys, "value", "n",
        F.explode(F.sequence(
            F.col("below") + F.col("_from"),
            F.col("below") + F.least(F.col("_from") + piece, F.col("cnt")) - 1,
        )).alias("place"),
    )
