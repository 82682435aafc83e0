"""Exponentially weighted sums inside ordered groups of any length.

``a * sum_i b^(t-i) x_i`` as a running sum of ``x_i b^-i`` is finite for about a thousand half-lives only. So a group is cut into
blocks of ``REACH`` half-lives: powers stay inside a block, and the value at the end of the block before is carried in, decayed. What is older
than that block is below 2^-REACH of its size. Rows stay in their partition: the blocks need a sort, no further shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Half-lives of a block: 2^400 times any price or volume is far below the largest double.
REACH = 400
HELPERS = ("_block", "_up", "_down", "_next", "_end")


def with_decay(df: DataFrame, half_life: float, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add the helper columns that ``decayed`` needs: block, powers, and whether a row is its block's last."""
    a = 1.0 - 2.0 ** (-1.0 / half_life)
    size = max(1, int(REACH * half_life))
    b, place = F.lit(1.0 - a), F.col("_place")
    w = Window.partitionBy(*partition).orderBy(*order)
    rows = df.withColumn("_row", F.row_number().over(w) - 1)
    return rows.select(
        *df.columns, F.floor(F.col("_row") / size).alias("_block"), (F.col("_row") % size).alias("_place"),
    ).select(
        *df.columns, "_block", F.pow(b, -place).alias("_up"), (F.lit(a) * F.pow(b, place)).alias("_down"),
        F.pow(b, place + 1).alias("_next"), (place == size - 1).alias("_end"),
    )


def decayed(df: DataFrame, values: Mapping[str, Column], partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``name`` -> weighted sum of the value up to the row, nulls skipped; NULL before the first value."""
    inside = Window.partitionBy(*partition, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*partition).orderBy("_block", *order).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.select("*", *[F.sum(x * F.col("_up")).over(inside).alias(f"_in_{n}") for n, x in values.items()])
    ends = {n: F.last(F.when(F.col("_end"), F.coalesce(F.col("_down") * F.col(f"_in_{n}"), F.lit(0.0))), ignorenulls=True) for n in values}
    carried = sums.select("*", *[e.over(before).alias(f"_at_{n}") for n, e in ends.items()])

    def total(n: str) -> Column:
        own, old = F.col(f"_in_{n}"), F.col(f"_at_{n}")
        return F.when(own.isNotNull() | old.isNotNull(), F.coalesce(F.col("_down") * own, F.lit(0.0)) + F.coalesce(F.col("_next") * old, F.lit(0.0)))

    return carried.select(*df.columns, *[total(n).alias(n) for n in values])
