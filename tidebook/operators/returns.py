"""Log returns, EWMA variance and strided samples.

Functions named ``*_columns`` work inside a bounded group (an hour batch) given by ``partition``.
Functions on a whole series number its rows and work in chunks with copied edges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DECISION_LAG, FWD_HORIZONS, FWD_PREFIX, HALF_LIFE, PAST_HORIZONS
from .decay import HELPERS, decayed, with_decay
from .ordering import positions, shifted, time_block

BATCH = ("symbol", "target_hour")


def _order(partition: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*partition).orderBy(*order)


def log_return(df: DataFrame, partition=BATCH, order=("timestamp",), price: str = "mid_price") -> DataFrame:
    w = _order(partition, order)
    return df.withColumn("log_return", F.log(price) - F.log(F.lag(price, 1).over(w)))


def past_columns(horizons=PAST_HORIZONS, partition=BATCH, order=("timestamp",), price="mid_price") -> list[Column]:
    w = _order(partition, order)
    return [(F.log(price) - F.log(F.lag(price, n).over(w))).alias(f"past_logret_{n}") for n in horizons]


def fwd_columns(
    horizons=FWD_HORIZONS, lag=DECISION_LAG, partition=BATCH, order=("timestamp",),
    price="mid_price", prefix=FWD_PREFIX,
) -> list[Column]:
    w = _order(partition, order)
    base = F.log(F.lead(price, lag).over(w))
    return [(F.log(F.lead(price, lag + n).over(w)) - base).alias(f"{prefix}{n}") for n in horizons]


def past_logret(df: DataFrame, horizons=PAST_HORIZONS, **kw) -> DataFrame:
    return df.select("*", *past_columns(horizons, **kw))


def fwd_logret(df: DataFrame, horizons=FWD_HORIZONS, lag=DECISION_LAG, **kw) -> DataFrame:
    return df.select("*", *fwd_columns(horizons, lag, **kw))


def ewma_variance(df: DataFrame, half_life: float = HALF_LIFE, partition=BATCH, order=("timestamp",)) -> DataFrame:
    """EWMA of squared ``log_return`` (zero start, nulls skipped) in batches of any length."""
    r = F.col("log_return")
    rows = decayed(with_decay(df, half_life, partition, order), {"variance_proxy": r * r}, partition, order)
    return rows.drop(*HELPERS)


def volatility(df: DataFrame) -> DataFrame:
    return df.withColumn("volatility", F.sqrt("variance_proxy"))


def number_series(
    df: DataFrame, keys=("symbol",), order=("timestamp",), length: str = "hour"
) -> DataFrame:
    """Add the dense position ``idx`` of every row of a time series; ``length`` is the time block that
    one task orders (an hour of trades by default, shorter for a denser feed)."""
    blocks = df.withColumn("_block", time_block(order[0], length))
    return positions(blocks, keys, order, "_block").drop("_block")


def series_fwd_logret(
    df: DataFrame, horizons=FWD_HORIZONS, lag=DECISION_LAG, price="last_traded_price",
    keys=("symbol",), prefix=FWD_PREFIX,
) -> DataFrame:
    """Forward returns of whole numbered series (``idx`` from ``number_series``)."""
    steps = sorted({lag, *[lag + n for n in horizons]})
    out = shifted(df, keys, {f"_p{s}": (F.col(price), -s) for s in steps})
    base = F.log(f"_p{lag}")
    return out.select(
        *df.columns, *[(F.log(f"_p{lag + n}") - base).alias(f"{prefix}{n}") for n in horizons]
    )


def ewma_series(
    df: DataFrame, value: str, half_life: float = HALF_LIFE, keys=("symbol",), name: str = "ewma"
) -> DataFrame:
    """EWMA over whole numbered series of any length.

    Chunks span 400 half-lives. A chunk receives the end values of the three chunks before it,
    decayed; anything older is below the smallest double.
    """
    a = 1.0 - 2.0 ** (-1.0 / half_life)
    size = int(400 * half_life)
    decay = (1.0 - a) ** size
    b = F.lit(1.0 - a)
    rows = df.withColumn("chunk", F.floor(F.col("idx") / size)).withColumn("_r", F.col("idx") % size)
    ends = (
        rows.groupBy(*keys, "chunk")
        .agg((F.lit(a) * F.sum(F.col(value) * F.pow(b, F.lit(size - 1) - F.col("_r")))).alias("_end"))
        .select(
            *keys,
            F.explode(F.array(*[
                F.struct((F.col("chunk") + d).alias("chunk"), (F.col("_end") * decay ** (d - 1)).alias("e"))
                for d in (1, 2, 3)
            ])).alias("x"),
        )
        .groupBy(*keys, F.col("x.chunk").alias("chunk"))
        .agg(F.sum("x.e").alias("_carry"))
    )
    w = Window.partitionBy(*keys, "chunk").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("_z", F.sum(F.col(value) * F.pow(b, -F.col("_r"))).over(w))
    inside = F.lit(a) * F.pow(b, F.col("_r")) * F.col("_z")
    carried = F.pow(b, F.col("_r") + 1) * F.col("_carry")
    total = F.when(
        F.col("_z").isNotNull() | F.col("_carry").isNotNull(),
        F.coalesce(inside, F.lit(0.0)) + F.coalesce(carried, F.lit(0.0)),
    )
    return local.join(ends, [*keys, "chunk"], "left").select(*df.columns, total.alias(name))


def complete_rows(df: DataFrame, cols: Sequence[str], keys=("symbol",)) -> DataFrame:
    """Rows where every column has a value, numbered anew as ``idx``."""
    kept = df.dropna(subset=list(cols)).withColumn("_block", F.floor(F.col("idx") / (1 << 20)))
    return positions(
        kept.withColumnRenamed("idx", "_idx"), keys, ["_idx"], "_block"
    ).drop("_idx", "_block")


def stride_sample(df: DataFrame, cols: Sequence[str], keys=("symbol",), strided: bool = True) -> DataFrame:
    """Long ``(keys, column, horizon, idx, value)``: rows 0, N, 2N... of each horizon column.

    N is the number at the end of the column name; ``strided=False`` keeps every row.
    """
    rows = complete_rows(df, cols, keys)
    long = rows.unpivot([*keys, "idx"], list(cols), "column", "value").withColumn("horizon", horizon_of("column"))
    if not strided:
        return long.select(*keys, "column", "horizon", "idx", "value")
    step = F.col("horizon")
    return long.filter(F.col("idx") % step == 0).select(
        *keys, "column", "horizon", F.floor(F.col("idx") / step).alias("idx"), "value"
    )


def horizon_of(column: str) -> Column:
    return F.regexp_extract(column, r"(\d+)$", 1).cast("long")


def as_series(strided: DataFrame, keys=("symbol",)) -> DataFrame:
    """``(series, idx, value)`` with the key and the column name joined into the series name."""
    return strided.select(F.concat_ws("/", *keys, "column").alias("series"), "idx", "value")
