"""Trading hours, processable hours, chronological splits and overlapping hour batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import small_side


def _units(n: int, unit: str) -> Column:
    return F.expr(f"INTERVAL {n} {unit.upper()}")


def with_trading_hour(df: DataFrame, unit: str = "hour") -> DataFrame:
    return df.withColumn("trading_hour", F.date_trunc(unit, "timestamp"))


def trading_hours(df: DataFrame, unit: str = "hour") -> DataFrame:
    return df.select("symbol", F.date_trunc(unit, "timestamp").alias("trading_hour")).distinct()


def processable_hours(df: DataFrame, past: int = 3, future: int = 3, unit: str = "hour") -> DataFrame:
    """Hours with at least ``past`` present hours before and ``future`` after them (by position).

    The windows run over one row per symbol and hour, which the calendar bounds.
    """
    w = Window.partitionBy("symbol")
    hours = trading_hours(df, unit).select(
        "symbol", "trading_hour",
        F.row_number().over(w.orderBy("trading_hour")).alias("_i"),
        F.count(F.lit(1)).over(w).alias("_n"),
    )
    kept = hours.filter((F.col("_i") > past) & (F.col("_n") - F.col("_i") >= future))
    return kept.select(
        "symbol", "trading_hour",
        (F.col("_i") - past).alias("hour_no"),
        (F.col("_n") - past - future).alias("hours"),
    )


def temporal_split(hours: DataFrame, train_pct: float = 0.8) -> DataFrame:
    """The first ``int(n * train_pct)`` processable hours are ``train``, the others ``test``."""
    cut = F.floor(F.col("hours") * F.lit(float(train_pct)))
    return hours.withColumn("split", F.when(F.col("hour_no") <= cut, "train").otherwise("test"))


def split_range(df: DataFrame, split_hours: DataFrame, past: int = 3, future: int = 3, unit: str = "hour") -> DataFrame:
    """Rows of each split with wall-clock context on both sides; ``is_context`` marks the latter.

    The range of a split is listed by hour, so rows meet it on ``(symbol, trading_hour)``.
    """
    ranges = split_hours.groupBy("symbol", "split").agg(
        F.min("trading_hour").alias("_first"), F.max("trading_hour").alias("_last")
    )
    wanted = ranges.select(
        "symbol", "split",
        F.explode(F.sequence(
            F.col("_first") - _units(past, unit), F.col("_last") + _units(future, unit), _units(1, unit)
        )).alias("trading_hour"),
        "_first", "_last",
    ).select(
        "symbol", "trading_hour", "split",
        ((F.col("trading_hour") < F.col("_first")) | (F.col("trading_hour") > F.col("_last"))).alias("is_context"),
    )
    rows = df if "trading_hour" in df.columns else with_trading_hour(df, unit)
    return rows.join(small_side(wanted), ["symbol", "trading_hour"])


def hour_batches(
    df: DataFrame,
    targets: DataFrame,
    past: int = 3,
    future: int = 3,
    unit: str = "hour",
    payload: Sequence[str] = (),
    first_context: bool = False,
) -> DataFrame:
    """Copy every row into the batches that look at it: ``[target - past, target + 1 + future)``.

    Columns in ``payload`` (large ones) travel once only, with the copy that will be kept: the
    row's own hour or, with ``first_context``, the first batch for its context rows. On the other
    copies they are NULL. Columns outside ``payload`` are on every copy.
    """
    targets = targets.select("symbol", "trading_hour", "hour_no").withColumnRenamed("trading_hour", "target_hour")
    rows = df if "trading_hour" in df.columns else with_trading_hour(df, unit)
    own = F.col("trading_hour")
    home = own
    if payload and first_context:
        first = targets.filter("hour_no = 1").select("symbol", F.col("target_hour").alias("_first"))
        lead_in = first.select(
            "symbol", "_first",
            F.explode(F.sequence(
                F.col("_first") - _units(past, unit), F.col("_first") - _units(1, unit), _units(1, unit)
            )).alias("trading_hour"),
        ) if past else first.withColumn("trading_hour", F.col("_first")).limit(0)
        rows = rows.join(small_side(lead_in), ["symbol", "trading_hour"], "left")
        home = F.coalesce(F.col("_first"), own)
    narrow = [c for c in df.columns if c not in payload]
    if "trading_hour" not in narrow:
        narrow.append("trading_hour")
    copies = rows.withColumn(
        "target_hour",
        F.explode(F.sequence(own - _units(future, unit), own + _units(past, unit), _units(1, unit))),
    )
    packed = [F.struct(*payload).alias("_payload")] if payload else []
    copies = copies.select(
        *narrow, "target_hour",
        *([F.when(F.col("target_hour") == home, packed[0]).alias("_payload")] if payload else []),
    )
    return copies.join(small_side(targets), ["symbol", "target_hour"])


def unpack_payload(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "_payload"]
    return df.select(*rest, "_payload.*")


def flag_context(df: DataFrame) -> DataFrame:
    return df.withColumn("is_context", F.col("trading_hour") < F.col("target_hour"))


def select_batch_output(df: DataFrame) -> DataFrame:
    """The first batch keeps its context rows; every other batch only its target hour."""
    own = F.col("trading_hour") == F.col("target_hour")
    lead_in = (F.col("hour_no") == 1) & (F.col("trading_hour") < F.col("target_hour"))
    return df.filter(own | lead_in)


def target_rows(df: DataFrame) -> DataFrame:
    """Target hour only, context rows dropped."""
    kept = df.filter(F.col("trading_hour") == F.col("target_hour"))
    return kept.filter(~F.col("is_context")) if "is_context" in df.columns else kept


def context_breakdown(df: DataFrame) -> DataFrame:
    return df.groupBy("is_context").agg(F.count(F.lit(1)).alias("rows"))
