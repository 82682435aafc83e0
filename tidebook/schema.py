"""Schemas and fixed values shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# Horizons, bands and defaults of the feature set.
FWD_HORIZONS = (2, 3, 4, 5, 10, 20, 40, 60, 120, 240)
PAST_HORIZONS = (1, 2, 3, 4, 5, 10, 20, 40, 60, 120, 240)
DECISION_LAG = 1
BANDS = (5, 15, 50, 0)  # 0 is the whole book
HALF_LIFE = 20
CLIP = 3.0
BINS = 1000
FWD_PREFIX = "fwd_logret_"

# Columns that are never transformed or scaled.
NOT_TRANSFORMED = (
    "symbol", "timestamp", "trading_hour", "target_hour", "bids", "asks",
    "mid_price", "variance_proxy", "is_context",
)
NOT_SCALED = NOT_TRANSFORMED + ("trading_day", "neg_bins", "pos_bins", "prices", "volumes")

PAIRS = T.ArrayType(T.ArrayType(T.DoubleType()))

L2_MESSAGE = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("action", T.StringType()),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.DoubleType()),
        T.StructField("side", T.StringType()),
    ]))),
])

SNAPSHOT_FILE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("bids", T.StringType()),
    T.StructField("asks", T.StringType()),
])

INGESTION_LOG = T.StructType([
    T.StructField("filename", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("record_count", T.IntegerType(), False),
])


def band_suffix(k: int) -> str:
    return f"top_{k}" if k > 0 else "all"
