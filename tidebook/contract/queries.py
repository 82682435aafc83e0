"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``, flat columns, rounded doubles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import book as K
from ..operators import dependence as D
from ..operators import densities as P
from ..operators import fitting as T
from ..operators import hours as H
from ..operators import messages as M
from ..operators import moments as S
from ..operators import normality as N
from ..operators import regression as G
from ..operators import returns as R
from ..operators import standardize as Z
from ..plans import diagnostics as X
from ..plans import features as PF
from ..plans import preparation as PP
from ..session import scratch_path, shared_dir
from ..sources import messages as SM
from ..sources import snapshots as I
from ..streaming import book_state as B
from ..streaming import ingest as SI
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

UNIT = "day"
TICK = "6 hours"
CHOSEN = {
    "l_quantity": {"transformation": "log", "parameters": {"offset": 0.0}},
    "l_extendedprice": {"transformation": "box-cox", "parameters": {"lambda": 0.3, "offset": 0.0}},
    "l_discount": {"transformation": "sqrt", "parameters": {"offset": 0.0}},
    "l_tax": {"transformation": "yeo-johnson", "parameters": {"lambda": -1.5}},
}


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            shared_dir(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = run
        return fn

    return register


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded double; plain arithmetic, so both engines round ties alike."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c.cast("double") * 10.0**digits + 0.5) / 10.0**digits


def us(c: str = "timestamp") -> Column:
    return F.unix_micros(c)


def out(df: DataFrame, *cols, digits: int = 6) -> DataFrame:
    """Columns by name; doubles rounded, timestamps as microseconds."""
    kinds = dict(df.dtypes)
    names = [c for c in (cols or df.columns)]
    picked = []
    for c in names:
        kind = kinds[c]
        if kind == "double":
            picked.append(r(c, digits).alias(c))
        elif kind == "timestamp":
            picked.append(us(c).alias(f"{c}_us"))
        elif kind == "int":
            picked.append(F.col(c).cast("long").alias(c))
        else:
            picked.append(F.col(c))
    return df.select(*picked)


# -- messages and stateful book ------------------------------------------------------------------

@query("b1_l2_messages")
def _(spark, sf):
    return out(SM.read_l2_messages(spark, fx.message_files(spark, sf)))


@query("b1_l2_messages_stream")
def _(spark, sf):
    stream = SM.read_l2_messages(spark, fx.message_files(spark, sf), streaming=True)
    table = scratch_path(spark, "entries")
    B.run_available(stream, table, scratch_path(spark, "entries-cp"))
    return out(spark.read.parquet(table))


@query("b2a_maintain_book")
def _(spark, sf):
    stream = SM.read_l2_messages(spark, fx.message_files(spark, sf), streaming=True)
    table = scratch_path(spark, "changes")
    B.run_available(B.maintain_book(stream), table, scratch_path(spark, "changes-cp"))
    return out(B.current_book(spark.read.parquet(table)))


@query("b2b_book_intervals")
def _(spark, sf):
    return out(M.book_intervals(fx.entries(spark, sf)))


@query("b2b_book_at_end")
def _(spark, sf):
    return out(M.book_at_end(M.book_intervals(fx.entries(spark, sf))))


def _sampled(spark, sf):
    entries = fx.entries(spark, sf)
    return M.sample_snapshots(M.book_intervals(entries), M.last_time(entries), TICK, entries)


@query("b3_book_sides")
def _(spark, sf):
    sides = _sampled(spark, sf)
    long = sides.select("symbol", "tick", F.lit("bid").alias("side"), F.posexplode("bids").alias("level", "x")).unionByName(
        sides.select("symbol", "tick", F.lit("ask").alias("side"), F.posexplode("asks").alias("level", "x"))
    )
    return out(long.select("symbol", "tick", "side", "level", F.col("x")[0].alias("price"), F.col("x")[1].alias("size")))


@query("b4_sample_snapshots")
def _(spark, sf):
    entries = fx.entries(spark, sf)
    return out(M.sample_levels(M.book_intervals(entries), M.last_time(entries), TICK))


@query("b4_sample_snapshots_stream")
def _(spark, sf):
    stream = SM.read_l2_messages(spark, fx.message_files(spark, sf), streaming=True)
    table = scratch_path(spark, "levels")
    B.run_available(B.maintain_book(stream, "snapshots", TICK), table, scratch_path(spark, "levels-cp"))
    return out(spark.read.parquet(table).filter("not late").drop("bucket", "late"))


@query("b2a_late_entries")
def _(spark, sf):
    """Every seventh message is delivered 25 messages late, in files of arrival order that are read one per trigger."""
    stream = SM.read_l2_messages(spark, fx.delayed_files(spark, sf), streaming=True, maxFilesPerTrigger=1)
    table = scratch_path(spark, "changes")
    B.run_available(B.maintain_book(stream, buckets=1), table, scratch_path(spark, "changes-cp"))
    changes = spark.read.parquet(table)
    book = B.current_book(changes).groupBy("symbol").agg(F.count(F.lit(1)).alias("live"), F.sum("size").alias("volume"))
    return out(B.late_entries(changes).join(book, "symbol"))


def _daily(spark, sf):
    """Snapshots as one JSON-text Parquet file per day."""
    encoded = M.encode_snapshots(fx.snapshots(spark, sf), "timestamp")
    path = scratch_path(spark, "daily")
    I.write_daily(encoded.repartition(F.substring("timestamp", 1, 10)), path)
    return path


def _typed(df):
    def total(side, i):
        return F.aggregate(side, F.lit(0.0), lambda acc, x: acc + x[i])

    return out(df.select(
        "symbol", "timestamp", F.size("bids").alias("n_bids"), F.size("asks").alias("n_asks"),
        *[total(s, i).alias(f"{s}_{n}") for s in ("bids", "asks") for i, n in ((0, "price"), (1, "volume"))],
    ))


@query("b5_encode_snapshots")
def _(spark, sf):
    text = M.encode_snapshots(fx.snapshots(spark, sf), "timestamp")
    sides = text.select("symbol", "timestamp", *[F.from_json(c, "array<array<double>>").alias(c) for c in ("bids", "asks")])

    def total(side, place):
        return F.aggregate(side, F.lit(0.0), lambda a, x: a + x[place])

    return out(sides.select(
        "symbol", "timestamp", *[F.size(c).cast("long").alias(f"n_{c}") for c in ("bids", "asks")],
        *[total(c, i).alias(f"{c}_{name}") for c in ("bids", "asks") for i, name in enumerate(("price", "volume"))]))


@query("b6_write_daily")
def _(spark, sf):
    files = spark.read.parquet(_daily(spark, sf))
    return files.groupBy(F.date_format("date", "yyyy-MM-dd").alias("date")).agg(F.count(F.lit(1)).alias("rows"))


@query("b7_damaged_files")
def _(spark, sf):
    path = _daily(spark, sf)
    fx.write_bytes(spark, f"{path}/date=2024-02-01/broken.parquet", b"PAR1 cut short")
    rows = I.scan_snapshots(spark, path, skip_bad=True).agg(F.count(F.lit(1)).alias("rows"))
    bad = I.bad_files(spark, path).agg(F.concat_ws(",", F.sort_array(F.collect_list("filename"))).alias("bad"))
    return rows.withColumn("k", F.lit(0)).join(bad.withColumn("k", F.lit(0)), "k").drop("k")


@query("b8_top_of_book")
def _(spark, sf):
    return out(K.top_of_book(_sampled(spark, sf)), "symbol", "tick", "best_bid", "best_ask", "top_spread")


# -- ingest --------------------------------------------------------------------------------------

@query("i1_scan_snapshots")
def _(spark, sf):
    df = I.scan_snapshots(spark, _daily(spark, sf))
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.min("timestamp").alias("first"))


@query("i2_parse_lob")
def _(spark, sf):
    return _typed(I.parse_lob(I.scan_snapshots(spark, _daily(spark, sf))))


@query("i3_pending_files")
def _(spark, sf):
    days = fx.snapshots(spark, sf).select(F.to_date("timestamp").alias("d")).distinct()
    files = days.select(F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit(".parquet")).alias("filename"), "d")
    log = files.select(
        "filename", F.when(F.dayofmonth("d") % 2 == 0, I.LABEL).otherwise("Other").alias("type")
    )
    return I.pending_files(files, log).select("filename")


@query("i4_ingest_log")
def _(spark, sf):
    source = _daily(spark, sf)
    fx.write_bytes(spark, f"{source}/date=2024-02-01/broken.parquet", b"PAR1 cut short")
    empty = spark.createDataFrame([], "symbol string, timestamp string, bids string, asks string")
    empty.coalesce(1).write.parquet(f"{source}/date=2024-02-02")
    table, log = scratch_path(spark, "raw"), scratch_path(spark, "log")
    I.ingest(spark, source, table, log)
    I.ingest(spark, source, table, log)  # nothing is pending the second time
    return I.read_log(spark, log).groupBy("type", F.col("record_count").cast("long").alias("record_count")).agg(
        F.count(F.lit(1)).alias("files")
    )


def _streamed(spark, sf):
    """Days in two deliveries, the second with a damaged and an empty file; the stream is run after each, and once more."""
    whole, source = spark.read.parquet(_daily(spark, sf)), scratch_path(spark, "delivered")
    table, log, checkpoint = (scratch_path(spark, x) for x in ("raw", "log", "ingest-cp"))
    for part in (0, 1):
        own = whole.filter(F.dayofmonth("date") % 2 == part)
        own.repartition("date").write.partitionBy("date").mode("append").parquet(source)
        if part:
            fx.write_bytes(spark, f"{source}/date=2024-02-01/broken.parquet", b"PAR1 cut short")
            empty = spark.createDataFrame([], "symbol string, timestamp string, bids string, asks string")
            empty.coalesce(1).write.parquet(f"{source}/date=2024-02-02")
        SI.ingest_stream(spark, source, table, log, checkpoint, max_files=20)
    SI.ingest_stream(spark, source, table, log, checkpoint)  # nothing is pending
    return table, log


@query("i4_ingest_stream")
def _(spark, sf):
    table, log = _streamed(spark, sf)
    return SI.stream_log(spark, log).groupBy("type", F.col("record_count").cast("long").alias("record_count")).agg(
        F.count(F.lit(1)).alias("files")
    )


@query("i5_stream_table")
def _(spark, sf):
    return _typed(I.load_raw(spark, _streamed(spark, sf)[0]))


@query("i5_append_raw")
def _(spark, sf):
    table = scratch_path(spark, "raw")
    snaps = fx.snapshots(spark, sf)
    I.append_raw(snaps, table)
    I.append_raw(snaps, table)  # keys already stored are left out
    return _typed(I.load_raw(spark, table))


@query("i6_load_raw")
def _(spark, sf):
    table = scratch_path(spark, "raw")
    I.append_raw(fx.snapshots(spark, sf), table)
    day = F.to_date(F.lit("2024-01-10"))
    return out(I.load_raw(spark, table, ["symbol", "timestamp"], F.col("date") >= day))


def _flagged(spark, sf):
    return fx.trades(spark, sf).withColumn("is_context", F.col("event_id") % 5 == 0)


@query("i7_sample_rows")
def _(spark, sf):
    return out(I.sample_rows(_flagged(spark, sf), 500, 7, ["event_id"]).select("event_id", "symbol", "last_traded_price"))


@query("i8_write_table")
def _(spark, sf):
    path = scratch_path(spark, "hours")
    rows = H.with_trading_hour(fx.trades(spark, sf), UNIT)
    I.write_table(rows, path, "append")
    I.write_table(rows.filter(F.dayofmonth("trading_hour") == 3), path, "overwrite")
    return spark.read.parquet(path).groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


@query("i9_context_breakdown")
def _(spark, sf):
    return H.context_breakdown(_flagged(spark, sf))


# -- hours ---------------------------------------------------------------------------------------

@query("h1_trading_hours")
def _(spark, sf):
    return out(H.trading_hours(fx.snapshots(spark, sf)))


@query("h2_processable_hours")
def _(spark, sf):
    return out(H.processable_hours(fx.snapshots(spark, sf)))


@query("h3_processable_hours_past")
def _(spark, sf):
    return out(H.processable_hours(fx.snapshots(spark, sf), 3, 0))


@query("h4_temporal_split")
def _(spark, sf):
    return out(H.temporal_split(H.processable_hours(fx.snapshots(spark, sf))))


@query("h5_split_range")
def _(spark, sf):
    snaps = fx.snapshots(spark, sf)
    split = H.temporal_split(H.processable_hours(snaps, unit=UNIT)).filter("split = 'train'")
    return out(H.split_range(snaps.select("symbol", "timestamp"), split, unit=UNIT))


@query("h6_run_split")
def _(spark, sf):
    path = scratch_path(spark, "split")
    PP.run_split(fx.snapshots(spark, sf), path=path)
    return spark.read.parquet(path).groupBy("symbol", "split", "is_context").agg(
        F.count(F.lit(1)).alias("rows"), us(F.min("timestamp")).alias("first_us"), us(F.max("timestamp")).alias("last_us")
    )


def _batches(spark, sf):
    snaps = K.mid_price(fx.snapshots(spark, sf)).select("symbol", "timestamp", "mid_price")
    return H.hour_batches(snaps, H.processable_hours(snaps, unit=UNIT), unit=UNIT)


@query("h7_hour_batches")
def _(spark, sf):
    return out(_batches(spark, sf), "symbol", "timestamp", "trading_hour", "target_hour", "mid_price")


@query("h8_flag_context")
def _(spark, sf):
    return H.flag_context(_batches(spark, sf)).groupBy("symbol", us("target_hour").alias("target_hour_us"), "is_context").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("h9_select_batch_output")
def _(spark, sf):
    kept = H.select_batch_output(H.flag_context(_batches(spark, sf)))
    return out(kept, "symbol", "timestamp", "target_hour", "is_context")


@query("h10_target_rows")
def _(spark, sf):
    return out(H.target_rows(H.flag_context(_batches(spark, sf))), "symbol", "timestamp", "target_hour")


# -- ordered series ------------------------------------------------------------------------------

def _mids(spark, sf):
    return _batches(spark, sf).select("symbol", "timestamp", "target_hour", "mid_price")


KEY = ("symbol", "timestamp", "target_hour")


@query("w1_log_return")
def _(spark, sf):
    return out(R.log_return(_mids(spark, sf)), *KEY, "log_return", digits=9)


@query("w2_past_logret")
def _(spark, sf):
    return out(R.past_logret(_mids(spark, sf), fx.PAST), *KEY, *[f"past_logret_{n}" for n in fx.PAST], digits=9)


@query("w3_fwd_logret")
def _(spark, sf):
    return out(R.fwd_logret(_mids(spark, sf), fx.FWD), *KEY, *[f"fwd_logret_{n}" for n in fx.FWD], digits=9)


@query("w4_trade_fwd_logret")
def _(spark, sf):
    df = fx.numbered_returns(spark, sf)
    return out(df, "symbol", "event_id", "idx", *[f"fwd_logret_{n}" for n in fx.FWD], digits=9)


@query("w5_ewma_variance")
def _(spark, sf):
    return out(R.ewma_variance(R.log_return(_mids(spark, sf))), *KEY, "variance_proxy", digits=12)


@query("w5_ewma_long_series")
def _(spark, sf):
    numbered = R.number_series(fx.trades(spark, sf), ["symbol"], ["timestamp", "event_id"])
    return out(R.ewma_series(numbered, "last_traded_price"), "symbol", "event_id", "ewma")


@query("w6_volatility")
def _(spark, sf):
    return out(R.volatility(R.ewma_variance(R.log_return(_mids(spark, sf)))), *KEY, "volatility", digits=9)


@query("w7_stride_sample")
def _(spark, sf):
    cols = [f"fwd_logret_{n}" for n in fx.FWD]
    return out(R.stride_sample(fx.numbered_returns(spark, sf), cols).drop("horizon"), digits=9)


@query("w8_horizon_of_column")
def _(spark, sf):
    cols = [f"fwd_logret_{n}" for n in fx.FWD]
    long = R.stride_sample(fx.numbered_returns(spark, sf), cols)
    return long.groupBy("column", "horizon").agg(F.count(F.lit(1)).alias("rows"))


# -- book features -------------------------------------------------------------------------------

def _row_feature(build, *names, digits: int = 6):
    def run(spark, sf):
        return out(build(fx.snapshots(spark, sf)), "symbol", "timestamp", *names, digits=digits)

    return run


def _banded(build):
    def run(df):
        for k in fx.BANDS:
            df = build(df, k)
        return df

    return run


def _band_names(family: str) -> list[str]:
    from ..schema import band_suffix

    return [f"{family}_{band_suffix(k)}" for k in fx.BANDS]


query("k1_mid_price")(_row_feature(K.mid_price, "mid_price"))
query("k2_spread")(_row_feature(K.spread, "spread"))
query("k3_microprice")(_row_feature(K.microprice, "microprice"))
for _id, _family, _fn in (
    ("k4", "depth_imbalance", K.depth_imbalance), ("k5", "depth", K.market_depth),
    ("k6", "liquidity_concentration", K.liquidity_concentration),
    ("k7", "price_impact_proxy", K.price_impact), ("k8", "liquidity_spread", K.liquidity_spread),
):
    query(f"{_id}_{_family}")(_row_feature(_banded(_fn), *_band_names(_family)))


@query("k9_book_features")
def _(spark, sf):
    df = K.book_features(fx.snapshots(spark, sf), fx.BANDS)
    return out(df.drop("bids", "asks"))


def _features(spark, sf, **kw):
    return PF.derive_features(
        fx.snapshots(spark, sf), unit=UNIT, bands=fx.BANDS, fwd=fx.FWD, back=fx.PAST, **kw
    )


@query("p1_derive_features")
def _(spark, sf):
    return out(_features(spark, sf, keep_books=False))


@query("p1_minimum_slice")
def _(spark, sf):
    return out(PF.minimum_slice(fx.snapshots(spark, sf)), digits=8)


# -- transforms ----------------------------------------------------------------------------------

def _line(spark, sf):
    return T.feature_long(fx.line_table(spark, sf), fx.LINE_FEATURES)


@query("t1_select_features")
def _(spark, sf):
    names = T.select_features(_features(spark, sf))
    return T.feature_long(_features(spark, sf), names).groupBy("feature").agg(F.count(F.lit(1)).alias("rows"))


@query("t2_feature_stats")
def _(spark, sf):
    return out(T.feature_stats(_line(spark, sf)), digits=5)


@query("t3_candidate_values")
def _(spark, sf):
    long = _line(spark, sf).withColumn(
        "value", F.when(F.col("feature") == "l_tax", F.col("value") - 0.04).otherwise(F.col("value"))
    )
    cand = T.candidate_values(long, T.feature_stats(long))
    return out(cand.groupBy("feature", "candidate").agg(
        F.count(F.lit(1)).alias("n"), F.max("offset").alias("offset"), F.avg("value").alias("mean"),
        F.max("value").alias("max"),
    ), digits=9)


@query("t4_lambda_profile")
def _(spark, sf):
    long = _line(spark, sf)
    grid = F.array(*[F.lit(g) for g in T.LAMBDA_GRID])
    positive = long.filter(F.col("feature").isin("l_quantity", "l_extendedprice"))
    both = T.lambda_profile(long, "yeo-johnson", grid).withColumn("family", F.lit("yeo-johnson")).unionByName(
        T.lambda_profile(positive, "box-cox", grid).withColumn("family", F.lit("box-cox"))
    )
    return both.select("feature", "family", r("lambda", 1).alias("lambda"), r("llf", 2).alias("llf"))


@query("t4_fit_lambda")
def _(spark, sf):
    long = _line(spark, sf)
    return out(T.fit_lambda(long, "yeo-johnson").withColumn("family", F.lit("yeo-johnson")).unionByName(
        T.fit_lambda(long, "box-cox").withColumn("family", F.lit("box-cox"))
    ), digits=3)


@query("t5_normality_score")
def _(spark, sf):
    return out(T.normality_score(_line(spark, sf), ["feature"]), digits=7)


@query("t6_fit_transforms")
def _(spark, sf):
    feats = fx.line_table(spark, sf)
    return out(T.fit_transforms(feats, fx.LINE_FEATURES), digits=5)


@query("t7_save_load_transforms")
def _(spark, sf):
    feats = fx.line_table(spark, sf)
    path = scratch_path(spark, "transforms")
    T.save_transforms(spark, T.transform_map(T.fit_transforms(feats, fx.LINE_FEATURES)), path)
    return out(T.apply_transforms(feats, T.load_transforms(spark, path)))


@query("t8_apply_transforms")
def _(spark, sf):
    items = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *fx.LINE_FEATURES)
    return out(T.apply_transforms(items, CHOSEN))


@query("t9_run_transform")
def _(spark, sf):
    return out(PP.run_transform(_features(spark, sf)).drop("bids", "asks"))


# -- standardization -----------------------------------------------------------------------------

def _priced(spark, sf):
    """Snapshots with mid and a variance that depends on the row alone."""
    df = K.mid_price(fx.snapshots(spark, sf))
    return df.withColumn("variance_proxy", F.pow(F.lit(0.5) / F.col("mid_price"), F.lit(2)))


def _levels(df):
    return df.select("symbol", "timestamp", F.explode(F.concat("bids", "asks")).alias("x")).select(
        "symbol", "timestamp", F.col("x")[0].alias("price"), F.col("x")[1].alias("volume")
    )


@query("z1_standardize_prices")
def _(spark, sf):
    return out(_levels(Z.standardize_prices(_priced(spark, sf))))


@query("z2_normalize_volumes")
def _(spark, sf):
    return out(_levels(Z.normalize_volumes(_priced(spark, sf))))


@query("z3_flatten_book")
def _(spark, sf):
    flat = Z.flatten_book(_priced(spark, sf))
    zipped = flat.select("symbol", "timestamp", F.explode(F.arrays_zip("prices", "volumes")).alias("x"))
    return out(zipped.select("symbol", "timestamp", "x.prices", "x.volumes"))


@query("z4_uniform_bins")
def _(spark, sf):
    flat = Z.flatten_book(Z.normalize_volumes(Z.standardize_prices(_priced(spark, sf))))
    binned = Z.uniform_bins(flat, 10)
    long = binned.select("symbol", "timestamp", F.posexplode(F.arrays_zip("neg_bins", "pos_bins")).alias("bin", "x"))
    return out(long.select("symbol", "timestamp", "bin", "x.neg_bins", "x.pos_bins"))


def _to_scale(spark, sf):
    df = K.book_features(fx.snapshots(spark, sf), (3, 0)).drop("bids", "asks")
    return H.hour_batches(df, H.processable_hours(df, 2, 0, UNIT), 2, 0, UNIT)


@query("z5_ewma_scale_one")
def _(spark, sf):
    return out(Z.ewma_scale(_to_scale(spark, sf), ["spread"]), *KEY, "spread")


@query("z6_ewma_scale_all")
def _(spark, sf):
    feats = ["spread", "depth_all", "depth_imbalance_top_3", "liquidity_spread_all"]
    return out(Z.ewma_scale(_to_scale(spark, sf), feats), *KEY, *feats)


@query("z7_run_standardize")
def _(spark, sf):
    feats = ["spread", "volatility", "depth_all"]
    df = PP.run_standardize(_features(spark, sf), 10, past=2, unit=UNIT, feats=feats)

    def total(c):
        return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)

    return out(df.select(
        "symbol", "timestamp", "trading_hour", *feats, "fwd_logret_2",
        total("neg_bins").alias("neg_volume"), total("pos_bins").alias("pos_volume"),
    ))


# -- statistics ----------------------------------------------------------------------------------

def _series_query(name: str, build, digits: int = 6, cols=()):
    @query(name)
    def _(spark, sf):
        return out(build(fx.return_series(spark, sf)), *cols, digits=digits)


@query("s1_describe_series")
def _(spark, sf):
    return out(S.describe_series(fx.line_long(spark, sf)), digits=5)


_series_query("s2_shapiro", N.shapiro)
_series_query("s3_k2_test", S.k2_test)
_series_query("s4_jarque_bera", S.jarque_bera)
_series_query("s5_anderson_normal", lambda d: N.anderson_normal(d).drop("anderson_crit_vals"))
_series_query("s7_arch_lm", G.arch_lm)
_series_query("s7_arch_lm_lag1", lambda d: G.arch_lm(d, 1), cols=("series", "n", "arch_lags", "arch_lm_stat", "arch_f_stat"))
_series_query("s8_adf", G.adf)
_series_query("s9_kpss", G.kpss)
_series_query("s10_diagnose", X.diagnose)
_series_query("s12_normality_report", X.normality_report)
_series_query("s13_hetero_report", X.hetero_report)
_series_query("s18_lagged_mi", D.lagged_mi)
_series_query("s19_quantile_acf", D.quantile_acf)
_series_query("s20_runs_test", S.runs_test)
_series_query("s21_tsay_test", G.tsay_test)
_series_query("s22_run_battery", X.run_battery)
_series_query("s24_histogram", S.histogram)
_series_query("s25_gaussian_kde", P.gaussian_kde)
_series_query("s26_fit_normal", P.fit_normal)
_series_query("s27_fit_student_t", P.fit_student_t)
_series_query("s28_fit_gmm", lambda d: P.fit_gmm(d, (2, 3)).drop("w", "m", "v"))
_series_query("s29_model_ranking", lambda d: P.model_ranking(P.fit_normal(d)))
_series_query("s30_qq_points", N.qq_points, digits=9)


@query("s6_ljung_box")
def _(spark, sf):
    series = fx.return_series(spark, sf)
    return out(D.ljung_box(series, of=D.KINDS))


@query("s11_interpret")
def _(spark, sf):
    """Verdicts from p-values that both sides can compute; each stands in for the named test."""
    series = fx.return_series(spark, sf)
    m = S.k2_of(S.jarque_bera_of(S.moments(series)))
    lb = D.ljung_box(series, [10], "square").select("series", F.col("lb_p").alias("arch_lm_p"))
    diag = m.join(lb, "series").select(
        "series", "n", "mean", F.sqrt("m2").alias("std"), F.col("skew_b").alias("skew"),
        F.col("kurt_b").alias("kurtosis_excess"), F.lit(None).cast("double").alias("shapiro_p"), "k2_p", "jb_p",
        F.col("k2_p").alias("adf_p"), F.col("arch_lm_p").alias("kpss_p"), "arch_lm_p",
    )
    return out(X.interpret(diag))


@query("s14_spearman_matrix")
def _(spark, sf):
    return out(D.spearman_matrix(fx.line_features(spark, sf), "idx", fx.LINE_FEATURES))


@query("s14_spearman_summary")
def _(spark, sf):
    shared_dir(spark)
    rho = D.spearman_matrix(fx.line_features(spark, sf), "idx", fx.LINE_FEATURES).checkpoint()
    best = D.top_pairs(rho, "rho", 3).select(F.concat_ws("/", "feature_a", "feature_b").alias("what"), F.col("rho").alias("v"))
    stats = D.pair_summary(rho).unpivot([], ["mean", "max", "min", "std", "abs_mean"], "what", "v")
    return out(best.unionByName(stats))


@query("s15_spearman_targets")
def _(spark, sf):
    pairs = D.spearman_targets(fx.line_features(spark, sf), "idx", fx.LINE_FEATURES[:2], fx.LINE_FEATURES[2:])
    return out(D.top_pairs(pairs))


@query("s16_mi_matrix")
def _(spark, sf):
    return out(D.mi_matrix(fx.line_table(spark, sf), fx.LINE_FEATURES), digits=8)


@query("s17_mi_targets")
def _(spark, sf):
    pairs = D.mi_targets(fx.line_table(spark, sf), fx.LINE_FEATURES[:2], fx.LINE_FEATURES[2:])
    return out(D.top_pairs(pairs, "mi"), digits=8)


@query("s23_battery_overview")
def _(spark, sf):
    shared_dir(spark)
    return X.battery_overview(X.run_battery(fx.return_series(spark, sf)).checkpoint())


@query("s22_battery_values")
def _(spark, sf):
    """The numbers of the battery; lists along lags have queries of their own."""
    return out(X.run_battery(fx.return_series(spark, sf)).filter("text IS NULL").select("series", "path", "value"))


@query("s23_overview_values")
def _(spark, sf):
    shared_dir(spark)
    rows = X.run_battery(fx.return_series(spark, sf)).filter("text IS NULL").checkpoint()
    wide = X.battery_overview(rows, X.FIRST_PATHS)
    return wide.select("series", *[r(F.col(f"`{p}`")).alias(p.replace(".", "_")) for p in X.FIRST_PATHS])
