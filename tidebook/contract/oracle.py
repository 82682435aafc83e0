"""SQL equivalents of the registered queries (DuckDB dialect, whole tables)."""

from __future__ import annotations

from ..functions.normal import log_cdf_sql, quantile_sql, tail_sql
from ..operators.fitting import LAMBDA_GRID
from ..operators.normality import LARGE_MEAN, LARGE_SD, LAST_WEIGHT, NEXT_WEIGHT
from .fixtures import BANDS, FWD, LINE_FEATURES, PAST, STRIDES

ORACLE: dict[str, str] = {}


def r(expr: str, digits: int = 6) -> str:
    return f"floor(CAST({expr} AS DOUBLE) * 1e{digits}::DOUBLE + 0.5::DOUBLE) / 1e{digits}::DOUBLE"


def suffix(k: int) -> str:
    return f"top_{k}" if k else "all"


TRADES = """
tr AS (SELECT 'S' || (user_id % 3) AS symbol, ts, event_id,
              1000.0::DOUBLE + (event_id % 97) * 0.5::DOUBLE + value * 0.01::DOUBLE AS p FROM events)"""

# Levels of the derived snapshots: one row per event.
LEVELS = """
lv0 AS (SELECT event_id // 10 AS sid, 'S' || ((event_id // 10) % 2) AS symbol,
               max(ts) OVER (PARTITION BY event_id // 10) AS ts, event_id % 2 = 0 AS is_bid,
               1000.0::DOUBLE + ((event_id // 10) % 97) * 0.5::DOUBLE AS base, value * 0.01::DOUBLE AS off,
               CAST(1 + user_id % 50 AS DOUBLE) AS v FROM events),
lv AS (SELECT sid, symbol, ts, is_bid, v,
              CASE WHEN is_bid THEN base - 0.5::DOUBLE - off ELSE base + 0.5::DOUBLE + off END AS p FROM lv0),
sn AS (SELECT sid, symbol, ts, max(p) FILTER (is_bid) AS bb, min(p) FILTER (NOT is_bid) AS ba,
              (max(p) FILTER (is_bid) + min(p) FILTER (NOT is_bid)) / 2.0::DOUBLE AS mid
       FROM lv GROUP BY sid, symbol, ts)"""

BAND_CTE = """
rk AS (SELECT *, row_number() OVER (PARTITION BY sid, is_bid
               ORDER BY CASE WHEN is_bid THEN -p ELSE p END, CASE WHEN is_bid THEN -v ELSE v END) AS i FROM lv),
al AS (SELECT sid, coalesce(sum(v) FILTER (is_bid), 0) AS vb, coalesce(sum(v) FILTER (NOT is_bid), 0) AS va,
              count(*) FILTER (is_bid) AS nb, count(*) FILTER (NOT is_bid) AS na FROM rk GROUP BY sid),
mp AS (SELECT a.sid, a.i, a.p - b.p AS d, a.v + b.v AS w FROM rk a JOIN rk b ON a.sid = b.sid AND a.i = b.i
       AND NOT a.is_bid AND b.is_bid)"""


def _band(k: int) -> str:
    cond = f"i <= {k}" if k else "true"
    s = suffix(k)
    kb = f"least({k}, nb)" if k else "nb"
    ka = f"least({k}, na)" if k else "na"
    return f"""
q_{s} AS (SELECT rk.sid, coalesce(sum(v) FILTER (is_bid AND {cond}), 0) AS vb,
          coalesce(sum(v) FILTER (NOT is_bid AND {cond}), 0) AS va,
          max(p) FILTER (is_bid AND i = {kb}) AS pb, max(p) FILTER (NOT is_bid AND i = {ka}) AS pa
          FROM rk JOIN al USING (sid) GROUP BY rk.sid),
l_{s} AS (SELECT sid, sum(d * w) AS num, sum(w) AS den FROM mp WHERE {cond} GROUP BY sid)"""


BANDED = BAND_CTE + "," + ",".join(_band(k) for k in BANDS)
BAND_JOIN = " ".join(
    f"LEFT JOIN q_{suffix(k)} USING (sid) LEFT JOIN l_{suffix(k)} USING (sid)" for k in BANDS
)
FAMILY = {
    "depth_imbalance": lambda s: f"CASE WHEN q_{s}.vb + q_{s}.va = 0 THEN 0 ELSE (q_{s}.vb - q_{s}.va) / (q_{s}.vb + q_{s}.va) END",
    "depth": lambda s: f"q_{s}.vb + q_{s}.va",
    "liquidity_concentration": lambda s: f"CASE WHEN al.vb + al.va = 0 THEN 0 ELSE (q_{s}.vb + q_{s}.va) / (al.vb + al.va) END",
    "price_impact_proxy": lambda s: f"CASE WHEN q_{s}.vb + q_{s}.va <= 0 THEN 0 ELSE (pa_{s} - pb_{s}) / (q_{s}.vb + q_{s}.va + 1e-12::DOUBLE) END",
    "liquidity_spread": lambda s: f"CASE WHEN coalesce(l_{s}.den, 0) <= 0 THEN 0 ELSE l_{s}.num / (l_{s}.den + 1e-12::DOUBLE) END",
}


def family(name: str, digits: int = 6, rounded: bool = True) -> str:
    items = []
    for k in BANDS:
        s = suffix(k)
        e = FAMILY[name](s).replace(f"pa_{s}", f"q_{s}.pa").replace(f"pb_{s}", f"q_{s}.pb")
        items.append(f"{r(e, digits) if rounded else e} AS {name}_{s}")
    return ", ".join(items)


MICRO = """
bv AS (SELECT lv.sid, sum(v) FILTER (is_bid AND p = bb) AS vbb, sum(v) FILTER (NOT is_bid AND p = ba) AS vba
       FROM lv JOIN sn USING (sid) GROUP BY lv.sid)"""
MICRO_EXPR = "CASE WHEN vbb + vba = 0 THEN mid ELSE (ba * vbb + bb * vba) / (vbb + vba) END"

ORACLE["k1_mid_price"] = f"WITH {LEVELS} SELECT symbol, epoch_us(ts) AS timestamp_us, {r('mid')} AS mid_price FROM sn"
ORACLE["k2_spread"] = f"WITH {LEVELS} SELECT symbol, epoch_us(ts) AS timestamp_us, {r('ba - bb')} AS spread FROM sn"
ORACLE["k3_microprice"] = (
    f"WITH {LEVELS}, {MICRO} SELECT symbol, epoch_us(ts) AS timestamp_us, {r(MICRO_EXPR)} AS microprice FROM sn JOIN bv USING (sid)"
)
for _id, _name in (("k4", "depth_imbalance"), ("k5", "depth"), ("k6", "liquidity_concentration"),
                   ("k7", "price_impact_proxy"), ("k8", "liquidity_spread")):
    ORACLE[f"{_id}_{_name}"] = (
        f"WITH {LEVELS}, {BANDED} SELECT symbol, epoch_us(ts) AS timestamp_us, {family(_name)} "
        f"FROM sn JOIN al USING (sid) {BAND_JOIN}"
    )
ALL_FAMILIES = ", ".join(family(f, rounded=False) for f in FAMILY)
BAND_NAMES = [f"{f}_{suffix(k)}" for f in FAMILY for k in BANDS]
FEATURED = f"""{LEVELS}, {MICRO}, {BANDED},
ft AS (SELECT sn.sid, symbol, ts, mid AS mid_price, ba - bb AS spread, {MICRO_EXPR} AS microprice, {ALL_FAMILIES}
       FROM sn JOIN bv USING (sid) JOIN al USING (sid) {BAND_JOIN})"""
ORACLE["k9_book_features"] = (
    f"WITH {FEATURED} SELECT symbol, epoch_us(ts) AS timestamp_us, "
    + ", ".join(f"{r(c)} AS {c}" for c in ("mid_price", "spread", "microprice", *BAND_NAMES)) + " FROM ft"
)


# -- hours ---------------------------------------------------------------------------------------

def hours(past: int, future: int, unit: str, source: str = "sn", name: str = "tg") -> str:
    return f"""
hr_{name} AS (SELECT DISTINCT symbol, date_trunc('{unit}', ts) AS h FROM {source}),
po_{name} AS (SELECT symbol, h, row_number() OVER (PARTITION BY symbol ORDER BY h) AS i,
              count(*) OVER (PARTITION BY symbol) AS n FROM hr_{name}),
{name} AS (SELECT symbol, h, i - {past} AS hour_no, n - {past} - {future} AS hours FROM po_{name}
       WHERE i > {past} AND n - i >= {future})"""


def hour_out(past, future, unit):
    return (f"WITH {LEVELS}, {hours(past, future, unit)} "
            "SELECT symbol, epoch_us(h) AS trading_hour_us, hour_no, hours FROM tg")


ORACLE["h1_trading_hours"] = (
    f"WITH {LEVELS} SELECT DISTINCT symbol, epoch_us(date_trunc('hour', ts)) AS trading_hour_us FROM sn"
)
ORACLE["h2_processable_hours"] = hour_out(3, 3, "hour")
ORACLE["h3_processable_hours_past"] = hour_out(3, 0, "hour")
SPLIT = "CASE WHEN hour_no <= floor(hours * 0.8::DOUBLE) THEN 'train' ELSE 'test' END"
ORACLE["h4_temporal_split"] = (
    f"WITH {LEVELS}, {hours(3, 3, 'hour')} SELECT symbol, epoch_us(h) AS trading_hour_us, hour_no, hours, {SPLIT} AS split FROM tg"
)
RANGES = """
sp AS (SELECT symbol, split, min(h) AS a, max(h) AS z FROM (SELECT *, {split} AS split FROM tg) GROUP BY symbol, split),
rg AS (SELECT s.symbol, s.ts, date_trunc('{unit}', s.ts) AS h, split, a, z FROM sn s JOIN sp ON s.symbol = sp.symbol
       AND s.ts >= a - INTERVAL 3 {unit} AND s.ts < z + INTERVAL 4 {unit})"""
ORACLE["h5_split_range"] = (
    f"WITH {LEVELS}, {hours(3, 3, 'day')}, {RANGES.format(split=SPLIT, unit='day')} SELECT symbol, epoch_us(ts) AS timestamp_us, "
    "epoch_us(h) AS trading_hour_us, split, h < a OR h > z AS is_context FROM rg WHERE split = 'train'"
)
ORACLE["h6_run_split"] = (
    f"WITH {LEVELS}, {hours(3, 3, 'hour')}, {RANGES.format(split=SPLIT, unit='hour')} SELECT symbol, split, h < a OR h > z AS is_context, "
    "count(*) AS rows, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM rg GROUP BY symbol, split, is_context"
)


def batches(past: int = 3, future: int = 3, cols: str = "s.mid AS mid_price", source: str = "sn", name: str = "b", tg: str = "tg") -> str:
    return f"""
{name} AS (SELECT s.symbol, s.ts, date_trunc('day', s.ts) AS h, t.h AS t, t.hour_no, {cols}
      FROM {source} s JOIN {tg} t ON s.symbol = t.symbol
      AND s.ts >= t.h - INTERVAL {past} DAY AND s.ts < t.h + INTERVAL {future + 1} DAY)"""


BATCH = f"{LEVELS}, {hours(3, 3, 'day')}, {batches()}"
BKEY = "symbol, epoch_us(ts) AS timestamp_us, epoch_us(t) AS target_hour_us"
ORACLE["h7_hour_batches"] = f"WITH {BATCH} SELECT {BKEY}, epoch_us(h) AS trading_hour_us, {r('mid_price')} AS mid_price FROM b"
ORACLE["h8_flag_context"] = (
    f"WITH {BATCH} SELECT symbol, epoch_us(t) AS target_hour_us, h < t AS is_context, count(*) AS rows FROM b GROUP BY symbol, t, h < t"
)
KEPT = "(h = t OR (hour_no = 1 AND ts < t + INTERVAL 1 DAY))"
ORACLE["h9_select_batch_output"] = f"WITH {BATCH} SELECT {BKEY}, h < t AS is_context FROM b WHERE {KEPT}"
ORACLE["h10_target_rows"] = f"WITH {BATCH} SELECT {BKEY} FROM b WHERE h = t"


# -- ordered series ------------------------------------------------------------------------------

W = "WINDOW w AS (PARTITION BY symbol, t ORDER BY ts)"
ALPHA = "(1.0::DOUBLE - pow(2.0::DOUBLE, -1.0::DOUBLE / 20))"
BETA = f"(1.0::DOUBLE - {ALPHA})"


def past(ns=PAST, price="mid_price"):
    return {f"past_logret_{n}": f"ln({price}) - ln(lag({price}, {n}) OVER w)" for n in ns}


def fwd(ns=FWD, price="mid_price"):
    return {f"fwd_logret_{n}": f"ln(lead({price}, {1 + n}) OVER w) - ln(lead({price}, 1) OVER w)" for n in ns}


def listed(items: dict, digits: int) -> str:
    return ", ".join(f"{r(e, digits)} AS {n}" for n, e in items.items())


LOGRET = "ln(mid_price) - ln(lag(mid_price, 1) OVER w)"
VARIANCE = f"""
x1 AS (SELECT *, {LOGRET} AS log_return, row_number() OVER w - 1 AS rn FROM b {W}),
x2 AS (SELECT *, {ALPHA} * pow({BETA}, rn) * sum(log_return * log_return * pow({BETA}, -rn))
       OVER (PARTITION BY symbol, t ORDER BY ts ROWS UNBOUNDED PRECEDING) AS variance_proxy FROM x1)"""
ORACLE["w1_log_return"] = f"WITH {BATCH} SELECT {BKEY}, {r(LOGRET, 9)} AS log_return FROM b {W}"
ORACLE["w2_past_logret"] = f"WITH {BATCH} SELECT {BKEY}, {listed(past(), 9)} FROM b {W}"
ORACLE["w3_fwd_logret"] = f"WITH {BATCH} SELECT {BKEY}, {listed(fwd(), 9)} FROM b {W}"
ORACLE["w5_ewma_variance"] = f"WITH {BATCH}, {VARIANCE} SELECT {BKEY}, {r('variance_proxy', 12)} AS variance_proxy FROM x2"
ORACLE["w6_volatility"] = f"WITH {BATCH}, {VARIANCE} SELECT {BKEY}, {r('sqrt(variance_proxy)', 9)} AS volatility FROM x2"

NUMBERED = f"""{TRADES},
fw AS (SELECT symbol, event_id, row_number() OVER w - 1 AS idx, {", ".join(f"{e} AS {n}" for n, e in fwd(price="p").items())}
       FROM tr WINDOW w AS (PARTITION BY symbol ORDER BY ts, event_id)),
cr AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY idx) - 1 AS i FROM fw
       WHERE {" AND ".join(f"fwd_logret_{n} IS NOT NULL" for n in FWD)})"""
ORACLE["w4_trade_fwd_logret"] = (
    f"WITH {NUMBERED} SELECT symbol, event_id, idx, " + ", ".join(f"{r(f'fwd_logret_{n}', 9)} AS fwd_logret_{n}" for n in FWD) + " FROM fw"
)
ORACLE["w5_ewma_long_series"] = f"""
WITH RECURSIVE {TRADES},
nm AS (SELECT symbol, event_id, p, row_number() OVER (PARTITION BY symbol ORDER BY ts, event_id) - 1 AS idx FROM tr),
near AS (SELECT a.symbol, a.event_id, sum({ALPHA} * pow({BETA}, a.idx - b.idx) * b.p) AS e
         FROM nm a JOIN nm b ON a.symbol = b.symbol AND b.idx <= a.idx AND b.idx > a.idx - 1200 GROUP BY a.symbol, a.event_id)
SELECT symbol, event_id, {r('e')} AS ewma FROM near"""
STRIDED = " UNION ALL ".join(
    f"SELECT symbol, 'fwd_logret_{n}' AS \"column\", {n} AS horizon, i // {n} AS idx, fwd_logret_{n} AS value FROM cr WHERE i % {n} = 0"
    for n in FWD
)
ORACLE["w7_stride_sample"] = f"WITH {NUMBERED}, st AS ({STRIDED}) SELECT symbol, \"column\", idx, {r('value', 9)} AS value FROM st"
ORACLE["w8_horizon_of_column"] = (
    f"WITH {NUMBERED}, st AS ({STRIDED}) SELECT \"column\", CAST(horizon AS BIGINT) AS horizon, count(*) AS rows FROM st GROUP BY \"column\", horizon"
)

# -- feature derivation --------------------------------------------------------------------------

CARRIED = ", ".join(f"s.{c}" for c in ("mid_price", "spread", "microprice", *BAND_NAMES))
DERIVED = f"""{FEATURED}, {hours(3, 3, 'day')}, {batches(cols=CARRIED, source="ft")}, {VARIANCE},
dv AS (SELECT *, sqrt(variance_proxy) AS volatility, {", ".join(f"{e} AS {n}" for n, e in (fwd() | past()).items())}
       FROM x2 {W}),
fe AS (SELECT *, h < t AS is_context FROM dv WHERE {KEPT})"""
P1_COLS = ["mid_price", "log_return", "variance_proxy", "volatility", "spread", "microprice",
           *fwd(), *past(), *BAND_NAMES]
ORACLE["p1_derive_features"] = (
    f"WITH {DERIVED} SELECT symbol, epoch_us(ts) AS timestamp_us, epoch_us(h) AS trading_hour_us, is_context, "
    + ", ".join(f"{r(c)} AS {c}" for c in P1_COLS) + " FROM fe"
)
ORACLE["p1_minimum_slice"] = f"""
WITH {LEVELS}, b AS (SELECT symbol, ts, date_trunc('day', ts) AS t, mid AS mid_price, ba - bb AS spread FROM sn), {VARIANCE}
SELECT symbol, epoch_us(ts) AS timestamp_us, epoch_us(t) AS trading_hour_us, {r('mid_price', 8)} AS mid_price,
       {r('spread', 8)} AS spread, {r('log_return', 8)} AS log_return, {r('variance_proxy', 8)} AS variance_proxy,
       {r('sqrt(variance_proxy)', 8)} AS volatility FROM x2"""
SELECTED = ["log_return", "volatility", "spread", "microprice", *past(), *BAND_NAMES]
ORACLE["t1_select_features"] = f"WITH {DERIVED} SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS rows FROM fe" for c in SELECTED
) + ") WHERE rows > 0"

# -- transforms ----------------------------------------------------------------------------------

LINE = "ll AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM lineitem" for c in LINE_FEATURES) + ")"


def skew_pop(v: str, m: str, m2: str) -> str:
    return f"avg(pow({v} - {m}, 3)) / pow({m2}, 1.5::DOUBLE)"


ORACLE["t2_feature_stats"] = f"""
WITH {LINE}, m AS (SELECT feature, avg(value) AS mu, var_pop(value) AS m2 FROM ll GROUP BY feature)
SELECT feature, count(*) AS n, {r('avg(value)', 5)} AS mean, {r('stddev_pop(value)', 5)} AS std, {r('min(value)', 5)} AS min,
       {r('max(value)', 5)} AS max, {r(skew_pop('value', 'mu', 'any_value(m2)'), 5)} AS skew
FROM ll JOIN m USING (feature) GROUP BY feature"""
ORACLE["t3_candidate_values"] = f"""
WITH {LINE}, l2 AS (SELECT feature, CASE WHEN feature = 'l_tax' THEN value - 0.04::DOUBLE ELSE value END AS x FROM ll),
o AS (SELECT feature, min(x) AS lo FROM l2 GROUP BY feature),
c AS (SELECT feature, 'identity' AS candidate, NULL::DOUBLE AS off, x AS y FROM l2
 UNION ALL SELECT feature, 'asinh', NULL, asinh(x) FROM l2
 UNION ALL SELECT feature, 'log', CASE WHEN lo > 0 THEN 0 ELSE abs(lo) + 1.0 END,
                  ln(x + CASE WHEN lo > 0 THEN 0 ELSE abs(lo) + 1.0 END) FROM l2 JOIN o USING (feature) WHERE lo >= -1e6
 UNION ALL SELECT feature, 'sqrt', CASE WHEN lo >= 0 THEN 0 ELSE abs(lo) + 0.1 END,
                  sqrt(x + CASE WHEN lo >= 0 THEN 0 ELSE abs(lo) + 0.1 END) FROM l2 JOIN o USING (feature) WHERE lo >= -1e6)
SELECT feature, candidate, count(*) AS n, {r('max(off)', 9)} AS "offset", {r('avg(y)', 9)} AS mean, {r('max(y)', 9)} AS max
FROM c GROUP BY feature, candidate"""
GRID = "gr AS (SELECT unnest([" + ", ".join(f"{g}::DOUBLE" for g in LAMBDA_GRID) + "]) AS lam)"
BOXCOX = "CASE WHEN lam = 0 THEN ln(value) ELSE (pow(value, lam) - 1) / lam END"
YEO = ("CASE WHEN value >= 0 THEN CASE WHEN lam = 0 THEN ln(1 + value) ELSE (pow(1 + value, lam) - 1) / lam END "
       "ELSE CASE WHEN lam = 2 THEN -ln(1 - value) ELSE -(pow(1 - value, 2 - lam) - 1) / (2 - lam) END END")
ORACLE["t4_lambda_profile"] = f"""
WITH {LINE}, {GRID},
y AS (SELECT feature, 'yeo-johnson' AS family, lam, {YEO} AS y, sign(value) * ln(1 + abs(value)) AS s FROM ll, gr
      UNION ALL SELECT feature, 'box-cox', lam, {BOXCOX}, ln(value) FROM ll, gr WHERE feature IN ('l_quantity', 'l_extendedprice'))
SELECT feature, family, {r('lam', 1)} AS lambda, {r('-count(*) / 2.0 * ln(var_pop(y)) + (lam - 1) * sum(s)', 2)} AS llf
FROM y GROUP BY feature, family, lam"""
ORACLE["t8_apply_transforms"] = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {r('CASE WHEN l_quantity > 0 THEN ln(l_quantity) END')} AS l_quantity,
       {r('CASE WHEN l_extendedprice > 0 THEN (pow(l_extendedprice, 0.3::DOUBLE) - 1) / 0.3::DOUBLE END')} AS l_extendedprice,
       {r('CASE WHEN l_discount >= 0 THEN sqrt(l_discount) END')} AS l_discount,
       {r('(pow(1 + l_tax, -1.5::DOUBLE) - 1) / -1.5::DOUBLE')} AS l_tax FROM lineitem"""

# -- standardization -----------------------------------------------------------------------------

STD = f"""{LEVELS},
zp AS (SELECT lv.sid, lv.symbol, lv.ts, (p - mid) / (greatest(sqrt(pow(0.5::DOUBLE / mid, 2)) * mid, 1e-6::DOUBLE) + 1e-8::DOUBLE) AS z,
              p, v, v / sum(v) OVER (PARTITION BY lv.sid) AS share FROM lv JOIN sn USING (sid))"""
ORACLE["z1_standardize_prices"] = f"WITH {STD} SELECT symbol, epoch_us(ts) AS timestamp_us, {r('z')} AS price, {r('v')} AS volume FROM zp"
ORACLE["z2_normalize_volumes"] = f"WITH {STD} SELECT symbol, epoch_us(ts) AS timestamp_us, {r('p')} AS price, {r('share')} AS volume FROM zp"
ORACLE["z3_flatten_book"] = f"WITH {STD} SELECT symbol, epoch_us(ts) AS timestamp_us, {r('p')} AS prices, {r('v')} AS volumes FROM zp"


def bins(source: str, n: int) -> str:
    """Bins from rows (sid, z, share): edges as lo + i * step, a value belongs to the last edge at or below it."""
    half = n // 2
    edge = f"CASE WHEN i = {n} THEN hi ELSE i * ((hi - lo) / {n}) + lo END"
    return f"""
rg AS (SELECT sid, min(z) AS lo, max(z) AS hi FROM {source} WHERE share > 0 GROUP BY sid),
ed AS (SELECT sid, i, {edge} AS e FROM rg, (SELECT unnest(range(0, {n + 1})) AS i)),
bn AS (SELECT s.sid, s.share, least(greatest((SELECT count(*) FROM ed WHERE ed.sid = s.sid AND ed.e <= s.z) - 1, 0), {n - 1}) AS bin
       FROM {source} s WHERE share > 0),
zb AS (SELECT sid, least(greatest(count(*) FILTER (e < 0) - 1, 0), {n}) AS zb FROM ed GROUP BY sid),
bs AS (SELECT sid, bin, sum(share) AS vol FROM bn GROUP BY sid, bin),
gd AS (SELECT sid, zb, unnest(range(0, {half})) AS j FROM zb),
bb AS (SELECT gd.sid, j, coalesce(n.vol, 0) AS neg_bins, coalesce(p.vol, 0) AS pos_bins FROM gd
       LEFT JOIN bs n ON n.sid = gd.sid AND n.bin = zb - {half} + j
       LEFT JOIN bs p ON p.sid = gd.sid AND p.bin = zb + j)"""


ORACLE["z4_uniform_bins"] = f"""WITH {STD}, {bins('zp', 10)}
SELECT symbol, epoch_us(ts) AS timestamp_us, j AS bin, {r('neg_bins')} AS neg_bins, {r('pos_bins')} AS pos_bins FROM bb JOIN sn USING (sid)"""


def scaled(feats: list[str], source: str = "b") -> str:
    w = "(PARTITION BY symbol, t ORDER BY ts ROWS UNBOUNDED PRECEDING)"
    centre = ", ".join(f"{f} - {ALPHA} * pow({BETA}, rn) * sum({f} * pow({BETA}, -rn)) OVER {w} AS c_{f}" for f in feats)
    z = ", ".join(
        f"least(3.0::DOUBLE, greatest(-3.0::DOUBLE, c_{f} / sqrt({ALPHA} * pow({BETA}, rn) * sum(c_{f} * c_{f} * pow({BETA}, -rn)) OVER {w} + 1e-12::DOUBLE))) AS z_{f}"
        for f in feats
    )
    return f"""
e0 AS (SELECT *, row_number() OVER (PARTITION BY symbol, t ORDER BY ts) - 1 AS rn FROM {source}),
e1 AS (SELECT *, {centre} FROM e0), e2 AS (SELECT *, {z} FROM e1)"""


_Z6 = ["spread", "depth_all", "depth_imbalance_top_3", "liquidity_spread_all"]
_ZB = f"{FEATURED}, {hours(2, 0, 'day')}, {batches(2, 0, CARRIED, 'ft')}"
ORACLE["z5_ewma_scale_one"] = f"WITH {_ZB}, {scaled(['spread'])} SELECT {BKEY}, {r('z_spread')} AS spread FROM e2"
ORACLE["z6_ewma_scale_all"] = (
    f"WITH {_ZB}, {scaled(_Z6)} SELECT {BKEY}, " + ", ".join(f"{r(f'z_{f}')} AS {f}" for f in _Z6) + " FROM e2"
)
_Z7 = ["spread", "volatility", "depth_all"]
ORACLE["z7_run_standardize"] = f"""
WITH {DERIVED}, fs AS (SELECT fe.* EXCLUDE (h, t, hour_no, rn), sn.sid FROM fe JOIN sn USING (symbol, ts)),
{hours(2, 0, 'day', 'fs', 't2')}, {batches(2, 0, 's.spread, s.volatility, s.depth_all, s.fwd_logret_2, s.is_context, s.sid', 'fs', 'b2', 't2')},
{scaled(_Z7, 'b2')},
zq AS (SELECT lv.sid, (p - mid_price) / (greatest(sqrt(variance_proxy) * mid_price, 1e-6::DOUBLE) + 1e-8::DOUBLE) AS z,
              v / sum(v) OVER (PARTITION BY lv.sid) AS share FROM lv JOIN fs USING (sid)),
{bins('zq', 10)},
tot AS (SELECT sid, sum(neg_bins) AS neg_volume, sum(pos_bins) AS pos_volume FROM bb GROUP BY sid)
SELECT symbol, epoch_us(ts) AS timestamp_us, epoch_us(h) AS trading_hour_us, {", ".join(f"{r(f'z_{f}')} AS {f}" for f in _Z7)},
       {r('fwd_logret_2')} AS fwd_logret_2, {r('neg_volume')} AS neg_volume, {r('pos_volume')} AS pos_volume
FROM e2 JOIN tot USING (sid) WHERE h = t AND NOT is_context"""

# -- messages ------------------------------------------------------------------------------------

MESSAGES = """
m0 AS (SELECT *, (event_id // 10) % 50 = 0 AS pt, min(ts) OVER (PARTITION BY event_id // 10) AS first_ts FROM events),
ms AS (SELECT 'X' AS symbol, CASE WHEN pt THEN (event_id // 10) * 10 ELSE event_id END AS seq,
       CASE WHEN pt THEN event_id - (event_id // 10) * 10 ELSE 0 END AS pos, CASE WHEN pt THEN first_ts ELSE ts END AS ts,
       CASE WHEN pt THEN 'partial' WHEN event_type IN ('signup', 'view') THEN 'insert'
            WHEN event_type IN ('click', 'error') THEN 'update' ELSE 'delete' END AS action,
       user_id AS id, 1000.0::DOUBLE + (event_id % 40) * 0.5::DOUBLE AS price, value AS size,
       CASE WHEN user_id % 2 = 0 THEN 'Buy' ELSE 'Sell' END AS side FROM m0)"""
INTERVALS = f"""{MESSAGES},
ep AS (SELECT *, sum(CASE WHEN action = 'partial' AND pos = 0 THEN 1 ELSE 0 END) OVER (ORDER BY seq, pos) AS epoch FROM ms),
es AS (SELECT epoch, min(ts) AS ts FROM ep WHERE action = 'partial' AND pos = 0 GROUP BY epoch),
sg AS (SELECT *, sum(CASE WHEN action <> 'update' THEN 1 ELSE 0 END) OVER (PARTITION BY epoch, id ORDER BY seq, pos) AS seg FROM ep),
iv AS (SELECT symbol, id, size, ts AS valid_from, epoch, seg, first_value(action) OVER s AS opened, first_value(price) OVER s AS price,
       first_value(side) OVER s AS side, lead(ts) OVER (PARTITION BY epoch, id ORDER BY seq, pos) AS nxt
       FROM sg WINDOW s AS (PARTITION BY epoch, id, seg ORDER BY seq, pos)),
bi AS (SELECT symbol, id, price, size, side, valid_from, coalesce(nxt, es.ts) AS valid_to
       FROM iv LEFT JOIN es ON es.epoch = iv.epoch + 1 WHERE seg > 0 AND opened IN ('insert', 'partial'))"""
LEVEL_OUT = f"symbol, id, {r('price')} AS price, {r('size')} AS size, side"
_ENTRY = (f"WITH {MESSAGES} SELECT symbol, seq, CAST(pos AS BIGINT) AS pos, epoch_us(ts) AS ts_us, action, id, {r('price')} AS price, "
          f"{r('size')} AS size, side FROM ms")
ORACLE["b1_l2_messages"] = _ENTRY
ORACLE["b1_l2_messages_stream"] = _ENTRY
ORACLE["b2b_book_intervals"] = (
    f"WITH {INTERVALS} SELECT {LEVEL_OUT}, epoch_us(valid_from) AS valid_from_us, epoch_us(valid_to) AS valid_to_us FROM bi"
)
ORACLE["b2b_book_at_end"] = f"WITH {INTERVALS} SELECT {LEVEL_OUT} FROM bi WHERE valid_to IS NULL"
ORACLE["b2a_maintain_book"] = ORACLE["b2b_book_at_end"]
_DELAYED = INTERVALS.replace("ms AS (SELECT 'X'", "m1 AS (SELECT 'X'", 1).replace(" FROM m0)", """ FROM m0),
m2 AS (SELECT *, (seq + CASE WHEN seq % 7 = 0 THEN 40 ELSE 0 END) // (SELECT count(*) // 5 + 1 FROM events) AS file FROM m1),
m3 AS (SELECT *, max(seq) OVER (ORDER BY file RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= seq AS late FROM m2),
ms AS (SELECT * FROM m3 WHERE late IS NOT TRUE)""", 1)
ORACLE["b2a_late_entries"] = f"""WITH {_DELAYED},
lt AS (SELECT symbol, count(*) AS late_entries, count(DISTINCT id) AS levels FROM m3 WHERE late GROUP BY symbol),
lb AS (SELECT symbol, count(*) AS live, sum(size) AS volume FROM bi WHERE valid_to IS NULL GROUP BY symbol)
SELECT symbol, late_entries, levels, live, {r('volume')} AS volume FROM lt JOIN lb USING (symbol)"""
SIX_HOURS = 6 * 3600 * 1_000_000
TICKS = f"""{INTERVALS},
lim AS (SELECT epoch_us(min(ts)) // {SIX_HOURS} AS a, epoch_us(max(ts)) // {SIX_HOURS} AS z FROM events),
tk AS (SELECT unnest(range(a, z + 1)) * {SIX_HOURS} AS tick FROM lim),
sl AS (SELECT symbol, tick, id, price, size, side FROM bi JOIN tk ON epoch_us(valid_from) <= tick AND (valid_to IS NULL OR tick < epoch_us(valid_to)))"""
_TICK_OUT = f"WITH {TICKS} SELECT symbol, tick AS tick_us, id, {r('price')} AS price, {r('size')} AS size, side FROM sl"
ORACLE["b4_sample_snapshots"] = _TICK_OUT
ORACLE["b4_sample_snapshots_stream"] = _TICK_OUT
ORACLE["b3_book_sides"] = f"""WITH {TICKS}
SELECT symbol, tick AS tick_us, CASE WHEN side = 'Buy' THEN 'bid' ELSE 'ask' END AS side, {r('price')} AS price, {r('size')} AS size,
       row_number() OVER (PARTITION BY symbol, tick, side ORDER BY CASE WHEN side = 'Buy' THEN -price ELSE price END,
                          CASE WHEN side = 'Buy' THEN -size ELSE size END) - 1 AS level FROM sl"""
ORACLE["b8_top_of_book"] = f"""WITH {TICKS},
tb AS (SELECT symbol, tick, max(price) FILTER (side = 'Buy') AS bb, min(price) FILTER (side <> 'Buy') AS ba FROM sl GROUP BY symbol, tick)
SELECT symbol, tick AS tick_us, {r('CASE WHEN ba IS NOT NULL THEN bb END')} AS best_bid, {r('CASE WHEN bb IS NOT NULL THEN ba END')} AS best_ask,
       {r('ba - bb')} AS top_spread FROM tb"""
ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"
_SIDE_SUMS = ", ".join(
    f"{r(f'coalesce(sum({c}) FILTER ({side}), 0)')} AS {name}"
    for side, stem in (("is_bid", "bids"), ("NOT is_bid", "asks")) for c, name in (("p", f"{stem}_price"), ("v", f"{stem}_volume"))
)
ORACLE["b5_encode_snapshots"] = f"""WITH {LEVELS} SELECT symbol, {ISO} AS timestamp, count(*) FILTER (is_bid) AS n_bids,
  count(*) FILTER (NOT is_bid) AS n_asks, {_SIDE_SUMS} FROM lv GROUP BY sid, symbol, ts"""
ORACLE["b6_write_daily"] = f"WITH {LEVELS} SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS rows FROM sn GROUP BY 1"
ORACLE["b7_damaged_files"] = f"WITH {LEVELS} SELECT count(*) AS rows, 'date=2024-02-01/broken.parquet' AS bad FROM sn"

# -- ingest --------------------------------------------------------------------------------------

ORACLE["i1_scan_snapshots"] = f"WITH {LEVELS} SELECT symbol, count(*) AS rows, min({ISO}) AS first FROM sn GROUP BY symbol"
_TYPED = f"""WITH {LEVELS} SELECT symbol, epoch_us(ts) AS timestamp_us, count(*) FILTER (is_bid) AS n_bids, count(*) FILTER (NOT is_bid) AS n_asks,
  {r('sum(p) FILTER (is_bid)')} AS bids_price, {r('sum(v) FILTER (is_bid)')} AS bids_volume,
  {r('sum(p) FILTER (NOT is_bid)')} AS asks_price, {r('sum(v) FILTER (NOT is_bid)')} AS asks_volume FROM lv GROUP BY sid, symbol, ts"""
ORACLE["i2_parse_lob"] = _TYPED
ORACLE["i5_append_raw"] = _TYPED
ORACLE["i3_pending_files"] = (
    f"WITH {LEVELS} SELECT DISTINCT strftime(ts, '%Y-%m-%d') || '.parquet' AS filename FROM sn WHERE day(ts) % 2 = 1"
)
ORACLE["i4_ingest_log"] = f"""WITH {LEVELS}, d AS (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM sn GROUP BY 1),
  a AS (SELECT n FROM d UNION ALL SELECT 0)
SELECT 'Raw LOB' AS type, n AS record_count, count(*) AS files FROM a GROUP BY n"""
ORACLE["i4_ingest_stream"] = ORACLE["i4_ingest_log"]
ORACLE["i5_stream_table"] = _TYPED
ORACLE["i6_load_raw"] = f"WITH {LEVELS} SELECT symbol, epoch_us(ts) AS timestamp_us FROM sn WHERE ts >= TIMESTAMP '2024-01-10'"
ORACLE["i7_sample_rows"] = f"""WITH {TRADES} SELECT event_id, symbol, {r('p')} AS last_traded_price FROM tr WHERE event_id % 5 <> 0
ORDER BY md5('7|' || event_id), event_id LIMIT 500"""
ORACLE["i8_write_table"] = f"WITH {TRADES} SELECT symbol, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids FROM tr GROUP BY symbol"
ORACLE["i9_context_breakdown"] = "SELECT event_id % 5 = 0 AS is_context, count(*) AS rows FROM events GROUP BY 1"

# -- statistics ----------------------------------------------------------------------------------

SERIES = NUMBERED + ", se AS (" + " UNION ALL ".join(
    f"SELECT symbol || '/fwd_logret_{n}' AS series, i // {n} AS idx, fwd_logret_{n} AS value FROM cr WHERE i % {n} = 0" for n in STRIDES
) + ")"
MOMENTS = """
mo0 AS (SELECT series, count(*) AS n, avg(value) AS mu, min(value) AS lo, max(value) AS hi FROM se GROUP BY series),
mo AS (SELECT series, any_value(n) AS n, any_value(mu) AS mu, any_value(lo) AS lo, any_value(hi) AS hi, avg(pow(value - mu, 2)) AS m2,
       avg(pow(value - mu, 3)) / pow(avg(pow(value - mu, 2)), 1.5::DOUBLE) AS g1,
       avg(pow(value - mu, 4)) / pow(avg(pow(value - mu, 2)), 2) - 3 AS g2 FROM se JOIN mo0 USING (series) GROUP BY series)"""
_PCT = {"p01": 0.01, "p05": 0.05, "q25": 0.25, "median": 0.5, "q75": 0.75, "p95": 0.95, "p99": 0.99}
ORACLE["s1_describe_series"] = f"""
WITH {LINE.replace('AS feature', 'AS series').replace('ll AS', 'se AS')}, {MOMENTS},
q AS (SELECT series, count(DISTINCT value) AS u, {", ".join(f"quantile_cont(value, {p}) AS {n}" for n, p in _PCT.items())} FROM se GROUP BY series)
SELECT series, n, 0::BIGINT AS missing, u AS "unique", u <= 1 AS is_constant, {r('mu', 5)} AS mean, {r('sqrt(m2 * n / (n - 1))', 5)} AS std,
       {r('g1 * sqrt(n * (n - 1.0::DOUBLE)) / (n - 2)', 5)} AS skew,
       {r('(n - 1) / ((n - 2.0::DOUBLE) * (n - 3.0::DOUBLE)) * ((n + 1) * g2 + 6)', 5)} AS kurtosis_excess, {r('lo', 5)} AS min,
       {", ".join(f"{r(n, 5)} AS {n}" for n in _PCT)}, {r('hi', 5)} AS max FROM mo JOIN q USING (series)"""
K2 = """
k0 AS (SELECT *, CAST(n AS DOUBLE) AS d FROM mo),
k1 AS (SELECT *, g1 * sqrt((d + 1) * (d + 3) / (6 * (d - 2))) AS y,
  3 * (d * d + 27 * d - 70) * (d + 1) * (d + 3) / ((d - 2) * (d + 5) * (d + 7) * (d + 9)) AS be,
  (g2 + 3 - 3 * (d - 1) / (d + 1)) / sqrt(24 * d * (d - 2) * (d - 3) / ((d + 1) * (d + 1) * (d + 3) * (d + 5))) AS x,
  6 * (d * d - 5 * d + 2) / ((d + 7) * (d + 9)) * sqrt(6 * (d + 3) * (d + 5) / (d * (d - 2) * (d - 3))) AS rb FROM k0),
k2 AS (SELECT *, -1 + sqrt(2 * (be - 1)) AS w2, 6 + 8 / rb * (2 / rb + sqrt(1 + 4 / (rb * rb))) AS a FROM k1),
k3 AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5::DOUBLE * ln(w2)) AS z1, 1 + x * sqrt(2 / (a - 4)) AS dn FROM k2),
kk AS (SELECT *, pow(z1, 2) + pow((1 - 2 / (9 * a) - sign(dn) * pow((1 - 2 / a) / abs(dn), 1.0::DOUBLE / 3)) / sqrt(2 / (9 * a)), 2) AS k2s FROM k3)"""
ORACLE["s3_k2_test"] = f"WITH {SERIES}, {MOMENTS}, {K2} SELECT series, n, {r('k2s')} AS k2_stat, {r('exp(-k2s / 2)')} AS k2_p FROM kk"
JB = "(n / 6.0::DOUBLE * (g1 * g1 + g2 * g2 / 4))"
ORACLE["s4_jarque_bera"] = f"WITH {SERIES}, {MOMENTS} SELECT series, n, {r(JB)} AS jb_stat, {r(f'exp(-{JB} / 2)')} AS jb_p FROM mo"


def ljung(kind: str, value: str, lags: tuple[int, ...]) -> str:
    listed_lags = ", ".join(map(str, lags))
    return f"""
v_{kind} AS (SELECT se.series, idx, {value} AS y FROM se JOIN mo0 USING (series)),
d_{kind} AS (SELECT series, idx, y - avg(y) OVER (PARTITION BY series) AS y, count(*) OVER (PARTITION BY series) AS n FROM v_{kind}),
g_{kind} AS (SELECT series, any_value(n) AS n, sum(y * y) AS s0 FROM d_{kind} GROUP BY series),
r_{kind} AS (SELECT a.series, b.k AS k, sum(a.y * c.y) AS s FROM d_{kind} a, (SELECT unnest(range(1, {max(lags) + 1})) AS k) b
        JOIN d_{kind} c ON c.series = a.series AND c.idx = a.idx - b.k GROUP BY a.series, b.k),
t_{kind} AS (SELECT g.series, g.n, l.lags, g.n * (g.n + 2.0::DOUBLE) * sum(pow(s / s0, 2) / (g.n - k)) FILTER (k <= l.lags) AS q
        FROM g_{kind} g JOIN r_{kind} USING (series), (SELECT unnest([{listed_lags}]) AS lags) l GROUP BY g.series, g.n, l.lags),
lb_{kind} AS (SELECT series, n, lags, CASE WHEN n > lags THEN q END AS q,
        CASE WHEN n > lags THEN list_sum(list_transform(range(0, CAST(lags // 2 AS BIGINT)), lambda i: exp(-q / 2 + i * ln(q / 2) - lgamma(i + 1)))) END AS p FROM t_{kind})"""


_KINDS = {"value": "value", "square": "value * value", "demeaned_square": "pow(value - mu, 2)"}
ORACLE["s6_ljung_box"] = f"WITH {SERIES}, {MOMENTS}, " + ",".join(ljung(k, v, (10, 20, 40)) for k, v in _KINDS.items()) + " " + " UNION ALL ".join(
    f"SELECT series, n, CAST(lags AS BIGINT) AS lags, {r('q')} AS lb_stat, {r('p')} AS lb_p, '{k}' AS \"of\" FROM lb_{k}" for k in _KINDS
)
ORACLE["s7_arch_lm_lag1"] = f"""
WITH {SERIES}, {MOMENTS}, e AS (SELECT se.series, idx, pow(value - mu, 2) AS e FROM se JOIN mo0 USING (series)),
p AS (SELECT series, e, lag(e) OVER (PARTITION BY series ORDER BY idx) AS x FROM e),
f AS (SELECT series, count(x) AS m, regr_r2(e, x) AS r2 FROM p WHERE x IS NOT NULL GROUP BY series)
SELECT series, n, 1::BIGINT AS arch_lags, {r('m * r2')} AS arch_lm_stat, {r('r2 / ((1 - r2) / (m - 2))')} AS arch_f_stat FROM f JOIN mo0 USING (series)"""
ORACLE["s9_kpss"] = f"""
WITH {SERIES}, {MOMENTS}, e AS (SELECT se.series, idx, value - mu AS e, n FROM se JOIN mo0 USING (series)),
c AS (SELECT a.series, k.k, a.n, sum(a.e * b.e) AS s FROM e a, (SELECT unnest(range(0, 400)) AS k) k
      JOIN e b ON b.series = a.series AND b.idx = a.idx - k.k GROUP BY a.series, k.k, a.n),
s AS (SELECT series, n, sum(CASE WHEN k = 0 THEN s / n ELSE 2 * s / n END) AS s0, sum(k * 2 * s / n) AS s1 FROM c
      WHERE k <= floor(pow(n, 2.0::DOUBLE / 9) + 1e-9::DOUBLE) GROUP BY series, n),
l AS (SELECT series, n, least(CAST(floor(1.1447::DOUBLE * pow(pow(s1 / s0, 2), 1.0::DOUBLE / 3) * pow(n, 1.0::DOUBLE / 3)) AS BIGINT), n - 1) AS lags FROM s),
v AS (SELECT c.series, l.lags, l.n, sum(CASE WHEN k = 0 THEN s ELSE 2 * s * (1 - k / (lags + 1.0::DOUBLE)) END) / l.n AS lrv
      FROM c JOIN l USING (series) WHERE k <= lags GROUP BY c.series, l.lags, l.n),
p AS (SELECT series, sum(e) OVER (PARTITION BY series ORDER BY idx) AS s FROM e),
t AS (SELECT v.series, v.n, lags, sum(s * s) / (CAST(v.n AS DOUBLE) * v.n) / lrv AS stat FROM p JOIN v USING (series) GROUP BY v.series, v.n, lags, lrv)
SELECT series, n, lags AS kpss_lags, {r('stat')} AS kpss_stat,
  {r('''CASE WHEN stat <= 0.347 THEN 0.1 WHEN stat <= 0.463 THEN 0.1::DOUBLE + (stat - 0.347) / 0.116 * -0.05
        WHEN stat <= 0.574 THEN 0.05::DOUBLE + (stat - 0.463) / 0.111 * -0.025
        WHEN stat <= 0.739 THEN 0.025::DOUBLE + (stat - 0.574) / 0.165 * -0.015 ELSE 0.01 END''')} AS kpss_p FROM t"""
ORACLE["s11_interpret"] = f"""
WITH {SERIES}, {MOMENTS}, {K2}, {ljung('square', 'value * value', (10,))},
p AS (SELECT kk.*, exp(-k2s / 2) AS k2p, exp(-{JB} / 2) AS jbp, lb.p AS ap FROM kk JOIN (SELECT series, p FROM lb_square) lb USING (series))
SELECT series, n, {r('mu')} AS mean, {r('sqrt(m2)')} AS std, {r('g1')} AS skew, {r('g2')} AS kurtosis_excess,
  CASE WHEN least(k2p, jbp) < 0.05 THEN 'not normal' ELSE 'normal' END AS normality,
  CASE WHEN ap IS NULL THEN 'unknown' WHEN k2p < 0.05 AND ap >= 0.05 THEN 'stationary' WHEN k2p >= 0.05 AND ap < 0.05 THEN 'non-stationary'
       ELSE 'conflicting' END AS stationarity,
  CASE WHEN ap IS NULL THEN 'unknown' WHEN ap < 0.05 THEN 'ARCH effects' ELSE 'homoskedastic' END AS heteroskedasticity FROM p"""

RANKED = ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS {c}" for c in LINE_FEATURES
)
_PAIRS = [(a, b) for i, a in enumerate(LINE_FEATURES) for b in LINE_FEATURES[i + 1:]]
_TARGETS = [(a, b) for a in LINE_FEATURES[:2] for b in LINE_FEATURES[2:]]


def rho(pairs) -> str:
    return f"rk AS (SELECT {RANKED} FROM lineitem), rho AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS rho FROM rk" for a, b in pairs
    ) + ")"


ORACLE["s14_spearman_matrix"] = f"WITH {rho(_PAIRS)} SELECT feature_a, feature_b, {r('rho')} AS rho FROM rho"
ORACLE["s15_spearman_targets"] = f"WITH {rho(_TARGETS)} SELECT feature_a, feature_b, {r('rho')} AS rho FROM rho"
ORACLE["s14_spearman_summary"] = f"""WITH {rho(_PAIRS)}, st AS (SELECT avg(rho) AS mean, max(rho) AS max, min(rho) AS min, stddev_pop(rho) AS std, avg(abs(rho)) AS abs_mean FROM rho),
tp AS (SELECT feature_a || '/' || feature_b AS what, rho AS v FROM rho ORDER BY abs(rho) DESC, feature_a, feature_b LIMIT 3)
SELECT what, {r('v')} AS v FROM (SELECT * FROM tp UNION ALL UNPIVOT st ON mean, max, min, std, abs_mean INTO NAME what VALUE v)"""
_EDGES = ", ".join(f"quantile_cont({c}, [{', '.join(str(i / 10) for i in range(1, 10))}]) AS {c}" for c in LINE_FEATURES)
_BINNED = f"ed AS (SELECT {_EDGES} FROM lineitem), bi AS (SELECT " + ", ".join(
    f"len(list_filter(ed.{c}, lambda e: e <= lineitem.{c})) AS {c}" for c in LINE_FEATURES
) + " FROM lineitem, ed)"


def mi(pairs) -> str:
    joint = " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {a} AS x, {b} AS y, count(*) AS c FROM bi GROUP BY {a}, {b}" for a, b in pairs
    )
    return f"""{_BINNED}, jc AS ({joint}),
jm AS (SELECT *, sum(c) OVER (PARTITION BY feature_a, feature_b) AS n, sum(c) OVER (PARTITION BY feature_a, feature_b, x) AS cx,
       sum(c) OVER (PARTITION BY feature_a, feature_b, y) AS cy FROM jc)"""


_MI = f"SELECT feature_a, feature_b, {r('sum(c / CAST(n AS DOUBLE) * ln(CAST(c AS DOUBLE) * n / (CAST(cx AS DOUBLE) * cy)))', 8)} AS mi FROM jm GROUP BY feature_a, feature_b"
ORACLE["s16_mi_matrix"] = f"WITH {mi(_PAIRS)} {_MI}"
ORACLE["s17_mi_targets"] = f"WITH {mi(_TARGETS)} {_MI}"
ORACLE["s18_lagged_mi"] = f"""
WITH {SERIES}, eg AS (SELECT series, quantile_cont(value, [{', '.join(str(i / 10) for i in range(1, 10))}]) AS q FROM se GROUP BY series),
b AS (SELECT se.series, idx, len(list_filter(q, lambda e: e <= value)) AS b FROM se JOIN eg USING (series)),
j AS (SELECT a.series, k AS lag, c.b AS x, a.b AS y, count(*) AS c FROM b a, (SELECT unnest(range(1, 21)) AS k) JOIN b c ON c.series = a.series AND c.idx = a.idx - k
      GROUP BY a.series, k, c.b, a.b),
m AS (SELECT *, CAST(sum(c) OVER (PARTITION BY series, lag) AS DOUBLE) AS n, CAST(sum(c) OVER (PARTITION BY series, lag, x) AS DOUBLE) AS cx,
      CAST(sum(c) OVER (PARTITION BY series, lag, y) AS DOUBLE) AS cy FROM j)
SELECT series, lag, CAST(n AS BIGINT) AS pairs, {r('CASE WHEN n >= 50 THEN sum(c / n * ln(c * n / (cx * cy))) END')} AS mi FROM m GROUP BY series, lag, n"""
ORACLE["s19_quantile_acf"] = f"""
WITH {SERIES}, tq AS (SELECT series, unnest([0.01::DOUBLE, 0.05::DOUBLE, 0.1::DOUBLE]) AS tau, unnest(quantile_cont(value, [0.01, 0.05, 0.1])) AS thr FROM se GROUP BY series),
i AS (SELECT se.series, tau, idx, CASE WHEN value <= thr THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS i FROM se JOIN tq USING (series)),
p AS (SELECT a.series, a.tau, k AS lag, a.i AS x, b.i AS y FROM i a, (SELECT unnest(range(1, 21)) AS k) JOIN i b ON b.series = a.series AND b.tau = a.tau AND b.idx = a.idx - k),
g AS (SELECT series, tau, lag, CAST(count(*) AS DOUBLE) AS m, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy FROM p GROUP BY series, tau, lag),
d AS (SELECT *, sqrt((m * sx - sx * sx) * (m * sy - sy * sy)) AS den FROM g)
SELECT series, {r('tau')} AS tau, lag, CAST(m AS BIGINT) AS pairs, {r('CASE WHEN m >= 10 AND den > 0 THEN (m * sxy - sx * sy) / den END')} AS qacf FROM d"""
ORACLE["s20_runs_test"] = f"""
WITH {SERIES}, s AS (SELECT series, idx, sign(value) AS s FROM se WHERE value <> 0),
c AS (SELECT series, count(*) AS n, avg(s) AS cut FROM s GROUP BY series),
u AS (SELECT s.series, n, s >= cut AS up, lag(s >= cut) OVER (PARTITION BY s.series ORDER BY idx) AS was FROM s JOIN c USING (series)),
a AS (SELECT series, n, CAST(count(*) FILTER (up) AS DOUBLE) AS pos, CAST(1 + count(*) FILTER (up <> was) AS DOUBLE) AS runs FROM u GROUP BY series, n),
z AS (SELECT *, 2 * pos * (n - pos) AS two FROM a),
y AS (SELECT *, CASE WHEN n >= 50 AND two > n THEN (runs - (two / n + 1)) / sqrt(two * (two - n) / (CAST(n AS DOUBLE) * n) / (n - 1)) END AS z FROM z)
SELECT series, n, {r('runs')} AS runs, {r('z')} AS z, CASE WHEN z IS NOT NULL THEN {r('2 * ' + tail_sql('abs(z)'))} END AS p,
       CASE WHEN n < 50 THEN 'not enough non-zero signs' ELSE '' END AS note FROM y"""
ORACLE["s24_histogram"] = f"""
WITH {SERIES}, {MOMENTS}, sp AS (SELECT series, n, lo, hi, (hi - lo) / 60 AS wd FROM mo0),
h AS (SELECT se.series, least(CAST(floor((value - lo) / wd) AS BIGINT), 59) AS bin, count(*) AS c FROM se JOIN sp USING (series) GROUP BY 1, 2),
g AS (SELECT *, unnest(range(0, 60)) AS bin FROM sp)
SELECT g.series, g.bin, {r('lo + g.bin * wd')} AS left_edge, coalesce(c, 0) AS rows, {r('coalesce(c, 0) / (n * wd)')} AS density
FROM g LEFT JOIN h ON h.series = g.series AND h.bin = g.bin"""
ORACLE["s25_gaussian_kde"] = f"""
WITH {SERIES}, q AS (SELECT series, count(*) AS n, quantile_cont(value, 0.005) AS lo, quantile_cont(value, 0.995) AS hi,
                     stddev_samp(value) * pow(count(*), -0.2::DOUBLE) AS h FROM se GROUP BY series),
g AS (SELECT *, unnest(range(0, 400)) AS point FROM q), gx AS (SELECT *, lo + point * ((hi - lo) / 399) AS x FROM g)
SELECT gx.series, point, {r('any_value(x)')} AS x, {r('sum(exp(-pow((x - value) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi()))')} AS density
FROM gx JOIN se USING (series) GROUP BY gx.series, point"""
NORMAL = """nf AS (SELECT series, count(*) AS n, avg(value) AS mu, stddev_samp(value) AS sigma,
  -count(*) / 2.0::DOUBLE * ln(2 * pi()) - count(*) * ln(stddev_samp(value)) - (count(*) - 1) / 2.0::DOUBLE AS loglik FROM se GROUP BY series)"""
ORACLE["s26_fit_normal"] = (
    f"WITH {SERIES}, {NORMAL} SELECT series, n, 'Normal' AS model, 2::BIGINT AS k, {r('mu')} AS mu, {r('sigma')} AS sigma, {r('loglik')} AS loglik FROM nf"
)
ORACLE["s29_model_ranking"] = (
    f"WITH {SERIES}, {NORMAL} SELECT series, 'Normal' AS model, n, 2::BIGINT AS k, {r('loglik')} AS loglik, {r('4 - 2 * loglik')} AS aic, "
    f"{r('ln(n) * 2 - 2 * loglik')} AS bic FROM nf WHERE n >= 50"
)
_QQ = "CASE WHEN i = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n) WHEN i = 1 THEN 1 - pow(0.5::DOUBLE, 1.0::DOUBLE / n) ELSE (i - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END"
ORDERED = """o AS (SELECT {k}, value, row_number() OVER (PARTITION BY {k} ORDER BY value) AS i, count(*) OVER (PARTITION BY {k}) AS n FROM {t})"""
ORACLE["s30_qq_points"] = f"""
WITH {SERIES}, {ORDERED.format(k='series', t='se')}, q AS (SELECT *, {_QQ} AS position FROM o)
SELECT series, n, i - 1 AS place, {r('position', 9)} AS position, {r(quantile_sql('position'), 9)} AS theoretical, {r('value', 9)} AS ordered FROM q"""


def _powers(coef, x: str) -> str:
    return " + ".join(f"({c!r}::DOUBLE) * pow({x}, {i})" for i, c in enumerate(coef))


def shapiro_ctes(k: str, t: str) -> str:
    """W and p of every group ``k`` of table ``t``, for groups of at least 12 rows."""
    return f"""{ORDERED.format(k=k, t=t)}, op AS (SELECT *, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p FROM o),
om AS (SELECT *, {quantile_sql('p')} AS m FROM op),
w0 AS (SELECT {k}, n, sum(m * m) AS mm, sum(m * value) FILTER (i > 2 AND i < n - 1) AS mx, var_pop(value) * n AS ss,
       max(value) FILTER (i = 1) AS x1, max(value) FILTER (i = 2) AS x2, max(value) FILTER (i = n - 1) AS y2, max(value) FILTER (i = n) AS y1,
       max(m) FILTER (i = n) AS m1, max(m) FILTER (i = n - 1) AS m2 FROM om GROUP BY {k}, n),
w1 AS (SELECT *, {_powers(LAST_WEIGHT, '(1 / sqrt(n))')} + m1 / sqrt(mm) AS a1, {_powers(NEXT_WEIGHT, '(1 / sqrt(n))')} + m2 / sqrt(mm) AS a2 FROM w0),
w2 AS (SELECT {k}, n, least(1, pow(a1 * (y1 - x1) + a2 * (y2 - x2) + mx / sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)), 2) / ss) AS w FROM w1),
w3 AS (SELECT *, (ln(1 - w) - ({_powers(LARGE_MEAN, 'ln(n)')})) / exp({_powers(LARGE_SD, 'ln(n)')}) AS z FROM w2),
sw AS (SELECT {k}, n, w, {tail_sql('z')} AS p FROM w3)"""


ORACLE["s2_shapiro"] = f"WITH {SERIES}, {shapiro_ctes('series', 'se')} SELECT series, n, {r('w')} AS shapiro_stat, {r('p')} AS shapiro_p FROM sw"
ORACLE["t5_normality_score"] = f"""
WITH {LINE}, {shapiro_ctes('feature', 'll')},
m0 AS (SELECT feature, avg(value) AS mu FROM ll GROUP BY feature),
m1 AS (SELECT feature, any_value(mu) AS mean, avg(pow(value - mu, 2)) AS v, avg(pow(value - mu, 3)) AS c, avg(pow(value - mu, 4)) AS d
       FROM ll JOIN m0 USING (feature) GROUP BY feature),
m2 AS (SELECT *, c / pow(v, 1.5::DOUBLE) AS skewness, d / (v * v) - 3 AS excess FROM m1)
SELECT feature, n, {r('mean', 7)} AS mean, {r('sqrt(v)', 7)} AS std, {r('skewness', 7)} AS skewness, {r('excess', 7)} AS excess_kurtosis,
       {r('p', 7)} AS shapiro_pvalue, {r('p - 0.1 * abs(skewness) - 0.05 * abs(excess)', 7)} AS score FROM m2 JOIN sw USING (feature)"""
_CRIT = "1.0::DOUBLE + 4.0 / n - 25.0 / n / n"
ORACLE["s5_anderson_normal"] = f"""
WITH {SERIES}, {ORDERED.format(k='series', t='se')}, f AS (SELECT series, avg(value) AS mu, stddev_samp(value) AS sd FROM se GROUP BY series),
z AS (SELECT series, n, i, (value - mu) / sd AS z, -(value - mu) / sd AS y FROM o JOIN f USING (series) WHERE sd > 0),
a AS (SELECT series, n, -n - sum((2 * i - 1) * {log_cdf_sql('z')} + (2 * (n - i) + 1) * {log_cdf_sql('y')}) / n AS a2 FROM z GROUP BY series, n),
b AS (SELECT *, round(0.787 / ({_CRIT}), 3) AS crit FROM a)
SELECT series, n, {r('a2')} AS anderson_stat, {r('crit')} AS anderson_crit_5pct, a2 > crit AS anderson_reject_5pct FROM b"""
