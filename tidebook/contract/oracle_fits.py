"""SQL equivalents of the tests that rest on least squares, and of the tables assembled from tests.

A model is its cross-product matrix with the response last. ``eliminated`` takes one column after the other out of it; after k columns
the last diagonal entry is the residual sum of squares on the first k, so nested models need one elimination.
"""

from __future__ import annotations

from .oracle import BOXCOX, JB, K2, LINE, MOMENTS, ORACLE, SERIES, YEO, ljung, r, shapiro_ctes

#: Values per series, standardized, as lists.
LISTS = """
zs AS (SELECT series, any_value(n) AS n, any_value(mu) AS mu, sqrt(any_value(m2)) AS sd, list((value - mu) / sqrt(m2) ORDER BY idx) AS x,
       list(value / sqrt(m2) ORDER BY idx) AS raw FROM se JOIN mo USING (series) GROUP BY series)"""


def eliminated(name: str, rows: str) -> str:
    """CTEs that take ``rows(series, v)``, lists with the response last, to ``<name>(series, k, m)`` for k eliminated columns."""
    return f"""
{name}_g AS (SELECT series, i, j, sum(v[i] * v[j]) AS g FROM (
    SELECT series, v, i, unnest(range(1, len(v) + 1)) AS j FROM (SELECT series, v, unnest(range(1, len(v) + 1)) AS i FROM {rows})) GROUP BY series, i, j),
{name}_m AS (SELECT series, list(w ORDER BY i) AS m FROM (SELECT series, i, list(g ORDER BY j) AS w FROM {name}_g GROUP BY series, i) GROUP BY series),
{name} AS (SELECT series, 0 AS k, m FROM {name}_m UNION ALL
    SELECT series, k + 1, list_transform(m, lambda w, i: CASE WHEN i <= k + 1 THEN w
        ELSE list_transform(w, lambda c, j: c - w[k + 1] / m[k + 1][k + 1] * m[k + 1][j]) END) FROM {name} WHERE k + 1 < len(m))"""


def normal_cdf(z: str) -> str:
    """Series of odd powers; exact to rounding where the density is not negligible."""
    odd = f"exp((2 * i + 1) * ln(abs({z}) + 1e-300) - (lgamma(2 * i + 2) - i * ln(2) - lgamma(i + 1)) - {z} * {z} / 2)"
    half = f"list_sum(list_transform(range(0, 200), lambda i: {odd})) / sqrt(2 * pi())"
    return f"CASE WHEN {z} < -8 THEN 0.0 WHEN {z} > 8 THEN 1.0 ELSE 0.5 + sign({z}) * {half} END"


def chi2_even(q: str, df: int) -> str:
    return f"list_sum(list_transform(range(0, {df // 2}), lambda i: exp(-({q}) / 2 + i * ln(({q}) / 2) - lgamma(i + 1))))"


def f_even(f: str, d1: int, d2: str) -> str:
    """Upper tail of F for an even number of numerator degrees."""
    x = f"(({d2}) / (({d2}) + {d1} * ({f})))"
    return f"""list_sum(list_transform(range(0, {d1 // 2}), lambda i: exp(({d2}) / 2.0 * ln({x}) + i * ln(1 - {x})
        + lgamma(({d2}) / 2.0 + i) - lgamma(({d2}) / 2.0) - lgamma(i + 1))))"""


def f_series(f: str, d1: int, d2: str) -> str:
    """Upper tail of F as one less the power series of the lower tail."""
    y = f"({d1} * ({f}) / (({d2}) + {d1} * ({f})))"
    a, b = d1 / 2, f"(({d2}) / 2.0)"
    return f"""1 - list_sum(list_transform(range(0, 400), lambda i: exp({a} * ln({y}) + {b} * ln(1 - {y}) - ln({a}) + lgamma({a} + {b})
        - lgamma({a}) - lgamma({b}) + lgamma({a} + {b} + i) - lgamma({a} + {b}) - lgamma({a} + 1 + i) + lgamma({a} + 1) + i * ln({y}))))"""


def arch(name: str, lags: int, values: str) -> str:
    """CTEs up to ``<name>_s(series, n, nobs, r2)``."""
    rows = f"""
{name}_e AS (SELECT series, n, list_transform({values}, lambda c: c * c) AS e FROM zs),
{name}_r AS (SELECT series, list_concat([1.0::DOUBLE], list_reverse(e[t - {lags}:t - 1]), [e[t]]) AS v
    FROM (SELECT series, e, unnest(range({lags + 1}, n + 1)) AS t FROM {name}_e)),"""
    return rows + eliminated(name, f"{name}_r") + f""",
{name}_s AS (SELECT series, n, n - {lags} AS nobs, 1 - max(CASE WHEN k = {lags + 1} THEN m[-1][-1] END) / max(CASE WHEN k = 1 THEN m[-1][-1] END) AS r2
    FROM {name} JOIN zs USING (series) GROUP BY series, n)"""


_START = f"WITH RECURSIVE {SERIES}, {MOMENTS}, {LISTS}"

ORACLE["s7_arch_lm"] = f"""{_START}, {arch('a', 12, 'x')},
f AS (SELECT *, nobs * r2 AS lm, (r2 / 12) / ((1 - r2) / (nobs - 13)) AS f FROM a_s)
SELECT series, n, 12::BIGINT AS arch_lags, {r('lm')} AS arch_lm_stat, {r(chi2_even('lm', 12))} AS arch_lm_p, {r('f')} AS arch_f_stat,
       {r(f_even('f', 12, 'nobs - 13'))} AS arch_f_p FROM f"""

_T = "(c * sqrt(s) / sqrt((y - c * c * s) / (nobs - u - 2)))"
_P = "CASE WHEN z <= -1.61 THEN 2.1659 + 1.4412 * z + 0.038269 * z * z ELSE 1.7339 + 0.93202 * z - 0.12745 * z * z - 0.010368 * z * z * z END"
ORACLE["s8_adf"] = f"""{_START},
d AS (SELECT series, n, x, list_transform(x, lambda c, i: CASE WHEN i > 1 THEN c - x[i - 1] ELSE 0 END) AS d,
      CAST(greatest(least(ceil(12 * pow(n / 100.0::DOUBLE, 0.25)), floor(n / 2.0::DOUBLE) - 2), 0) AS BIGINT) AS top FROM zs),
r1 AS (SELECT series, list_concat([1.0::DOUBLE, x[t - 1]], list_reverse(d[t - top:t - 1]), [d[t]]) AS v
       FROM (SELECT *, unnest(range(top + 2, n + 1)) AS t FROM d)), {eliminated('a', 'r1')},
c1 AS (SELECT series, k - 2 AS lag, (n - top - 1) * ln(m[-1][-1] / (n - top - 1)) + 2 * k AS aic FROM a JOIN d USING (series) WHERE k >= 2),
b AS (SELECT series, arg_min(lag, aic) AS u FROM c1 GROUP BY series),
r2 AS (SELECT series, list_concat([1.0::DOUBLE], CASE WHEN u > 0 THEN list_reverse(d[t - u:t - 1]) ELSE [] END, [x[t - 1], d[t]]) AS v
       FROM (SELECT *, unnest(range(u + 2, n + 1)) AS t FROM d JOIN b USING (series))), {eliminated('e', 'r2')},
s AS (SELECT series, n, u, n - u - 1 AS nobs, m[-2][-1] / m[-2][-2] AS c, m[-2][-2] AS s, m[-1][-1] AS y
      FROM e JOIN b USING (series) JOIN d USING (series) WHERE k = u + 1),
z AS (SELECT *, {_T} AS z FROM s), p AS (SELECT *, {_P} AS w FROM z)
SELECT series, n, {r('z')} AS adf_stat, CAST(u AS BIGINT) AS adf_lags, CAST(nobs AS BIGINT) AS adf_nobs,
       {r(f"CASE WHEN z > 2.74 THEN 1.0 WHEN z < -18.83 THEN 0.0 ELSE {normal_cdf('w')} END")} AS adf_p FROM p"""

ORACLE["s21_tsay_test"] = f"""{_START},
r1 AS (SELECT series, list_concat([1.0::DOUBLE], l, list_transform(l, lambda c: c * c), [y]) AS v FROM (
       SELECT series, list_reverse(x[t - 5:t - 1]) AS l, x[t] AS y FROM (SELECT series, x, unnest(range(6, n + 1)) AS t FROM zs))), {eliminated('a', 'r1')},
s AS (SELECT series, n, n - 5 AS nobs, max(CASE WHEN k = 6 THEN m[-1][-1] END) AS r1, max(CASE WHEN k = 11 THEN m[-1][-1] END) AS r2
      FROM a JOIN zs USING (series) GROUP BY series, n),
f AS (SELECT *, (r1 - r2) / 5 / (r2 / (nobs - 11)) AS f FROM s)
SELECT series, n, 'F-nested' AS method, {r('f')} AS tsay_f, {r(f_series('f', 5, 'nobs - 11'))} AS tsay_p, 5::BIGINT AS df_diff FROM f"""

_HORIZON = "CAST(regexp_extract(series, '(\\d+)$', 1) AS BIGINT)"
_SQUARES = "pow(value - mu, 2)"
ORACLE["s13_hetero_report"] = f"""{_START}, {arch('a', 10, 'raw')},
{ljung('demeaned_square', _SQUARES, (10, 20))}, {ljung('one', _SQUARES, (1,))},
w AS (SELECT series, max(CASE WHEN lags = 10 THEN p END) AS pa, max(CASE WHEN lags = 20 THEN p END) AS pb FROM lb_demeaned_square GROUP BY series),
o AS (SELECT series, 2 * (1 - {normal_cdf('sqrt(q)')}) AS p1 FROM lb_one),
t AS (SELECT a_s.*, nobs * r2 AS lm, pa, pb, p1 FROM a_s JOIN w USING (series) JOIN o USING (series)),
u AS (SELECT *, {chi2_even('lm', 10)} AS lp, least(p1, pa, pb) < 0.05 AS lb FROM t),
x AS (SELECT *, concat_ws('+', CASE WHEN lp < 0.05 THEN 'ARCH' END, CASE WHEN lb THEN 'LB(sq)' END) AS found, n >= 50 AS ok FROM u)
SELECT series, {_HORIZON} AS horizon_n, n AS n_stride, {r('CASE WHEN n >= 50 THEN lm END')} AS arch_lm_stat, {r('CASE WHEN n >= 50 THEN lp END')} AS arch_lm_p,
       CASE WHEN ok THEN lp < 0.05 END AS arch_reject_5pct, {r('CASE WHEN ok THEN p1 END')} AS lb_sq_lag1_p, {r('CASE WHEN ok THEN pa END')} AS lb_sq_laga_p,
       {r('CASE WHEN ok THEN pb END')} AS lb_sq_lagb_p, CASE WHEN ok THEN lb END AS lb_reject_any_5pct,
       CASE WHEN ok THEN '' ELSE 'insufficient n (<50)' END AS note,
       CASE WHEN NOT ok THEN 'insufficient sample' WHEN found = '' THEN 'no evidence at 5%' ELSE 'heteroskedasticity detected: ' || found END AS verdict FROM x"""

_STD = "CASE WHEN n > 1 THEN sqrt(m2 * n / (n - 1.0::DOUBLE)) END"
_SKEW = "g1 * sqrt(n * (n - 1.0::DOUBLE)) / (n - 2.0::DOUBLE)"
_KURT = "(n - 1.0::DOUBLE) / ((n - 2.0::DOUBLE) * (n - 3.0::DOUBLE)) * ((n + 1.0::DOUBLE) * g2 + 6.0::DOUBLE)"
ORACLE["s12_normality_report"] = f"""WITH {SERIES}, {MOMENTS}, {K2},
q AS (SELECT series, n, {r('mu')} AS mean, {r(_STD)} AS std, {r(_SKEW)} AS skew, {r(_KURT)} AS excess_kurtosis,
      {r(JB)} AS jarque_bera_stat, {r(f'exp(-{JB} / 2)')} AS jarque_bera_p FROM kk)
SELECT q.*, sh.* EXCLUDE (series, n), an.* EXCLUDE (series, n), {_HORIZON.replace('series', 'q.series')} AS horizon_n
FROM q LEFT JOIN ({ORACLE['s2_shapiro']}) sh USING (series) LEFT JOIN ({ORACLE['s5_anderson_normal']}) an USING (series)"""

_QUANTILES = {"p01": 0.01, "p05": 0.05, "q25": 0.25, "median": 0.5, "q75": 0.75, "p95": 0.95, "p99": 0.99}
ORACLE["s10_diagnose"] = f"""WITH {SERIES}, {MOMENTS}, {K2},
q AS (SELECT series, count(DISTINCT value) AS uniq, {", ".join(f"quantile_cont(value, {p}) AS {k}" for k, p in _QUANTILES.items())}
      FROM se GROUP BY series),
h AS (SELECT series, n, 0::BIGINT AS missing, uniq AS "unique", uniq <= 1 AS is_constant, {r('mu')} AS mean, {r(_STD)} AS std, {r(_SKEW)} AS skew,
      {r(_KURT)} AS kurtosis_excess, {r('lo')} AS min, {", ".join(f"{r(k)} AS {k}" for k in _QUANTILES)}, {r('hi')} AS max FROM kk JOIN q USING (series))
SELECT h.*, sh.shapiro_stat AS "shapiro_W", sh.shapiro_p, tk.k2_stat, tk.k2_p, jb.jb_stat, jb.jb_p, ad.adf_stat, ad.adf_p, ad.adf_lags, ad.adf_nobs,
       kp.kpss_stat, kp.kpss_p, CAST(kp.kpss_lags AS BIGINT) AS kpss_lags, ar.arch_lm_stat, ar.arch_lm_p, ar.arch_lags
FROM h LEFT JOIN ({ORACLE['s2_shapiro']}) sh USING (series) LEFT JOIN ({ORACLE['s3_k2_test']}) tk USING (series)
LEFT JOIN ({ORACLE['s4_jarque_bera']}) jb USING (series) LEFT JOIN ({ORACLE['s8_adf']}) ad USING (series)
LEFT JOIN ({ORACLE['s9_kpss']}) kp USING (series) LEFT JOIN ({ORACLE['s7_arch_lm']}) ar USING (series)"""


def arch_battery(lags: int) -> str:
    """LM and F tail of the ARCH test of raw values, as rows of the battery."""
    f_tail = f_even if lags % 2 == 0 else f_series
    chi2 = chi2_even("lm", lags) if lags % 2 == 0 else f"1 - list_sum(list_transform(range(0, 400), lambda i: exp({lags / 2} * ln(lm / 2) + i * ln(lm / 2) - lm / 2 - lgamma({lags / 2} + i + 1))))"
    return f"""SELECT series, 'arch_lm.lags_{lags}.' || k AS path, CASE WHEN k = 'LM_p' THEN lp ELSE fp END AS value FROM (
      {_START}, {arch('a', lags, 'raw')}, f AS (SELECT *, nobs * r2 AS lm, (r2 / {lags}) / ((1 - r2) / (nobs - {lags + 1})) AS f FROM a_s)
      SELECT series, {r(chi2)} AS lp, {r(f_tail('f', lags, f'nobs - {lags + 1}'))} AS fp FROM f WHERE n >= {2 * lags + 2}), (SELECT unnest(['LM_p', 'F_p']) AS k)"""


def _paths(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT series, '{path}' AS path, CAST({c} AS DOUBLE) AS value FROM ({table})" for path, c in columns.items())


_SUMMARY = f"""WITH {SERIES}, {MOMENTS}, md AS (SELECT series, quantile_cont(value, 0.5) AS md FROM se GROUP BY series)
SELECT series, n, {r('mu')} AS mean, {r(_STD)} AS std, {r(_SKEW)} AS skew, {r(_KURT)} AS kurt, {r('lo')} AS lo, {r('hi')} AS hi, {r('md')} AS md FROM mo JOIN md USING (series)"""
_LB = " UNION ALL ".join(
    f"SELECT series, 'autocorr.ljung_box_{name}.lags_' || lags AS path, lb_p AS value FROM ({ORACLE['s6_ljung_box']}) WHERE \"of\" = '{kind}'"
    for kind, name in (("value", "returns"), ("square", "squared")))
BATTERY = " UNION ALL ".join([
    _paths(_SUMMARY, {f"summary.{p}": c for p, c in {"n": "n", "mean": "mean", "std": "std", "skew": "skew", "kurt": "kurt", "min": "lo", "max": "hi", "median": "md"}.items()}),
    _paths(ORACLE["s4_jarque_bera"], {"normality.jb_stat": "jb_stat", "normality.jb_p": "jb_p"}),
    _paths(ORACLE["s2_shapiro"], {"normality.shapiro_stat": "shapiro_stat", "normality.shapiro_p": "shapiro_p"}),
    _paths(ORACLE["s5_anderson_normal"], {"normality.anderson_stat": "anderson_stat"}),
    _paths(ORACLE["s8_adf"], {"stationarity.adf_stat": "adf_stat", "stationarity.adf_p": "adf_p"}),
    _paths(ORACLE["s9_kpss"], {"stationarity.kpss_stat": "kpss_stat", "stationarity.kpss_p": "kpss_p"}),
    _paths(ORACLE["s21_tsay_test"], {"tsay.F": "tsay_f", "tsay.p": "tsay_p", "tsay.df_diff": "df_diff"}),
    _paths(ORACLE["s20_runs_test"], {"runs.z": "z", "runs.p": "p"}),
    _LB, *[arch_battery(k) for k in (5, 10, 20)],
])
ORACLE["s22_battery_values"] = f"SELECT series, path, value FROM ({BATTERY}) WHERE value IS NOT NULL"
_FIRST = ("normality.jb_p", "autocorr.ljung_box_returns.lags_20", "autocorr.ljung_box_squared.lags_20", "arch_lm.lags_10.LM_p",
          "stationarity.adf_p", "stationarity.kpss_p", "tsay.p", "runs.p")
ORACLE["s23_overview_values"] = f"""SELECT series, {", ".join(f"max(CASE WHEN path = '{p}' THEN value END) AS {p.replace('.', '_')}" for p in _FIRST)}
FROM ({BATTERY}) GROUP BY series"""


def lambda_levels(family: str, y: str, log: str, rows: str, levels: int = 11) -> str:
    """CTEs that search the peak of a profile on ever finer grids of 21 places; the last is ``<family>_best``."""
    out, before = [], ""
    for k in range(levels):
        step = f"{16.0 / 5**k!r}::DOUBLE"
        places = f"(SELECT feature, unnest(range(-10, 11)) * {step} + lam AS lam FROM {before})" if before else (
            f"(SELECT DISTINCT feature, unnest(range(-10, 11)) * {step} AS lam FROM {rows})")
        out.append(f"""{family}_p{k} AS MATERIALIZED (SELECT feature, lam, -count(*) / 2.0 * ln(var_pop({y})) + (lam - 1) * sum({log}) AS llf
            FROM {rows} JOIN {places} g USING (feature) GROUP BY feature, lam),
{family}_b{k} AS MATERIALIZED (SELECT feature, arg_max(lam, llf) AS lam, max(llf) AS llf FROM {family}_p{k} WHERE isfinite(llf) GROUP BY feature)""")
        before = f"{family}_b{k}"
    return ", ".join(out) + f", {family}_best AS (SELECT * FROM {before})"


_LAMBDAS = f"""{LINE},
pl AS (SELECT * FROM ll WHERE feature IN (SELECT feature FROM ll GROUP BY feature HAVING min(value) > 0)),
{lambda_levels('yj', YEO, 'sign(value) * ln(1 + abs(value))', 'll')}, {lambda_levels('bc', BOXCOX, 'ln(value)', 'pl')}"""
ORACLE["t4_fit_lambda"] = f"""WITH {_LAMBDAS}
SELECT feature, 'yeo-johnson' AS family, {r('lam', 3)} AS "lambda", {r('llf', 3)} AS llf FROM yj_best
UNION ALL SELECT feature, 'box-cox', {r('lam', 3)}, {r('llf', 3)} FROM bc_best"""

#: The value of a feature under a named transform, with columns ``value``, ``lam`` and ``o`` (the offset).
NAMED = f"""CASE name WHEN 'asinh' THEN asinh(value) WHEN 'log' THEN CASE WHEN value + o > 0 THEN ln(value + o) END
  WHEN 'sqrt' THEN CASE WHEN value + o >= 0 THEN sqrt(value + o) END WHEN 'yeo-johnson' THEN {YEO}
  WHEN 'box-cox' THEN CASE WHEN value > 0 THEN {BOXCOX} END ELSE value END"""
_CHOSEN = f"""{_LAMBDAS},
fs AS (SELECT feature, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS lo, max(value) AS hi FROM ll GROUP BY feature),
fk AS (SELECT feature, avg(pow(value - mean, 3)) / pow(any_value(std), 3) AS skew FROM ll JOIN fs USING (feature) GROUP BY feature),
cn AS (SELECT feature, unnest(['identity', 'asinh', 'yeo-johnson', 'log', 'sqrt', 'box-cox']) AS name, lo FROM fs),
cp AS (SELECT cn.feature, name, CASE name WHEN 'yeo-johnson' THEN round(yj_best.lam, 3) WHEN 'box-cox' THEN round(bc_best.lam, 3) END AS lam,
       CASE name WHEN 'log' THEN CASE WHEN lo > 0 THEN 0.0 ELSE abs(lo) + 1.0 END WHEN 'sqrt' THEN CASE WHEN lo >= 0 THEN 0.0 ELSE abs(lo) + 0.1 END
                 WHEN 'box-cox' THEN 0.0 END AS o
       FROM cn LEFT JOIN yj_best USING (feature) LEFT JOIN bc_best USING (feature) WHERE name <> 'box-cox' OR (lo > 0 AND bc_best.lam IS NOT NULL)),
cv AS MATERIALIZED (SELECT feature || '|' || name AS fc, feature, name, lam, o, {NAMED} AS value FROM ll JOIN cp USING (feature)), {shapiro_ctes('fc', 'cv')},
c0 AS (SELECT fc, any_value(feature) AS feature, any_value(name) AS name, any_value(lam) AS lam, any_value(o) AS o, avg(value) AS mu, var_pop(value) AS v
       FROM cv GROUP BY fc),
c1 AS (SELECT cv.fc, avg(pow(value - mu, 3)) / pow(any_value(v), 1.5::DOUBLE) AS sk, avg(pow(value - mu, 4)) / pow(any_value(v), 2) - 3 AS ku
       FROM cv JOIN c0 USING (fc) GROUP BY cv.fc),
c2 AS (SELECT c0.*, sk, ku, sw.p AS sp, sw.p - 0.1 * abs(sk) - 0.05 * abs(ku) AS score FROM c0 JOIN c1 USING (fc) JOIN sw USING (fc)),
ch AS (SELECT * FROM c2 QUALIFY row_number() OVER (PARTITION BY feature ORDER BY score DESC,
       list_position(['identity', 'asinh', 'yeo-johnson', 'log', 'sqrt', 'box-cox'], name)) = 1)"""
ORACLE["t6_fit_transforms"] = f"""WITH {_CHOSEN}
SELECT feature, name AS transformation, {r('lam', 5)} AS "lambda", {r('o', 5)} AS "offset", {r('score', 5)} AS normality_score, {r('sp', 5)} AS shapiro_pvalue,
       {r('sk', 5)} AS skewness, {r('ku', 5)} AS excess_kurtosis, n, {r('mean', 5)} AS mean, {r('std', 5)} AS std, {r('lo', 5)} AS min, {r('hi', 5)} AS max, {r('skew', 5)} AS skew,
       {r('mu', 5)} AS new_mean, {r('sqrt(v)', 5)} AS new_std FROM ch JOIN fs USING (feature) JOIN fk USING (feature)"""


def _applied(column: str) -> str:
    value = NAMED.replace("value", f"li.{column}")
    picked = ", ".join(f"(SELECT {c} FROM ch WHERE feature = '{column}') AS {c}" for c in ("name", "lam", "o"))
    return f"(SELECT {r(value)} FROM (SELECT {picked}) q) AS {column}"


ORACLE["t7_save_load_transforms"] = f"""WITH {_CHOSEN}
SELECT {", ".join(_applied(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))} FROM lineitem li"""
