"""Kernel density, parametric fits by expectation-maximization and their ranking."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import BROADCAST_ROWS, materialized
from .packed import packed, pieces
from .ranks import quantiles_of_runs, value_runs

LOG_2PI = math.log(2 * math.pi)
MIN_FIT = 50
STARTS = 3
#: Cells of a bandwidth, terms of the series of a cell.
CELLS, TERMS = 8, 10
REACH = 38.0  # a standard normal density is zero in double precision beyond this


def _hermite() -> list[list[float]]:
    """Coefficients of the Hermite polynomials of the normal density up to ``TERMS``, each over its factorial."""
    rows = [[1.0], [0.0, 1.0]]
    for k in range(1, TERMS):
        up, down = [0.0, *rows[k]], [*rows[k - 1], 0.0, 0.0]
        rows.append([u - k * d for u, d in zip(up, down)])
    return [[c / math.factorial(k) for c in row] for k, row in enumerate(rows)]


def gaussian_kde(long: DataFrame, points: int = 400) -> DataFrame:
    """Density with Scott's bandwidth on ``points`` places between the 0.5 and 99.5 percentiles.

    Values are gathered in cells of an eighth of a bandwidth by their moments around the cell's middle, and a cell adds a series of
    Hermite polynomials to the places within its reach. Values lie at most a sixteenth of a bandwidth off, so the
    ``TERMS`` = 10 terms leave less than 1e-15 of the largest density. Work beyond one pass grows with cells x places, not
    with the rows.
    """
    runs = value_runs(long)
    lim = quantiles_of_runs(runs, [0.005, 0.995])
    spread = long.groupBy("series").agg(F.stddev_samp("value").alias("_sd"))
    grid = materialized(lim.join(spread, "series").filter("_sd > 0").select(
        "series", F.col("n"), F.get("q", 0).alias("_lo"), F.get("q", 1).alias("_hi"),
        (F.col("_sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("_h"),
    ).withColumn("_step", (F.col("_hi") - F.col("_lo")) / (points - 1)))
    v, lo, step, h = F.col("value"), F.col("_lo"), F.col("_step"), F.col("_h")
    width = h / CELLS
    placed = runs.drop("n").join(_hint(grid)(grid), "series").withColumn("_cell", F.floor((v - lo) / width))
    middle = lo + (F.col("_cell") + 0.5) * width
    off = placed.withColumn("_u", (v - middle) / h)
    cells = off.groupBy("series", "_cell", "_lo", "_step", "_h").agg(
        *[F.sum(F.col("cnt") * F.pow("_u", F.lit(k))).alias(f"_m{k}") for k in range(TERMS)])
    # The series in powers of the distance: one polynomial per cell.
    table = _hermite()
    powers = [sum((F.col(f"_m{k}") * table[k][j] for k in range(j, TERMS) if table[k][j]), F.lit(0.0)) for j in range(TERMS)]
    sums = cells.select("series", "_lo", "_step", "_h", middle.alias("_c"), *[p.alias(f"_p{j}") for j, p in enumerate(powers)])
    c = F.col("_c")
    near = sums.withColumn("_a", F.greatest(F.ceil((c - REACH * h - lo) / step), F.lit(0))).withColumn(
        "_z", F.least(F.floor((c + REACH * h - lo) / step), F.lit(points - 1))).filter("_a <= _z").withColumn(
        "point", F.explode(F.sequence("_a", "_z"))).withColumn("_d", (lo + F.col("point") * step - c) / h)
    poly, d = F.col(f"_p{TERMS - 1}"), F.col("_d")
    for j in range(TERMS - 2, -1, -1):
        poly = poly * d + F.col(f"_p{j}")
    sums = near.groupBy("series", "point").agg(F.sum(F.exp(-d * d / 2) * poly).alias("_s"))
    places = grid.withColumn("point", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))))
    return places.join(sums, ["series", "point"], "left").select(
        "series", "point", (lo + F.col("point") * step).alias("x"),
        (F.coalesce("_s", F.lit(0.0)) / (F.col("n") * h * math.sqrt(2 * math.pi))).alias("density"),
    )


def fit_normal(long: DataFrame) -> DataFrame:
    """``mu, sigma`` (ddof 1) and log-likelihood, in closed form from one aggregate."""
    m = long.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mu"), F.stddev_samp("value").alias("sigma")
    )
    n, s = F.col("n"), F.col("sigma")
    ll = -n / 2.0 * LOG_2PI - n * F.log(s) - (n - 1) / 2.0
    return m.select("series", "n", F.lit("Normal").alias("model"), F.lit(2).alias("k"), "mu", "sigma", ll.alias("loglik"))


def _iterate(
    params: DataFrame, step: Callable[[DataFrame], DataFrame], rounds: int, every: int = 6, tol: float | None = None
) -> DataFrame:
    """Repeat ``step``; the small parameter table is written to the checkpoint folder every few rounds,
    so the plan stays short and a lost executor repeats a few rounds only. With ``tol`` the rounds
    end once no model's mean log-likelihood moves by more."""
    params = materialized(params)
    for done in range(every, rounds + every, every):
        before = params
        for _ in range(min(every, rounds - (done - every))):
            params = step(params)
        params = materialized(params)
        if tol is not None and "loglik" in before.columns:
            keys = ["series", "components", "start"]
            old = before.select(*keys, F.col("loglik").alias("_old"))
            gain = F.max(F.coalesce(F.abs(F.col("loglik") - F.col("_old")) / F.col("n"), F.lit(float("inf"))))
            moved = params.join(old, keys).agg(gain).first()[0]
            if moved is None or moved <= tol:
                break
    return params


def _hint(params: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Broadcast the parameter table in every round if it is counted to be small."""
    return F.broadcast if params.count() <= BROADCAST_ROWS else (lambda df: df)


def _t_constant(nu: Column) -> Column:
    """ln of gamma((nu+1)/2) / (gamma(nu/2) sqrt(nu pi)) from a table keyed by the fixed grid."""
    table = {float(v): math.lgamma((v + 1) / 2) - math.lgamma(v / 2) - 0.5 * math.log(v * math.pi) for v in _NU_ALL}
    keys = [x for kv in table.items() for x in (F.lit(kv[0]), F.lit(kv[1]))]
    return F.try_element_at(F.create_map(*keys), nu)


def _nu_grid() -> list[float]:
    """Degrees of freedom, spaced evenly in ratio: 0.5 ... 200, 97 values."""
    return [round(0.5 * 400 ** (i / 96), 6) for i in range(97)]


_NU_ALL = _nu_grid()
_NU_COARSE = _NU_ALL[::8]


def fit_student_t(long: DataFrame, rounds: int = 12) -> DataFrame:
    """Degrees of freedom, location, scale and log-likelihood by EM.

    All grid values of the degrees of freedom run together for all series, so a round is one
    aggregate. A coarse grid comes first, then the grid values around its best one.
    """
    start = long.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mu"), F.var_pop("value").alias("s2")
    ).filter((F.col("n") >= 3) & (F.col("s2") > 0))

    start = materialized(start)
    hint = _hint(start)

    def with_grid(base: DataFrame, nus: Column) -> DataFrame:
        return base.withColumn("nu", F.explode(nus)).select("series", "n", "nu", "mu", "s2")

    values = packed(long)

    def summed(params: DataFrame, sums: Callable[[np.ndarray, np.ndarray, float, float], tuple], names: Sequence[str]) -> DataFrame:
        """Per series and degrees of freedom: the sums over all rows, and the parameters that they were taken at."""
        own = params.groupBy("series").agg(F.collect_list(F.struct("nu", "mu", "s2", "n")).alias("_p"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                series, given, out = batch.column("series"), batch.column("_p"), []
                for i, x, k in pieces(batch):
                    for p in given[i].as_py():
                        d = x - p["mu"]
                        out.append((series[i].as_py(), p["nu"], p["n"], p["mu"], p["s2"], *map(float, sums(d * d, d, k, p["nu"], p["s2"]))))
                types = (pa.string(), pa.float64(), pa.int64(), *[pa.float64()] * (2 + len(names)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(types), types)],
                    names=["series", "nu", "n", "mu", "s2", *names])

        schema = "series string, nu double, n long, mu double, s2 double, " + ", ".join(f"{c} double" for c in names)
        return values.join(hint(own), "series").mapInArrow(run, schema).groupBy("series", "nu").agg(
            *[F.max(c).alias(c) for c in ("n", "mu", "s2")], *[F.sum(c).alias(c) for c in names])

    # Moments around the previous location keep the sums well conditioned.
    def weighted(d2, d, k, nu, s2):
        w = k * (nu + 1.0) / (nu + d2 / s2)
        return w.sum(), w @ d, w @ d2

    def body(d2, d, k, nu, s2):
        return (k @ (-(nu + 1.0) / 2.0 * np.log1p(d2 / (s2 * nu)) - math.log(s2) / 2.0),)

    move = F.col("_wx") / F.col("_w")
    updated = [(F.col("mu") + move).alias("mu"), ((F.col("_wxx") - F.col("_w") * move * move) / F.col("n")).alias("s2")]

    def step(params: DataFrame) -> DataFrame:
        return summed(params, weighted, ("_w", "_wx", "_wxx")).select("series", "n", "nu", *updated)

    def likelihood(params: DataFrame) -> DataFrame:
        return summed(params, body, ("_b",)).withColumn("loglik", F.col("_b") + F.col("n") * _t_constant(F.col("nu")))

    def best(scored: DataFrame) -> DataFrame:
        pick = F.max_by(F.struct("n", "nu", "mu", "s2", "loglik"), "loglik").alias("b")
        return scored.groupBy("series").agg(pick).select("series", "b.*")

    coarse = _iterate(with_grid(start, F.array(*[F.lit(x) for x in _NU_COARSE])), step, rounds)
    first = materialized(best(likelihood(coarse)))
    grid = F.array(*[F.lit(x) for x in _NU_ALL])
    at = F.array_position(grid, F.col("nu"))
    lo = F.greatest(at - 8, F.lit(1))
    near = F.slice(grid, lo.cast("int"), (F.least(at + 8, F.lit(len(_NU_ALL))) - lo + 1).cast("int"))
    fine = _iterate(with_grid(first, near), step, rounds)
    return best(likelihood(fine)).select(
        "series", "n", F.lit("Student-t").alias("model"), F.lit(3).alias("k"), "nu", "mu",
        F.sqrt("s2").alias("sigma"), "loglik",
    )


def _slices(count: int, start: int) -> list[float]:
    """Probabilities of a start's means: even, crowded at the low end, crowded at the high end."""
    even = [(2 * j + 1) / (2 * count) for j in range(count)]
    return [even, [p * p for p in even], [1 - (1 - p) ** 2 for p in even]][start]


_SUMS_OF_PIECE = ("series string, n long, _s2 double, components int, start int, m array<double>, loglik double, "
                  "_r array<double>, _d array<double>, _q array<double>")


def _responsibilities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per packed row and mixture: the likelihood, and per component the sums of the rows' shares, times deviation and its square."""
    types = (pa.string(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.float64(), *[pa.list_(pa.float64())] * 3)
    for batch in batches:
        series, given, out = batch.column("series"), batch.column("_p"), []
        for i, x, k in pieces(batch):
            for p in given[i].as_py():
                w, m, v = (np.array(p[c])[:, None] for c in "wmv")
                d = x - m
                logs = np.log(np.maximum(w, 1e-300)) - 0.5 * (LOG_2PI + np.log(v) + d * d / v)
                top = logs.max(axis=0)
                e = np.exp(logs - top)
                total = e.sum(axis=0)
                r = e * (k / total)
                rd = r * d
                out.append((
                    series[i].as_py(), p["n"], p["_s2"], p["components"], p["start"], p["m"], float(k @ (top + np.log(total))),
                    r.sum(axis=1).tolist(), rd.sum(axis=1).tolist(), np.einsum("ij,ij->i", rd, d).tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(types), types)],
            names=["series", "n", "_s2", "components", "start", "m", "loglik", "_r", "_d", "_q"])


def fit_gmm(long: DataFrame, components: Sequence[int] = (3,), rounds: int = 96, tol: float = 1e-3) -> DataFrame:
    """Gaussian mixtures by EM; all series, component counts and starts share each round's aggregate.

    Starts from ``STARTS`` sets of quantile slices of each series (even ones, and ones that crowd at either end), so repeated runs
    agree; the start of the highest likelihood is kept, the earlier one of equals. ``converged`` says whether its mean
    log-likelihood moved by at most ``tol`` in the last round.
    """
    runs = value_runs(long)
    slices = {(c, i): _slices(c, i) for c in components for i in range(STARTS)}
    probs = sorted({p for own in slices.values() for p in own})
    base = long.groupBy("series").agg(
        F.count(F.lit(1)).alias("n"), F.var_pop("value").alias("s2")
    ).filter((F.col("n") >= MIN_FIT) & (F.col("s2") > 0))
    q = quantiles_of_runs(runs, probs).drop("n")
    starts = F.array(*[
        F.struct(
            F.lit(c).alias("components"),
            F.lit(i).alias("start"),
            F.array(*[F.lit(1.0 / c)] * c).alias("w"),
            F.array(*[F.get("q", probs.index(p)) for p in own]).alias("m"),
            F.array(*[F.col("s2") / (c * c)] * c).alias("v"),
        )
        for (c, i), own in slices.items()
    ])
    params = base.join(q, "series").select("series", "n", F.col("s2").alias("_s2"), F.explode(starts).alias("p")).select(
        "series", "n", "_s2", "p.*"
    ).withColumn("loglik", F.lit(None).cast("double"))

    params = materialized(params)
    hint = _hint(params)

    model = ["series", "n", "_s2", "components", "start"]
    most = max(components)
    # One aggregate a round: a fixed, small number of sums per component.
    sums = [F.sum("loglik").alias("loglik")]
    for k in range(most):
        sums += [*[F.sum(F.get(c, k)).alias(f"{c}{k}") for c in ("_r", "_d", "_q")], F.max(F.get("m", k)).alias(f"_m{k}")]

    def each(build) -> Column:
        return F.array_compact(F.array(*[
            build(F.greatest(F.col(f"_r{k}"), F.when(F.col(f"_r{k}").isNotNull(), F.lit(1e-300))),
                  F.col(f"_d{k}"), F.col(f"_q{k}"), F.col(f"_m{k}"))
            for k in range(max(components))
        ]))

    floor = F.col("_s2") * 1e-6
    updated = [
        each(lambda r, d, q, m: r / F.col("n")).alias("w"),
        each(lambda r, d, q, m: m + d / r).alias("m"),
        each(lambda r, d, q, m: F.when(r.isNotNull(), F.greatest(q / r - d / r * d / r, floor))).alias("v"),
    ]
    values = packed(long)

    def step(p: DataFrame) -> DataFrame:
        own = p.groupBy("series").agg(F.collect_list(F.struct("n", "_s2", "components", "start", "w", "m", "v")).alias("_p"))
        return values.join(hint(own), "series").mapInArrow(_responsibilities, _SUMS_OF_PIECE).groupBy(*model).agg(*sums).select(
            *model, *updated, "loglik")

    final = materialized(_iterate(params, step, rounds, every=5, tol=tol))
    # A round reports the likelihood of the parameters that it was given; one more says that of the last ones.
    keys = ["series", "components", "start"]
    last = step(final).select(*keys, F.col("loglik").alias("_last"))
    final = final.join(last, keys).withColumn("converged", F.abs(F.col("_last") - F.col("loglik")) <= tol * F.col("n"))
    pick = F.struct("n", "w", "m", "v", F.col("_last").alias("loglik"), "converged")
    best = final.groupBy("series", "components").agg(F.max_by(pick, F.struct("_last", -F.col("start"))).alias("b"))
    return best.select("series", "components", "b.*").select(
        "series", "n", F.concat(F.lit("GMM(K="), "components", F.lit(")")).alias("model"),
        (3 * F.col("components") - 1).alias("k"), "w", "m", "v", "loglik", "converged",
    )


def model_ranking(fits: DataFrame) -> DataFrame:
    """AIC and BIC of ``(series, n, model, k, loglik)``, best BIC first; short series left out."""
    k, ll, n = F.col("k"), F.col("loglik"), F.col("n")
    return (
        fits.filter(n >= MIN_FIT)
        .select("series", "model", "n", "k", "loglik", (2 * k - 2 * ll).alias("aic"), (F.log(n) * k - 2 * ll).alias("bic"))
        .orderBy("series", "bic", "model")
    )
