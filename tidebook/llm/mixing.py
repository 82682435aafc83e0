"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target of size units (words). Whole passes over a source are taken first; what is left
of the budget is fitted on the counts of its documents by exact size:

1. Of each size an equal share of the documents is taken, rounded down, which leaves a budget of at most one
   document per size.
2. Single documents are added in seeded order of sizes while the budget is above ``SLACK`` units.
3. A bounded-knapsack dynamic programme (bit sets, counts split in powers of two) finds the number of
   documents per size whose sum comes closest to the rest from below, exactly if any subset does.

The documents of a size are then chosen by seeded rank. Only counts by (source, size) meet in one task, never
documents; ranks are counted in blocks of hashes, so a hot source or size is split. The plan (one row per source and
size) is broadcast after its rows are counted, or else shuffled. One number per source reaches the driver.

Defined results: a null text has size 0; documents of size 0 are never taken. A null source is a source of
its own, last in order. Rows with equal ``doc_id`` are documents of their own, interchangeable if equal in size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import positions, small_side
from .words import carried, free_name, saved

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SLACK = 1 << 15


def word_count(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[float] = WEIGHTS, most: float = MAX_REPEATS):
    """``[(source, size, target)]``: weights repeat over the sources by code point, null last; shares of the
    whole are capped at ``most`` times a source, and the excess is dealt again by weight."""
    ordered = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = [float(weights[i % len(weights)]) for i in range(len(ordered))]
    total = float(sum(n for _, n in ordered))
    target, open_ = [0.0] * len(ordered), list(range(len(ordered)))
    rest = total
    while open_:
        scale = sum(weight[i] for i in open_)
        over = [i for i in open_ if rest * weight[i] / scale > most * ordered[i][1]]
        if not over:
            for i in open_:
                target[i] = rest * weight[i] / scale
            break
        for i in over:
            target[i] = most * float(ordered[i][1])
        rest -= sum(target[i] for i in over)
        open_ = [i for i in open_ if i not in over]
    return [(s, n, t) for (s, n), t in zip(ordered, target)]


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, order: np.ndarray, slack: int = SLACK) -> np.ndarray:
    """How many documents of each size to take, so that their sum comes as close to ``budget`` as possible
    without passing it."""
    whole = int((sizes * counts).sum())
    if whole <= budget:
        return counts.copy()
    take = np.array([int(c) * budget // whole for c in counts.tolist()], dtype=np.int64)
    left = counts - take
    rest = budget - int((sizes * take).sum())
    spare = slack
    for i in order.tolist():
        s = int(sizes[i])
        while left[i] and rest - s > spare:
            n = min(int(left[i]), (rest - spare) // s)
            take[i] += n
            left[i] -= n
            rest -= n * s
    items = []  # (size index, documents at once); powers of two cover every count
    for i in np.argsort(-sizes, kind="stable").tolist():
        n, part = min(int(left[i]), rest // int(sizes[i])), 1
        while n > 0:
            part = min(part, n)
            items.append((i, part))
            n -= part
            part *= 2
    mask, reach, states = (1 << (rest + 1)) - 1, 1, []
    for i, part in items:
        states.append(reach)
        reach = (reach | (reach << (part * int(sizes[i])))) & mask
        if reach >> rest & 1:
            break
    best = reach.bit_length() - 1
    for (i, part), before in zip(reversed(items[: len(states)]), reversed(states)):
        if not before >> best & 1:
            take[i] += part
            best -= part * int(sizes[i])
    return take


def _plan(slack: int, seed: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size").reset_index(drop=True)
        sizes, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        some = sizes > 0
        whole = int((sizes * counts).sum())
        target = float(pdf["target"].iloc[0])
        passes = int(target // whole) if whole else 0
        extra = np.zeros(len(sizes), np.int64)
        order = np.random.default_rng(seed).permutation(int(some.sum()))
        extra[some] = fit_counts(sizes[some], counts[some], round(target - passes * whole), order, slack)
        return pd.DataFrame({"key": pdf["key"], "size": sizes, "passes": np.where(some, passes, 0), "extra": extra})

    return run


def mix_sources(
    docs: DataFrame, size: Column | None = None, weights: Sequence[float] = WEIGHTS, most: float = MAX_REPEATS,
    seed: int = 1, slack: int = SLACK, columns: list[str] | None = None,
) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target`` (its source's), ``copies`` and ``taken``
    (``size * copies``). Names of results replace columns of ``docs``, whatever their case."""
    added = ["size", "source_size", "target", "copies", "taken"]
    names = carried(columns or docs.columns, added)
    need = list(dict.fromkeys([*names, "doc_id", "source"]))
    tag, order, passes, bound = (free_name(c, need) for c in ("source", "order", "passes", "bound"))
    # One non-null key per source: null is told from every text.
    key = F.concat(F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce("source", F.lit("")))
    number = F.coalesce("doc_id", F.lit(-(1 << 63)))
    place = F.struct(F.xxhash64(F.lit(seed), number).alias("h"), number.alias("d"))
    size = word_count("text") if size is None else size

    slim = saved(docs.select(key.alias("key"), size.alias("size"), place.alias("place")), "sizes")
    by_size = slim.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"))
    totals = by_size.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("whole"))
    found = [(r.key[1:] if r.key[0] == "1" else None, int(r.whole)) for r in totals.collect()]
    rows = [("0" if s is None else "1" + s, n, t) for s, n, t in targets(found, weights, most)]
    goal = docs.sparkSession.createDataFrame(rows, "key string, source_size long, target double")
    plan = saved(
        by_size.join(F.broadcast(goal), "key")
        .groupBy("key").applyInPandas(_plan(slack, seed), "key string, size long, passes long, extra long"),
        "plan",
    )
    ranked = slim.join(plan.filter("extra > 0"), ["key", "size"]).select(
        "*", F.shiftright("place.h", 52).alias("block"))  # blocks rise with the order
    last = positions(ranked, ["key", "size"], ["place"], "block", "idx").filter("idx = extra - 1")
    choice = small_side(
        plan.join(last.select("key", "size", F.col("place").alias(bound)), ["key", "size"], "left")
        .join(F.broadcast(goal), "key")
        .select(F.col("key").alias(tag), "size", F.col("passes").alias(passes), bound, "source_size", "target")
    )
    taken = F.col(passes) + F.coalesce((F.col(order) <= F.col(bound)).cast("long"), F.lit(0))
    return (
        docs.select(*need, key.alias(tag), size.alias("size"), place.alias(order))
        .join(choice, [tag, "size"])
        .withColumn("copies", taken)
        .withColumn("taken", F.col("size") * F.col("copies"))
        .select(*names, *added)
    )


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: every row as often as ``copies`` says."""
    return mixed.filter("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*columns)
