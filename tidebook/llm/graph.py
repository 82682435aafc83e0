"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import saved


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``: the least node that it reaches.

    Each round points every node at the least of itself and its neighbours (a map-side aggregate) and
    contracts the links to these. The first round orders nodes as they are, which ends stars around
    their least node; later ones by a fresh hash, so a long chain loses a constant share each time.
    All joins are plain shuffled joins, so a hub is split by the adaptive planner. Links never reach the
    driver.
    """
    edges = saved(links.select("a", "b").filter("a <> b").distinct(), "links")
    found, turn = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def rank(node: str, turn: int = turn):
            return F.struct((F.xxhash64(node, F.lit(turn)) if turn else F.col(node)).alias("p"), F.col(node).alias("v"))

        least = saved(
            both.groupBy("a").agg(F.min(rank("b")).alias("least"))
            .select(F.col("a").alias("node"), F.least(rank("a"), F.col("least"))["v"].alias("root")),
            "least",
        )
        if found is None:
            found = least
        else:
            step = least.select(F.col("node").alias("root"), F.col("root").alias("_to"))
            found = saved(
                found.join(step, "root", "left").select("node", F.coalesce("_to", "root").alias("root")), "found"
            )
        to_a = least.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        to_b = least.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        edges = saved(
            edges.join(to_a, "a").join(to_b, "b").filter("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
            "links",
        )
        turn += 1
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    first = found.groupBy("root").agg(F.min("node").alias("component"))
    return found.join(first, "root").select("node", "component")
