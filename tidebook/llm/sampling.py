"""Bounded samples of labelled rows, chosen by a hash of ``doc_id``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame, known: DataFrame, columns: list[str], bounds: Mapping[int | None, int], seed: int, once: bool = False
) -> DataFrame:
    """``columns``, ``label`` and ``rank`` of slightly more rows per label than ``bounds`` names (None: rows that
    ``known(doc_id, label)`` lacks); the caller cuts at the bound by ``rank``. Labels without a bound are left out.

    ``once``: repeated ids and labels count once, so they multiply no rows; of several labels the least holds.
    The labels are counted on ids alone, and texts are filtered by hash before they are moved.
    """
    rank = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)).alias("rank")
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull())
    if once:
        ids, known = ids.distinct(), known.groupBy("doc_id").agg(F.min("label").alias("label"))
    marked = ids.join(known, "doc_id", "left" if None in bounds else "inner").select("doc_id", "label", rank)
    sizes = {r.label: r.n for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    limit, top = F.lit(-1.0), 0.0
    for label, bound in bounds.items():
        if not sizes.get(label):
            continue
        share = (1.2 * bound + 50) / sizes[label] * (1 << 30)
        limit = F.when(F.col("label").isNull() if label is None else F.col("label") == label, F.lit(share)).otherwise(limit)
        top = max(top, share)
    drawn = marked.filter(F.col("rank") <= limit)
    near = docs.select("doc_id", *columns).filter(rank <= F.lit(top))
    return near.join(drawn, "doc_id").select(*columns, "label", "rank")
