"""License scan by diagonal voting, in DataFrame operations only.

All word pairs of every text are joined to the pairs of a fixed list of templates (hash join, then the words
themselves are compared). A hit of pair ``off`` of a template at word ``i`` votes for the diagonal ``i - off``; the votes of a
diagonal are kept as bits, so repeated rows count once. Whole diagonals are places of the exact phrases; for longer
notices neighbouring diagonals, which inserted or missing words cause, are merged, and the merged span is
verified: it holds at least ``SHARE`` of the template's pairs within one and a half times its length. Where notices or
their beginnings repeat, diagonals chain to spans that are too long; then the parts of a chain that begin at one of its
diagonals and reach ``REACH`` further are verified, and the best one (largest share, shortest, first) stands for the chain.

Words are runs of digits, letters a-z (A-Z lowered) and characters beyond ASCII. A null text is empty. Rows with equal
``doc_id`` and text get equal results, each its own row; a null ``doc_id`` is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHARE, GAP = 0.75, 3
#: How many diagonals further a part of a chain may reach.
REACH = (0, 3, 6, 12, 24)
# Phrases that count wherever they stand.
PHRASES = (
    ("cc-by", "cc by"),
    ("gpl", "general public license"),
    ("reserved", "all rights reserved"),
)
# Wording of public licenses' notices; matched with gaps. At most 62 words each.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                   "associated documentation files"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def template_rows() -> list[tuple[int, str, bool, int, int, str, str]]:
    """``(template, label, base, pairs, off, first word, second word)``."""
    rows = []
    for t, (label, text, base) in enumerate([(*p, True) for p in PHRASES] + [(*n, False) for n in NOTICES]):
        words = text.split()
        rows += [(t, label, base, len(words) - 1, i, words[i], words[i + 1]) for i in range(len(words) - 1)]
    return rows


def values_sql() -> str:
    return ", ".join(f"({t}, '{label}', {base}, {n}, {off}, '{a}', '{b}')" for t, label, base, n, off, a, b in template_rows())


def _templates(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {values_sql()} AS t(template, label, base, pairs, off, w1, w2)").withColumn(
        "pair", F.xxhash64("w1", "w2"))


def scan_words(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def spans(docs: DataFrame) -> DataFrame:
    """Verified spans and one row without template per document: ``doc_id, mark, copies, n_words, template, label, base,
    start, stop`` (words, end included) and ``share`` of the template's pairs."""
    words = docs.select("doc_id", F.xxhash64("text").alias("mark"), scan_words("text").alias("words"))
    # Place -1 stands for the document itself.
    pairs = words.select("doc_id", "mark", "words", F.explode(F.sequence(F.lit(-1), F.greatest(F.size("words") - 2, F.lit(-1)))).alias("i"))
    i = F.col("i")
    one, two = F.get("words", i), F.get("words", i + 1)
    pairs = pairs.select(
        "doc_id", "mark", "i", F.when(i < 0, F.size("words")).alias("n_words"),
        F.when(i >= 0, one).alias("a"), F.when(i >= 0, two).alias("b"), F.when(i >= 0, F.xxhash64(one, two)).alias("pair"),
    )
    templates = F.broadcast(_templates(docs.sparkSession))  # a constant of a few hundred rows
    hits = pairs.join(templates, "pair", "left").filter("i < 0 or (a = w1 and b = w2)")
    votes = hits.groupBy("doc_id", "mark", "template", "label", "base", "pairs", (i - F.col("off")).alias("diagonal")).agg(
        F.bit_or(F.expr("shiftleft(1L, off)")).alias("bits"), F.min("i").alias("low"), F.max("i").alias("high"),
        F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("copies"),
    )
    along = Window.partitionBy("doc_id", "mark", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(along) > GAP), F.lit(True))
    chains = votes.withColumn("fresh", fresh.cast("int")).withColumn("span", F.sum("fresh").over(along))

    def sound(bits: Column, start: Column, stop: Column) -> Column:
        return (F.bit_count(bits) >= SHARE * F.col("pairs")) & (stop - start <= F.lit(1.5) * (F.col("pairs") + 1))

    def part(reach: int) -> Column:
        over = Window.partitionBy("doc_id", "mark", "template", "span").orderBy("diagonal").rangeBetween(0, reach)
        bits, start, stop = F.bit_or("bits").over(over), F.min("low").over(over), F.max("high").over(over) + 1
        own = F.struct(F.bit_count(bits).alias("n"), (start - stop).alias("less"), (-start).alias("first"))
        return F.when(sound(bits, start, stop), own)

    merged = (
        chains.withColumn("part", F.when(~F.col("base"), F.greatest(*[part(reach) for reach in REACH])))
        .groupBy("doc_id", "mark", "template", "label", "base", "pairs", "span")
        .agg(F.bit_or("bits").alias("bits"), F.min("low").alias("low"), (F.max("high") + 1).alias("high"),
             F.max("part").alias("part"), F.max("n_words").alias("n_words"), F.max("copies").alias("copies"))
    )
    exact = F.col("base") & (F.bit_count("bits") == F.col("pairs"))
    whole = exact | (~F.col("base") & sound(F.col("bits"), F.col("low"), F.col("high")))
    found = F.when(whole, F.struct(
        F.col("low").alias("start"), F.col("high").alias("stop"), F.bit_count("bits").alias("n"))
    ).otherwise(F.when(F.col("part").isNotNull(), F.struct(
        (-F.col("part.first")).alias("start"), (-F.col("part.first") - F.col("part.less")).alias("stop"), F.col("part.n").alias("n"))))
    return merged.withColumn("found", found).filter(F.col("template").isNull() | F.col("found").isNotNull()).select(
        "doc_id", "mark", F.when(F.col("template").isNull(), F.col("copies")).alias("copies"), "n_words", "template", "label",
        "base", "found.start", "found.stop", (F.col("found.n") / F.col("pairs")).alias("share"))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``, one row per input row.
    ``score`` is the largest share of a template that a verified span holds, else 0."""
    base = F.col("base")

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    return (
        spans(docs).groupBy("doc_id", "mark").agg(
            F.max("copies").alias("copies"), F.max("n_words").cast("long").alias("n_words"),
            F.count_if(base).alias("n_base"),
            F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
            joined(F.when(base, F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        )
        .withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )
