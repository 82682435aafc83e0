"""Values of a key packed into arrays, for sums that are taken over all rows again and again.

One pass over the rows, without an exchange: a task gathers ``GATHER`` rows, merges equal values of a key and writes one row per key
with two arrays. A later pass joins its few parameters to these rows and adds up in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import materialized

GATHER = 200_000


def _merged(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    names = pc.dictionary_encode(table.column(0), null_encoding="encode").combine_chunks()
    names = names.chunk(0) if isinstance(names, pa.ChunkedArray) else names
    code, value = names.indices.to_numpy(zero_copy_only=False), table.column(1).to_numpy()
    order = np.lexsort((value, code))
    code, value = code[order], value[order]
    first = np.ones(len(value), bool)
    first[1:] = (code[1:] != code[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(first)
    code, value, count = code[at], value[at], np.diff(np.append(at, len(value)))
    keys = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    ends = pa.array(np.append(keys, len(code)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [names.dictionary.take(pa.array(code[keys])), pa.ListArray.from_arrays(ends, pa.array(value)), pa.ListArray.from_arrays(ends, pa.array(count))],
        names=[table.column_names[0], "values", "counts"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GATHER:
            yield _merged(held)
            held, rows = [], 0
    if rows:
        yield _merged(held)


def packed(long: DataFrame, key: str = "series") -> DataFrame:
    """``(key, values, counts)``: the values of ``long`` that are not null in ascending pieces, with how often each occurs; written."""
    rows = long.select(F.col(key).cast("string").alias(key), F.col("value").cast("double").alias("value")).filter("value IS NOT NULL")
    return materialized(rows.mapInArrow(_packed, f"`{key}` string, values array<double>, counts array<long>"))


def pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row number, values and counts of the packed rows of a batch."""
    values, counts = batch.column("values"), batch.column("counts")
    for i in range(batch.num_rows):
        yield i, values[i].values.to_numpy(), counts[i].values.to_numpy().astype(np.float64)


def merged_of(rows: DataFrame, key: str = "series") -> DataFrame:
    """``(key, value, cnt)``: the equal values of all packed rows merged, and written."""
    long = rows.select(key, F.explode(F.arrays_zip("values", "counts")).alias("e"))
    return materialized(long.groupBy(key, F.col("e.values").alias("value")).agg(F.sum("e.counts").alias("cnt")))
