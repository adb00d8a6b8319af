"""Embeddings as whole numbers, in tables and in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.llm.common import ranges

#: Rows that a task works on at a time.
CHUNK_ROWS = 2048


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers."""
    number = lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")), F.lit(False))
    return F.coalesce(F.forall(vector, number), F.lit(False))


def whole(vector: Column, scale: int = 256) -> Column:
    """floor(scale * component) of each component, as longs."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def longest(df: DataFrame, column: str) -> int:
    """The length of the longest vector; shorter ones count as if zeros followed."""
    return df.agg(F.max(F.size(column))).first()[0] or 0


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """The lists as rows of ``dims`` numbers, zeros after the shorter ones."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), flat.dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), ranges(np.zeros(len(sizes), np.int64), sizes)] = flat
    return out


def chunks(batches: Iterator[pa.RecordBatch], rows: int = CHUNK_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` or, at the end, fewer."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - count)
            held.append(part)
            count += part.num_rows
            batch = batch.slice(part.num_rows)
            if count == rows:
                yield pa.concat_batches(held)
                held, count = [], 0
    if count:
        yield pa.concat_batches(held)
