"""What the operators on text corpora share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Characters of text that a Python task works on at a time, so its memory does not follow the Arrow batch.
BLOCK_CHARS = 1_000_000

#: The most rows in an Arrow batch, if the session allows more: the batches of a task are held outside of the heap.
BATCH_ROWS = 500

#: White space between words.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(docs: DataFrame, wish: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone (null text: empty), so extra columns of any name do not matter."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def about(rows: DataFrame, wanted: int, *keys: str) -> DataFrame:
    """About ``wanted`` rows, drawn by a hash of ``keys``; all rows if there are no more.

    A filter, so no task and not the driver has to put the draws of all tasks together.
    """
    total = rows.count()
    if total <= wanted:
        return rows
    return rows.where(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < int(wanted / total * (1 << 40)))


#: Whole numbers may be null and are not turned into doubles, which would round them.
_WHOLE = {pa.int64(): pd.Int64Dtype()}.get


def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """The same rows in frames of about BLOCK_CHARS characters of text; a longer text is alone."""
    for batch in batches:
        if batch.num_rows:
            mark = np.cumsum(pc.utf8_length(batch.column("text")).to_numpy().astype(np.int64)) // BLOCK_CHARS
            cuts = [0, *(np.flatnonzero(np.diff(mark)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
                yield batch.slice(begin, end - begin).to_pandas(types_mapper=_WHOLE)


_shared: set[str] = set()


def to_python(df: DataFrame) -> DataFrame:
    """``df``, after seeing to it that its texts go to Python workers in small batches, and that the workers of a
    local session can import this package.

    They start in the folder the program was started in, wherever the package lies. On
    a cluster the package is installed, or given by ``--py-files``, like any other.
    """
    spark, rows = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.master.startswith("local[") and context.applicationId not in _shared:
        _shared.add(context.applicationId)
        context.addFile(str(Path(__file__).parents[1]), recursive=True)
    return df


def map_texts(docs: DataFrame, function: Callable[[Iterator[pd.DataFrame]], Iterable[pd.DataFrame]], schema: str) -> DataFrame:
    """``docs.mapInArrow`` by a function on frames of bounded size; whole numbers may be null."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in function(blocks(batches)):
            yield pa.RecordBatch.from_pandas(frame, schema=arrow, preserve_index=False)

    return to_python(docs).mapInArrow(run, schema)


def map_groups(docs: DataFrame, key: str | Column, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``docs.groupBy(key).applyInArrow`` by a function on frames; whole numbers may be null."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(group: pa.Table) -> pa.Table:
        return pa.Table.from_pandas(function(group.to_pandas(types_mapper=_WHOLE)), schema=arrow, preserve_index=False)

    return to_python(docs).groupBy(key).applyInArrow(run, schema)


def longs(frame: pd.DataFrame, column: str) -> list[int | None]:
    return [None if x is pd.NA else x for x in frame[column].tolist()]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the runs, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
