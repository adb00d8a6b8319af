"""Small literal tables and random columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.functions.draws import normal as normal_draw
from tallyroll.functions.draws import uniform


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A table written in the program itself."""
    return spark.createDataFrame(list(rows), schema)


def random_columns(
    df: DataFrame, keys: Sequence[str], normal: Sequence[str] = (), choice: tuple[str, Sequence[str]] | None = None, seed: int = 0
) -> DataFrame:
    """Add standard normal columns and a uniform pick from a list, drawn by a hash of the row's unique ``keys``."""
    out = df
    for i, name in enumerate(normal):
        out = out.withColumn(name, normal_draw(keys, seed + i))
    if choice is not None:
        name, options = choice
        at = (F.floor(uniform(keys, seed + len(normal)) * len(options)) + 1).cast("int")
        out = out.withColumn(name, F.element_at(F.array(*[F.lit(o) for o in options]), at))
    return out
