"""Readers of text files. Schemas are given, so no pass is spent on inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv_header(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line; the word ``null`` and empty fields are null."""
    return spark.read.schema(schema).csv(path, header=True, nullValue="null", enforceSchema=False)


def read_csv_named(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV without a header; the schema names the columns."""
    return spark.read.schema(schema).csv(path, header=False, nullValue="null")


def read_delimited_numbers(
    spark: SparkSession, path: str, fields: dict[str, int], delimiter: str = ","
) -> DataFrame:
    """Plain text lines cut at ``delimiter``; keeps the given field positions as doubles.

    Blank lines, such as the one that ends the flower file, are left out.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    parts = F.split("value", rf"\Q{delimiter}\E")
    return lines.select(
        *[F.try_element_at(parts, F.lit(at + 1)).try_cast("double").alias(name) for name, at in fields.items()]
    )
