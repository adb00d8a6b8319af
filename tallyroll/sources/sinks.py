"""Writers of text files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv_header(df: DataFrame, path: str) -> None:
    """Feature dump: one folder of CSV parts, each with the header."""
    df.write.mode("errorifexists").csv(path, header=True, nullValue="null")


def write_csv_plain(df: DataFrame, path: str) -> None:
    """Result or importance file: values only."""
    df.write.mode("errorifexists").csv(path, header=False, nullValue="null")
