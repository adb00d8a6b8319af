"""Row filters and the split into history and label windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallyroll.functions import parse_day

# First days and lengths of the windows.
WINDOWS = {
    "train": {"history": ("2016-01-31", 90), "label": ("2016-04-30", 31)},
    "validate": {"history": ("2016-03-02", 90), "label": ("2016-05-31", 31)},
    "test": {"history": ("2016-04-01", 90)},
}
WINDOWS_V1 = {
    "train": {"history": ("2016-03-02", 60), "middle": ("2016-05-01", 15), "label": ("2016-05-16", 31)},
    "validate": {"history": ("2016-01-16", 60), "middle": ("2016-03-16", 15), "label": ("2016-03-31", 31)},
    "test": {"history": ("2016-04-17", 60), "middle": ("2016-06-16", 15)},
}


def interval(df: DataFrame, contain: str, beginning: str, length: int) -> DataFrame:
    """Rows whose day is one of ``length`` days from ``beginning``; null drops.

    ``contain`` is a date column or raw ``yyyyMMdd`` text. Text of that form
    sorts like the day, so the filter on a raw column reaches the file scan.
    Text that is no day drops.
    """
    first = dt.date.fromisoformat(beginning)
    last = first + dt.timedelta(days=length - 1)
    if isinstance(df.schema[contain].dataType, StringType):
        inside = F.col(contain).between(f"{first:%Y%m%d}", f"{last:%Y%m%d}")
        return df.where(inside & parse_day(contain).isNotNull())
    return df.where(F.col(contain).between(F.lit(first), F.lit(last)))


def split_windows(df: DataFrame, test: DataFrame) -> dict[str, dict[str, DataFrame]]:
    """History by receipt day, all history by purchase day and label frame of each set."""
    return {
        name: {
            "history": interval(df, "Date_received", *spans["history"]),
            "all_history": interval(df, "Date", *spans["history"]),
            "label": interval(df, "Date_received", *spans["label"]) if "label" in spans else test,
        }
        for name, spans in WINDOWS.items()
    }


def split_windows_v1(df: DataFrame, test: DataFrame) -> dict[str, dict[str, DataFrame]]:
    """The older split: 60-day history, 15-day middle by purchase day, 31-day label."""
    return {
        name: {
            "history": interval(df, "Date_received", *spans["history"]),
            "middle": interval(df, "Date", *spans["middle"]),
            "label": interval(df, "Date_received", *spans["label"]) if "label" in spans else test,
        }
        for name, spans in WINDOWS_V1.items()
    }


def filter_used(df: DataFrame) -> DataFrame:
    return df.where(F.col("label") == 1)


def filter_has_distance(df: DataFrame) -> DataFrame:
    return df.where(F.col("Distance") != -1)


def filter_notnull(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def filter_isin(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def filter_compound(df: DataFrame, equal: dict, day: str, first: str, last: str) -> DataFrame:
    """Rows that match every given value and lie inside a closed range of days."""
    hit = F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    for column, value in equal.items():
        hit = hit & (F.col(column) == value)
    return df.where(hit)
