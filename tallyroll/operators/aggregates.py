"""Grouped and global aggregates. Rows with a null key are left out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.runtime import stage


def known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where no given column is null, as plain filters that reach the scan."""
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def group_agg(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return known(df, keys).groupBy(*keys).agg(*aggs)


def group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return group_agg(df, keys, F.sum(value).alias(out))


def group_count(df: DataFrame, keys: Sequence[str], out: str, of: str = "*") -> DataFrame:
    """Rows by key, or not-null values of one column."""
    return group_agg(df, keys, F.count(of).alias(out))


def group_avg(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return group_agg(df, keys, F.avg(value).alias(out))


def group_min_max(df: DataFrame, keys: Sequence[str], value: str, low: str, high: str) -> DataFrame:
    return group_agg(df, keys, F.min(value).alias(low), F.max(value).alias(high))


def group_count_distinct(df: DataFrame, keys: Sequence[str], value: str, out: str, approximate: bool = False) -> DataFrame:
    """Distinct values by key.

    The exact form drops copies of (key, value) first, so a hot key spreads over
    its values before the count.
    """
    count = F.approx_count_distinct if approximate else F.countDistinct
    return group_agg(df, keys, count(value).alias(out))


def group_count_distinct_2step(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """The same number by two groupings: pairs, then pairs by key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    pairs = known(df, [*keys, value]).groupBy(*keys, value).agg(F.count("*").alias("rows"))
    return pairs.groupBy(*keys).agg(F.count("*").alias(out))


def cond_agg(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Used receipts by key: count, mean discount, and mean distance where known."""
    used = F.col("label") == 1
    return group_agg(
        df, keys,
        F.count_if(used).alias("used"),
        F.avg(F.when(used, F.col("discount"))).alias("used_discount"),
        F.avg(F.when(used & (F.col("Distance") != -1), F.col("Distance"))).alias("used_distance"),
    )


def global_stats(df: DataFrame) -> DataFrame:
    """One row: sizes, distinct ids and the range of both days (yyyyMMdd text; other text is no day).

    The input is read once: each row becomes one row per id, with the row's own facts
    beside the first. Rows are summed by (kind, id) before the shuffle. Days are numbers
    on the way and ids stay what they are, so every step is a hash aggregate.
    """
    kinds = {"coupon": "Coupon_id", "user": "User_id", "merchant": "Merchant_id"}
    types = {df.schema[c].dataType.simpleString() for c in kinds.values()}
    as_id = (lambda c: F.col(c)) if len(types) == 1 else (lambda c: F.col(c).cast("string"))
    days = {"received": "Date_received", "date": "Date"}
    facts = {
        "records": F.lit(1).cast("long"), "received": F.col("Date_received").isNotNull().cast("long"),
        **{f"{n}_day": F.col(c).cast("string").try_cast("int") for n, c in days.items()},
    }
    nothing = {name: F.lit(None).cast("long" if name in ("records", "received") else "int") for name in facts}
    ids = F.array(*[
        F.struct(F.lit(i).cast("byte").alias("kind"), as_id(c).alias("id"), *[v.alias(name) for name, v in (facts if i == 0 else nothing).items()])
        for i, c in enumerate(kinds.values())
    ])
    ranges = [f(f"{n}_day").alias(f"{w}_{n}_day") for n in days for w, f in (("min", F.min), ("max", F.max))]
    parts = df.select(F.inline(ids)).groupBy("kind", "id").agg(F.sum("records").alias("records"), F.sum("received").alias("received"), *ranges)
    return parts.agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("record_count"),
        F.coalesce(F.sum("received"), F.lit(0)).alias("received_count"),
        *[f(f"{w}_{n}_day").cast("string").alias(f"{w}_{n}") for n in days for w, f in (("min", F.min), ("max", F.max))],
        *[F.count_if((F.col("kind") == i) & F.col("id").isNotNull()).alias(f"{kind}_count") for i, kind in enumerate(kinds)],
    )


def _one_row_per_column(df: DataFrame, aggs: dict[str, Column], out: str) -> DataFrame:
    wide = df.agg(*[agg.alias(c) for c, agg in aggs.items()])
    return wide.unpivot([], list(aggs), "column", out)


def column_counts(df: DataFrame) -> DataFrame:
    """Not-null values of each column, as (column, n)."""
    return _one_row_per_column(df, {c: F.count(c) for c in df.columns}, "n")


def null_ratio(df: DataFrame) -> DataFrame:
    """Share of nulls of each column, as (column, null_ratio)."""
    return _one_row_per_column(df, {c: F.avg(F.col(c).isNull().cast("int")) for c in df.columns}, "null_ratio")


def value_counts(df: DataFrame, column: str, ordered: bool = True) -> DataFrame:
    """Rows by value, most frequent first; null left out."""
    counts = group_count(df, [column], "n")
    return counts.orderBy(F.desc("n"), column) if ordered else counts


def value_shares(df: DataFrame, column: str, ordered: bool = True) -> DataFrame:
    """Share of rows by value, greatest first; null left out."""
    # Staged, as the counts are read twice and the input once.
    counts = stage(group_count(df, [column], "n"), "value-counts")
    total = counts.agg(F.sum("n")).scalar()
    shares = counts.select(column, (F.col("n") / total).alias("share"))
    return shares.orderBy(F.desc("share"), column) if ordered else shares


def frequency_map(df: DataFrame, column: str) -> DataFrame:
    return group_count(df, [column], "n")


def pivot_cols(df: DataFrame, column: str, values: Sequence, value: str) -> DataFrame:
    """Mean of ``value`` with one output column for each given value of ``column``."""
    return df.groupBy().pivot(column, list(values)).agg(F.avg(value))
