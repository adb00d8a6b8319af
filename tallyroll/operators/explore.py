"""Tables behind the exploration charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.functions.draws import draw
from tallyroll.operators.aggregates import group_agg, group_count, known, value_shares
from tallyroll.operators.filters import filter_has_distance, filter_used


def received_per_day(df: DataFrame) -> DataFrame:
    """Coupons received by raw day."""
    return group_count(df, ["Date_received"], "received", "Coupon_id")


def rows_by_distance(df: DataFrame) -> DataFrame:
    """Rows by known distance."""
    return group_count(filter_has_distance(df), ["Distance"], "n")


def use_rate_by_distance(df: DataFrame, with_coupon_only: bool = False) -> DataFrame:
    """Share of label 1 by known distance, over every row unless told otherwise."""
    rows = filter_has_distance(df)
    if with_coupon_only:
        rows = rows.where(F.col("Coupon_id").isNotNull())
    return group_agg(rows, ["Distance"], F.avg("label").alias("use_rate"))


def received_by_discount(df: DataFrame) -> DataFrame:
    return group_count(df, ["discount"], "n")


def monthly_activity(df: DataFrame) -> DataFrame:
    """By month: coupons used (by receipt month), received, and purchases."""
    def event(day: str, used: Column, received: int, consumed: int) -> Column:
        return F.struct(
            F.month(day).alias("month"), used.alias("used"),
            F.lit(received).alias("received"), F.lit(consumed).alias("consumed"),
        )

    events = df.select(F.inline(F.array(
        event("received_day", F.col("label"), 1, 0), event("use_day", F.lit(0), 0, 1)
    )))
    return group_agg(
        events, ["month"],
        *[F.sum(c).alias(c) for c in ("used", "received", "consumed")],
    )


def label_shares(df: DataFrame) -> DataFrame:
    shares = value_shares(df, "label", ordered=False)
    return shares.select(F.when(F.col("label") == 1, "positive").otherwise("negative").alias("name"), "share")


def used_kind_shares(df: DataFrame) -> DataFrame:
    """Share of spend-and-save coupons among the used ones."""
    shares = value_shares(filter_used(df), "is_manjian", ordered=False)
    return shares.select(F.when(F.col("is_manjian"), "manjian").otherwise("discount").alias("name"), "share")


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin number; the greatest value falls in the last bin."""
    return F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")


def _bounds(df: DataFrame, column: str) -> tuple[Column, Column]:
    """Least and greatest value as scalar subqueries. A single value v is
    binned over [v - 0.5, v + 0.5]."""
    values = df.where(F.col(column).isNotNull())
    low, high = F.min(column).cast("double"), F.max(column).cast("double")
    pad = F.when(low == high, 0.5).otherwise(0.0)
    return values.agg(low - pad).scalar(), values.agg(high + pad).scalar()


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Rows by equal-width bin between the least and the greatest value; empty bins are absent."""
    low, high = _bounds(df, column)
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(_bin(F.col(column).cast("double"), low, high, bins).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    width = (high - low) / bins
    return counts.select("bin", (low + F.col("bin") * width).alias("bin_low"), "n")


def histogram_density(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Histogram whose bars have total area 1."""
    one = histogram_density_by(df.select(F.lit(0).alias("all"), column), column, "all", {0: bins})
    return one.drop("all")


def histogram_density_by(df: DataFrame, column: str, by: str, bins: dict) -> DataFrame:
    """Density histogram of each group, with its own range and number of bins.

    Two passes: ranges and sizes of the groups, then the bins. There are only as
    many groups as the caller names, so their ranges are broadcast.
    """
    rows = df.where(F.col(column).isNotNull() & F.col(by).isin(list(bins))).select(
        by, F.col(column).cast("double").alias(column)
    )
    count = F.coalesce(*[F.when(F.col(by) == group, F.lit(n)) for group, n in bins.items()])
    low, high = F.min(column), F.max(column)
    pad = F.when(low == high, 0.5).otherwise(0.0)
    groups = rows.groupBy(by).agg(
        (low - pad).alias("low"), (high + pad).alias("high"), F.count("*").alias("total")
    ).withColumn("bins", count)
    at = F.least(
        F.floor((F.col(column) - F.col("low")) / (F.col("high") - F.col("low")) * F.col("bins")), F.col("bins") - 1
    ).cast("int")
    width = (F.col("high") - F.col("low")) / F.col("bins")
    return (
        rows.join(F.broadcast(groups), by)
        .groupBy(by, "low", "high", "total", "bins", at.alias("bin"))
        .agg(F.count("*").alias("n"))
        .select(
            by, "bin", (F.col("low") + F.col("bin") * width).alias("bin_low"),
            (F.col("n") / (F.col("total") * (F.col("high") - F.col("low")) / F.col("bins"))).alias("density"),
        )
    )


def stacked_bar_data(df: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    """(row, series, value) for every numeric column."""
    doubles = df.select(row, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(row, list(columns), "series", "value")


def pie_shares(df: DataFrame, name: str, value: str, out: str = "share") -> DataFrame:
    """Each row's share of the column's total."""
    total = df.agg(F.sum(value)).scalar()
    return df.select(name, F.try_divide(F.col(value), total).alias(out))


def scatter_sample(df: DataFrame, x: str, y: str, fraction: float, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Two columns of a random share of the rows, drawn by a hash of their unique ``keys``."""
    return df.where(F.substring(draw(keys, seed), 1, 8) < f"{int(fraction * (1 << 32)):08x}").select(x, y)


def day_series(df: DataFrame, day: str, first: str, days: int, keys: Sequence[str] = ()) -> DataFrame:
    """For each key, every day of the range: ``n`` rows on it and ``so_far`` rows in the range up to it.

    Days without rows are there too, with 0 and what came before. Rows are counted by
    (key, day) before the calendar is laid under them, so a hot key has one row a day;
    keys without a row in the range are left out, and without keys the range is one series.
    """
    keys = list(keys)
    start = F.lit(first).cast("date")
    inside = known(df, [*keys, day]).where((F.col(day) >= start) & (F.col(day) < F.date_add(start, days)))
    counts = inside.groupBy(*keys, day).agg(F.count("*").alias("n"))
    calendar = F.explode(F.sequence(start, F.date_add(start, days - 1))).alias(day)
    if keys:
        every = counts.select(*keys).distinct().select(*keys, calendar)
    else:
        every = df.sparkSession.range(1).select(calendar)
    full = every.join(counts, [*keys, day], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    so_far = W.partitionBy(*keys).orderBy(day).rowsBetween(W.unboundedPreceding, 0)
    return full.withColumn("so_far", F.sum("n").over(so_far))
