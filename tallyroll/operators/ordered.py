"""Ranks, neighbours and other results that need order inside a group.

A window over raw rows would put a whole hot group into one task. So rows are
first counted by (key, value); the window then sees one row per distinct value.
That is enough for days, distances and rates, whose values are few. For a value
that may take any number of values, ``wide=True`` sorts by range over all tasks,
so even one group with all rows is spread, and adds up the parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.operators.aggregates import group_agg, known
from tallyroll.operators.relational import agg_join_back, left_join
from tallyroll.runtime import stage

_PART = "_part"
_EARLIER = (W.unboundedPreceding, -1)
_WHOLE = (W.unboundedPreceding, W.unboundedFollowing)


def range_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Spread ``df`` over tasks by ranges of ``order`` and keep the range number.

    The result is staged: range bounds come from a sample, and all readers must
    see the same ones.
    """
    ranged = df.repartitionByRange(*order).withColumn(_PART, F.spark_partition_id())
    return stage(ranged, "range-parts")


def running_counts(
    df: DataFrame, keys: Sequence[str], value: str, *extra: Column, wide: bool = False, rows: str | None = None
) -> DataFrame:
    """One row per (keys, value): ``n`` rows, ``before`` rows of the key with a
    smaller value, ``total`` rows of the key. Null keys and values are left out.
    The wide form also has ``_part``, the number of the row's range. Where ``df`` is
    counted already, the column ``rows`` says how many rows each of its rows stands for.
    """
    keys = list(keys)
    counted = F.count("*") if rows is None else F.sum(rows)
    counts = group_agg(df, [*keys, value], counted.alias("n"), *extra)

    def summed(rows: DataFrame, group: Sequence[str]) -> DataFrame:
        ordered = W.partitionBy(*group).orderBy(value)
        return rows.withColumns({
            "before": F.coalesce(F.sum("n").over(ordered.rowsBetween(*_EARLIER)), F.lit(0)),
            "total": F.sum("n").over(ordered.rowsBetween(*_WHOLE)),
        })

    if not wide:
        return summed(counts, keys)
    counts = range_parts(counts, [*keys, value])
    local = summed(counts, [_PART, *keys])
    across = W.partitionBy(*keys)
    # A border between two ranges is crossed by one key at most, so the keys kept
    # here are fewer than the ranges: small enough to broadcast at any data size.
    crossing = (
        counts.groupBy(_PART, *keys).agg(F.sum("n").alias("_sum"))
        .withColumns({
            "_offset": F.coalesce(F.sum("_sum").over(across.orderBy(_PART).rowsBetween(*_EARLIER)), F.lit(0)),
            "_total": F.sum("_sum").over(across),
            "_parts": F.count("*").over(across),
        })
        .where(F.col("_parts") > 1)
        .drop("_sum", "_parts")
    )
    return (
        local.join(F.broadcast(crossing), [_PART, *keys], "left")
        .withColumns({
            "before": F.col("before") + F.coalesce("_offset", F.lit(0)),
            "total": F.coalesce("_total", "total"),
        })
        .drop("_offset", "_total")
    )


def average_rank(ascending: bool = True) -> Column:
    """Rank with ties averaged, from the columns of ``running_counts``."""
    rank = F.col("before") + (F.col("n") + 1) / 2
    return rank if ascending else F.col("total") + 1 - rank


def avg_rank(
    df: DataFrame, key: str, value: str, out: str, ascending: bool = True, wide: bool = False
) -> DataFrame:
    """Average-tie rank of ``value`` inside ``key``; a null value has a null rank."""
    ranks = running_counts(df, [key], value, wide=wide).select(key, value, average_rank(ascending).alias(out))
    return left_join(df, ranks, [key, value])


def _edge_flag(df: DataFrame, key: str, day: str, out: str, pick) -> DataFrame:
    marked = agg_join_back(df, [key], pick(day).alias("_edge"))
    return marked.withColumn(out, F.when(F.col(day) == F.col("_edge"), 1).otherwise(0)).drop("_edge")


def first_flag(df: DataFrame, key: str, day: str, out: str) -> DataFrame:
    """1 on every row of the key's first day, else 0."""
    return _edge_flag(df, key, day, out, F.min)


def last_flag(df: DataFrame, key: str, day: str, out: str) -> DataFrame:
    """1 on every row of the key's last day, else 0."""
    return _edge_flag(df, key, day, out, F.max)


def next_value(df: DataFrame, key: str, value: str, row_id: str, out: str) -> DataFrame:
    """The value of the row that follows inside the key by (value, row id).

    Rows are sorted by range over all tasks; the last row of a key in a range
    takes the first value of the key's next range. Null where key or value is.
    """
    parts = range_parts(df, [key, value, row_id])
    following = F.lead(value).over(W.partitionBy(_PART, key).orderBy(value, row_id))
    first = parts.where(F.col(value).isNotNull()).groupBy(_PART, key).agg(F.min(value).alias("_first"))
    # Only keys that cross a border between ranges: fewer rows than ranges.
    crossing = first.select(
        _PART, key, F.lead("_first").over(W.partitionBy(key).orderBy(_PART)).alias("_next")
    ).where(F.col("_next").isNotNull())
    return (
        parts.withColumn(out, following)
        .join(F.broadcast(crossing), [_PART, key], "left")
        .withColumn(out, F.when(F.col(key).isNotNull() & F.col(value).isNotNull(), F.coalesce(out, "_next")))
        .drop(_PART, "_next")
    )


def _distinct_days(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    return known(df, [*keys, day]).select(*keys, day).distinct()


def gap_next(df: DataFrame, key: str, day: str, out: str) -> DataFrame:
    """Days until the key's next day with a row; null on the last."""
    later = F.lead(day).over(W.partitionBy(key).orderBy(day))
    days = _distinct_days(df, [key], day).withColumn(out, F.datediff(later, F.col(day)))
    return left_join(df, days, [key, day])


def gap_prev(df: DataFrame, key: str, day: str, out: str) -> DataFrame:
    """Days since the key's previous day with a row; null on the first."""
    earlier = F.lag(day).over(W.partitionBy(key).orderBy(day))
    days = _distinct_days(df, [key], day).withColumn(out, F.datediff(F.col(day), earlier))
    return left_join(df, days, [key, day])


def range_self_count(
    df: DataFrame, keys: Sequence[str], day: str, out: str, back: int = 7, ahead: int = 7
) -> DataFrame:
    """Rows of the same keys with a day in [day - back, day + ahead], on every row."""
    counts = group_agg(df, [*keys, day], F.count("*").alias("_n"))
    near = W.partitionBy(*keys).orderBy(F.unix_date(day)).rangeBetween(-back, ahead)
    return left_join(df, counts.withColumn(out, F.sum("_n").over(near)).drop("_n"), [*keys, day])


def rows_before(df: DataFrame, keys: Sequence[str], day: str, out: str) -> DataFrame:
    """Rows of the same keys on earlier days, on every row."""
    counts = running_counts(df, keys, day).select(*keys, day, F.col("before").alias(out))
    return left_join(df, counts, [*keys, day])


def quantiles_of(counts: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact quantiles by key from ``running_counts``, interpolated between neighbours."""

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("before") <= index) & (index < F.col("before") + F.col("n")), F.col(value)))

    aggs = []
    for name, q in quantiles.items():
        place = (F.col("total") - 1) * F.lit(q)
        low, high = at(F.floor(place)), at(F.ceil(place))
        share = F.max(place - F.floor(place))
        aggs.append((low + (high - low) * share).alias(name))
    return counts.groupBy(*keys).agg(*aggs)


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float], wide: bool = False
) -> DataFrame:
    """Exact quantiles by key, one column each."""
    return quantiles_of(running_counts(df, keys, value, wide=wide), keys, value, quantiles)


def approx_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Quantiles by key from a mergeable sketch, one column each: values that are in ``df``, not between two of them.

    The rank of a value is off by no more than a share of 1 / ``accuracy`` of the key's
    rows. A task keeps a sketch for each key, whose size follows ``accuracy``, not the
    rows or their distinct values. Null keys and values are left out.
    """
    rows = known(df, [*keys, value])
    return rows.groupBy(*keys).agg(*[F.percentile_approx(value, q, accuracy).alias(name) for name, q in quantiles.items()])


def group_median(df: DataFrame, keys: Sequence[str], value: str, out: str, wide: bool = False) -> DataFrame:
    """Exact median by key."""
    return group_quantiles(df, keys, value, {out: 0.5}, wide)


def box_stats(df: DataFrame, value: str, keys: Sequence[str] = (), wide: bool = True) -> DataFrame:
    """Quartiles by key, whiskers inside 1.5 quartile ranges, and the number of outliers.

    Distinct values, not rows, are held against the quartiles. In the wide form
    the quartiles go to each (key, range), so a key with all rows stays spread.
    """
    keys = list(keys)
    counts = running_counts(df, keys, value, wide=wide)
    box = quantiles_of(counts, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    slots = [*keys, _PART] if wide else keys
    if not keys:
        # One row; as a scalar subquery it needs no join.
        rows = counts.withColumn("_box", box.select(F.struct("*")).scalar()).select("*", "_box.*")
    else:
        rows = left_join(counts, counts.select(*slots).distinct().join(box, keys), slots)
    x = F.col(value)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    )


def exact_auc(df: DataFrame, score: str, label: str, out: str = "auc") -> DataFrame:
    """Area under the ROC curve of one score, from average ranks; one row."""
    hits = F.sum(F.col(label).cast("long")).alias("hits")
    ranked = running_counts(df, [], score, hits, wide=True)
    totals = ranked.agg(
        F.sum(F.col("hits") * average_rank()).alias("rank_sum"),
        F.sum("hits").cast("double").alias("pos"),
        F.sum(F.col("n") - F.col("hits")).cast("double").alias("neg"),
    )
    wins = F.col("rank_sum") - F.col("pos") * (F.col("pos") + 1) / 2
    return totals.select(F.try_divide(wins, F.col("pos") * F.col("neg")).alias(out))
