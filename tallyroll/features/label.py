"""Features of the label window: how a receipt compares with the others of its
user, merchant or coupon in the same window.

Each group needs counts and ranks at several grains of one key. All of them are
brought to one table with a row for each (key, discount), or each (user, coupon,
day), and that table is joined once: the wide side is shuffled once per group.
On such a row, the statistics by day and by distance travel as maps of those that
its receipts have: days are at most those of the calendar window and distances are
0 to 10 or missing. Discounts have no such bound, so they stay rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.operators.aggregates import group_agg, known
from tallyroll.operators.relational import left_join

def _ranks(df: DataFrame, key: str) -> DataFrame:
    """One row per (key, discount, distance, day) with its count ``n``.

    For each of the three it has the rows of the key with the same value and the average ranks of
    the value, null where it is missing, and for the key its rows and its first and last day.
    """
    values = {"discount": F.col("discount"), "distance": F.col("Distance"), "day": F.unix_date("received_day")}
    counts = (
        df.where(F.col(key).isNotNull())
        .select(key, *[value.cast("double").alias(attr) for attr, value in values.items()])
        .groupBy(key, *values).agg(F.count("*").alias("n"))
        .repartition(key)
    )
    of_key, columns = W.partitionBy(key), [key, *values, "n"]
    for attr in values:
        # Missing values come first in both orders, so that one sort serves both windows.
        up_to = F.sum("n").over(of_key.orderBy(attr).rangeBetween(W.unboundedPreceding, W.currentRow))
        counts = counts.withColumns({f"{attr}_n": F.sum("n").over(W.partitionBy(key, attr)), "_up_to": up_to}).select(*columns, f"{attr}_n", "_up_to")
        known = F.sum(F.when(F.col(attr).isNotNull(), F.col("n"))).over(of_key)
        counts = counts.withColumns({"_rows": F.sum("n").over(of_key), "_known": known})
        up = F.col("_up_to") - (F.col("_rows") - F.col("_known")) - (F.col(f"{attr}_n") - 1) / 2
        counts = counts.withColumn("_up", F.when(F.col(attr).isNotNull(), up))
        ranks = {f"{attr}_up": F.col("_up"), f"{attr}_down": F.col("_known") + 1 - F.col("_up")}
        columns += [f"{attr}_n", *ranks]
        counts = counts.withColumns(ranks).select(*columns)
    return counts.withColumns({"_rows": F.sum("n").over(of_key), "_first": F.min("day").over(of_key), "_last": F.max("day").over(of_key)})


def _map_of(attr: str, *fields: str) -> Column:
    entry = F.struct(F.col(attr), F.struct(*[F.col(f"{attr}_{f}").alias(f) for f in fields]))
    return F.map_from_entries(F.collect_set(F.when(F.col(attr).isNotNull(), entry)))


def rank_stats(df: DataFrame, key: str) -> DataFrame:
    """One row per (key, discount): rows of the key, its first and last day, and
    average ranks by discount, distance and day.

    The maps hold the days and distances of the receipts of that key and discount,
    as no other receipt reads the row: all maps of a key together are no longer than
    its receipts, however many discounts it has.
    """
    return (
        _ranks(df, key)
        .groupBy(key, F.col("discount").alias("_discount"))
        .agg(
            F.max("discount_up").alias("_up"), F.max("discount_down").alias("_down"),
            F.max("_rows").alias("_rows"), F.max("_first").alias("_first"), F.max("_last").alias("_last"),
            _map_of("day", "n", "up", "down").alias("_days"), _map_of("distance", "up", "down").alias("_distances"),
        )
    )


def dealt_by(discount: str) -> list[Column]:
    """The discount as whole numbers, equal where it is and where both are missing.

    The hash of a single double is one to one. Unlike doubles, these are compared
    as they are, so that a later step can find its rows dealt by them.
    """
    return [F.xxhash64(discount), F.isnull(discount)]


def attach_stats(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Join the (key, discount) rows; a receipt without a known discount has the null row."""
    right = stats.withColumnRenamed(key, "_key")
    on = F.col(key) == F.col("_key")
    for own, other in zip(dealt_by("discount"), dealt_by("_discount"), strict=True):
        on = on & (own == other)
    return df.join(right, on, "left").drop("_key", "_discount")


def _day() -> Column:
    return F.unix_date("received_day").cast("double")


def _day_stats() -> Column:
    return F.try_element_at("_days", _day())


def rank_columns(prefix: str) -> dict[str, Column]:
    """The six rank features, from the columns of ``rank_stats``."""
    distance = F.try_element_at("_distances", F.col("Distance").cast("double"))
    day = _day_stats()
    return {
        f"{prefix}discount_rate_rank": F.col("_down"),
        f"{prefix}discount_rate_rank_ascend": F.col("_up"),
        f"{prefix}distance_rank": distance["down"],
        f"{prefix}distance_rank_ascend": distance["up"],
        f"{prefix}date_received_rank": day["down"],
        f"{prefix}date_received_rank_ascend": day["up"],
    }


STATS_COLUMNS = ("_up", "_down", "_rows", "_first", "_last", "_days", "_distances")


def user_columns() -> dict[str, Column]:
    return {
        "u_l_total_coupon": F.col("_rows"),
        "u_l_today_coupon": _day_stats()["n"],
        "u_l_if_is_first_received": F.when(_day() == F.col("_first"), 1).otherwise(0),
        "u_l_if_is_last_received": F.when(_day() == F.col("_last"), 1).otherwise(0),
        **rank_columns("u_l_"),
    }


def user_coupon_stats(df: DataFrame) -> DataFrame:
    """Receipts by (user, coupon) and by (user, coupon, day), a row for each day."""
    today = group_agg(
        df, USER_COUPON_DAY, F.count("*").alias("u_l_today_this_coupon")
    )
    pair = W.partitionBy("User_id", "Coupon_id")
    return today.withColumn("u_l_this_coupon", F.sum("u_l_today_this_coupon").over(pair))


USER_COUPON_DAY = ["User_id", "Coupon_id", "received_day"]
USER_COUPON_COLUMNS = ("u_l_this_coupon", "u_l_today_this_coupon")


def user_label_features(df: DataFrame) -> DataFrame:
    """Twelve ``u_l_`` columns."""
    own = attach_stats(df, rank_stats(df, "User_id"), "User_id")
    out = own.withColumns(user_columns()).drop(*STATS_COLUMNS)
    return left_join(out, user_coupon_stats(df), USER_COUPON_DAY)


def merchant_kinds(df: DataFrame) -> DataFrame:
    """By merchant: distinct coupons, and a map from day to the day's distinct coupons.

    A coupon counts for the whole window on its first day only, so the two
    numbers come from one chain of groupings and no distinct count.
    """
    first = F.min("received_day").over(W.partitionBy("Merchant_id", "Coupon_id"))
    columns = ["Merchant_id", "Coupon_id", "received_day"]
    coupon_days = (
        known(df.select(*columns), columns).distinct()
        .withColumn("_new", (F.col("received_day") == first).cast("int"))
    )
    days = coupon_days.groupBy("Merchant_id", "received_day").agg(
        F.count("*").alias("kinds"), F.sum("_new").alias("new")
    )
    entry = F.struct(F.unix_date("received_day").cast("double"), F.col("kinds"))
    return days.groupBy("Merchant_id").agg(
        F.sum("new").alias("_kinds"), F.map_from_entries(F.collect_list(entry)).alias("_kinds_by_day")
    )


def merchant_stats(df: DataFrame) -> DataFrame:
    """With the distinct coupons, also only of the days that receipts of the row have."""
    both = rank_stats(df, "Merchant_id").join(merchant_kinds(df), "Merchant_id", "left")
    return both.withColumn("_kinds_by_day", F.map_filter("_kinds_by_day", lambda day, _: F.map_contains_key("_days", day)))


MERCHANT_STATS_COLUMNS = (*STATS_COLUMNS, "_kinds", "_kinds_by_day")


def merchant_columns() -> dict[str, Column]:
    return {
        "m_l_howmuch_coupon": F.col("_rows"),
        "m_l_howmuch_kindof_coupon": F.col("_kinds"),
        "m_l_howmuch_coupon_today": _day_stats()["n"],
        "m_l_howmuch_kindof_coupon_today": F.try_element_at("_kinds_by_day", _day()),
        **rank_columns("m_l_"),
    }


def merchant_label_features(df: DataFrame) -> DataFrame:
    """Ten ``m_l_`` columns."""
    own = attach_stats(df, merchant_stats(df), "Merchant_id")
    return own.withColumns(merchant_columns()).drop(*MERCHANT_STATS_COLUMNS)


def coupon_columns() -> dict[str, Column]:
    return {"c_l_total_received": F.col("_rows"), **rank_columns("c_l_")}


def coupon_label_features(df: DataFrame) -> DataFrame:
    """Seven ``c_l_`` columns."""
    own = attach_stats(df, rank_stats(df, "Coupon_id"), "Coupon_id")
    return own.withColumns(coupon_columns()).drop(*STATS_COLUMNS)
