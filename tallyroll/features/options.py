"""Features that are off by default: one function per family.

Counts and ranks are aggregated before they are joined, as in the default groups.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.functions import fill_sentinel, fill_sentinel_int, ratio
from tallyroll.operators.aggregates import group_agg, known
from tallyroll.operators.ordered import average_rank, group_median, range_self_count, rows_before, running_counts
from tallyroll.operators.relational import agg_join_back, count_over, left_join


def _used() -> Column:
    return F.col("label") == 1


def _known() -> Column:
    return F.col("Distance") != -1


def _user_spread(df: DataFrame, rows: DataFrame, value: str, name: str) -> DataFrame:
    names = {kind: f"u_l_{kind}_{name}" for kind in ("average", "max", "min", "median")}
    stats = group_agg(
        rows, ["User_id"],
        F.avg(value).alias(names["average"]), F.max(value).alias(names["max"]), F.min(value).alias(names["min"]),
    )
    median = group_median(rows, ["User_id"], value, names["median"])
    out = left_join(df, stats.join(median, "User_id", "left"), "User_id")
    return out.withColumns({c: fill_sentinel(F.col(c).cast("double"), -1.0) for c in names.values()})


def user_discount_spread(df: DataFrame) -> DataFrame:
    """Mean, greatest, least and median discount of the user; -1 where none."""
    return _user_spread(df, df, "discount", "discount")


def user_distance_spread(df: DataFrame) -> DataFrame:
    """The same of known distances."""
    return _user_spread(df, df.where(_known()), "Distance", "Distance")


def price_before_ranks(df: DataFrame) -> DataFrame:
    """Average rank of the amount to spend inside user, merchant and coupon."""
    for key, prefix in (("User_id", "u_l_"), ("Merchant_id", "m_l_"), ("Coupon_id", "c_l_")):
        ranks = running_counts(df, [key], "price_before").select(
            key, "price_before",
            average_rank(False).alias(f"{prefix}price_before_rank"),
            average_rank(True).alias(f"{prefix}price_before_rank_ascend"),
        )
        df = left_join(df, ranks, [key, "price_before"])
    return df


def coupon_today_received(df: DataFrame) -> DataFrame:
    return count_over(df, ["Coupon_id", "received_day"], "c_l_today_received")


def user_avg_per_day(df: DataFrame) -> DataFrame:
    """Receipts of the user per day with a receipt."""
    days = group_agg(df, ["User_id", "received_day"], F.count("*").alias("_n"))
    per_user = days.groupBy("User_id").agg((F.sum("_n") / F.count("*")).alias("u_l_avg_per_day"))
    return left_join(df, per_user, "User_id")


def user_same_coupon_same_day(df: DataFrame) -> DataFrame:
    """1 if the user took the same coupon more than once that day."""
    counted = count_over(df, ["User_id", "Coupon_id", "received_day"], "_n")
    return counted.withColumn("u_l_same_coupon_same_day", F.when(F.col("_n") > 1, 1).otherwise(0)).drop("_n")


def user_kind_counts(df: DataFrame) -> DataFrame:
    """Receipts of the user by kind of coupon."""
    return agg_join_back(
        df, ["User_id"],
        F.count_if("is_manjian").alias("u_l_manjian_count"),
        F.count_if(F.col("have_discount") & ~F.col("is_manjian")).alias("u_l_discount_count"),
    )


def days_to_window_end(df: DataFrame, beginning: str, length: int) -> DataFrame:
    """Days from the receipt to the last day of the window."""
    last = dt.date.fromisoformat(beginning) + dt.timedelta(days=length - 1)
    return df.withColumn("u_l_days_to_window_end", F.datediff(F.lit(last), "received_day"))


def receipt_day_and_gap(df: DataFrame) -> DataFrame:
    """Weekday of the receipt, from 1 for Monday, and 1 where the distance is missing; a missing day has no weekday."""
    return df.withColumns({
        "l_weekday": F.weekday("received_day") + 1, "l_distance_missing": F.when(_known(), 0).otherwise(1),
    })


def user_prior_same_coupon(df: DataFrame) -> DataFrame:
    """Receipts of the same coupon by the user on earlier days."""
    return rows_before(df, ["User_id", "Coupon_id"], "received_day", "u_l_prior_same_coupon")


def _attach_null_safe(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be null; compared as pairs of value and nullness, they get shuffles of their own."""
    own = {k: f"_{k}" for k in keys}
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(o)) for k, o in own.items()])
    return df.join(stats.withColumnsRenamed(own), on, "left").drop(*own.values())


def _all_known(*keys: str) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def merchant_pair_counts(df: DataFrame) -> DataFrame:
    """Receipts by merchant with coupon, with coupon and day, and with user.

    The counts by day are summed to those of the pair, so the rows are joined once for
    both, and once more for the users, which share no other key.
    """
    pair = ["Merchant_id", "Coupon_id"]
    days = known(df, pair).groupBy(*pair, "received_day").agg(F.count("*").alias("mc_l_today"))
    days = left_join(days, days.groupBy(*pair).agg(F.sum("mc_l_today").alias("mc_l_total")), pair)
    days = days.withColumn("mc_l_today", F.when(_all_known("received_day"), F.col("mc_l_today")))
    return count_over(_attach_null_safe(df, days, [*pair, "received_day"]), ["Merchant_id", "User_id"], "mu_l_total")


def user_used_distance_range(history: DataFrame, label: DataFrame) -> DataFrame:
    """Least and greatest known distance of the user's used coupons."""
    near = F.when(_used() & _known(), F.col("Distance"))
    names = ("u_h_used_min_distance", "u_h_used_max_distance")
    stats = group_agg(history, ["User_id"], F.min(near).alias(names[0]), F.max(near).alias(names[1]))
    return left_join(label, stats, "User_id").withColumns({c: fill_sentinel_int(c) for c in names})


def user_timedelta_range(history: DataFrame, label: DataFrame) -> DataFrame:
    """Least and greatest days from receipt to use of the user's used coupons.

    The missing fill is null: -1 can be a real gap, as a use before the receipt counts.
    """
    gap = F.when(_used(), F.datediff("use_day", "received_day"))
    stats = group_agg(
        history, ["User_id"], F.min(gap).alias("u_h_min_timedelta"), F.max(gap).alias("u_h_max_timedelta")
    )
    return left_join(label, stats, "User_id")


def _purchases(all_history: DataFrame, key: str, *aggs) -> DataFrame:
    return group_agg(all_history.where(F.col("use_day").isNotNull()), [key], *aggs)


def user_purchases(all_history: DataFrame, label: DataFrame) -> DataFrame:
    """Purchases of the user, and those without a coupon."""
    names = ("u_h_purchases", "u_h_no_coupon_purchases")
    stats = _purchases(
        all_history, "User_id",
        F.count("*").alias(names[0]), F.count_if(F.col("Coupon_id").isNull()).alias(names[1]),
    )
    return left_join(label, stats, "User_id").fillna(0, list(names))


def merchant_sales(all_history: DataFrame, label: DataFrame) -> DataFrame:
    """Sales of the merchant and the share of them with a coupon."""
    stats = _purchases(
        all_history, "Merchant_id",
        F.count("*").alias("m_h_total_sales"), ratio(F.count("Coupon_id"), F.count("*")).alias("m_h_coupon_share"),
    )
    out = left_join(label, stats, "Merchant_id")
    return out.fillna(0, ["m_h_total_sales"]).withColumn("m_h_coupon_share", fill_sentinel("m_h_coupon_share", -1.0))


def pair_total_received(history: DataFrame, label: DataFrame) -> DataFrame:
    """Coupons the user received at the merchant."""
    stats = group_agg(history, ["User_id", "Merchant_id"], F.count("*").alias("um_h_total_received"))
    return left_join(label, stats, ["User_id", "Merchant_id"]).fillna(0, ["um_h_total_received"])


def merchant_received_n_days(df: DataFrame, days: int) -> DataFrame:
    """Receipts at the merchant on the day and the ``days`` before it."""
    return range_self_count(df, ["Merchant_id"], "received_day", f"m_l_received_{days}_days", back=days, ahead=0)


def v1_label_features(df: DataFrame) -> DataFrame:
    """The older counts: only rows with a coupon count.

    Rows are counted by (user, day, coupon) once; the two coarser counts are sums over
    windows of these groups, and the rows are joined with the three once.
    """
    keys = ["User_id", "received_day", "Coupon_id"]
    names = ["feature__this_coupon", "feature__today_coupon", "feature__today_this_coupon"]
    counts = df.groupBy(*keys).agg(F.count("Coupon_id").alias(names[2]))
    for name, coarse in ((names[0], ["User_id", "Coupon_id"]), (names[1], keys[:2])):
        counts = counts.withColumn(name, F.when(_all_known(*coarse), F.sum(names[2]).over(W.partitionBy(*coarse))))
    counts = counts.withColumn(names[2], F.when(_all_known(*keys), F.col(names[2])))
    return _attach_null_safe(df, counts.select(*keys, *names), keys)


def v1_basic_features(df: DataFrame) -> DataFrame:
    """Coupons, mean discount and mean distance of the user; the missing distance -1 takes part."""
    return agg_join_back(
        df, ["User_id"],
        F.count("Coupon_id").alias("feature_basic_total_coupon"),
        F.avg("discount").alias("feature_basic_average_discount"),
        F.avg("Distance").alias("feature_basic_average_distance"),
    )


def v1_usage_features(df: DataFrame) -> DataFrame:
    """Coupons, uses, unused and use rate of the user over the whole table."""
    total, used = F.count("Coupon_id"), F.sum("label")
    return agg_join_back(
        df, ["User_id"],
        total.alias("feature_basic_total_coupon"), used.alias("feature_basic_used"),
        (total - used).alias("feature_basic_not_use"), ratio(used, total).alias("feature_basic_rate_used"),
    )
