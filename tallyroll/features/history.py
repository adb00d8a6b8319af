"""Features of the history window, joined to the label frame.

User, merchant and pair numbers all come from one table of (user, merchant)
sums: distinct merchants are its rows, so no distinct count is needed and a hot
user is spread over merchants before it is summed.

A label of the history looks up to 15 days past the end of the history, that is
into the label window. This leak is part of the expected result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions import fill_sentinel, fill_sentinel_int, ratio
from tallyroll.operators.aggregates import group_agg
from tallyroll.operators.relational import left_join

def pair_stats(history: DataFrame, all_history: DataFrame | None = None) -> DataFrame:
    """Sums by (user, merchant) over received coupons.

    With ``all_history``, the rows by purchase day, ``all_used`` sums their
    labels. Both frames are read as one tagged union and grouped once; a side
    without rows for the pair leaves null sums and zero counts.
    """
    columns = ["User_id", "Merchant_id", "label", "Distance", "discount",
               "Date", "Date_received", "use_day", "received_day"]
    rows = history.select(*columns, F.lit(True).alias("_rec"))
    if all_history is not None:
        rows = rows.unionByName(all_history.select(*columns, F.lit(False).alias("_rec")))
    rec = F.col("_rec")
    used, known = rec & (F.col("label") == 1), F.col("Distance") != -1
    raw_gap = F.col("Date").cast("bigint") - F.col("Date_received").cast("bigint")
    return group_agg(
        rows, ["User_id", "Merchant_id"],
        F.count_if(rec).alias("n"),
        F.sum(F.when(rec, F.col("label"))).alias("used"),
        F.sum(F.when(~rec, F.col("label"))).alias("all_used"),
        F.sum(F.when(used, F.col("discount"))).alias("discount_sum"),
        F.count(F.when(used, F.col("discount"))).alias("discount_n"),
        F.sum(F.when(used & known, F.col("Distance"))).alias("used_distance_sum"),
        F.count_if(used & known).alias("used_distance_n"),
        F.sum(F.when(rec & known, F.col("Distance"))).alias("distance_sum"),
        F.count_if(rec & known).alias("distance_n"),
        F.sum(F.when(used, raw_gap)).alias("gap_sum"),
        F.sum(F.when(used, F.datediff("use_day", "received_day"))).alias("gap_days_sum"),
        F.count(F.when(used, raw_gap)).alias("gap_n"),
    )


def user_stats(pairs: DataFrame) -> DataFrame:
    """One row per user; null where there is nothing to average.

    The last two columns, uses by receipt day and by purchase day, are for the
    pair rates.
    """

    def mean(total: str, n: str) -> Column:
        return ratio(F.sum(total), F.sum(n))

    merchants, used_merchants = F.count_if(F.col("n") > 0), F.count_if(F.col("used") > 0)
    return pairs.groupBy("User_id").agg(
        F.sum("n").alias("u_h_total_coupon"),
        F.sum("used").alias("u_h_used"),
        F.sum(F.col("n") - F.col("used")).alias("u_h_not_use"),
        ratio(F.sum("used"), F.sum("n")).alias("u_h_rate_used"),
        mean("discount_sum", "discount_n").alias("u_h_used_average_discount"),
        mean("used_distance_sum", "used_distance_n").alias("u_h_used_average_distance"),
        used_merchants.alias("u_h_used_howmuch_merchant"),
        merchants.alias("u_h_howmuch_merchant"),
        F.when(used_merchants > 0, ratio(used_merchants, merchants)).alias("u_h_rate_used_howmuch_merchant"),
        mean("gap_sum", "gap_n").alias("u_h_timedelta_rec_use"),
        mean("gap_days_sum", "gap_n").alias("u_h_timedelta_rec_use_days"),
        F.sum("used").alias("_user_rec_used"),
        F.sum("all_used").alias("_user_used"),
    )


USAGE = ("_user_rec_used", "_user_used")


def user_fills(with_days: bool = False) -> dict[str, Column]:
    """Fill for users without history; averages of distances and gaps are cut to int."""
    zero = ("u_h_total_coupon", "u_h_used", "u_h_not_use", "u_h_used_howmuch_merchant", "u_h_howmuch_merchant")
    missing = ("u_h_rate_used", "u_h_used_average_discount", "u_h_rate_used_howmuch_merchant")
    columns = {c: F.coalesce(F.col(c), F.lit(0)) for c in zero}
    columns |= {c: fill_sentinel(c, -1.0) for c in missing}
    columns |= {
        "u_h_used_average_distance": fill_sentinel_int("u_h_used_average_distance"),
        "u_h_used_mean_distance": fill_sentinel_int("u_h_used_average_distance"),
        "u_h_timedelta_rec_use": fill_sentinel_int("u_h_timedelta_rec_use"),
    }
    if with_days:
        columns["u_h_timedelta_rec_use_days"] = fill_sentinel_int("u_h_timedelta_rec_use_days")
    return columns


def user_history_features(history: DataFrame, label: DataFrame, with_days: bool = False) -> DataFrame:
    """Eleven ``u_h_`` columns.

    ``u_h_timedelta_rec_use`` subtracts the raw yyyyMMdd numbers; ``with_days``
    adds the same mean in days.
    """
    stats = user_stats(pair_stats(history)).drop(*USAGE)
    out = left_join(label, stats, "User_id").withColumns(user_fills(with_days))
    return out if with_days else out.drop("u_h_timedelta_rec_use_days")


def coupon_history_stats(history: DataFrame) -> DataFrame:
    total, used = F.count("*"), F.sum("label")
    return group_agg(
        history, ["Coupon_id"],
        total.alias("c_h_total_coupon"), used.alias("c_h_used"),
        (total - used).alias("c_h_not_use"), ratio(used, total).alias("c_h_rate_used"),
    )


def coupon_history_fills() -> dict[str, Column]:
    columns = {c: F.coalesce(F.col(c), F.lit(-1)) for c in ("c_h_total_coupon", "c_h_used", "c_h_not_use")}
    return columns | {"c_h_rate_used": fill_sentinel("c_h_rate_used", -1.0)}


def coupon_history_features(history: DataFrame, label: DataFrame) -> DataFrame:
    """Four ``c_h_`` columns; all fills are -1."""
    return left_join(label, coupon_history_stats(history), "Coupon_id").withColumns(coupon_history_fills())


def merchant_history_stats(rows: DataFrame, n: Column, used: Column) -> DataFrame:
    """From receipts (count, sum of labels) or from pair sums, as the columns say."""
    return group_agg(
        rows, ["Merchant_id"],
        n.alias("m_h_total_coupon"), used.alias("m_h_rec_used"), ratio(used, n).alias("m_h_rate_used"),
    )


def merchant_history_fills() -> dict[str, Column]:
    columns = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("m_h_total_coupon", "m_h_rec_used")}
    return columns | {"m_h_rate_used": fill_sentinel("m_h_rate_used", -1.0)}


def merchant_history_features(history: DataFrame, label: DataFrame) -> DataFrame:
    """Three ``m_h_`` columns."""
    stats = merchant_history_stats(history, F.count("*"), F.sum("label"))
    return left_join(label, stats, "Merchant_id").withColumns(merchant_history_fills())


def pair_usage(pairs: DataFrame) -> DataFrame:
    rec, used = "um_h_user_merchant_rec_used", "um_h_user_merchant_used"
    return pairs.select(
        "User_id", "Merchant_id",
        F.col("used").alias(rec), F.col("all_used").alias(used),
        ratio("distance_sum", "distance_n").alias("um_h_user_merchant_mean_distance"),
    )


def pair_fills() -> dict[str, Column]:
    """Rates and fills; every expression reads the columns as joined."""
    rec, used = "um_h_user_merchant_rec_used", "um_h_user_merchant_used"
    return {
        f"{rec}_rate": fill_sentinel(ratio(rec, "_user_rec_used"), -1.0),
        f"{used}_rate": fill_sentinel(ratio(used, "_user_used"), -1.0),
        rec: F.coalesce(F.col(rec), F.lit(0)),
        used: F.coalesce(F.col(used), F.lit(0)),
        "um_h_user_merchant_mean_distance": fill_sentinel_int("um_h_user_merchant_mean_distance"),
    }


def user_merchant_history_features(history: DataFrame, all_history: DataFrame, label: DataFrame) -> DataFrame:
    """Five ``um_h_`` columns. Purchases without a coupon have label 0 and add nothing."""
    pairs = pair_stats(history, all_history)
    usage = user_stats(pairs).select("User_id", *USAGE)
    out = left_join(left_join(label, usage, "User_id"), pair_usage(pairs), ["User_id", "Merchant_id"])
    return out.withColumns(pair_fills()).drop(*USAGE)
