"""Aggregates over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyroll.catalog.base import Query, prepared, r8, sql
from tallyroll.operators import aggregates as ag
from tallyroll.operators import ordered as od
from tallyroll.operators.filters import filter_used
from tallyroll.sources import load_table, receipts

_RAW = ["User_id", "Merchant_id", "Coupon_id", "Discount_rate", "Distance", "Date_received", "Date"]
_DISTANCES = list(range(11))


def _quoted(column):
    return '"Date"' if column == "Date" else column


def group_avg(spark, sf_dir):
    return ag.group_avg(prepared(spark, sf_dir), ["Merchant_id"], "discount", "mean_discount").select(
        "Merchant_id", r8("mean_discount")
    )


def group_median(spark, sf_dir):
    return od.group_median(prepared(spark, sf_dir), ["User_id"], "discount", "median_discount").select(
        "User_id", r8("median_discount")
    )


def group_median_wide(spark, sf_dir):
    items = load_table(spark, sf_dir, "lineitem")
    return od.group_median(items, ["l_returnflag"], "l_extendedprice", "median_price", wide=True).select(
        "l_returnflag", r8("median_price")
    )


def cond_agg(spark, sf_dir):
    return ag.cond_agg(prepared(spark, sf_dir), ["User_id"]).select(
        "User_id", "used", r8("used_discount"), r8("used_distance")
    )


def pivot_cols(spark, sf_dir):
    wide = ag.pivot_cols(prepared(spark, sf_dir), "Distance", _DISTANCES, "discount")
    return wide.select(*[r8(F.col(f"`{d}`"), f"distance_{d}") for d in _DISTANCES])


QUERIES = {
    "group_sum": Query(
        lambda spark, sf_dir: ag.group_sum(prepared(spark, sf_dir), ["User_id"], "label", "used"),
        sql("SELECT User_id, CAST(sum(label) AS BIGINT) AS used FROM prep GROUP BY User_id"),
    ),
    "group_count": Query(
        lambda spark, sf_dir: ag.group_count(receipts(spark, sf_dir), ["User_id", "Merchant_id"], "coupons", "Coupon_id"),
        sql("SELECT User_id, Merchant_id, count(Coupon_id) AS coupons FROM receipts GROUP BY ALL"),
    ),
    "group_avg": Query(group_avg, sql("""
SELECT Merchant_id, round(avg(discount), 8) AS mean_discount FROM prep GROUP BY Merchant_id""")),
    "group_min_max": Query(
        lambda spark, sf_dir: ag.group_min_max(receipts(spark, sf_dir), ["User_id"], "Date_received", "first", "last"),
        sql('SELECT User_id, min(Date_received) AS "first", max(Date_received) AS "last" FROM receipts GROUP BY User_id'),
    ),
    "group_median": Query(group_median, sql("""
SELECT User_id, round(median(discount), 8) AS median_discount FROM prep
WHERE discount IS NOT NULL GROUP BY User_id""")),
    "group_median_wide": Query(group_median_wide, """
SELECT l_returnflag, round(median(l_extendedprice), 8) AS median_price FROM lineitem GROUP BY l_returnflag"""),
    "group_count_distinct": Query(
        lambda spark, sf_dir: ag.group_count_distinct(
            filter_used(prepared(spark, sf_dir)), ["User_id"], "Merchant_id", "merchants"
        ),
        sql("SELECT User_id, count(DISTINCT Merchant_id) AS merchants FROM prep WHERE label = 1 GROUP BY User_id"),
    ),
    "group_count_distinct_2step": Query(
        lambda spark, sf_dir: ag.group_count_distinct_2step(
            prepared(spark, sf_dir), ["User_id"], "Merchant_id", "merchants"
        ),
        sql("SELECT User_id, count(DISTINCT Merchant_id) AS merchants FROM prep GROUP BY User_id"),
    ),
    "cond_agg": Query(cond_agg, sql("""
SELECT User_id, count(*) FILTER (label = 1) AS used, round(avg(discount) FILTER (label = 1), 8) AS used_discount,
  round(avg(Distance) FILTER (label = 1 AND Distance <> -1), 8) AS used_distance
FROM prep GROUP BY User_id""")),
    "global_stats": Query(
        lambda spark, sf_dir: ag.global_stats(receipts(spark, sf_dir)),
        sql("""
SELECT count(*) AS record_count, count(Date_received) AS received_count, count(DISTINCT Coupon_id) AS coupon_count,
  count(DISTINCT User_id) AS user_count, count(DISTINCT Merchant_id) AS merchant_count,
  min(Date_received) AS min_received, max(Date_received) AS max_received,
  min("Date") AS min_date, max("Date") AS max_date FROM receipts"""),
    ),
    "column_counts": Query(
        lambda spark, sf_dir: ag.column_counts(receipts(spark, sf_dir)),
        sql("\nUNION ALL ".join(f"""SELECT '{c}' AS "column", count({_quoted(c)}) AS n FROM receipts""" for c in _RAW)),
    ),
    "null_ratio": Query(
        lambda spark, sf_dir: ag.null_ratio(receipts(spark, sf_dir)).select("column", r8("null_ratio")),
        sql("\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", round(avg(CAST({_quoted(c)} IS NULL AS INTEGER)), 8) AS null_ratio FROM receipts"""
            for c in _RAW
        )),
    ),
    "value_counts": Query(
        lambda spark, sf_dir: ag.value_counts(receipts(spark, sf_dir), "Discount_rate"),
        sql("""
SELECT Discount_rate, count(*) AS n FROM receipts WHERE Discount_rate IS NOT NULL
GROUP BY Discount_rate ORDER BY n DESC, Discount_rate"""),
    ),
    "value_shares": Query(
        lambda spark, sf_dir: ag.value_shares(receipts(spark, sf_dir), "Discount_rate").select("Discount_rate", r8("share")),
        sql("""
SELECT Discount_rate, round(count(*) / sum(count(*)) OVER (), 8) AS share FROM receipts
WHERE Discount_rate IS NOT NULL GROUP BY Discount_rate"""),
    ),
    "frequency_map": Query(
        lambda spark, sf_dir: ag.frequency_map(receipts(spark, sf_dir), "Distance"),
        sql("SELECT Distance, count(*) AS n FROM receipts WHERE Distance IS NOT NULL GROUP BY Distance"),
    ),
    "pivot_cols": Query(pivot_cols, sql(
        "SELECT " + ", ".join(f"round(avg(discount) FILTER (Distance = {d}), 8) AS distance_{d}" for d in _DISTANCES)
        + " FROM prep"
    )),
}
