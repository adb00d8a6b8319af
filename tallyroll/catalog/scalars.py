"""Projections and scalar columns over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroll import functions as fn
from tallyroll.catalog.base import Query, label_frame, prepared, r8, sql, text
from tallyroll.operators import relational as rel
from tallyroll.operators.aggregates import group_agg
from tallyroll.sources import load_table, receipts

_ID = ["User_id", "Merchant_id", "Coupon_id"]
_ID_SQL = "User_id, Merchant_id, Coupon_id"


def _rows(columns: Callable[[], list[Column]]):
    """Receipts with the given computed columns, made once there is a session."""
    return lambda spark, sf_dir: receipts(spark, sf_dir).select(*_ID, *columns())


def parse_yyyymmdd(spark, sf_dir):
    days = receipts(spark, sf_dir).select(
        *_ID,
        fn.parse_day("Date_received").alias("received_day"),
        fn.parse_day("Date").alias("use_day"),
        fn.parse_day(F.date_format(fn.parse_day("Date_received"), "dd/MM/yyyy"), "dd/MM/yyyy").alias("other_format"),
    )
    return days.select(*_ID, text("received_day"), text("use_day"), text("other_format"))


def _user_means(spark, sf_dir):
    """Label rows with the mean used distance and discount of the user, null where none."""
    rows = prepared(spark, sf_dir)
    used = F.col("label") == 1
    means = group_agg(
        rows, ["User_id"],
        F.avg(F.when(used & (F.col("Distance") != -1), F.col("Distance"))).alias("mean_distance"),
        F.avg(F.when(used, F.col("discount"))).alias("mean_discount"),
    )
    return rel.left_join(rows.select("User_id", "Merchant_id"), means, "User_id")


_MEANS_SQL = """
SELECT p.User_id, p.Merchant_id, {column}
FROM prep p LEFT JOIN (
  SELECT User_id, avg(CASE WHEN label = 1 AND Distance <> -1 THEN Distance END) AS mean_distance,
    avg(CASE WHEN label = 1 THEN discount END) AS mean_discount
  FROM prep GROUP BY User_id) u ON p.User_id = u.User_id"""


def col_arith(spark, sf_dir):
    users = group_agg(
        prepared(spark, sf_dir), ["User_id"],
        F.count("Coupon_id").alias("total"), F.sum("label").alias("used"),
    )
    return users.select(
        "User_id", (F.col("total") - F.col("used")).alias("not_use"), r8(fn.ratio("used", "total"), "rate")
    )


def _raw_number(column):
    return F.col(column).cast("bigint")


def cast_int_cols(spark, sf_dir):
    types = {"User_id": "bigint", "Coupon_id": "bigint", "Date_received": "bigint", "Distance": "int", "label": "int"}
    return rel.cast_int_cols(label_frame(spark, sf_dir), types).select(*types)


def reorder(spark, sf_dir):
    rows = rel.reorder(prepared(spark, sf_dir), "Coupon_id", last=["label"])
    return rel.drop_columns(rows, "received_day", "use_day", "have_discount", "discount", "is_manjian", "price_before")


QUERIES = {
    "parse_yyyymmdd": Query(parse_yyyymmdd, sql(f"""
SELECT {_ID_SQL}, CAST(received_day AS VARCHAR) AS received_day, CAST(use_day AS VARCHAR) AS use_day,
  CAST(received_day AS VARCHAR) AS other_format FROM receipts""")),
    "discount_rate": Query(
        _rows(lambda: [r8(fn.discount_rate("Discount_rate"), "discount")]),
        sql(f"SELECT {_ID_SQL}, round(discount, 8) AS discount FROM prep"),
    ),
    "is_manjian": Query(
        _rows(lambda: [fn.is_manjian("Discount_rate").alias("is_manjian")]), sql(f"SELECT {_ID_SQL}, is_manjian FROM prep")
    ),
    "have_discount": Query(
        _rows(lambda: [fn.have_discount("Discount_rate").alias("have_discount")]),
        sql(f"SELECT {_ID_SQL}, have_discount FROM prep"),
    ),
    "price_before": Query(
        _rows(lambda: [fn.price_before("Discount_rate").alias("price_before")]), sql(f"SELECT {_ID_SQL}, price_before FROM prep")
    ),
    "price_before_or_rate": Query(
        _rows(lambda: [fn.price_before_or_rate("Discount_rate").alias("price_before")]),
        sql(f"SELECT {_ID_SQL}, price_or_rate AS price_before FROM prep"),
    ),
    "distance_fill": Query(
        _rows(lambda: [fn.distance_fill("Distance").alias("Distance")]),
        sql(f"SELECT {_ID_SQL}, coalesce(Distance, -1) AS Distance FROM receipts"),
    ),
    "fill_all_zero": Query(
        lambda spark, sf_dir: rel.fill_all_zero(receipts(spark, sf_dir)),
        sql("""
SELECT User_id, Merchant_id, coalesce(Coupon_id, 0) AS Coupon_id, Discount_rate,
  coalesce(Distance, 0) AS Distance, Date_received, "Date" FROM receipts"""),
    ),
    "fill_sentinel_int": Query(
        lambda spark, sf_dir: _user_means(spark, sf_dir).select(
            "User_id", "Merchant_id", fn.fill_sentinel_int("mean_distance").alias("mean_distance")
        ),
        sql(_MEANS_SQL.format(column="coalesce(CAST(trunc(mean_distance) AS INTEGER), -1) AS mean_distance")),
    ),
    "fill_sentinel": Query(
        lambda spark, sf_dir: _user_means(spark, sf_dir).select(
            "User_id", "Merchant_id", r8(fn.fill_sentinel("mean_discount", -1.0), "mean_discount")
        ),
        sql(_MEANS_SQL.format(column="coalesce(round(mean_discount, 8), -1.0::DOUBLE) AS mean_discount")),
    ),
    "label_15d": Query(
        lambda spark, sf_dir: prepared(spark, sf_dir).select(*_ID, "Date_received", "Date", "label"),
        sql(f'SELECT {_ID_SQL}, Date_received, "Date", label FROM prep'),
    ),
    "received_month": Query(
        _rows(lambda: [F.month(fn.parse_day("Date_received")).alias("received_month")]),
        sql(f"SELECT {_ID_SQL}, CAST(month(received_day) AS INTEGER) AS received_month FROM receipts"),
    ),
    "date_month": Query(
        _rows(lambda: [F.month(fn.parse_day("Date")).alias("date_month")]),
        sql(f"SELECT {_ID_SQL}, CAST(month(use_day) AS INTEGER) AS date_month FROM receipts"),
    ),
    "col_arith": Query(col_arith, sql("""
SELECT User_id, count(Coupon_id) - CAST(sum(label) AS BIGINT) AS not_use,
  round(CAST(sum(label) AS DOUBLE) / nullif(count(Coupon_id), 0), 8) AS rate
FROM prep GROUP BY User_id""")),
    "diff_or_default": Query(
        _rows(lambda: [fn.diff_or_default(_raw_number("Date_received"), _raw_number("Date")).alias("gap")]),
        sql(f'SELECT {_ID_SQL}, coalesce(CAST("Date" AS BIGINT) - CAST(Date_received AS BIGINT), -1) AS gap FROM receipts'),
    ),
    "date_later_flag": Query(
        _rows(lambda: [fn.date_later_flag(fn.parse_day("Date"), fn.parse_day("Date_received")).alias("later")]),
        sql(f"SELECT {_ID_SQL}, coalesce(use_day > received_day, FALSE) AS later FROM receipts"),
    ),
    "abs_col": Query(
        lambda spark, sf_dir: load_table(spark, sf_dir, "customer").select(
            "c_custkey", fn.abs_value("c_acctbal").alias("abs_balance")
        ),
        "SELECT c_custkey, abs(c_acctbal) AS abs_balance FROM customer",
    ),
    "null_predicates": Query(
        _rows(lambda: [flag.alias(name) for flag, name in zip(fn.null_flags("Date"), ("date_null", "date_notnull"))]),
        sql(f'SELECT {_ID_SQL}, "Date" IS NULL AS date_null, "Date" IS NOT NULL AS date_notnull FROM receipts'),
    ),
    "project": Query(
        lambda spark, sf_dir: rel.project(prepared(spark, sf_dir), "User_id", "Merchant_id", "label", "Distance"),
        sql("SELECT User_id, Merchant_id, label, Distance FROM prep"),
    ),
    "drop": Query(
        lambda spark, sf_dir: rel.drop_columns(receipts(spark, sf_dir), "Discount_rate", "Date"),
        sql("SELECT User_id, Merchant_id, Coupon_id, Distance, Date_received FROM receipts"),
    ),
    "rename": Query(
        lambda spark, sf_dir: rel.rename(
            receipts(spark, sf_dir).select("User_id", "Coupon_id", "Distance"), {"Distance": "km", "User_id": "who"}
        ),
        sql("SELECT User_id AS who, Coupon_id, Distance AS km FROM receipts"),
    ),
    "reorder": Query(reorder, sql("""
SELECT Coupon_id, User_id, Merchant_id, Discount_rate, Distance, Date_received, "Date", label FROM prep""")),
    "cast_int_cols": Query(cast_int_cols, sql("""
SELECT User_id, Coupon_id, CAST(Date_received AS BIGINT) AS Date_received, Distance, label FROM lab""")),
    "const_col": Query(
        _rows(lambda: [fn.const_one().alias("cnt"), F.col("Coupon_id").isNotNull().cast("int").alias("has_coupon")]),
        sql(f"SELECT {_ID_SQL}, 1 AS cnt, CAST(Coupon_id IS NOT NULL AS INTEGER) AS has_coupon FROM receipts"),
    ),
    "date_shift": Query(
        _rows(lambda: [
            F.date_format(F.date_add(fn.parse_day("Date_received"), 5), "yyyy-MM-dd").alias("five_days_on"),
            F.date_format(F.date_sub(fn.parse_day("Date_received"), 7), "yyyy-MM-dd").alias("week_before"),
        ]),
        sql(f"""
SELECT {_ID_SQL}, strftime(received_day + 5, '%Y-%m-%d') AS five_days_on,
  strftime(received_day - 7, '%Y-%m-%d') AS week_before FROM receipts"""),
    ),
}
