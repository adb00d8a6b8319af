"""Sources and sinks: tables written to text and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyroll.catalog.base import Query, label_frame, r8, sql, sql_normal, sql_uniform
from tallyroll.features.label import coupon_label_features
from tallyroll.runtime import new_path
from tallyroll.schema import RECEIPTS, RESULT
from tallyroll.sources import (
    inline_rows, load_table, random_columns, read_csv_header, read_csv_named, read_delimited_numbers,
    receipts, write_csv_header, write_csv_plain,
)

_COLUMNS = 'User_id, Merchant_id, Coupon_id, Discount_rate, Distance, Date_received, "Date"'


def scan_csv_header(spark, sf_dir):
    path = new_path(spark, "receipts-csv")
    write_csv_header(receipts(spark, sf_dir), path)
    return read_csv_header(spark, path, RECEIPTS)


def scan_csv_named(spark, sf_dir):
    path = new_path(spark, "receipts-plain")
    write_csv_plain(receipts(spark, sf_dir), path)
    return read_csv_named(spark, path, RECEIPTS)


def scan_delimited_text(spark, sf_dir):
    path = new_path(spark, "items-text")
    fields = ["l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_returnflag"]
    lines = load_table(spark, sf_dir, "lineitem").select(F.concat_ws(",", *fields).alias("value"))
    blank = inline_rows(spark, [("",)], "value string")
    lines.unionByName(blank).write.text(path)
    return read_delimited_numbers(spark, path, {"quantity": 2, "discount": 3})


_FEATURES = ["User_id", "Coupon_id", "Date_received", "c_l_total_received", "c_l_distance_rank"]


def sink_csv_header(spark, sf_dir):
    path = new_path(spark, "features-csv")
    features = coupon_label_features(label_frame(spark, sf_dir)).select(*_FEATURES)
    write_csv_header(features, path)
    return read_csv_header(spark, path, features.schema)


def sink_csv_plain(spark, sf_dir):
    path = new_path(spark, "result-csv")
    rows = label_frame(spark, sf_dir).select("User_id", "Coupon_id", "Date_received", r8("discount", "Probability"))
    write_csv_plain(rows, path)
    return read_csv_named(spark, path, RESULT)


def inline_rows_query(spark, sf_dir):
    kinds = inline_rows(
        spark, [("R", "bought without coupon"), ("A", "coupon used"), ("N", "coupon not used")],
        "l_returnflag string, kind string",
    )
    counts = load_table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(kinds), "l_returnflag").select("kind", "n")


def random_table(spark, sf_dir):
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey")
    return random_columns(orders, ["o_orderkey"], [f"data{i}" for i in range(5)], ("letter", ["a", "b", "c"]), seed=7).select(
        "o_orderkey", *[r8(f"data{i}") for i in range(5)], "letter")


QUERIES = {
    "scan_csv_header": Query(scan_csv_header, sql(f"SELECT {_COLUMNS} FROM receipts")),
    "scan_csv_named": Query(scan_csv_named, sql(f"SELECT {_COLUMNS} FROM receipts")),
    "scan_delimited_text": Query(
        scan_delimited_text, "SELECT l_quantity AS quantity, l_discount AS discount FROM lineitem"
    ),
    "sink_csv_header": Query(sink_csv_header, sql("""
SELECT User_id, Coupon_id, Date_received, count(*) OVER (PARTITION BY Coupon_id) AS c_l_total_received,
  rank() OVER (PARTITION BY Coupon_id ORDER BY Distance DESC)
    + (count(*) OVER (PARTITION BY Coupon_id, Distance) - 1) / 2.0::DOUBLE AS c_l_distance_rank
FROM lab""")),
    "sink_csv_plain": Query(
        sink_csv_plain, sql("SELECT User_id, Coupon_id, Date_received, round(discount, 8) AS Probability FROM lab")
    ),
    "inline_rows": Query(inline_rows_query, """
SELECT kind, count(*) AS n
FROM lineitem JOIN (VALUES ('R', 'bought without coupon'), ('A', 'coupon used'), ('N', 'coupon not used')) k(flag, kind)
  ON l_returnflag = flag
GROUP BY kind"""),
    "random_table": Query(random_table, f"""
SELECT o_orderkey, {", ".join(f"{sql_normal('o_orderkey', 7 + i)} AS data{i}" for i in range(5))},
  ['a', 'b', 'c'][CAST(floor({sql_uniform('o_orderkey', 12)} * 3) AS INTEGER) + 1] AS letter
FROM orders"""),
}
