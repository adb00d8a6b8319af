"""Coupon receipts read from the order tables by integer rules.

A line item is a receipt row: the customer is the user, the supplier the
merchant, the part the coupon. Return flag ``R`` is a purchase without coupon,
``A`` a coupon used after 0..24 days, ``N`` a coupon not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_DAY = "2016-01-01"
TEST_FIRST_DAY = "2016-07-01"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day_text(first: str, offset: Column) -> Column:
    day = F.date_add(F.lit(first).cast("date"), offset.cast("int"))
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("string")


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_returnflag", "l_linestatus", "l_discount", "l_quantity",
    )
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    offset = (F.col("l_orderkey") * 31 + F.col("l_linenumber") * 7 + F.col("l_partkey")) % 167
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "*",
        offset.alias("day_offset"),
        ((F.col("l_suppkey") + F.col("o_custkey")) % 12).cast("int").alias("distance_code"),
        (100 - F.round(F.col("l_discount") * 100).cast("int")).alias("percent"),
    )


def _id_columns() -> list[Column]:
    return [
        F.col("o_custkey").alias("User_id"),
        F.col("l_suppkey").alias("Merchant_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_partkey")).alias("Coupon_id"),
        F.when(F.col("distance_code") < 11, F.col("distance_code")).alias("Distance"),
    ]


def _discount_text() -> Column:
    part = F.col("l_partkey")
    threshold = F.concat(
        (10 * (1 + part % 20)).cast("string"), F.lit(":"), (1 + part % 10).cast("string")
    )
    rate = F.when(F.col("percent") == 100, "1").otherwise(
        F.concat(F.lit("0."), F.lpad(F.col("percent").cast("string"), 2, "0"))
    )
    return F.when(F.col("l_returnflag") != "R", F.when(F.col("l_linestatus") == "F", threshold).otherwise(rate))


def _with_texts(rows: DataFrame, **texts: Column) -> DataFrame:
    """Add text columns that later expressions read as if they came from a file.

    Made by a generator of one row, they are computed once. As plain columns
    they would be written out again at each place that a filter or a parser
    uses them.
    """
    return rows.select(
        *_id_columns(), F.inline(F.array(F.struct(*[c.alias(name) for name, c in texts.items()])))
    )


_ORDER = ["User_id", "Merchant_id", "Coupon_id", "Discount_rate", "Distance", "Date_received"]


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training file: one row per receipt or purchase, with the purchase day."""
    offset, flag = F.col("day_offset"), F.col("l_returnflag")
    used = F.when(flag == "R", offset).when(flag == "A", offset + F.col("l_quantity").cast("int") % 25)
    return _with_texts(
        _joined(spark, sf_dir),
        Discount_rate=_discount_text(),
        Date_received=F.when(flag != "R", _day_text(FIRST_DAY, offset)),
        Date=_day_text(FIRST_DAY, used),
    ).select(*_ORDER, "Date")


def receipts_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test file: receipts of the month after, without the purchase day."""
    rows = _joined(spark, sf_dir).where(F.col("l_returnflag") != "R")
    return _with_texts(
        rows,
        Discount_rate=_discount_text(),
        Date_received=_day_text(TEST_FIRST_DAY, F.col("day_offset") % 31),
    ).select(*_ORDER)
