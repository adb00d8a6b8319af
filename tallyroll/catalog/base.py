"""Shared inputs of the registered queries and the common head of their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.operators.filters import split_windows
from tallyroll.plans.dataset import prepare, preprocess, stage_receipts
from tallyroll.sources import receipts, receipts_test


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(receipts(spark, sf_dir))


def prepared_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess(receipts_test(spark, sf_dir), has_outcome=False)


def train_frames(spark: SparkSession, sf_dir: str, *columns: str) -> dict[str, DataFrame]:
    """Staged, as features read the frames several times; the test file is not read.

    ``columns`` names those that are read beside the days; without it all are staged."""
    return split_windows(stage_receipts(receipts(spark, sf_dir), columns), prepared_test(spark, sf_dir))["train"]


def label_frame(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return train_frames(spark, sf_dir, *columns)["label"]


def r8(column: str | Column, out: str | None = None) -> Column:
    """Rounded to eight places, as sums of doubles depend on their order."""
    name = out or column
    return F.round(F.col(column) if isinstance(column, str) else column, 8).alias(name)


def text(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


_RECEIPTS = """
WITH j AS (
  SELECT *, (l_orderkey * 31 + l_linenumber * 7 + l_partkey) % 167 AS day_offset,
    CAST((l_suppkey + o_custkey) % 12 AS INTEGER) AS dm,
    100 - CAST(round(l_discount * 100) AS INTEGER) AS pct
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
coupon_rows AS (
  SELECT *, o_custkey AS User_id, l_suppkey AS Merchant_id,
    CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS Coupon_id,
    CASE WHEN l_returnflag = 'R' THEN NULL
         WHEN l_linestatus = 'F' THEN concat(CAST(10 * (1 + l_partkey % 20) AS VARCHAR), ':', CAST(1 + l_partkey % 10 AS VARCHAR))
         WHEN pct = 100 THEN '1'
         ELSE concat('0.', lpad(CAST(pct AS VARCHAR), 2, '0')) END AS Discount_rate,
    CASE WHEN dm < 11 THEN dm END AS raw_distance
  FROM j),
raw AS (
  SELECT User_id, Merchant_id, Coupon_id, Discount_rate, raw_distance AS Distance,
    CASE WHEN l_returnflag <> 'R' THEN CAST(DATE '2016-01-01' + CAST(day_offset AS INTEGER) AS DATE) END AS received_day,
    CASE WHEN l_returnflag = 'R' THEN CAST(DATE '2016-01-01' + CAST(day_offset AS INTEGER) AS DATE)
         WHEN l_returnflag = 'A' THEN CAST(DATE '2016-01-01' + CAST(day_offset + CAST(l_quantity AS INTEGER) % 25 AS INTEGER) AS DATE) END AS use_day
  FROM coupon_rows),
receipts AS (
  SELECT *, strftime(received_day, '%Y%m%d') AS Date_received, strftime(use_day, '%Y%m%d') AS "Date" FROM raw),
raw_test AS (
  SELECT User_id, Merchant_id, Coupon_id, Discount_rate, raw_distance AS Distance,
    CAST(DATE '2016-07-01' + CAST(day_offset % 31 AS INTEGER) AS DATE) AS received_day
  FROM coupon_rows WHERE l_returnflag <> 'R'),
"""


def _typed(source: str) -> str:
    a, b = "CAST(split_part(Discount_rate, ':', 1) AS DOUBLE)", "CAST(split_part(Discount_rate, ':', 2) AS DOUBLE)"
    return f"""
  SELECT * REPLACE (coalesce(Distance, -1) AS Distance),
    Discount_rate IS NOT NULL AS have_discount,
    CASE WHEN contains(Discount_rate, ':') THEN ({a} - {b}) / {a} ELSE TRY_CAST(Discount_rate AS DOUBLE) END AS discount,
    coalesce(contains(Discount_rate, ':'), FALSE) AS is_manjian,
    CASE WHEN contains(Discount_rate, ':') THEN {a} ELSE -1.0::DOUBLE END AS price_before,
    CASE WHEN contains(Discount_rate, ':') THEN {a} ELSE TRY_CAST(Discount_rate AS DOUBLE) END AS price_or_rate
  FROM {source}"""


_PREPARED = f"""
prep AS (
  SELECT *, CASE WHEN date_diff('day', received_day, use_day) <= 15 THEN 1 ELSE 0 END AS label FROM ({_typed("receipts")})),
test_prep AS ({_typed("(SELECT *, strftime(received_day, '%Y%m%d') AS Date_received FROM raw_test)")}),
"""


def window_ctes(history: tuple[str, str], label: tuple[str, str] | None) -> str:
    """hist, allh and lab: closed day ranges; without a label range, the test rows."""
    lab = (
        f"SELECT * FROM prep WHERE received_day BETWEEN '{label[0]}' AND '{label[1]}'"
        if label else "SELECT *, CAST(NULL AS INTEGER) AS label FROM test_prep"
    )
    return f"""
hist AS (SELECT * FROM prep WHERE received_day BETWEEN '{history[0]}' AND '{history[1]}'),
allh AS (SELECT * FROM prep WHERE use_day BETWEEN '{history[0]}' AND '{history[1]}'),
lab AS ({lab})"""


TRAIN = (("2016-01-31", "2016-04-29"), ("2016-04-30", "2016-05-30"))
VALIDATE = (("2016-03-02", "2016-05-30"), ("2016-05-31", "2016-06-30"))
TEST = (("2016-04-01", "2016-06-29"), None)


def sql(body: str, *ctes: str, windows=TRAIN) -> str:
    """The query over receipts, prep, test_prep, hist, allh and lab."""
    return _RECEIPTS + _PREPARED + ",\n".join([window_ctes(*windows), *ctes]) + "\n" + body


def sql_uniform(keys: str, seed: int) -> str:
    """The draws of ``functions.draws``; ``keys`` are the key columns with commas."""
    return f"((CAST(('0x' || substr(md5(concat_ws('|', {keys}, '{seed}')), 1, 13)) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)"


def sql_normal(keys: str, seed: int) -> str:
    return f"round(sqrt(-2 * ln({sql_uniform(keys, seed)})) * cos(2 * pi() * {sql_uniform(keys, seed + 1_000_003)}), 8)"


def sql_avg_rank(key: str, value: str, ascending: bool) -> str:
    way = "ASC" if ascending else "DESC"
    return (
        f"CASE WHEN {value} IS NOT NULL THEN rank() OVER (PARTITION BY {key} ORDER BY {value} {way} NULLS LAST)"
        f" + (count(*) OVER (PARTITION BY {key}, {value}) - 1) / 2.0::DOUBLE END"
    )
