import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyroll import functions as fn
from tallyroll.operators import relational as rel


def values(df, column):
    return [row["out"] for row in df.select("id", column.alias("out")).orderBy("id").collect()]


@pytest.fixture(scope="module")
def rates(spark):
    texts = ["150:20", "0.9", None, "x", "0:5", "nan", "5:1:2", "30:", "1"]
    return spark.createDataFrame(list(enumerate(texts)), "id int, r string")


def test_discount_rate(rates):
    assert values(rates, fn.discount_rate("r")) == [130 / 150, 0.9, None, None, None, None, None, None, 1.0]


def test_price_before(rates):
    assert values(rates, fn.price_before("r")) == [150, -1, -1, -1, 0, -1, 5, 30, -1]


def test_price_before_or_rate(rates):
    assert values(rates, fn.price_before_or_rate("r")) == [150, 0.9, None, None, 0, None, 5, 30, 1]


def test_kind_flags(rates):
    assert values(rates, fn.is_manjian("r")) == [True, False, False, False, True, False, True, True, False]
    assert values(rates, fn.have_discount("r")) == [True, True, False, True, True, True, True, True, True]


def test_label(spark):
    days = [("2016-06-01", "2016-06-16"), ("2016-06-01", "2016-06-17"), ("2016-06-05", "2016-06-01"),
            ("2016-06-01", None), (None, "2016-06-01")]
    rows = [(i, *[d and dt.date.fromisoformat(d) for d in pair]) for i, pair in enumerate(days)]
    df = spark.createDataFrame(rows, "id int, received date, used date")
    assert values(df, fn.label_within("used", "received")) == [1, 0, 1, 0, 0]
    assert values(df, fn.label_within("used", "received", min_days=0)) == [1, 0, 0, 0, 0]


def test_parse_day(spark):
    texts = ["20160229", "20150229", None, "2016", "2016010112", "abcdefgh", "201602-1", "20161301"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    assert values(df, fn.parse_day("t")) == [dt.date(2016, 2, 29)] + [None] * 7
    number = spark.createDataFrame([(0, 20160501)], "id int, t int")
    assert values(number, fn.parse_day("t")) == [dt.date(2016, 5, 1)]
    other = spark.createDataFrame([(0, "10202010"), (1, "99202010")], "id int, t string")
    assert values(other, fn.parse_day("t", "ddyyyyMM")) == [dt.date(2020, 10, 10), None]


def test_fills(spark):
    df = spark.createDataFrame([(0, 2.7), (1, None), (2, -2.7)], "id int, x double")
    assert values(df, fn.fill_sentinel_int("x")) == [2, -1, -2]
    assert values(df, fn.fill_sentinel_int("x", 0)) == [2, 0, -2]
    assert values(df, fn.fill_sentinel("x", -1.0)) == [2.7, -1.0, -2.7]
    assert values(df, fn.distance_fill("x")) == [2, -1, -2]
    assert values(df, fn.abs_value("x")) == [2.7, None, 2.7]
    filled = rel.fill_all_zero(df.withColumn("t", F.lit(None).cast("string"))).orderBy("id").collect()
    assert [(r["x"], r["t"]) for r in filled] == [(2.7, None), (0.0, None), (-2.7, None)]


def test_ratio_of_nothing(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 1, 4), (2, None, 4)], "id int, a int, b int")
    assert values(df, fn.fill_sentinel(fn.ratio("a", "b"), -1.0)) == [-1.0, 0.25, -1.0]
    assert values(df, fn.diff_or_default("a", "b")) == [0, 3, -1]


def test_date_later_flag(spark):
    df = spark.createDataFrame(
        [(0, None, dt.date(2021, 12, 12)), (1, dt.date(2022, 1, 1), dt.date(2021, 1, 1))], "id int, x date, y date"
    )
    assert values(df, fn.date_later_flag("x", "y")) == [False, True]
    assert values(df, fn.null_flags("x")[0]) == [True, False]


def test_cast_int_cols(spark):
    df = spark.createDataFrame([(1.9, "20160501")], "a double, b string")
    out = rel.cast_int_cols(df, {"a": "int", "b": "bigint"})
    assert out.dtypes == [("a", "int"), ("b", "bigint")]
    assert out.first() == (1, 20160501)
