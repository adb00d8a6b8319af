from collections import Counter

import pytest

from tallyroll.operators import aggregates as ag
from tallyroll.operators import explore as ex
from tallyroll.operators import filters as flt
from tallyroll.operators import relational as rel
from pyspark.sql import functions as F


def bag(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.fixture(scope="module")
def a(spark):
    return spark.createDataFrame([(70, 12), (70, 18), (81, 5), (92, 6), (95, 30)], "c1 int, c2 int")


@pytest.fixture(scope="module")
def b(spark):
    return spark.createDataFrame([(95, 400), (70, 100), (81, 200)], "c1 int, c3 int")


def test_left_join(a, b):
    assert bag(rel.left_join(a, b, "c1")) == Counter([(70, 12, 100), (70, 18, 100), (81, 5, 200), (92, 6, None), (95, 30, 400)])


def test_right_join(a, b):
    assert bag(rel.right_join(a, b, "c1")) == Counter([(95, 30, 400), (70, 12, 100), (70, 18, 100), (81, 5, 200)])


def test_pivot(a):
    wide = ag.pivot_cols(a.withColumn("c6", F.col("c1") - F.col("c2")), "c1", [70, 81, 92, 95], "c6")
    assert wide.first().asDict() == {"70": 55.0, "81": 76.0, "92": 86.0, "95": 65.0}


def test_union(spark):
    c = spark.createDataFrame([(31, "n", 2.5), (32, "s", 4.0)], "place int, side string, far double")
    d = spark.createDataFrame([("w", 33), ("n", 31), ("e", 34)], "side string, place int")
    assert bag(rel.union_rows(c, d)) == Counter([(31, "n", 2.5), (32, "s", 4.0), (33, "w", None), (31, "n", None), (34, "e", None)])


def test_null_keys_stay_without_a_value(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert bag(rel.count_over(df, ["k"], "n")) == Counter({(1, 2): 2, (None, None): 1})


def test_arg_max_and_top(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 7.0)], "id int, v double")
    assert rel.arg_max(df, "v", "id").first() == (3, 7.0)
    assert [r["id"] for r in rel.top_k(df, 2, "v", "id").collect()] == [2, 3]


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, 9), ("a", 1, 8), ("b", 3, 7)], "k string, day int, v int")
    assert bag(rel.first_per_key(df, ["k"], ["day"])) == Counter([("a", 1, 8), ("b", 3, 7)])
    assert bag(rel.first_per_key(df, ["k"], ["day"], ascending=False)) == Counter([("a", 2, 9), ("b", 3, 7)])


@pytest.mark.parametrize("parts", [2, 16])
def test_missing_order_values_come_last(spark, parts):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 7, 3), ("b", None, 4)], "k string, day int, v int").repartition(parts)
    assert bag(rel.first_per_key(df, ["k"], ["day"])) == Counter([("a", 5, 2), ("b", None, 4)])
    assert bag(rel.first_per_key(df, ["k"], ["day"], ascending=False)) == Counter([("a", 7, 3), ("b", None, 4)])
    assert [r["day"] for r in rel.sort_values(df, "day", "v").collect()] == [5, 7, None, None]
    assert [r["v"] for r in rel.sort_values(df, F.desc("day"), "v").collect()] == [3, 2, 1, 4]


def test_reorder_and_drop(a):
    wide = a.withColumn("label", F.lit(1))
    assert rel.reorder(wide, "c2", last=["c1"]).columns == ["c2", "label", "c1"]
    assert rel.drop_columns(wide, "c1").columns == ["c2", "label"]
    assert rel.rename(a, {"c1": "x"}).columns == ["x", "c2"]


def test_sample(spark):
    df = spark.range(1000)
    picked = [r["id"] for r in rel.sample_rows(df, 50, ["id"], seed=4).collect()]
    assert len(set(picked)) == 50
    assert picked == [r["id"] for r in rel.sample_rows(df.repartition(7), 50, ["id"], seed=4).collect()]
    assert picked != [r["id"] for r in rel.sample_rows(df, 50, ["id"], seed=5).collect()]


def test_interval(spark):
    days = ["20160130", "20160131", "20160429", "20160430", None, "2016022x", "20160231"]
    df = spark.createDataFrame([(d,) for d in days], "raw string").withColumn("day", F.try_to_date("raw", "yyyyMMdd"))
    for column in ("raw", "day"):
        kept = sorted(r["raw"] for r in flt.interval(df, column, "2016-01-31", 90).collect())
        assert kept == ["20160131", "20160429"]


def test_interval_reaches_the_scan(spark, receipts):
    plan = flt.interval(receipts, "Date_received", "2016-04-30", 31)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(Date_received), GreaterThanOrEqual(Date_received,20160430)" in plan


def test_windows_do_not_pass_their_last_day(receipts):
    for split in (flt.split_windows, flt.split_windows_v1):
        for name, parts in split(receipts, receipts).items():
            if name != "test":
                last = parts["history"].agg(F.max("received_day")).first()[0]
                first = parts["label"].agg(F.min("received_day")).first()[0]
                assert last is None or first is None or last < first


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert ex.histogram(df, "x", 10).collect() == [(5, 3.0, 2)]


def test_histogram_closes_the_last_bin(spark):
    import numpy as np

    data = [float(v) for v in np.random.default_rng(1).integers(0, 50, 400)]
    df = spark.createDataFrame([(v,) for v in data], "x double")
    counts = {r["bin"]: r["n"] for r in ex.histogram(df, "x", 7).collect()}
    want, edges = np.histogram(data, 7)
    assert [counts.get(i, 0) for i in range(7)] == list(want)
    density = {r["bin"]: r["density"] for r in ex.histogram_density(df, "x", 7).collect()}
    assert density == pytest.approx({i: v for i, v in enumerate(np.histogram(data, 7, density=True)[0]) if v})


def test_use_rate_options(receipts):
    every = {r["Distance"]: r["use_rate"] for r in ex.use_rate_by_distance(receipts).collect()}
    some = {r["Distance"]: r["use_rate"] for r in ex.use_rate_by_distance(receipts, with_coupon_only=True).collect()}
    assert set(every) == set(range(11))
    assert all(some[d] >= every[d] for d in every)


def test_count_distinct_forms_agree(receipts):
    one = ag.group_count_distinct(receipts, ["User_id"], "Merchant_id", "n")
    two = ag.group_count_distinct_2step(receipts, ["User_id"], "Merchant_id", "n")
    assert bag(one) == bag(two)
    near = ag.group_count_distinct(receipts, ["User_id"], "Merchant_id", "n", approximate=True)
    assert near.count() == one.count()


@pytest.mark.parametrize("parts", [1, 2, 16])
def test_columns_are_zipped_by_position(spark, parts):
    """The places are those of the rows' order, however many tasks write or read the files."""
    rows = [(i * 7919 % 101, None if i % 9 == 0 else i) for i in range(101)]
    left = rel.row_positions(spark.createDataFrame(rows, "k long, v long").coalesce(1).repartitionByRange(parts, "k").sortWithinPartitions("k"))
    assert [r["k"] for r in left.orderBy("position").collect()] == sorted(k for k, _ in rows)
    right = left.select("position", (F.col("k") * 2).alias("double"))
    zipped = rel.zip_columns(left, right).collect()
    assert sorted(r["position"] for r in zipped) == list(range(101)) and all(r["double"] == 2 * r["k"] for r in zipped)
    short = rel.zip_columns(left, right.where("position < 40")).collect()
    assert len(short) == 101 and sum(r["double"] is None for r in short) == 61
    assert rel.zip_columns(rel.row_positions(left.limit(0).drop("position")), right.limit(0)).count() == 0
