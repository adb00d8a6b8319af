import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyroll.operators import ordered as od


@pytest.fixture(scope="module", autouse=True)
def several_ranges(spark):
    """Keep the small ranges apart, so that groups cross their borders."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture(scope="module")
def hot(spark):
    """4000 rows, a third of them in one group, with ties and nulls."""
    rng = np.random.default_rng(5)
    key = np.where(rng.random(4000) < 1 / 3, 0, rng.integers(1, 40, 4000))
    value = np.where(rng.random(4000) < 0.05, np.nan, np.round(rng.normal(0, 1, 4000), 2))
    return pd.DataFrame({"id": range(4000), "key": key, "value": value, "label": rng.integers(0, 2, 4000)})


@pytest.fixture(scope="module")
def hot_rows(spark, hot):
    return spark.createDataFrame(hot).withColumn("value", F.nanvl("value", F.lit(None))).repartition(5)


def by_id(df, column):
    return df.select("id", column).toPandas().sort_values("id")[column].to_numpy()


def test_toy_ranks(spark):
    df = spark.createDataFrame([(0, 1, 3), (1, 1, 1), (2, 1, 3), (3, 1, None)], "id int, k int, v int")
    for wide in (False, True):
        up = od.avg_rank(df, "k", "v", "r", wide=wide).orderBy("id").collect()
        down = od.avg_rank(df, "k", "v", "r", ascending=False, wide=wide).orderBy("id").collect()
        assert [r["r"] for r in up] == [2.5, 1, 2.5, None]
        assert [r["r"] for r in down] == [1.5, 3, 1.5, None]


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("ascending", [False, True])
def test_ranks_of_a_hot_group(hot, hot_rows, wide, ascending):
    got = by_id(od.avg_rank(hot_rows, "key", "value", "r", ascending, wide), "r")
    np.testing.assert_array_equal(got, hot.groupby("key")["value"].rank(ascending=ascending).to_numpy())


def test_rank_sums(hot_rows):
    up = od.avg_rank(hot_rows, "key", "value", "up")
    both = od.avg_rank(up, "key", "value", "down", ascending=False).where("value IS NOT NULL")
    for row in both.groupBy("key").agg(
        F.count("*").alias("n"), F.sum("up").alias("s"), F.min(F.col("up") + F.col("down")).alias("lo"),
        F.max(F.col("up") + F.col("down")).alias("hi"),
    ).collect():
        assert row["s"] == row["n"] * (row["n"] + 1) / 2
        assert row["lo"] == row["hi"] == row["n"] + 1


def test_one_group_spreads_over_ranges(spark):
    """All rows in one group: the wide form must still use several ranges."""
    df = spark.range(20000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    parts = od.range_parts(df, ["k", "v"])
    assert parts.select("_part").distinct().count() > 1
    counts = od.running_counts(df, ["k"], "v", wide=True)
    assert counts.where("before != v OR total != 20000 OR n != 1").count() == 0


def test_next_value_toy(spark):
    rows = [("p", 40), ("q", 10), ("p", 15), ("p", 40), ("q", 12), ("p", 8), (None, 3), (None, 4), ("q", None), ("p", None), ("q", 10)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, u string, b int")
    want = [40, 10, 40, None, None, 15, None, None, None, None, 12]
    for parts in (2, 16):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = [r["next"] for r in od.next_value(df, "u", "b", "id", "next").orderBy("id").collect()]
        assert got == want
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_next_value_of_null_keys(spark):
    df = spark.range(400).select(F.lit(None).cast("int").alias("u"), (F.col("id") % 50).alias("b"), "id")
    assert od.next_value(df, "u", "b", "id", "next").where("next IS NOT NULL").count() == 0


def test_next_value_of_a_hot_group(hot, hot_rows):
    got = by_id(od.next_value(hot_rows, "key", "value", "id", "next"), "next")
    ordered = hot.dropna().sort_values(["key", "value", "id"])
    want = ordered.groupby("key")["value"].shift(-1).reindex(hot.index)
    np.testing.assert_array_equal(got, want.to_numpy())


def test_range_self_count_toy(spark):
    rows = [(0, 9, 5, dt.date(2019, 6, 1)), (1, 9, 5, dt.date(2019, 6, 8)), (2, 9, 5, dt.date(2019, 6, 9)),
            (3, 9, 6, dt.date(2019, 6, 8)), (4, 9, 5, dt.date(2019, 6, 30)), (5, 8, 5, dt.date(2019, 6, 1)), (6, 9, 5, dt.date(2019, 6, 8))]
    df = spark.createDataFrame(rows, "id int, u int, c int, t date")
    got = od.range_self_count(df, ["u", "c"], "t", "n").orderBy("id").collect()
    assert [r["n"] for r in got] == [3, 4, 3, 1, 1, 1, 4]


def test_edges_and_gaps(spark):
    rows = [(i, 1, dt.date(2016, 5, d)) for i, d in enumerate([1, 1, 2, 9])]
    df = spark.createDataFrame(rows, "id int, u int, day date")
    got = lambda out, c: [r[c] for r in out.orderBy("id").collect()]
    assert got(od.first_flag(df, "u", "day", "f"), "f") == [1, 1, 0, 0]
    assert got(od.last_flag(df, "u", "day", "f"), "f") == [0, 0, 0, 1]
    assert got(od.gap_next(df, "u", "day", "g"), "g") == [1, 1, 7, None]
    assert got(od.gap_prev(df, "u", "day", "g"), "g") == [None, None, 1, 7]
    assert got(od.rows_before(df, ["u"], "day", "b"), "b") == [0, 0, 2, 3]


@pytest.mark.parametrize("wide", [False, True])
def test_median(hot, hot_rows, wide):
    got = {r["key"]: r["m"] for r in od.group_median(hot_rows, ["key"], "value", "m", wide).collect()}
    assert got == pytest.approx(hot.groupby("key")["value"].median().to_dict())


def test_quantiles_and_box(hot, hot_rows):
    values = hot["value"].dropna()
    q = od.group_quantiles(hot_rows, [], "value", {"a": 0.1, "b": 0.25, "c": 1.0}, wide=True).first()
    assert list(q) == pytest.approx(list(values.quantile([0.1, 0.25, 1.0])))
    box = od.box_stats(hot_rows, "value").first()
    q1, q3 = values.quantile(0.25), values.quantile(0.75)
    inside = values.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert (box["whisker_low"], box["whisker_high"]) == (values[inside].min(), values[inside].max())
    assert box["outliers"] == (~inside).sum()


def test_auc(hot, hot_rows):
    pairs = hot.dropna()
    pos, neg = pairs[pairs.label == 1].value.to_numpy(), pairs[pairs.label == 0].value.to_numpy()
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    got = od.exact_auc(hot_rows, "value", "label").first()["auc"]
    assert got == pytest.approx(wins / (len(pos) * len(neg)))


def test_auc_of_one_class_is_missing(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, label int")
    assert od.exact_auc(df, "s", "label").first()["auc"] is None


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, k int, v double")
    assert od.avg_rank(df, "k", "v", "r", wide=True).count() == 0
    assert od.next_value(df, "k", "v", "id", "n").count() == 0


def test_day_series(spark):
    from tallyroll.operators.explore import day_series

    rows = [("a", "2020-02-27"), ("a", "2020-02-27"), ("a", "2020-03-01"), ("b", "2020-03-02"), ("b", "2020-03-09"), ("c", "2020-01-01"), (None, "2020-02-28"), ("a", None)]
    df = spark.createDataFrame(rows, "k string, d string").selectExpr("k", "cast(d as date) d")
    got = {(r["k"], str(r["d"])): (r["n"], r["so_far"]) for r in day_series(df, "d", "2020-02-27", 5, ["k"]).collect()}
    days = ["2020-02-27", "2020-02-28", "2020-02-29", "2020-03-01", "2020-03-02"]
    assert got == {**dict(zip([("a", d) for d in days], [(2, 2), (0, 2), (0, 2), (1, 3), (0, 3)])), **dict(zip([("b", d) for d in days], [(0, 0)] * 4 + [(1, 1)]))}
    whole = [(r["n"], r["so_far"]) for r in day_series(df, "d", "2020-02-27", 5).orderBy("d").collect()]
    assert whole == [(2, 2), (1, 3), (0, 3), (1, 4), (1, 5)]


def test_global_stats_without_sorting(spark):
    from tallyroll.operators.aggregates import global_stats

    rows = [(1, 5, None, None, "20160203"), (1, 6, 9, "20160102", None), (2, 6, 9, "2016x", "20160301"), (None, None, None, "20160131", None)]
    df = spark.createDataFrame(rows, "User_id long, Merchant_id long, Coupon_id long, Date_received string, Date string")
    got = global_stats(df).first().asDict()
    assert got == {
        "record_count": 4, "received_count": 3, "coupon_count": 1, "user_count": 2, "merchant_count": 2,
        "min_received": "20160102", "max_received": "20160131", "min_date": "20160203", "max_date": "20160301",
    }
    assert "SortAggregate" not in global_stats(df)._jdf.queryExecution().toString()
    empty = global_stats(df.limit(0)).first().asDict()
    assert empty["record_count"] == empty["user_count"] == 0 and empty["min_date"] is None


@pytest.mark.parametrize("accuracy", [20, 1000])
def test_approx_quantiles_keep_their_bound(spark, accuracy):
    """The rank of each answer, against the exact ranks; one key has nine tenths of all rows."""
    draw = np.random.default_rng(3)
    rows = [("hot" if i % 10 else "cold", None if i % 97 == 0 else float(x)) for i, x in enumerate(draw.exponential(size=20_000).round(3))]
    df = spark.createDataFrame([*rows, (None, 1.0)], "k string, v double").repartition(7)
    wanted = {"low": 0.1, "mid": 0.5, "high": 0.99}
    got = {r["k"]: r.asDict() for r in od.approx_quantiles(df, ["k"], "v", wanted, accuracy).collect()}
    assert set(got) == {"hot", "cold"}
    for key in got:
        values = np.sort([v for k, v in rows if k == key and v is not None])
        for name, q in wanted.items():
            below, upto = (values < got[key][name]).mean(), (values <= got[key][name]).mean()
            assert below - 1 / accuracy - 1 / len(values) <= q <= upto + 1 / accuracy + 1 / len(values)
    exact = {r["k"]: r["mid"] for r in od.group_quantiles(df, ["k"], "v", {"mid": 0.5}).collect()}
    assert got["hot"]["mid"] == pytest.approx(exact["hot"], abs=0.2)
    assert od.approx_quantiles(df.limit(0), ["k"], "v", wanted).count() == 0
