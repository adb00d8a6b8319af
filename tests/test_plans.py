"""What the plans must look like at scale, with broadcast joins turned off."""

import re

import pytest
from pyspark.sql import functions as F

from tallyroll.features import label as lab
from tallyroll.operators import ordered as od
from tallyroll.operators import relational as rel
from tallyroll.plans.dataset import build_dataset, build_features
from tallyroll.runtime import stage

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module", autouse=True)
def large_data_plans(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark):
    """One user with a third of 60,000 rows, read from eight files."""
    rows = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("user"),
        F.date_add(F.lit("2016-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    return stage(rows, "test-hot")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("function", [
    lambda df: rel.count_over(df, ["user"], "n"),
    lambda df: od.first_flag(df, "user", "day", "f"),
    lambda df: od.gap_prev(rel.count_over(df, ["user"], "n"), "user", "day", "g"),
])
def test_a_hot_key_is_split(hot, function):
    assert "SortMergeJoin(skew=true)" in final_plan(function(hot))


def test_two_joins_on_one_key_are_both_split(hot):
    plan = final_plan(od.last_flag(od.first_flag(hot, "user", "day", "f"), "user", "day", "l"))
    assert plan.count("SortMergeJoin(skew=true)") == 2


def test_no_python_and_no_global_window(frames):
    out = build_dataset(build_features(frames["history"], frames["all_history"], frames["label"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Arrow|BatchEval|CartesianProduct|NestedLoop|SinglePartition", plan)


def test_wide_side_is_joined_five_times(frames):
    out = build_features(frames["history"], frames["all_history"], frames["label"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # five on the wide side, and user, coupon and two merchant joins among grouped tables
    assert len(re.findall(r"Join LeftOuter", plan)) == 5 + 4


def test_copies_are_dropped_without_a_shuffle(frames):
    out = build_dataset(build_features(frames["history"], frames["all_history"], frames["label"]))
    above = out._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[0]
    assert above.count("HashAggregate") == 2 and "Exchange" not in above


@pytest.mark.parametrize("key", ["User_id", "Merchant_id", "Coupon_id"])
def test_maps_are_no_longer_than_the_receipts(frames, key):
    """One key has a third of the rows and many discounts; each of its rows had a map of all its days before."""
    maps = lab.rank_stats(frames["label"], key).agg(F.sum(F.size("_days")), F.sum(F.size("_distances"))).first()
    assert all(0 < size <= frames["label"].where(F.col(key).isNotNull()).count() for size in maps)


def test_kinds_by_day_are_no_longer_than_the_receipts(frames):
    size = lab.merchant_stats(frames["label"]).agg(F.sum(F.size("_kinds_by_day"))).first()[0]
    assert 0 < size <= frames["label"].count()


def test_missing_and_signed_discounts_find_their_row(spark):
    rows = spark.createDataFrame([(1, d) for d in (0.0, -0.0, None, float("nan"), 0.5)], "User_id long, discount double")
    stats = rows.select("User_id", F.col("discount").alias("_discount")).distinct().withColumn("found", F.lit(True))
    assert [r.found for r in lab.attach_stats(rows, stats, "User_id").collect()] == [True] * 5


def test_only_needed_columns_are_read(frames):
    plan = lab.merchant_kinds(frames["label"])._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"Merchant_id", "Coupon_id", "received_day", "Date_received"}


def test_windows_run_on_grouped_rows(frames):
    """Below every window there is an aggregate: no window sees raw rows."""
    plan = lab.user_label_features(frames["label"])._jdf.queryExecution().optimizedPlan().toString().split("\n")
    depth = lambda line: len(re.match(r"[ :+\-]*", line).group(0))
    for i, line in enumerate(plan):
        if re.search(r"[+:]- Window|^Window", line):
            below = [l for l in plan[i + 1:] if depth(l) > depth(line)]
            assert any("Aggregate" in l for l in below)
