"""Feature groups on receipts where one user, merchant and coupon hold a third
of the rows, against pandas and against each other."""

import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyroll.features import history as hist
from tallyroll.features import label as lab
from tallyroll.features import options as opt
from tallyroll.plans.dataset import build_dataset, build_features, prepare
from tallyroll.plans.model import score
from tallyroll.plans.older import older_sets, train_older
from tallyroll.sources import receipts as load
from tallyroll.sources import receipts_test

SF = "/root/testdata/sf0.001"


def bag(df, columns):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in df.select(*columns).collect())


@pytest.fixture(scope="module")
def single(frames):
    """The seven groups one after the other."""
    label, history, every = frames["label"], frames["history"], frames["all_history"]
    out = lab.user_label_features(label)
    out = lab.merchant_label_features(out)
    out = lab.coupon_label_features(out)
    out = hist.user_history_features(history, out)
    out = hist.coupon_history_features(history, out)
    out = hist.merchant_history_features(history, out)
    return hist.user_merchant_history_features(history, every, out)


@pytest.fixture(scope="module")
def together(frames):
    return build_features(frames["history"], frames["all_history"], frames["label"])


def test_one_plan_gives_what_the_single_groups_give(single, together):
    assert set(single.columns) == set(together.columns)
    assert len(together.columns) - 52 == 14
    columns = sorted(single.columns)
    assert bag(single, columns) == bag(together, columns)


def test_no_row_is_lost_or_added(frames, together):
    assert together.count() == frames["label"].count()


@pytest.mark.parametrize("key,prefix", [("User_id", "u_l_"), ("Merchant_id", "m_l_"), ("Coupon_id", "c_l_")])
def test_ranks_equal_pandas(together, key, prefix):
    rows = together.toPandas()
    for name, value in (("discount_rate", "discount"), ("distance", "Distance"), ("date_received", "Date_received")):
        column = rows[value].astype(float)
        for ascending in (False, True):
            want = column.groupby(rows[key]).rank(ascending=ascending)
            got = rows[f"{prefix}{name}_rank{'_ascend' if ascending else ''}"]
            np.testing.assert_array_equal(got.to_numpy(), want.to_numpy())


def test_counts_equal_pandas(together):
    rows = together.toPandas()
    size = lambda *keys: rows.groupby(list(keys))["Distance"].transform("size")
    assert (rows["u_l_total_coupon"] == size("User_id")).all()
    assert (rows["u_l_this_coupon"] == size("User_id", "Coupon_id")).all()
    assert (rows["u_l_today_coupon"] == size("User_id", "Date_received")).all()
    assert (rows["u_l_today_this_coupon"] == size("User_id", "Coupon_id", "Date_received")).all()
    assert (rows["m_l_howmuch_coupon_today"] == size("Merchant_id", "Date_received")).all()
    kinds = rows.groupby("Merchant_id")["Coupon_id"].transform("nunique")
    assert (rows["m_l_howmuch_kindof_coupon"] == kinds).all()
    today = rows.groupby(["Merchant_id", "Date_received"])["Coupon_id"].transform("nunique")
    assert (rows["m_l_howmuch_kindof_coupon_today"] == today).all()
    assert (rows["c_l_total_received"] == size("Coupon_id")).all()


def test_ranges(together):
    rows = together.toPandas()
    assert (rows["u_h_used"] + rows["u_h_not_use"] == rows["u_h_total_coupon"]).all()
    for rate in [c for c in rows if "rate" in c and "rank" not in c and c.startswith(("u_h", "c_h", "m_h", "um_h"))]:
        assert (rows[rate].between(0, 1) | (rows[rate] == -1)).all(), rate
    assert (rows["u_h_used_average_distance"] == rows["u_h_used_mean_distance"]).all()


def test_raw_number_gap(spark):
    raw = spark.createDataFrame(
        [(1, 2, 3, "0.9", 1, "20160430", "20160501")],
        "User_id bigint, Merchant_id bigint, Coupon_id bigint, Discount_rate string, Distance int, "
        "Date_received string, `Date` string",
    )
    rows = prepare(raw)
    got = hist.user_history_features(rows, rows, with_days=True).first()
    assert (got["u_h_timedelta_rec_use"], got["u_h_timedelta_rec_use_days"]) == (71, 1)


def test_missing_history_fills(frames):
    label = frames["label"].withColumns({c: F.lit(-5).cast("bigint") for c in ("User_id", "Merchant_id", "Coupon_id")})
    got = build_features(frames["history"], frames["all_history"], label).first().asDict()
    zero = ["u_h_total_coupon", "u_h_used", "u_h_not_use", "u_h_used_howmuch_merchant", "u_h_howmuch_merchant",
            "m_h_total_coupon", "m_h_rec_used", "um_h_user_merchant_rec_used", "um_h_user_merchant_used"]
    history = [c for c in got if c.startswith(("u_h_", "c_h_", "m_h_", "um_h_"))]
    assert len(history) == 11 + 4 + 3 + 5
    assert {c: got[c] for c in history} == {c: 0 if c in zero else -1 for c in history}


def test_unreadable_discount_has_no_rank(frames):
    odd = frames["label"].withColumn("discount", F.when(F.col("Distance") > 5, F.col("discount")))
    got = lab.user_label_features(odd)
    assert got.where("discount IS NULL AND (u_l_discount_rate_rank IS NOT NULL OR u_l_total_coupon IS NULL)").count() == 0
    rows = got.toPandas()
    want = rows.groupby("User_id")["discount"].rank()
    np.testing.assert_array_equal(rows["u_l_discount_rate_rank_ascend"].to_numpy(), want.to_numpy())
    assert (rows["u_l_total_coupon"] == rows.groupby("User_id")["Distance"].transform("size")).all()


def test_dataset_drops_copies(together):
    dataset = build_dataset(together)
    assert dataset.columns[:3] == ["User_id", "Coupon_id", "Date_received"]
    assert dataset.columns[-1] == "label"
    twice = build_dataset(together.unionByName(together))
    assert twice.count() == dataset.count()
    assert dataset.count() < together.count()


def test_dump_sees_all_features(frames, spark):
    seen = []
    build_features(frames["history"], frames["all_history"], frames["label"], dump=lambda df: seen.append(df.count()))
    assert seen == [frames["label"].count()]


def test_prior_same_coupon(frames):
    rows = opt.user_prior_same_coupon(frames["label"]).toPandas()
    days = pd.to_datetime(rows["Date_received"])
    for _, group in rows.assign(day=days).groupby(["User_id", "Coupon_id"]):
        for day, part in group.groupby("day"):
            assert (part["u_l_prior_same_coupon"] == (group["day"] < day).sum()).all()


def test_v1_counts_leave_rows_without_coupon(receipts):
    rows = opt.v1_label_features(receipts).where("Coupon_id IS NULL").first()
    assert rows["feature__this_coupon"] is None and rows["feature__today_coupon"] is None


def test_v1_counts_by_brute_force(receipts):
    """Rows without a user, coupon or day among them."""
    holes = receipts.withColumn("User_id", F.when(F.xxhash64(*receipts.columns) % 11 != 0, F.col("User_id")))
    rows = opt.v1_label_features(holes).collect()
    assert len(rows) == holes.count()
    for name, keys in {
        "feature__this_coupon": ("User_id", "Coupon_id"), "feature__today_coupon": ("User_id", "received_day"),
        "feature__today_this_coupon": ("User_id", "received_day", "Coupon_id"),
    }.items():
        n = Counter()
        for r in rows:
            n[tuple(r[k] for k in keys)] += r["Coupon_id"] is not None
        assert all(r[name] == (None if None in (at := tuple(r[k] for k in keys)) else n[at]) for r in rows)


def test_merchant_pair_counts_without_a_day(receipts):
    rows = opt.merchant_pair_counts(receipts.withColumn("received_day", F.when(F.col("Distance") > 2, F.col("received_day")))).collect()
    seen = [r for r in rows if r["Coupon_id"] is not None and r["received_day"] is None]
    pairs = Counter((r["Merchant_id"], r["Coupon_id"]) for r in rows)
    assert seen and all(r["mc_l_today"] is None and r["mc_l_total"] == pairs[r["Merchant_id"], r["Coupon_id"]] for r in seen)


@pytest.mark.parametrize(("function", "joins"), [(opt.v1_label_features, 1), (opt.merchant_pair_counts, 2)])
def test_few_joins_of_the_wide_rows(spark, receipts, function, joins):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(function(receipts)._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    shuffles = [x for x in plan.split("\n\n") if re.match(r"\s*\(\d+\) Exchange", x)]
    assert sum("Discount_rate#" in x for x in shuffles) == joins < len(shuffles)


def test_older_counts_read_the_rows_once(receipts):
    plan = opt.v1_label_features(receipts)._jdf.queryExecution().optimizedPlan().toString()
    # The rows and their counts; before, each of the counts read them.
    assert len(re.findall(r"Relation ", plan)) == 2


def test_older_sets(receipts, spark):
    sets = older_sets(load(spark, SF), receipts_test(spark, SF))
    assert sets["train"].columns == [*sets["test"].columns, "label"]
    scores = score(train_older(sets["train"], rounds=3), sets["test"]).collect()
    assert len(scores) == sets["test"].count() and all(0 <= r.Probability <= 1 for r in scores)
