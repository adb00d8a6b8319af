"""Feature groups and the assembled datasets."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallyroll.catalog.base import (
    TEST, TRAIN, VALIDATE, Query, label_frame, prepared, sql, sql_avg_rank, text, train_frames,
)
from tallyroll.features import history as hist
from tallyroll.features import label as lab
from tallyroll.features import options as opt
from tallyroll.operators.filters import WINDOWS, WINDOWS_V1
from tallyroll.operators.relational import union_rows
from tallyroll.plans.dataset import (
    build_dataset, build_features, preprocess, train_validate_test,
)
from tallyroll.plans.model import dump_joined
from tallyroll.plans.older import older_sets
from tallyroll.runtime import new_path
from tallyroll.sources import read_csv_header, receipts, receipts_test

_ID = ["User_id", "Merchant_id", "Coupon_id", "Date_received"]


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to eight places."""
    return df.select(*[
        F.round(f.name, 8).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _added(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row ids and the columns that the function added."""
    return rounded(after.select(*_ID, *[c for c in after.columns if c not in before.columns]))


def on_label(function: Callable[[DataFrame], DataFrame]):
    def run(spark, sf_dir):
        frame = label_frame(spark, sf_dir)
        return _added(frame, function(frame))

    return run


def on_history(function: Callable[[DataFrame, DataFrame], DataFrame], part: str = "history"):
    def run(spark, sf_dir):
        frames = train_frames(spark, sf_dir)
        return _added(frames["label"], function(frames[part], frames["label"]))

    return run


def user_merchant_history(spark, sf_dir):
    frames = train_frames(spark, sf_dir)
    label = frames["label"]
    return _added(label, hist.user_merchant_history_features(frames["history"], frames["all_history"], label))


def preprocess_query(spark, sf_dir):
    rows = preprocess(receipts(spark, sf_dir))
    return rounded(rows.withColumns({c: text(c) for c in ("received_day", "use_day")}))


def _staged_train(spark, sf_dir):
    frames = train_frames(spark, sf_dir)
    return build_features(frames["history"], frames["all_history"], frames["label"])


def build_features_query(spark, sf_dir):
    return rounded(_staged_train(spark, sf_dir).drop("received_day", "use_day"))


def build_dataset_query(spark, sf_dir):
    return rounded(build_dataset(_staged_train(spark, sf_dir)))


def train_validate_test_query(spark, sf_dir):
    sets = train_validate_test(receipts(spark, sf_dir), receipts_test(spark, sf_dir))
    return rounded(reduce(union_rows, [df.withColumn("dataset", F.lit(name)) for name, df in sets.items()]))


def dump_joined_query(spark, sf_dir):
    """The joined training set as it is read back from its dump."""
    path = new_path(spark, "joined-csv")
    sets = train_validate_test(receipts(spark, sf_dir), receipts_test(spark, sf_dir), ["train", "validate"])
    dump_joined(sets["train"], sets["validate"], path)
    return rounded(read_csv_header(spark, path, union_rows(sets["train"], sets["validate"]).schema))


def older_sets_query(spark, sf_dir):
    sets = older_sets(receipts(spark, sf_dir), receipts_test(spark, sf_dir))
    return rounded(reduce(union_rows, [df.withColumn("dataset", F.lit(name)) for name, df in sets.items()]))


# --- SQL -------------------------------------------------------------------

_RANKS = {"discount_rate": "discount", "distance": "Distance", "date_received": "Date_received"}


def _rank_sql(key: str, prefix: str) -> list[str]:
    return [
        f"{sql_avg_rank(key, value, ascending)} AS {prefix}{name}_rank{'_ascend' if ascending else ''}"
        for name, value in _RANKS.items() for ascending in (False, True)
    ]


def _count_sql(out: str, *keys: str) -> str:
    return f"count(*) OVER (PARTITION BY {', '.join(keys)}) AS {out}"


def _edge_sql(out: str, pick: str) -> str:
    return f"CAST(Date_received = {pick}(Date_received) OVER (PARTITION BY User_id) AS INTEGER) AS {out}"


_USER = [
    _count_sql("u_l_total_coupon", "User_id"),
    _count_sql("u_l_this_coupon", "User_id", "Coupon_id"),
    _count_sql("u_l_today_coupon", "User_id", "Date_received"),
    _count_sql("u_l_today_this_coupon", "User_id", "Date_received", "Coupon_id"),
    _edge_sql("u_l_if_is_first_received", "min"),
    _edge_sql("u_l_if_is_last_received", "max"),
    *_rank_sql("User_id", "u_l_"),
]
_MERCHANT = [
    _count_sql("m_l_howmuch_coupon", "Merchant_id"),
    _count_sql("m_l_howmuch_coupon_today", "Merchant_id", "Date_received"),
    *_rank_sql("Merchant_id", "m_l_"),
]
_COUPON = [_count_sql("c_l_total_received", "Coupon_id"), *_rank_sql("Coupon_id", "c_l_")]

_UH = """uh AS (
  SELECT User_id, count(*) AS n, CAST(sum(label) AS BIGINT) AS used,
    avg(discount) FILTER (label = 1) AS discount,
    avg(Distance) FILTER (label = 1 AND Distance <> -1) AS distance,
    count(DISTINCT Merchant_id) AS merchants,
    count(DISTINCT CASE WHEN label = 1 THEN Merchant_id END) AS used_merchants,
    avg(CAST("Date" AS BIGINT) - CAST(Date_received AS BIGINT)) FILTER (label = 1) AS gap,
    avg(date_diff('day', received_day, use_day)) FILTER (label = 1) AS gap_days
  FROM hist GROUP BY User_id)"""
_CH = "ch AS (SELECT Coupon_id, count(*) AS n, CAST(sum(label) AS BIGINT) AS used FROM hist WHERE Coupon_id IS NOT NULL GROUP BY Coupon_id)"
_MH = "mh AS (SELECT Merchant_id, count(*) AS n, CAST(sum(label) AS BIGINT) AS used FROM hist GROUP BY Merchant_id)"
_UM = [
    """rec AS (SELECT User_id, Merchant_id, CAST(sum(label) AS BIGINT) AS used,
    avg(Distance) FILTER (Distance <> -1) AS distance FROM hist GROUP BY ALL)""",
    "purch AS (SELECT User_id, Merchant_id, CAST(sum(label) AS BIGINT) AS used FROM allh GROUP BY ALL)",
    "urec AS (SELECT User_id, sum(label) AS used FROM hist GROUP BY ALL)",
    "upurch AS (SELECT User_id, sum(label) AS used FROM allh GROUP BY ALL)",
]


def _cut(value: str) -> str:
    return f"coalesce(CAST(trunc({value}) AS INTEGER), -1)"


_UH_COLUMNS = [
    "coalesce(uh.n, 0) AS u_h_total_coupon", "coalesce(uh.used, 0) AS u_h_used",
    "coalesce(uh.n - uh.used, 0) AS u_h_not_use",
    "coalesce(round(CAST(uh.used AS DOUBLE) / uh.n, 8), -1.0::DOUBLE) AS u_h_rate_used",
    "coalesce(round(uh.discount, 8), -1.0::DOUBLE) AS u_h_used_average_discount",
    f"{_cut('uh.distance')} AS u_h_used_average_distance", f"{_cut('uh.distance')} AS u_h_used_mean_distance",
    "coalesce(uh.used_merchants, 0) AS u_h_used_howmuch_merchant",
    "coalesce(uh.merchants, 0) AS u_h_howmuch_merchant",
    "CASE WHEN uh.used_merchants > 0 THEN round(CAST(uh.used_merchants AS DOUBLE) / uh.merchants, 8)"
    " ELSE -1.0::DOUBLE END AS u_h_rate_used_howmuch_merchant",
    f"{_cut('uh.gap')} AS u_h_timedelta_rec_use",
]
_CH_COLUMNS = [
    "coalesce(ch.n, -1) AS c_h_total_coupon", "coalesce(ch.used, -1) AS c_h_used",
    "coalesce(ch.n - ch.used, -1) AS c_h_not_use",
    "coalesce(round(CAST(ch.used AS DOUBLE) / ch.n, 8), -1.0::DOUBLE) AS c_h_rate_used",
]
_MH_COLUMNS = [
    "coalesce(mh.n, 0) AS m_h_total_coupon", "coalesce(mh.used, 0) AS m_h_rec_used",
    "coalesce(round(CAST(mh.used AS DOUBLE) / mh.n, 8), -1.0::DOUBLE) AS m_h_rate_used",
]
_UM_COLUMNS = [
    "coalesce(rec.used, 0) AS um_h_user_merchant_rec_used", "coalesce(purch.used, 0) AS um_h_user_merchant_used",
    "coalesce(round(CAST(rec.used AS DOUBLE) / nullif(urec.used, 0), 8), -1.0::DOUBLE) AS um_h_user_merchant_rec_used_rate",
    "coalesce(round(CAST(purch.used AS DOUBLE) / nullif(upurch.used, 0), 8), -1.0::DOUBLE) AS um_h_user_merchant_used_rate",
    f"{_cut('rec.distance')} AS um_h_user_merchant_mean_distance",
]
_UH_JOIN = "LEFT JOIN uh ON l.User_id = uh.User_id"
_CH_JOIN = "LEFT JOIN ch ON l.Coupon_id = ch.Coupon_id"
_MH_JOIN = "LEFT JOIN mh ON l.Merchant_id = mh.Merchant_id"
_UM_JOIN = """LEFT JOIN rec ON l.User_id = rec.User_id AND l.Merchant_id = rec.Merchant_id
LEFT JOIN purch ON l.User_id = purch.User_id AND l.Merchant_id = purch.Merchant_id
LEFT JOIN urec ON l.User_id = urec.User_id LEFT JOIN upurch ON l.User_id = upurch.User_id"""
_KEYS = "l.User_id, l.Merchant_id, l.Coupon_id, l.Date_received"


def _added_sql(columns: list[str], joins: str = "", *ctes: str) -> str:
    return sql(f"SELECT {_KEYS}, {', '.join(columns)} FROM lab l {joins}", *ctes)


_KINDS = [
    "mk AS (SELECT Merchant_id, count(DISTINCT Coupon_id) AS kinds FROM lab GROUP BY ALL)",
    "mdk AS (SELECT Merchant_id, Date_received, count(DISTINCT Coupon_id) AS kinds FROM lab GROUP BY ALL)",
]
_KIND_COLUMNS = ["mk.kinds AS m_l_howmuch_kindof_coupon", "mdk.kinds AS m_l_howmuch_kindof_coupon_today"]
_KIND_JOIN = """LEFT JOIN mk ON l.Merchant_id = mk.Merchant_id
LEFT JOIN mdk ON l.Merchant_id = mdk.Merchant_id AND l.Date_received = mdk.Date_received"""


def features_sql(select: str, windows=TRAIN) -> str:
    """All features in one row, then the given SELECT over ``feats``."""
    same_window = f"ranked AS (SELECT *, {', '.join([*_USER, *_MERCHANT, *_COUPON])} FROM lab)"
    columns = [*_UH_COLUMNS, *_CH_COLUMNS, *_MH_COLUMNS, *_UM_COLUMNS, *_KIND_COLUMNS]
    feats = (
        f"feats AS (SELECT l.* REPLACE (round(l.discount, 8) AS discount), {', '.join(columns)} FROM ranked l "
        f"{_UH_JOIN} {_CH_JOIN} {_MH_JOIN} {_UM_JOIN} {_KIND_JOIN})"
    )
    return sql(select, _UH, _CH, _MH, *_UM, *_KINDS, same_window, feats, windows=windows)


_DROPPED = 'EXCLUDE (Merchant_id, Discount_rate, "Date", received_day, use_day, price_or_rate)'
_DROPPED_TEST = "EXCLUDE (Merchant_id, Discount_rate, received_day, price_or_rate)"
_INT_DAY = "REPLACE (CAST(Date_received AS BIGINT) AS Date_received)"


def _all_sets_sql(*names: str) -> str:
    """The named datasets, or all three, each from its own windows, as one query."""
    parts = []
    for name, windows in (("train", TRAIN), ("validate", VALIDATE), ("test", TEST)):
        if names and name not in names:
            continue
        dropped = _DROPPED_TEST if name == "test" else _DROPPED
        body = features_sql(f"SELECT DISTINCT * {dropped} {_INT_DAY}, '{name}' AS dataset FROM feats", windows)
        parts.append(f"SELECT * FROM ({body})")
    return "\nUNION ALL BY NAME ".join(parts)


_SPREAD = """s AS (SELECT User_id, avg({v}) AS a, max({v}) AS b, min({v}) AS c, median({v}) AS d
  FROM lab WHERE {where} GROUP BY User_id)"""


def _spread_sql(value: str, name: str, where: str) -> str:
    columns = [
        f"coalesce(round(CAST(s.{c} AS DOUBLE), 8), -1.0::DOUBLE) AS u_l_{kind}_{name}"
        for c, kind in zip("abcd", ("average", "max", "min", "median"))
    ]
    return _added_sql(columns, "LEFT JOIN s ON l.User_id = s.User_id", _SPREAD.format(v=value, where=where))


_PRICE_RANKS = [
    f"{sql_avg_rank(key, 'price_before', ascending)} AS {prefix}price_before_rank{'_ascend' if ascending else ''}"
    for key, prefix in (("User_id", "u_l_"), ("Merchant_id", "m_l_"), ("Coupon_id", "c_l_"))
    for ascending in (False, True)
]
_LABEL_FIRST, _LABEL_DAYS = WINDOWS["train"]["label"]


def _v1(function):
    def run(spark, sf_dir):
        rows = prepared(spark, sf_dir)
        return _added(rows, function(rows))

    return run


def _when_known(column: str, *keys: str) -> str:
    guard = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"CASE WHEN {guard} THEN count(Coupon_id) OVER (PARTITION BY {', '.join(keys)}) END AS {column}"


_V1_LABEL = [
    _when_known("feature__this_coupon", "User_id", "Coupon_id"),
    _when_known("feature__today_coupon", "User_id", "Date_received"),
    _when_known("feature__today_this_coupon", "User_id", "Date_received", "Coupon_id"),
]


def _older_sql(name: str, label: str, source: str) -> str:
    return f"""
SELECT DISTINCT '{name}' AS dataset, User_id, Coupon_id, CAST(Date_received AS BIGINT) AS Date_received, Distance, have_discount,
  round(discount, 8) AS discount, round(price_or_rate, 8) AS price_before, {", ".join(_V1_LABEL)}, {label} AS label FROM ({source})"""


def _older_sets_sql() -> str:
    def rows(name: str, part: str) -> str:
        first, days = WINDOWS_V1[name][part]
        day = f"DATE '{first}'"
        return f"SELECT * FROM prep WHERE received_day >= {day} AND received_day < {day} + {days}"

    parts = [("train", "label", rows("validate", "history")), ("validate", "label", rows("train", "label")),
             ("test", "CAST(NULL AS INTEGER)", "SELECT * FROM test_prep")]
    return sql("\nUNION ALL".join(_older_sql(*part) for part in parts))


QUERIES = {
    "user_label_features": Query(on_label(lab.user_label_features), _added_sql(_USER)),
    "merchant_label_features": Query(
        on_label(lab.merchant_label_features),
        sql(f"SELECT {_KEYS}, {', '.join(_KIND_COLUMNS)}, l.* LIKE 'm_l_%' FROM ranked l {_KIND_JOIN}",
            *_KINDS, f"ranked AS (SELECT *, {', '.join(_MERCHANT)} FROM lab)"),
    ),
    "coupon_label_features": Query(on_label(lab.coupon_label_features), _added_sql(_COUPON)),
    "user_history_features": Query(
        on_history(lambda h, l: hist.user_history_features(h, l, with_days=True)),
        _added_sql([*_UH_COLUMNS, f"{_cut('uh.gap_days')} AS u_h_timedelta_rec_use_days"], _UH_JOIN, _UH),
    ),
    "coupon_history_features": Query(on_history(hist.coupon_history_features), _added_sql(_CH_COLUMNS, _CH_JOIN, _CH)),
    "merchant_history_features": Query(
        on_history(hist.merchant_history_features), _added_sql(_MH_COLUMNS, _MH_JOIN, _MH)
    ),
    "user_merchant_history_features": Query(user_merchant_history, _added_sql(_UM_COLUMNS, _UM_JOIN, *_UM)),
    "u_l_discount_spread": Query(
        on_label(opt.user_discount_spread), _spread_sql("discount", "discount", "discount IS NOT NULL")
    ),
    "u_l_distance_spread": Query(
        on_label(opt.user_distance_spread), _spread_sql("Distance", "Distance", "Distance <> -1")
    ),
    "price_before_rank": Query(on_label(opt.price_before_ranks), _added_sql(_PRICE_RANKS)),
    "c_l_today_received": Query(
        on_label(opt.coupon_today_received), _added_sql([_count_sql("c_l_today_received", "Coupon_id", "Date_received")])
    ),
    "u_l_avg_per_day": Query(on_label(opt.user_avg_per_day), _added_sql(
        ["s.a AS u_l_avg_per_day"], "LEFT JOIN s ON l.User_id = s.User_id",
        "s AS (SELECT User_id, round(CAST(count(*) AS DOUBLE) / count(DISTINCT Date_received), 8) AS a FROM lab GROUP BY 1)",
    )),
    "u_l_same_coupon_same_day": Query(on_label(opt.user_same_coupon_same_day), _added_sql([
        "CAST(count(*) OVER (PARTITION BY User_id, Coupon_id, Date_received) > 1 AS INTEGER) AS u_l_same_coupon_same_day"
    ])),
    "u_l_manjian_count": Query(on_label(opt.user_kind_counts), _added_sql([
        "count(*) FILTER (is_manjian) OVER (PARTITION BY User_id) AS u_l_manjian_count",
        "count(*) FILTER (have_discount AND NOT is_manjian) OVER (PARTITION BY User_id) AS u_l_discount_count",
    ])),
    "u_l_days_to_window_end": Query(
        on_label(lambda df: opt.days_to_window_end(df, _LABEL_FIRST, _LABEL_DAYS)),
        _added_sql(["CAST(date_diff('day', received_day, DATE '2016-05-30') AS INTEGER) AS u_l_days_to_window_end"]),
    ),
    "u_l_prior_same_coupon": Query(on_label(opt.user_prior_same_coupon), _added_sql([
        "rank() OVER (PARTITION BY User_id, Coupon_id ORDER BY received_day) - 1 AS u_l_prior_same_coupon"
    ])),
    "mc_l_mu_l_counts": Query(on_label(opt.merchant_pair_counts), _added_sql([
        _count_sql("mc_l_total", "Merchant_id", "Coupon_id"),
        _count_sql("mc_l_today", "Merchant_id", "Coupon_id", "Date_received"),
        _count_sql("mu_l_total", "Merchant_id", "User_id"),
    ])),
    "u_h_used_distance_range": Query(on_history(opt.user_used_distance_range), _added_sql(
        ["coalesce(s.a, -1) AS u_h_used_min_distance", "coalesce(s.b, -1) AS u_h_used_max_distance"],
        "LEFT JOIN s ON l.User_id = s.User_id",
        "s AS (SELECT User_id, min(Distance) AS a, max(Distance) AS b FROM hist WHERE label = 1 AND Distance <> -1 GROUP BY 1)",
    )),
    "u_h_timedelta_range": Query(on_history(opt.user_timedelta_range), _added_sql(
        ["s.a AS u_h_min_timedelta", "s.b AS u_h_max_timedelta"], "LEFT JOIN s ON l.User_id = s.User_id",
        """s AS (SELECT User_id, CAST(min(use_day - received_day) AS INTEGER) AS a,
  CAST(max(use_day - received_day) AS INTEGER) AS b FROM hist WHERE label = 1 GROUP BY 1)""",
    )),
    "u_h_purchases": Query(on_history(opt.user_purchases, "all_history"), _added_sql(
        ["coalesce(s.a, 0) AS u_h_purchases", "coalesce(s.b, 0) AS u_h_no_coupon_purchases"],
        "LEFT JOIN s ON l.User_id = s.User_id",
        "s AS (SELECT User_id, count(*) AS a, count(*) - count(Coupon_id) AS b FROM allh GROUP BY 1)",
    )),
    "m_h_total_sales": Query(on_history(opt.merchant_sales, "all_history"), _added_sql(
        ["coalesce(s.a, 0) AS m_h_total_sales", "coalesce(s.b, -1.0::DOUBLE) AS m_h_coupon_share"],
        "LEFT JOIN s ON l.Merchant_id = s.Merchant_id",
        "s AS (SELECT Merchant_id, count(*) AS a, round(CAST(count(Coupon_id) AS DOUBLE) / count(*), 8) AS b FROM allh GROUP BY 1)",
    )),
    "um_h_total_received": Query(on_history(opt.pair_total_received), _added_sql(
        ["coalesce(s.a, 0) AS um_h_total_received"],
        "LEFT JOIN s ON l.User_id = s.User_id AND l.Merchant_id = s.Merchant_id",
        "s AS (SELECT User_id, Merchant_id, count(*) AS a FROM hist GROUP BY ALL)",
    )),
    "m_l_received_n_days": Query(on_label(lambda df: opt.merchant_received_n_days(df, 7)), _added_sql([
        """count(*) OVER (PARTITION BY Merchant_id ORDER BY received_day
  RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS m_l_received_7_days"""
    ])),
    "v1_label_features": Query(
        _v1(opt.v1_label_features),
        sql(f"SELECT User_id, Merchant_id, Coupon_id, Date_received, {', '.join(_V1_LABEL)} FROM prep"),
    ),
    "v1_basic_features": Query(_v1(opt.v1_basic_features), sql("""
SELECT User_id, Merchant_id, Coupon_id, Date_received,
  count(Coupon_id) OVER w AS feature_basic_total_coupon,
  round(avg(discount) OVER w, 8) AS feature_basic_average_discount,
  round(avg(Distance) OVER w, 8) AS feature_basic_average_distance
FROM prep WINDOW w AS (PARTITION BY User_id)""")),
    "v1_usage_features": Query(_v1(opt.v1_usage_features), sql("""
SELECT User_id, Merchant_id, Coupon_id, Date_received,
  count(Coupon_id) OVER w AS feature_basic_total_coupon,
  CAST(sum(label) OVER w AS BIGINT) AS feature_basic_used,
  count(Coupon_id) OVER w - CAST(sum(label) OVER w AS BIGINT) AS feature_basic_not_use,
  round(CAST(sum(label) OVER w AS DOUBLE) / nullif(count(Coupon_id) OVER w, 0), 8) AS feature_basic_rate_used
FROM prep WINDOW w AS (PARTITION BY User_id)""")),
    "preprocess": Query(preprocess_query, sql("""
SELECT User_id, Merchant_id, Coupon_id, Discount_rate, Distance, Date_received, "Date",
  CAST(received_day AS VARCHAR) AS received_day, CAST(use_day AS VARCHAR) AS use_day,
  have_discount, round(discount, 8) AS discount, is_manjian, price_before FROM prep""")),
    "build_features": Query(
        build_features_query, features_sql("SELECT * EXCLUDE (received_day, use_day, price_or_rate) FROM feats")
    ),
    "build_dataset": Query(build_dataset_query, features_sql(f"SELECT DISTINCT * {_DROPPED} {_INT_DAY} FROM feats")),
    "older_sets": Query(older_sets_query, _older_sets_sql()),
    "dump_joined": Query(dump_joined_query, f"SELECT * EXCLUDE (dataset) FROM ({_all_sets_sql('train', 'validate')})"),
    "l_weekday": Query(on_label(opt.receipt_day_and_gap), _added_sql([
        "CAST(isodow(received_day) AS INTEGER) AS l_weekday", "CAST(Distance = -1 AS INTEGER) AS l_distance_missing",
    ])),
    "train_validate_test": Query(train_validate_test_query, _all_sets_sql()),
}
