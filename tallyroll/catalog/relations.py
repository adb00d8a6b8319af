"""Filters, joins, sorting, set operations and ordered results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tallyroll.catalog.base import Query, label_frame, prepared, prepared_test, r8, sql, sql_avg_rank, text, train_frames
from tallyroll.operators import filters as flt
from tallyroll.operators import ordered as od
from tallyroll.operators import relational as rel
from tallyroll.operators.aggregates import group_agg, group_count
from tallyroll.plans.dataset import stage_inputs
from tallyroll.sources import load_table, receipts, receipts_test

_ID = ["User_id", "Merchant_id", "Coupon_id"]
_DAYS = [*_ID, "Date_received", "Date"]
_DAYS_SQL = 'User_id, Merchant_id, Coupon_id, Date_received, "Date"'


def _window_sizes(split, parts):
    """Rows of every window frame, as (dataset, part, n)."""

    def run(spark, sf_dir):
        frames = split(*stage_inputs(receipts(spark, sf_dir), receipts_test(spark, sf_dir)))
        sizes = [
            frames[name][part].agg(F.count("*").alias("n")).select(
                F.lit(name).alias("dataset"), F.lit(part).alias("part"), "n"
            )
            for name in frames for part in parts
        ]
        return reduce(rel.union_rows, sizes)

    return run


def _window_sizes_sql(windows, second, second_days):
    selects = []
    for name, spans in windows.items():
        for part, column, span in (
            ("history", "received_day", spans["history"]),
            (second, "use_day", spans[second_days]),
            ("label", "received_day", spans.get("label")),
        ):
            rows = "test_prep" if span is None else (
                f"prep WHERE {column} BETWEEN DATE '{span[0]}' AND DATE '{span[0]}' + {span[1] - 1}"
            )
            selects.append(f"SELECT '{name}' AS dataset, '{part}' AS part, count(*) AS n FROM {rows}")
    return sql("\nUNION ALL ".join(selects))


def filter_compound(spark, sf_dir):
    equal = {"is_manjian": True, "Distance": 3}
    return flt.filter_compound(prepared(spark, sf_dir), equal, "received_day", "2016-03-01", "2016-04-15").select(*_DAYS)


def date_range_open(spark, sf_dir):
    day = F.col("received_day")
    rows = prepared(spark, sf_dir).where((day > F.lit("2016-03-31").cast("date")) & (day < F.lit("2016-05-01").cast("date")))
    return rows.select(*_ID, text("received_day"))


def left_join_1key(spark, sf_dir):
    frames = train_frames(spark, sf_dir)
    counts = group_count(frames["history"], ["User_id"], "user_total")
    return rel.left_join(frames["label"].select(*_ID), counts, "User_id")


def left_join_nkey(spark, sf_dir):
    frames = train_frames(spark, sf_dir, *_ID)
    counts = group_count(frames["history"], ["User_id", "Merchant_id"], "pair_total")
    return rel.left_join(frames["label"].select(*_ID), counts, ["User_id", "Merchant_id"])


def right_join(spark, sf_dir):
    used = group_agg(
        flt.filter_used(prepared(spark, sf_dir)).withColumnRenamed("Merchant_id", "s_suppkey"),
        ["s_suppkey"], F.count("*").alias("used"),
    )
    return rel.right_join(used, load_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey")


def agg_join_back(spark, sf_dir):
    rows = prepared(spark, sf_dir).select(*_ID, "Distance")
    total = rel.agg_join_back(rows, ["User_id"], F.count("*").alias("user_rows"), F.max("Distance").alias("far"))
    return rel.count_over(total, ["User_id", "Coupon_id"], "pair_rows")


def join_suffix_collision(spark, sf_dir):
    rows = prepared(spark, sf_dir).select("User_id", "discount", "Distance")
    means = group_agg(rows, ["User_id"], F.avg("discount").alias("mean_discount"), F.avg("Distance").alias("mean_distance"))
    return rel.left_join(rows, means, "User_id").select(
        "User_id", r8("discount"), "Distance", r8("mean_discount"), r8("mean_distance")
    )


def zip_columns(spark, sf_dir):
    """Keys and a score that are kept apart, put side by side by the place of the row."""
    rows = rel.row_positions(label_frame(spark, sf_dir).select("User_id", "Coupon_id", "Date_received", "discount"))
    scored = rows.select("position", r8(1 / (1 + F.col("discount")), "pred"))
    return rel.zip_columns(rows.drop("discount"), scored).drop("position")


def range_self_count(spark, sf_dir):
    events = load_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    return od.range_self_count(events, ["user_id", "event_type"], "day", "near").select("event_id", "near")


def avg_rank(spark, sf_dir):
    rows = label_frame(spark, sf_dir, *_ID, "discount", "Distance").select(*_ID, "discount", "Distance")
    out = od.avg_rank(rows, "Merchant_id", "discount", "discount_rank", ascending=False)
    out = od.avg_rank(out, "User_id", "Distance", "distance_rank_ascend")
    return out.select(*_ID, "discount_rank", "distance_rank_ascend")


def avg_rank_wide(spark, sf_dir):
    items = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return od.avg_rank(items, "l_returnflag", "l_extendedprice", "price_rank", wide=True)


def _edges(spark, sf_dir, flag, name):
    rows = label_frame(spark, sf_dir).select(*_ID, "Date_received", "received_day")
    return flag(rows, "User_id", "received_day", name).drop("received_day")


def next_value(spark, sf_dir):
    events = load_table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return od.next_value(events, "user_id", "value", "event_id", "next_value")


def _gap(spark, sf_dir, gap, name):
    rows = prepared(spark, sf_dir).select(*_ID, "Date_received", "received_day")
    return gap(rows, "User_id", "received_day", name).drop("received_day")


def _gap_sql(name, far, near):
    return sql(f"""
SELECT p.User_id, p.Merchant_id, p.Coupon_id, p.Date_received, g.{name}
FROM prep p LEFT JOIN (
  SELECT User_id, received_day, CAST(date_diff('day', {near}, {far}) AS INTEGER) AS {name}
  FROM (SELECT DISTINCT User_id, received_day FROM prep WHERE received_day IS NOT NULL)
  WINDOW w AS (PARTITION BY User_id ORDER BY received_day)) g
ON p.User_id = g.User_id AND p.received_day = g.received_day""")


def top_k(spark, sf_dir):
    return rel.top_k(group_count(prepared(spark, sf_dir), ["Merchant_id"], "n"), 15, "n", "Merchant_id")


def arg_max(spark, sf_dir):
    items = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return rel.arg_max(items, "l_extendedprice", "l_orderkey", "l_linenumber")


def first_per_key(spark, sf_dir):
    rows = prepared(spark, sf_dir).where(F.col("Date_received").isNotNull())
    rows = rows.select("User_id", "Date_received", "Coupon_id", "Merchant_id", "Distance")
    return rel.first_per_key(rows, ["User_id"], ["Date_received"])


def union_rows(spark, sf_dir):
    label = label_frame(spark, sf_dir).select(*_ID, "Date_received", "label")
    return rel.union_rows(label, prepared_test(spark, sf_dir).select(*_ID, "Date_received"))


def split_windows_sql():
    return _window_sizes_sql(flt.WINDOWS, "all_history", "history")


QUERIES = {
    "interval": Query(
        lambda spark, sf_dir: flt.interval(prepared(spark, sf_dir), "received_day", "2016-04-30", 31).select(*_DAYS),
        sql(f"SELECT {_DAYS_SQL} FROM lab"),
    ),
    "split_windows": Query(
        _window_sizes(flt.split_windows, ("history", "all_history", "label")), split_windows_sql()
    ),
    "split_windows_v1": Query(
        _window_sizes(flt.split_windows_v1, ("history", "middle", "label")),
        _window_sizes_sql(flt.WINDOWS_V1, "middle", "middle"),
    ),
    "filter_used": Query(
        lambda spark, sf_dir: flt.filter_used(prepared(spark, sf_dir)).select(*_DAYS),
        sql(f"SELECT {_DAYS_SQL} FROM prep WHERE label = 1"),
    ),
    "filter_has_distance": Query(
        lambda spark, sf_dir: flt.filter_has_distance(prepared(spark, sf_dir)).select(*_ID, "Distance"),
        sql("SELECT User_id, Merchant_id, Coupon_id, Distance FROM prep WHERE Distance <> -1"),
    ),
    "filter_notnull": Query(
        lambda spark, sf_dir: flt.filter_notnull(receipts(spark, sf_dir), "Date_received").select(*_DAYS),
        sql(f"SELECT {_DAYS_SQL} FROM receipts WHERE Date_received IS NOT NULL"),
    ),
    "filter_isin": Query(
        lambda spark, sf_dir: flt.filter_isin(receipts(spark, sf_dir), "Distance", [0, 4, 9]).select(*_ID, "Distance"),
        sql("SELECT User_id, Merchant_id, Coupon_id, Distance FROM receipts WHERE Distance IN (0, 4, 9)"),
    ),
    "filter_compound": Query(filter_compound, sql(f"""
SELECT {_DAYS_SQL} FROM prep
WHERE is_manjian AND Distance = 3 AND received_day BETWEEN '2016-03-01' AND '2016-04-15'""")),
    "date_range_open": Query(date_range_open, sql("""
SELECT User_id, Merchant_id, Coupon_id, CAST(received_day AS VARCHAR) AS received_day FROM prep
WHERE received_day > '2016-03-31' AND received_day < '2016-05-01'""")),
    "left_join_1key": Query(left_join_1key, sql("""
SELECT l.User_id, Merchant_id, Coupon_id, user_total
FROM lab l LEFT JOIN (SELECT User_id, count(*) AS user_total FROM hist GROUP BY 1) h ON l.User_id = h.User_id""")),
    "left_join_nkey": Query(left_join_nkey, sql("""
SELECT l.User_id, l.Merchant_id, Coupon_id, pair_total
FROM lab l LEFT JOIN (SELECT User_id, Merchant_id, count(*) AS pair_total FROM hist GROUP BY 1, 2) h
  ON l.User_id = h.User_id AND l.Merchant_id = h.Merchant_id""")),
    "right_join": Query(right_join, sql("""
SELECT s_suppkey, used, s_name
FROM (SELECT Merchant_id, count(*) AS used FROM prep WHERE label = 1 GROUP BY 1) m
RIGHT JOIN supplier ON Merchant_id = s_suppkey""")),
    "agg_join_back": Query(agg_join_back, sql("""
SELECT User_id, Merchant_id, Coupon_id, Distance, count(*) OVER (PARTITION BY User_id) AS user_rows,
  max(Distance) OVER (PARTITION BY User_id) AS far,
  CASE WHEN Coupon_id IS NOT NULL THEN count(*) OVER (PARTITION BY User_id, Coupon_id) END AS pair_rows
FROM prep""")),
    "join_suffix_collision": Query(join_suffix_collision, sql("""
SELECT User_id, round(discount, 8) AS discount, Distance,
  round(avg(discount) OVER (PARTITION BY User_id), 8) AS mean_discount,
  round(avg(Distance) OVER (PARTITION BY User_id), 8) AS mean_distance
FROM prep""")),
    "zip_columns": Query(zip_columns, sql("""
SELECT User_id, Coupon_id, Date_received, round(1 / (1 + discount), 8) AS pred FROM lab""")),
    "range_self_count": Query(range_self_count, """
SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE)
  RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 7 DAYS FOLLOWING) AS near FROM events"""),
    "avg_rank": Query(avg_rank, sql(f"""
SELECT User_id, Merchant_id, Coupon_id, {sql_avg_rank("Merchant_id", "discount", False)} AS discount_rank,
  {sql_avg_rank("User_id", "Distance", True)} AS distance_rank_ascend FROM lab""")),
    "avg_rank_wide": Query(avg_rank_wide, f"""
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
  {sql_avg_rank("l_returnflag", "l_extendedprice", True)} AS price_rank FROM lineitem"""),
    "first_flag": Query(
        lambda spark, sf_dir: _edges(spark, sf_dir, od.first_flag, "is_first"),
        sql("""
SELECT User_id, Merchant_id, Coupon_id, Date_received,
  CAST(received_day = min(received_day) OVER (PARTITION BY User_id) AS INTEGER) AS is_first FROM lab"""),
    ),
    "last_flag": Query(
        lambda spark, sf_dir: _edges(spark, sf_dir, od.last_flag, "is_last"),
        sql("""
SELECT User_id, Merchant_id, Coupon_id, Date_received,
  CAST(received_day = max(received_day) OVER (PARTITION BY User_id) AS INTEGER) AS is_last FROM lab"""),
    ),
    "next_value": Query(next_value, """
SELECT event_id, user_id, value, lead(value) OVER (PARTITION BY user_id ORDER BY value, event_id) AS next_value
FROM events"""),
    "gap_next": Query(
        lambda spark, sf_dir: _gap(spark, sf_dir, od.gap_next, "gap_next"),
        _gap_sql("gap_next", "lead(received_day) OVER w", "received_day"),
    ),
    "gap_prev": Query(
        lambda spark, sf_dir: _gap(spark, sf_dir, od.gap_prev, "gap_prev"),
        _gap_sql("gap_prev", "received_day", "lag(received_day) OVER w"),
    ),
    "sort_values": Query(
        lambda spark, sf_dir: rel.sort_values(receipts(spark, sf_dir).select(*_DAYS), F.desc("Date_received"), "User_id"),
        sql(f"SELECT {_DAYS_SQL} FROM receipts ORDER BY Date_received DESC, User_id"),
    ),
    "sort_index": Query(
        lambda spark, sf_dir: rel.sort_values(group_count(receipts(spark, sf_dir), ["Distance"], "n"), "Distance"),
        sql("SELECT Distance, count(*) AS n FROM receipts WHERE Distance IS NOT NULL GROUP BY Distance ORDER BY Distance"),
    ),
    "top_k": Query(top_k, sql("""
SELECT Merchant_id, count(*) AS n FROM prep GROUP BY Merchant_id ORDER BY n DESC, Merchant_id LIMIT 15""")),
    "arg_max": Query(arg_max, """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey DESC, l_linenumber DESC LIMIT 1"""),
    "first_per_key": Query(first_per_key, sql("""
SELECT User_id, Date_received, Coupon_id, Merchant_id, Distance FROM (
  SELECT *, row_number() OVER (PARTITION BY User_id ORDER BY Date_received, Coupon_id, Merchant_id, Distance) AS rn
  FROM prep WHERE Date_received IS NOT NULL) WHERE rn = 1""")),
    "distinct_rows": Query(
        lambda spark, sf_dir: rel.distinct_rows(receipts(spark, sf_dir)),
        sql(f"SELECT DISTINCT {_DAYS_SQL}, Discount_rate, Distance FROM receipts"),
    ),
    "distinct_projection": Query(
        lambda spark, sf_dir: rel.distinct_projection(receipts(spark, sf_dir), "Merchant_id", "Coupon_id"),
        sql("SELECT DISTINCT Merchant_id, Coupon_id FROM receipts"),
    ),
    "union_rows": Query(union_rows, sql("""
SELECT User_id, Merchant_id, Coupon_id, Date_received, label FROM lab
UNION ALL SELECT User_id, Merchant_id, Coupon_id, Date_received, NULL FROM test_prep""")),
    "sample_rows": Query(
        lambda spark, sf_dir: rel.sample_rows(
            load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), 100, ["l_orderkey", "l_linenumber"], seed=3
        ),
        "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, '3')), 1, 2 LIMIT 100",
    ),
}
