"""Exploration tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyroll.catalog.base import Query, label_frame, prepared, r8, sql, sql_avg_rank, text
from tallyroll.operators import explore as ex
from tallyroll.operators.ordered import avg_rank
from tallyroll.operators.ordered import box_stats as box_stats_of
from tallyroll.sources import load_table


def histogram(spark, sf_dir):
    items = load_table(spark, sf_dir, "lineitem").select("l_extendedprice")
    return ex.histogram(items, "l_extendedprice", 10).select("bin", r8("bin_low"), "n")


def histogram_density_by(spark, sf_dir):
    rows = label_frame(spark, sf_dir).select("User_id", "discount", "label")
    ranked = avg_rank(rows, "User_id", "discount", "discount_rank", ascending=False)
    return ex.histogram_density_by(ranked, "discount_rank", "label", {1: 12, 0: 10}).select(
        "label", "bin", r8("bin_low"), r8("density")
    )


def _density_sql(label: int, bins: int) -> str:
    return f"""
SELECT {label} AS label, bin, round(lo + bin * ((hi - lo) / {bins}), 8) AS bin_low,
  round(n / (total * (hi - lo) / {bins}), 8) AS density
FROM (
  SELECT CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins} - 1) AS INTEGER) AS bin, lo, hi, total, count(*) AS n
  FROM (SELECT discount_rank AS x, min(discount_rank) OVER () AS lo, max(discount_rank) OVER () AS hi,
      CAST(count(*) OVER () AS DOUBLE) AS total
    FROM ranked WHERE label = {label} AND discount_rank IS NOT NULL)
  GROUP BY ALL)"""


def day_series(spark, sf_dir):
    rows = prepared(spark, sf_dir).select("Merchant_id", "received_day")
    series = ex.day_series(rows, "received_day", "2016-04-30", 31, ["Merchant_id"])
    return series.select("Merchant_id", text("received_day"), "n", "so_far")


def box_stats(spark, sf_dir):
    items = load_table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    out = box_stats_of(items, "l_extendedprice", ["l_returnflag"])
    return out.select("l_returnflag", *[r8(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "outliers")


def box_stats_whole(spark, sf_dir):
    out = box_stats_of(load_table(spark, sf_dir, "customer").select("c_acctbal"), "c_acctbal")
    return out.select(*[r8(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "outliers")


def _box_sql(table: str, value: str, key: str | None) -> str:
    group = f"{key}, " if key else ""
    join = f"JOIN q USING ({key})" if key else "CROSS JOIN q"
    inside = f"{value} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return f"""
WITH q AS (
  SELECT {group}quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
  FROM {table} {f"GROUP BY {key}" if key else ""})
SELECT {group}round(q1, 8) AS q1, round(median, 8) AS median, round(q3, 8) AS q3,
  min({value}) FILTER ({inside}) AS whisker_low, max({value}) FILTER ({inside}) AS whisker_high,
  count(*) FILTER (NOT ({inside})) AS outliers
FROM {table} {join} GROUP BY {group}q1, median, q3"""


def pie_shares(spark, sf_dir):
    accounts = load_table(spark, sf_dir, "customer").select("c_custkey", F.abs("c_acctbal").alias("balance"))
    return ex.pie_shares(accounts, "c_custkey", "balance").select("c_custkey", r8(F.col("share") * 1000, "per_mille"))


QUERIES = {
    "day_series": Query(day_series, sql("""
SELECT Merchant_id, CAST(received_day AS VARCHAR) AS received_day, coalesce(n, 0) AS n,
  CAST(sum(coalesce(n, 0)) OVER (PARTITION BY Merchant_id ORDER BY received_day) AS BIGINT) AS so_far
FROM (SELECT DISTINCT Merchant_id FROM prep WHERE received_day BETWEEN '2016-04-30' AND '2016-05-30' AND Merchant_id IS NOT NULL)
CROSS JOIN (SELECT CAST(d AS DATE) AS received_day FROM generate_series(DATE '2016-04-30', DATE '2016-05-30', INTERVAL 1 DAY) AS t(d))
LEFT JOIN (SELECT Merchant_id, received_day, count(*) AS n FROM prep GROUP BY ALL) USING (Merchant_id, received_day)""")),
    "received_per_day": Query(
        lambda spark, sf_dir: ex.received_per_day(prepared(spark, sf_dir)),
        sql("SELECT Date_received, count(Coupon_id) AS received FROM prep WHERE Date_received IS NOT NULL GROUP BY 1"),
    ),
    "rows_by_distance": Query(
        lambda spark, sf_dir: ex.rows_by_distance(prepared(spark, sf_dir)),
        sql("SELECT Distance, count(*) AS n FROM prep WHERE Distance <> -1 GROUP BY 1"),
    ),
    "use_rate_by_distance": Query(
        lambda spark, sf_dir: ex.use_rate_by_distance(prepared(spark, sf_dir)).select("Distance", r8("use_rate")),
        sql("SELECT Distance, round(avg(label), 8) AS use_rate FROM prep WHERE Distance <> -1 GROUP BY 1"),
    ),
    "received_by_discount": Query(
        lambda spark, sf_dir: ex.received_by_discount(prepared(spark, sf_dir)).select(r8("discount"), "n"),
        sql("SELECT round(discount, 8) AS discount, count(*) AS n FROM prep WHERE discount IS NOT NULL GROUP BY prep.discount"),
    ),
    "monthly_activity": Query(
        lambda spark, sf_dir: ex.monthly_activity(prepared(spark, sf_dir)),
        sql("""
SELECT CAST(month AS INTEGER) AS month, CAST(sum(used) AS BIGINT) AS used,
  CAST(sum(received) AS BIGINT) AS received, CAST(sum(consumed) AS BIGINT) AS consumed
FROM (
  SELECT month(received_day) AS month, label AS used, 1 AS received, 0 AS consumed FROM prep
  UNION ALL SELECT month(use_day), 0, 0, 1 FROM prep)
WHERE month IS NOT NULL GROUP BY month"""),
    ),
    "label_shares": Query(
        lambda spark, sf_dir: ex.label_shares(prepared(spark, sf_dir)).select("name", r8("share")),
        sql("""
SELECT CASE WHEN label = 1 THEN 'positive' ELSE 'negative' END AS name,
  round(count(*) / sum(count(*)) OVER (), 8) AS share FROM prep GROUP BY label"""),
    ),
    "used_kind_shares": Query(
        lambda spark, sf_dir: ex.used_kind_shares(prepared(spark, sf_dir)).select("name", r8("share")),
        sql("""
SELECT CASE WHEN is_manjian THEN 'manjian' ELSE 'discount' END AS name,
  round(count(*) / sum(count(*)) OVER (), 8) AS share FROM prep WHERE label = 1 GROUP BY is_manjian"""),
    ),
    "histogram": Query(histogram, """
SELECT bin, round(lo + bin * ((hi - lo) / 10), 8) AS bin_low, count(*) AS n
FROM (
  SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 10), 9) AS INTEGER) AS bin, lo, hi
  FROM lineitem CROSS JOIN (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem))
GROUP BY bin, lo, hi"""),
    "histogram_density_by": Query(histogram_density_by, sql(
        _density_sql(1, 12) + "\nUNION ALL" + _density_sql(0, 10),
        f"ranked AS (SELECT label, {sql_avg_rank('User_id', 'discount', False)} AS discount_rank FROM lab)",
    )),
    "box_stats": Query(box_stats, _box_sql("lineitem", "l_extendedprice", "l_returnflag")),
    "box_stats_whole": Query(box_stats_whole, _box_sql("customer", "c_acctbal", None)),
    "stacked_bar_data": Query(
        lambda spark, sf_dir: ex.stacked_bar_data(
            load_table(spark, sf_dir, "part"), "p_partkey", ["p_size", "p_retailprice"]
        ),
        """
SELECT p_partkey, 'p_size' AS series, CAST(p_size AS DOUBLE) AS value FROM part
UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""",
    ),
    "scatter_sample": Query(
        lambda spark, sf_dir: ex.scatter_sample(load_table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", 0.1, ["l_orderkey", "l_linenumber"], 5),
        f"""
SELECT l_quantity, l_extendedprice FROM lineitem
WHERE substr(md5(concat_ws('|', l_orderkey, l_linenumber, '5')), 1, 8) < '{int(0.1 * (1 << 32)):08x}'""",
    ),
    "pie_shares": Query(pie_shares, """
SELECT c_custkey, round(abs(c_acctbal) / (SELECT sum(abs(c_acctbal)) FROM customer) * 1000, 8) AS per_mille FROM customer"""),
}
