"""Clustering and boosted trees."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallyroll.catalog.base import Query, prepared, r8, sql, sql_uniform
from tallyroll.operators import clusters as cl
from tallyroll.operators.ordered import exact_auc
from tallyroll.operators.relational import union_rows
from tallyroll.plans import model as md
from tallyroll.plans.dataset import train_validate_test
from tallyroll.plans.older import older_sets, train_older
from tallyroll.runtime import new_path, stage
from tallyroll.sources import load_table, receipts, receipts_test

_XY = ["x", "y"]
_CENTROIDS = [(10.0, 2.0), (25.0, 5.0), (40.0, 8.0)]
# Saved fits and model tables of a session, by what they were made from.
_SAVED: dict[tuple, str] = {}


def _there(spark, key):
    """Whether what was saved under ``key`` is still in the shared folder."""
    if key not in _SAVED:
        return False
    path = spark._jvm.org.apache.hadoop.fs.Path(_SAVED[key])
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def points(spark, sf_dir):
    """Line items as points (quantity, discount in percent)."""
    items = load_table(spark, sf_dir, "lineitem")
    return items.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"), F.round(F.col("l_discount") * 100).alias("y"))


def _assigned(spark, sf_dir):
    return cl.kmeans_assign(points(spark, sf_dir), _XY, _CENTROIDS)


def kmeans_two_passes(spark, sf_dir):
    """Lloyd from given centroids; with no bound on the change of the SSE a run ends after its second pass."""
    weighted = stage(cl.collapse(points(spark, sf_dir), _XY), "points")
    centroids, sse = cl.lloyd(weighted, _XY, {3: _CENTROIDS}, sse_tol=float("inf"))[3]
    return cl.centroid_table(weighted, _XY, centroids).select("cluster", r8("x"), r8("y"), F.round(F.lit(sse), 4).alias("sse"))


def _dataset(spark, sf_dir, name):
    """A model table, made and written once for all queries that read it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if not _there(spark, key):
        path = new_path(spark, f"dataset-{name}")
        train_validate_test(receipts(spark, sf_dir), receipts_test(spark, sf_dir), [name])[name].write.parquet(path)
        _SAVED[key] = path
    return spark.read.parquet(_SAVED[key])


def _fitted(spark, sf_dir, modes):
    """Fits that the queries share; trained once with all their rounds, side by side, and saved."""
    keys = {mode: (spark.sparkContext.applicationId, sf_dir, mode, md.ROUNDS[mode]) for mode in modes}
    missing = {mode: md.ROUNDS[mode] for mode, key in keys.items() if not _there(spark, key)}
    if missing:
        train = _dataset(spark, sf_dir, "train")
        validate = None if set(missing) == {"offline"} else _dataset(spark, sf_dir, "validate")
        for mode, model in md.train_all_modes(train, validate, missing).items():
            path = new_path(spark, f"fit-{mode}")
            model.write().save(path)
            _SAVED[keys[mode]] = path
    return {mode: PipelineModel.load(_SAVED[key]) for mode, key in keys.items()}


def _offline(spark, sf_dir):
    return _fitted(spark, sf_dir, ["offline"])["offline"]


def train_boosted_trees(spark, sf_dir):
    return md.auc_eval(_offline(spark, sf_dir), _dataset(spark, sf_dir, "train"))


def _modes(spark, sf_dir):
    """(mode, its model, the sets it is watched on) of all modes."""
    models = _fitted(spark, sf_dir, list(md.ROUNDS))
    watch = md.watched(*(_dataset(spark, sf_dir, n) for n in ("train", "validate")))
    return [(mode, models[mode], watch[mode]) for mode in md.ROUNDS]


def train_modes(spark, sf_dir):
    parts = [
        md.auc_eval(model, df).select(F.lit(mode).alias("mode"), F.lit(name).alias("watched"), "auc")
        for mode, model, watch in _modes(spark, sf_dir) for name, df in watch.items()
    ]
    return reduce(union_rows, parts)


def auc_by_round(spark, sf_dir):
    parts = [md.auc_by_round(model, watch).select(F.lit(mode).alias("mode"), "*") for mode, model, watch in _modes(spark, sf_dir)]
    return reduce(union_rows, parts)


def class_weight(spark, sf_dir):
    rows = md.class_weight(prepared(spark, sf_dir).select("User_id", "label"))
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))


def score(spark, sf_dir):
    return md.score(_offline(spark, sf_dir), _dataset(spark, sf_dir, "test"))


def older_score(spark, sf_dir):
    sets = older_sets(receipts(spark, sf_dir), receipts_test(spark, sf_dir))
    return md.score(train_older(stage(sets["train"], "older-train")), sets["test"])


def _importance(spark, sf_dir):
    return md.feature_importance(_offline(spark, sf_dir))


def auc_eval(spark, sf_dir):
    rows = prepared(spark, sf_dir).where(F.col("Coupon_id").isNotNull())
    return exact_auc(rows, "discount", "label").select(r8("auc"))


_POINTS_SQL = f"""
WITH p AS (SELECT l_orderkey, l_linenumber, l_quantity AS x, round(l_discount * 100) AS y FROM lineitem),
d AS (SELECT *, {", ".join(f"(x - {a}) * (x - {a}) + (y - {b}) * (y - {b}) AS d{i}" for i, (a, b) in enumerate(_CENTROIDS))} FROM p),
assigned AS (
  SELECT l_orderkey, l_linenumber, x, y, least(d0, d1, d2) AS distance,
    CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM d)
"""


def _far_sql(n: int) -> str:
    """The next farthest point, from the n points already in c1..cn."""
    least = ", ".join(f"(x - c{i}.x0) * (x - c{i}.x0) + (y - c{i}.y0) * (y - c{i}.y0)" for i in range(1, n + 1))
    return f"""c{n + 1} AS (
  SELECT x AS x0, y AS y0 FROM (
    SELECT x, y, least({least}, 1e300) AS far FROM p, {", ".join(f"c{i}" for i in range(1, n + 1))})
  ORDER BY far DESC, x DESC, y DESC LIMIT 1)"""


QUERIES = {
    "train_boosted_trees": Query(train_boosted_trees),
    "train_modes": Query(train_modes),
    "auc_by_round": Query(auc_by_round),
    "class_weight": Query(class_weight, sql("""
SELECT label, count(*) AS n, CAST(sum(CASE WHEN label = 1 THEN 26 ELSE 1 END) AS DOUBLE) AS weight
FROM prep GROUP BY label""")),
    "auc_eval": Query(auc_eval, sql("""
SELECT round((sum(r) FILTER (label = 1) - p * (p + 1) / 2) / (p * n), 8) AS auc
FROM (
  SELECT label, rank() OVER (ORDER BY discount) + (count(*) OVER (PARTITION BY discount) - 1) / 2.0::DOUBLE AS r,
    CAST(count(*) FILTER (label = 1) OVER () AS DOUBLE) AS p, CAST(count(*) FILTER (label = 0) OVER () AS DOUBLE) AS n
  FROM prep WHERE discount IS NOT NULL)
GROUP BY p, n""")),
    "score": Query(score),
    "older_score": Query(older_score),
    "feature_importance": Query(_importance),
    "top_importance": Query(lambda spark, sf_dir: md.top_importance(_importance(spark, sf_dir))),
    "kmeans_fit": Query(lambda spark, sf_dir: cl.kmeans_fit(points(spark, sf_dir), _XY, 3)),
    "kmeans_fit_vectors": Query(
        lambda spark, sf_dir: cl.kmeans_fit_vectors(load_table(spark, sf_dir, "embeddings"), "embedding", 4)
    ),
    "kmeans_assign": Query(_assigned, _POINTS_SQL + "SELECT * FROM assigned"),
    "kmeans_two_passes": Query(kmeans_two_passes, _POINTS_SQL + """, once AS (SELECT cluster, avg(x) AS cx, avg(y) AS cy FROM assigned GROUP BY cluster),
counted AS (SELECT x, y, count(*) AS n FROM p GROUP BY x, y),
near AS (
  SELECT x, y, n, cluster,
    row_number() OVER (PARTITION BY x, y ORDER BY (x - cx) * (x - cx) + (y - cy) * (y - cy), cluster) AS place
  FROM counted, once),
twice AS (SELECT cluster, CAST(sum(n * x) AS DOUBLE) / sum(n) AS cx, CAST(sum(n * y) AS DOUBLE) / sum(n) AS cy FROM near WHERE place = 1 GROUP BY cluster)
SELECT cluster, round(cx, 8) AS x, round(cy, 8) AS y,
  (SELECT round(sum(n * ((x - t.cx) * (x - t.cx) + (y - t.cy) * (y - t.cy))), 4) FROM near JOIN twice t USING (cluster) WHERE place = 1) AS sse
FROM twice"""),
    "kmeans_update": Query(
        lambda spark, sf_dir: cl.kmeans_update(_assigned(spark, sf_dir), _XY).select("cluster", r8("x"), r8("y")),
        _POINTS_SQL + "SELECT cluster, round(avg(x), 8) AS x, round(avg(y), 8) AS y FROM assigned GROUP BY cluster",
    ),
    "kmeans_sse": Query(
        lambda spark, sf_dir: cl.kmeans_sse(_assigned(spark, sf_dir)).select(r8("sse"), r8("sse_mean")),
        _POINTS_SQL + "SELECT round(sum(distance), 8) AS sse, round(avg(distance), 8) AS sse_mean FROM assigned",
    ),
    "init_random": Query(lambda spark, sf_dir: cl.init_random(points(spark, sf_dir), _XY, 3, seed=1), f"""
SELECT x, y FROM (
  SELECT l_quantity::DOUBLE AS x, round(l_discount * 100)::DOUBLE AS y, count(*) AS n FROM lineitem GROUP BY 1, 2)
ORDER BY -ln({sql_uniform('x, y', 1)}) / n, x, y LIMIT 3"""),
    "init_farthest_first": Query(
        lambda spark, sf_dir: cl.init_farthest_first(points(spark, sf_dir), _XY, 4, first=(25.0, 5.0)),
        f"""
WITH p AS (SELECT l_quantity AS x, round(l_discount * 100) AS y FROM lineitem),
c1 AS (SELECT 25.0::DOUBLE AS x0, 5.0::DOUBLE AS y0), {_far_sql(1)}, {_far_sql(2)}, {_far_sql(3)}
SELECT 0 AS cluster, x0 AS x, y0 AS y FROM c1
UNION ALL SELECT 1, x0, y0 FROM c2 UNION ALL SELECT 2, x0, y0 FROM c3 UNION ALL SELECT 3, x0, y0 FROM c4""",
    ),
    "kmeans_elbow": Query(lambda spark, sf_dir: cl.kmeans_elbow(points(spark, sf_dir), _XY)),
}
