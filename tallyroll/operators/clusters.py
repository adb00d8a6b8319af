"""K-Means as aggregations over a table of points.

Only centroids, k rows of numbers, pass through the driver. Equal points are
collapsed to one weighted row before the first pass; the results are the same.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.functions.draws import uniform
from tallyroll.operators.aggregates import known
from tallyroll.runtime import stage

Centroid = Sequence[float]
WEIGHT = "_weight"


def squared_distance(columns: Sequence[str], centroid: Centroid) -> Column:
    terms = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(columns, centroid)]
    return sum(terms[1:], terms[0])


def _nearest(columns: Sequence[str], centroids: Sequence[Centroid]) -> Column:
    """(distance, cluster) of the nearest centroid; the lowest number wins ties."""
    pairs = [
        F.struct(squared_distance(columns, c).alias("distance"), F.lit(i).alias("cluster"))
        for i, c in enumerate(centroids)
    ]
    return F.array_min(F.array(*pairs))


def kmeans_assign(points: DataFrame, columns: Sequence[str], centroids: Sequence[Centroid]) -> DataFrame:
    """Add ``cluster`` and the squared ``distance`` to its centroid."""
    near = points.withColumn("_near", _nearest(columns, centroids))
    return near.select(*points.columns, "_near.cluster", "_near.distance")


def kmeans_update(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of each cluster."""
    return assigned.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in columns])


def kmeans_sse(assigned: DataFrame) -> DataFrame:
    """One row: sum of squared distances, and that sum per point."""
    return assigned.agg(F.sum("distance").alias("sse"), F.avg("distance").alias("sse_mean"))


def collapse(points: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct points with their number of copies."""
    return known(points, columns).groupBy(*columns).agg(F.count("*").alias(WEIGHT))


def _draw(weighted: DataFrame, columns: Sequence[str], k: int, seed: int) -> DataFrame:
    """k distinct points, each drawn with a chance that follows its weight.

    The draw is a hash of the point, so it does not change with the partitioning
    or when a task runs again.
    """
    return weighted.orderBy(-F.ln(uniform(columns, seed)) / F.col(WEIGHT), *columns).limit(k).select(*columns)


def _drawn(weighted: DataFrame, columns: Sequence[str], k: int, seed: int) -> list[Centroid]:
    rows = [list(row) for row in _draw(weighted, columns, k, seed).collect()]
    if len(rows) < k:
        raise ValueError(f"fewer than {k} distinct points")
    return rows


def init_random(points: DataFrame, columns: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """k points at random; copies of a point raise its chance. Fewer distinct points are an error."""
    rows = [tuple(row) for row in _drawn(collapse(points, columns), columns, k, seed)]
    return points.sparkSession.createDataFrame(rows, points.select(*columns).schema)


def _farthest(points: DataFrame, columns: Sequence[str], chosen: Sequence[Centroid]) -> Centroid:
    least = F.least(*[squared_distance(columns, c) for c in chosen]) if len(chosen) > 1 else squared_distance(columns, chosen[0])
    row = points.agg(F.max_by(F.struct(*columns), F.struct(least, *columns)).alias("p")).select("p.*").first()
    return list(row)


def farthest_first(
    points: DataFrame, columns: Sequence[str], k: int, first: Centroid | None = None, seed: int = 0
) -> list[Centroid]:
    """The first point is given or drawn from weighted points; each next one is the point farthest
    from those chosen. Ties go to the greatest point. One aggregate per centroid."""
    if first is None:
        first = _drawn(points, columns, 1, seed)[0]
    chosen = [list(first)]
    while len(chosen) < k:
        chosen.append(_farthest(points, columns, chosen))
    return chosen


def centroid_table(like: DataFrame, columns: Sequence[str], centroids: Sequence[Centroid]) -> DataFrame:
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(centroids)]
    fields = ", ".join(f"{c} double" for c in columns)
    return like.sparkSession.createDataFrame(rows, f"cluster int, {fields}")


def init_farthest_first(
    points: DataFrame, columns: Sequence[str], k: int, first: Centroid | None = None, seed: int = 0
) -> DataFrame:
    if first is None:
        first = list(init_random(points, columns, 1, seed).first())
    return centroid_table(points, columns, farthest_first(points, columns, k, first))


def _pass(
    points: DataFrame, columns: Sequence[str], runs: dict[int, list[Centroid]]
) -> dict[int, tuple[dict[int, list[float]], float]]:
    """One pass for all runs: new means by cluster, and the SSE around them.

    The squares are taken around the old centroid, so that large coordinates do
    not lose digits: sum |x - m|^2 = sum |x - c|^2 - n |m - c|^2.
    """
    w = F.col(WEIGHT)
    nearest = F.array(*[
        F.struct(F.lit(run).alias("run"), _nearest(columns, centroids).alias("near"))
        for run, centroids in runs.items()
    ])
    rows = (
        points.select(*columns, WEIGHT, F.inline(nearest))
        .groupBy("run", F.col("near.cluster").alias("cluster"))
        .agg(
            F.sum(w).alias("n"),
            F.sum(w * F.col("near.distance")).alias("square"),
            *[F.sum(w * F.col(c)).alias(f"s{i}") for i, c in enumerate(columns)],
        )
        .collect()  # one row for each centroid
    )
    out = {run: ({}, 0.0) for run in runs}
    for row in rows:
        means, sse = out[row["run"]]
        old = runs[row["run"]][row["cluster"]]
        mean = [row[f"s{i}"] / row["n"] for i in range(len(columns))]
        means[row["cluster"]] = mean
        moved = sum((m - c) ** 2 for m, c in zip(mean, old))
        out[row["run"]] = means, sse + row["square"] - row["n"] * moved
    return out


def lloyd(
    points: DataFrame, columns: Sequence[str], starts: dict[int, Sequence[Centroid]],
    sse_tol: float = 0.01, max_passes: int = 1000, seed: int = 0,
) -> dict[int, tuple[list[Centroid], float]]:
    """Centroids and SSE of each run, from its starting centroids.

    A run ends when its SSE changes by at most ``sse_tol``. An empty cluster
    starts the run again from random points. All open runs share a pass over
    the points. ``points`` carries a weight column (see ``collapse``). It is an
    error if a run has not ended after ``max_passes``, or has too few points.
    """
    draws = random.Random(seed)
    open_runs = {run: [list(c) for c in start] for run, start in starts.items()}
    last: dict[int, float] = {}
    done: dict[int, tuple[list[Centroid], float]] = {}
    for _ in range(max_passes):
        for run, (means, sse) in _pass(points, columns, open_runs).items():
            k = len(open_runs[run])
            if len(means) < k:
                open_runs[run] = _drawn(points, columns, k, draws.randrange(1 << 30))
                last.pop(run, None)
                continue
            open_runs[run] = [means[i] for i in range(k)]
            if run in last and abs(sse - last[run]) <= sse_tol:
                done[run] = open_runs.pop(run), sse
            last[run] = sse
        if not open_runs:
            return done
    raise ValueError(f"runs {sorted(open_runs)} have not ended after {max_passes} passes")


def kmeans_fit(
    points: DataFrame, columns: Sequence[str], k: int, first: Centroid | None = None,
    sse_tol: float = 0.01, seed: int = 0,
) -> DataFrame:
    """Centroids by farthest-first start and Lloyd passes."""
    weighted = stage(collapse(points, columns), "points")
    start = farthest_first(weighted, columns, k, first, seed)
    centroids, _ = lloyd(weighted, columns, {k: start}, sse_tol, seed=seed)[k]
    return centroid_table(points, columns, centroids)


def kmeans_elbow(
    points: DataFrame, columns: Sequence[str], ks: Sequence[int] = range(2, 8),
    sse_tol: float = 0.01, seed: int = 0,
) -> DataFrame:
    """SSE for each number of clusters, from random starts."""
    weighted = stage(collapse(points, columns), "points")
    drawn = _drawn(weighted, columns, max(ks), seed)
    runs = lloyd(weighted, columns, {k: drawn[:k] for k in ks}, sse_tol, seed=seed)
    return points.sparkSession.createDataFrame([(k, runs[k][1]) for k in ks], "k int, sse double")


def kmeans_fit_vectors(
    vectors: DataFrame, column: str, k: int, seed: int = 0, max_passes: int = 500, tol: float = 1e-4
) -> DataFrame:
    """Centroids of an array column by the stock estimator, for many dimensions, and the passes used.

    It is an error if the centroids still move by more than ``tol`` after ``max_passes``.
    """
    model = KMeans(k=k, seed=seed, maxIter=max_passes, tol=tol).fit(vectors.select(array_to_vector(F.col(column).cast("array<double>")).alias("features")))
    passes = model.summary.numIter
    if passes >= max_passes:
        raise ValueError(f"not ended after {max_passes} passes")
    rows = [(i, [float(v) for v in c], passes) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(rows, "cluster int, centroid array<double>, passes int")
