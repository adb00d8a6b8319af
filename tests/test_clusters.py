import numpy as np
import pytest

from tallyroll.operators import clusters as cl

DOTS = [[-6, 30], [-4, 34], [50, 7], [52, 9]]
XY = ["x", "y"]


@pytest.fixture(scope="module")
def dots(spark):
    return spark.createDataFrame([(float(x), float(y)) for x, y in DOTS], "x double, y double")


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(2)
    data = np.round(np.concatenate([rng.normal(m, 1, (60, 2)) for m in ((0, 0), (9, 1), (3, 8))]), 1)
    return data, spark.createDataFrame([tuple(map(float, p)) for p in data], "x double, y double").repartition(4)


def test_empty_cluster_is_seen(dots):
    assigned = cl.kmeans_assign(dots, XY, [(-90, -80), (10, 20)])
    assert {r["cluster"] for r in assigned.collect()} == {1}


def test_lowest_cluster_wins_ties(dots):
    assert {r["cluster"] for r in cl.kmeans_assign(dots, XY, [(5, 5), (5, 5)]).collect()} == {0}


def test_farthest_first_and_fit(dots):
    start = cl.farthest_first(dots, XY, 2, first=(-6.0, 30.0))
    assert start[1] == [52.0, 9.0]
    centroids, sse = cl.lloyd(cl.collapse(dots, XY), XY, {0: start})[0]
    assert centroids == [[-5.0, 32.0], [51.0, 8.0]]
    assert sse == pytest.approx(14.0)


def test_restart_after_an_empty_cluster(dots):
    centroids, sse = cl.lloyd(cl.collapse(dots, XY), XY, {0: [(-90, -80), (10, 20)]})[0]
    assert len(centroids) == 2 and sse == pytest.approx(14.0)


def test_too_few_points(spark):
    one = spark.createDataFrame([(1.0, 1.0)] * 5, "x double, y double")
    with pytest.raises(ValueError):
        cl.lloyd(cl.collapse(one, XY), XY, {0: [(0, 0), (5, 5)]})
    with pytest.raises(ValueError):
        cl.kmeans_elbow(one, XY, ks=(1, 2))
    with pytest.raises(ValueError):
        cl.init_random(one, XY, 2)


def test_runs_that_do_not_end_are_an_error(dots):
    with pytest.raises(ValueError):
        cl.lloyd(cl.collapse(dots, XY), XY, {0: [(-6, 30), (-4, 34)]}, max_passes=1)


def brute(data, start, tol=0.01):
    centroids, last = np.array(start, float), None
    while True:
        near = ((data[:, None] - centroids[None]) ** 2).sum(2).argmin(1)
        centroids = np.array([data[near == i].mean(0) for i in range(len(centroids))])
        sse = ((data - centroids[near]) ** 2).sum()
        if last is not None and abs(sse - last) <= tol:
            return centroids, sse
        last = sse


def test_lloyd_equals_brute_force_for_all_runs(cloud):
    data, points = cloud
    starts = {k: [list(p) for p in data[:: 180 // k][:k]] for k in (2, 3, 4)}
    runs = cl.lloyd(cl.collapse(points, XY), XY, starts)
    for k, start in starts.items():
        centroids, sse = brute(data, start)
        np.testing.assert_allclose(runs[k][0], centroids)
        assert runs[k][1] == pytest.approx(sse)


def test_sse_does_not_rise(cloud):
    data, points = cloud
    weighted, centroids, seen = cl.collapse(points, XY), [list(p) for p in data[:3]], []
    for _ in range(6):
        means, sse = cl._pass(weighted, XY, {0: centroids})[0]
        centroids = [means[i] for i in range(3)]
        seen.append(sse)
    assert all(b <= a + 1e-9 for a, b in zip(seen, seen[1:]))


def test_pieces_agree(cloud):
    data, points = cloud
    assigned = cl.kmeans_assign(points, XY, data[:3].tolist())
    sse = cl.kmeans_sse(assigned).first()
    assert sse["sse_mean"] == pytest.approx(sse["sse"] / len(data))
    means = cl.kmeans_update(assigned, XY)
    assert means.count() == assigned.select("cluster").distinct().count()


def test_elbow_and_draws(cloud):
    data, points = cloud
    elbow = cl.kmeans_elbow(points, XY, ks=(2, 3))
    assert [r["k"] for r in elbow.collect()] == [2, 3]
    one = cl.init_random(points, XY, 5, seed=3).collect()
    assert one == cl.init_random(points.repartition(9), XY, 5, seed=3).collect()
    known = {tuple(p) for p in data.tolist()}
    assert all(tuple(r) in known for r in one)


def test_vectors(spark):
    rows = [(i, [float(i % 2) * 10, 0.0, 1.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, v array<float>")
    centers = sorted(tuple(r["centroid"]) for r in cl.kmeans_fit_vectors(df, "v", 2).collect())
    assert centers == [(0.0, 0.0, 1.0), (10.0, 0.0, 1.0)]
