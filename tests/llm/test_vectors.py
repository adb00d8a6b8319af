"""Hard negatives and whitening, held against brute force and dense linear algebra."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroll.llm import negatives, whitening

from .conftest import CLASHING

_INF, _NAN = float("inf"), float("nan")


def _whole(vector):
    return [math.floor(256 * float(c)) for c in vector]


def _good(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def _mined(rows, is_anchor, low=80, high=100):
    """Every pair scored, in Python's own numbers; rows are (vec_id, label, vector)."""
    rows = [(i, label, _whole(v)) for i, label, v in rows if label is not None and _good(v)]
    last = lambda x: (x is None, x)
    out = []
    for a, (anchor, label, own) in enumerate(rows):
        if not is_anchor(anchor):
            continue
        scored = [(sum(x * y for x, y in zip(own, v)), i, other) for b, (i, other, v) in enumerate(rows) if a != b]
        scored.sort(key=lambda x: (-x[0], last(x[1])))
        for score, positive, _ in [x for x in scored if x[2] == label][:5]:
            near = [x for x in scored if x[2] != label and low * score <= 100 * x[0] <= high * score][:5]
            out += [(anchor, positive, rank, i, score, s) for rank, (s, i, _) in enumerate(near, 1)]
    return sorted(out, key=str)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_hard_negatives_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    moved = [(i, (label + 1) % 10 if i % 7 == 0 else label, v) for i, label, v in rows]
    want = _mined(moved, lambda i: i % 100 == 0)
    got = negatives.op11_hard_negatives(spark, sf)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert _rows(got) == want and want


def _crowd(seed, count, dims):
    """Vectors of few directions, with ties and repeats."""
    random = np.random.default_rng(seed)
    base = random.normal(size=(6, dims))
    rows = base[random.integers(0, 6, count)] + random.normal(size=(count, dims)) * random.choice([0, 0.02, 0.5], (count, 1))
    return [(i // 2 if i % 9 == 0 else i, int(random.integers(0, 3)), [float(x) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize(("dims", "block"), [(64, 8192), (13, 8), (100, 3)])
def test_all_pairs_are_covered(spark, monkeypatch, dims, block):
    monkeypatch.setattr(negatives, "ANCHOR_TILE", 4)
    rows = _crowd(dims, 300, dims)
    df = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>").repartition(5)
    got = negatives.mine(df, F.col("vec_id") % 10 == 0, block=block, low=60)
    assert _rows(got) == _mined(rows, lambda i: i % 10 == 0, low=60)


def test_bounds_hold_and_screen_out_pairs():
    random = np.random.default_rng(4)
    x = random.integers(-90, 90, (400, 64)) + random.integers(-200, 200, (400, 8)).repeat(8, axis=1)
    own = [negatives.Vectors(np.arange(len(p)), np.arange(len(p)), np.zeros(len(p)), p, negatives.levels(*negatives.segments(p))) for p in (x[:100], x[100:])]
    exact = x[:100] @ x[100:].T
    spread = []
    for (ma, da), (mb, db) in zip(own[0].levels, own[1].levels):
        middle, reach = ma @ mb.T, da @ db.T
        assert (exact <= middle + reach + 1e-6).all() and (exact >= middle - reach - 1e-6).all()
        spread.append(reach.mean())
    assert len(spread) == 4 and spread == sorted(spread, reverse=True)
    floor, ceiling = np.quantile(exact, 0.99, axis=1), np.full(100, np.inf)
    i, j = negatives.screened(*own, np.ones(exact.shape, bool), floor, ceiling)
    assert set(zip(i, j)) >= set(zip(*np.nonzero(exact >= floor[:, None]))) and len(i) < 0.2 * exact.size


def test_scores_are_exact():
    big = np.array([[2**40 + 1, 3, -(2**41)]])
    zero = np.array([0])
    assert negatives.scores(big, np.array([[2**20 + 1, 5, 1]]), zero, zero).tolist() == [(2**40 + 1) * (2**20 + 1) + 15 - 2**41]
    assert negatives.scores(big, big, zero, zero).tolist() == [2**63 - 1]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, repeats, ties, short and empty vectors, numbers that are none."""
    rows = [
        (0, 1, [1.0, 2.0, 0.5]), (0, 1, [1.0, 2.0, 0.5]), (100, 1, [1.0, 2.0, 0.5]), (5, 1, [1.0, 2.0, 0.5]), (6, 2, [1.0, 1.9, 0.5]), (3, 2, [1.0, 1.9, 0.5]),
        (None, 2, [1.0, 1.9, 0.5]), (None, 1, [0.9, 1.9, 0.5]), (7, None, [1.0, 1.0, 1.0]), (8, 2, None), (9, 2, [1.0, None, 1.0]), (10, 2, [1.0, _NAN, 1.0]),
        (11, 2, [_INF, 0.0, 1.0]), (12, 2, [1.0]), (13, 2, []), (14, 2, [0.0, -0.0, 0.0]), (200, 3, [-1.0, -1.0, -1.0]), (15, 3, [1.0, 1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    return rows, df.withColumns({c: F.lit(7) for c in (*(c for c in CLASHING if c != "label"), "x", "rid", "anchor", "means", "score", "rank", "n", "part")})


def test_hard_negatives_edge(odd):
    rows, df = odd
    padded = [(i, label, v + [0.0] * (3 - len(v)) if _good(v) else v) for i, label, v in rows]
    got = negatives.mine(df, F.col("vec_id") % 100 == 0)
    assert _rows(got) == _mined(padded, lambda i: i is not None and i % 100 == 0)
    assert negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def _dense(rows, components=4):
    """n, S, the variances and directions by numpy, on different vectors."""
    x = np.array(sorted({tuple(_whole(v)) for _, v in rows}), dtype=np.float64)
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(x))
    return x, values[::-1], vectors[:, ::-1][:, :components]


def _check_white(got, rows, components=4):
    x, values, vectors = _dense(rows, components)
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(got) == components * len(rows)
    signs = None
    for vec_id, vector in rows:
        own, w = by_id[vec_id], _whole(vector)
        assert sorted(own) == list(range(1, components + 1))
        assert {r.n for r in own.values()} == {n} and {r.deviation for r in own.values()} == {sum((n * v - s) ** 2 for v, s in zip(w, sums))}
        want = (np.array(w) - np.array(sums) / n) @ vectors / np.sqrt(values[:components])
        have = np.array([own[k + 1].whitened for k in range(components)])
        if signs is None:
            signs = np.sign(have * want)
        assert have == pytest.approx(signs * want, abs=1e-8)
        assert [own[k + 1].explained for k in range(components)] == pytest.approx(values[:components] / values.sum(), rel=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    _check_white(whitening.op13_embedding_whitening(spark, sf).collect(), rows)


def test_repeats_count_once_and_triangles_combine(spark, monkeypatch):
    monkeypatch.setattr(whitening, "STACK", 3)
    random = np.random.default_rng(6)
    base = random.normal(size=(150, 9)) * np.linspace(3, 0.5, 9)
    rows = [(i, [float(c) for c in base[min(i, 149)]]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(13, "vec_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check_white(whitening.whiten(df).collect(), rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("kind", ["plain", "few rows", "equal", "graded", "zero", "one column", "identity"])
def test_solver(kind):
    random = np.random.default_rng(8)
    x = random.normal(size=(200, 40))
    if kind == "few rows":
        x = x[:12]
    if kind == "equal":
        x = np.linalg.qr(x)[0]
    if kind == "graded":
        x = x * np.logspace(0, -9, 40)
    if kind == "zero":
        x = x * 0
    if kind == "one column":
        x = x[:, :1]
    if kind == "identity":
        x = np.eye(40)
    size = x.shape[1]
    r = whitening.triangle(iter([x[:7], x[7:90], x[90:]]), size)
    diagonal, above, v = whitening.bidiagonal(r)
    full = np.diag(diagonal) + np.diag(above, 1)
    assert v.T @ v == pytest.approx(np.eye(size), abs=1e-13)
    assert (r @ v).T @ (r @ v) == pytest.approx(full.T @ full, abs=1e-11)
    # dqds finds even the least value to high relative accuracy; numpy only relative to the greatest.
    squares, vectors = whitening.directions(r, 4)
    want = np.zeros(size)
    singular = np.linalg.svd(x, compute_uv=False)
    want[:len(singular)] = singular**2
    assert squares == pytest.approx(want, rel=1e-12, abs=1e-13 * max(1e-300, want[0]))
    assert vectors.T @ vectors == pytest.approx(np.eye(min(4, size)), abs=1e-12)
    assert x.T @ (x @ vectors) == pytest.approx(vectors * squares[:4], abs=1e-10 * max(1, want[0]))


def test_dqds_is_accurate_for_small_values():
    # The product of all squares is that of the diagonal's, whatever their range.
    diagonal, above = np.logspace(0, -8, 12), np.full(11, 1e-3)
    squares = whitening.dqds(diagonal, above)
    assert np.log(squares).sum() == pytest.approx(2 * np.log(diagonal).sum(), rel=1e-11)
    assert (np.diff(squares) <= 0).all()


def test_whitening_edge(spark, odd):
    rows, df = odd
    got = whitening.whiten(df).collect()
    kept = [(i, v) for i, _, v in rows if _good(v)]
    assert len(got) == 3 * len(kept) and {r.component for r in got} == {1, 2, 3}
    padded = {tuple(_whole(v)) + (0,) * (3 - len(v)) for _, v in kept}
    assert {r.n for r in got} == {len(padded)} and max(r.identity_error for r in got) < 1e-9
    assert whitening.whiten(df.limit(0)).collect() == []
    # All vectors equal: no variance, so no direction.
    same = whitening.whiten(df.where("vec_id in (0, 100, 5)")).collect()
    assert {r.whitened for r in same} == {None} and {r.deviation for r in same} == {0} and {r.explained for r in same} == {0.0}
    assert whitening.deviations(np.array([[2**40]]), 1000, (5,)) == [None]
