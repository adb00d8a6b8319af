"""Whitening of embeddings: blockwise QR, bidiagonal form, dqds and twisted factorisations.

1. Each task reduces its centred rows to a triangle by QR, block by block; triangles are
   stacked and reduced again, many at a time, until one R is left. R'R is n times the
   covariance, but no product of rows is ever summed.
2. Householder reflections turn R into a bidiagonal B.
3. The differential qd algorithm with shifts finds the squares of B's singular values.
4. A twisted factorisation of B'B less a square gives its vector; reflections turn it back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyroll.llm.common import table, to_python
from tallyroll.llm.vectors import chunks, finite, longest, matrix, whole
from tallyroll.runtime import stage

#: Triangles that one task stacks, and the most that the driver does.
STACK = 64
COMPONENTS = 4
EPS = np.finfo(np.float64).eps
_LONG = np.iinfo(np.int64).max

_ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double"


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and upper diagonal of B = U'RV, and V, by Householder reflections from both sides."""
    a, size = r.astype(np.float64).copy(), len(r)
    v = np.eye(size)

    def reflection(x: np.ndarray) -> np.ndarray:
        """w, of length root 2 or 0, so that x - w (w.x) is zero but for its first entry."""
        top = np.abs(x).max(initial=0)
        if not np.abs(x[1:]).any():
            return np.zeros_like(x)
        w = x / top
        w[0] += np.copysign(np.linalg.norm(w), w[0])
        return w * np.sqrt(2 / (w @ w))

    for k in range(size):
        w = reflection(a[k:, k])
        a[k:, k:] -= np.outer(w, w @ a[k:, k:])
        if k < size - 2:
            w = reflection(a[k, k + 1:])
            a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _qd(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd transform: new q, new e, and the differences d on the way."""
    d, differences, new_q, new_e = q[0] - shift, [], [], []
    for i in range(len(e)):
        differences.append(d)
        total = d + e[i]
        ratio = q[i + 1] / total if total else 0.0
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift if total else q[i + 1] - shift
    return [*new_q, d], new_e, [*differences, d]


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, greatest first, each to high relative accuracy.

    The shift is Newton's step towards the least square left, which never goes beyond
    it: 1 over the sum of 1/d, the trace of the inverse, from a transform without shift.
    """
    if not len(diagonal):
        return np.empty(0)
    scale = max(np.abs(diagonal).max(), np.abs(above).max(initial=0)) or 1.0
    work = [([float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2], 0.0)]
    out: list[float] = []
    while work:
        q, e, moved = work.pop()
        if len(q) == 1:
            out.append(moved + q[0])
            continue
        cut = next((i for i in range(len(e)) if e[i] <= 1e-32 * (moved + min(q[i], q[i + 1])) or e[i] < 1e-290), None)
        if cut is not None:
            work += [(q[:cut + 1], e[:cut], moved), (q[cut + 1:], e[cut + 1:], moved)]
            continue
        if len(q) == 2:
            gap = q[0] - q[1] + e[0]
            greater = (q[0] + q[1] + e[0] + np.sqrt(gap * gap + 4 * q[1] * e[0])) / 2
            out += [moved + greater, moved + q[0] / greater * q[1]]
            continue
        if q[0] < q[-1]:
            q, e = q[::-1], e[::-1]  # the least should come out last
        q, e, differences = _qd(q, e, 0.0)
        if min(differences) > 0:
            shift = (1 - 8 * EPS * len(q)) / sum(1 / d for d in differences)
            while shift > 1e-300:
                next_q, next_e, differences = _qd(q, e, shift)
                if min(differences) >= 0:
                    q, e, moved = next_q, next_e, moved + shift
                    break
                shift /= 2
        work.append((q, e, moved))
    return np.sort(np.array(out))[::-1] * scale**2


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, square: float) -> np.ndarray:
    """The unit vector that B'B turns into ``square`` times itself.

    B'B - square is factored from the top and from the bottom; the two meet where the
    middle pivot is least, and the vector grows from there by products alone.
    """
    size = len(diagonal)
    least = EPS * max(np.abs(diagonal).max(), np.abs(above).max(initial=0), 1e-150)
    a = np.where(np.abs(diagonal) < least, np.copysign(least, diagonal), diagonal)
    pivots, factors = a * a, above / a[:-1]
    tiny = EPS * EPS * max(pivots.max(), 1e-290)
    safe = lambda x: x if abs(x) > tiny else np.copysign(tiny, x)
    down, lower, s = np.empty(size), np.empty(max(0, size - 1)), -square
    for i in range(size):
        down[i] = s
        if i < size - 1:
            pivot = safe(pivots[i] + s)
            lower[i] = pivots[i] * factors[i] / pivot
            s = lower[i] * factors[i] * s - square
    up, upper, p = np.empty(size), np.empty(max(0, size - 1)), pivots[-1] - square
    up[-1] = p
    for i in range(size - 2, -1, -1):
        pivot = safe(pivots[i] * factors[i] ** 2 + p)
        ratio = pivots[i] / pivot
        upper[i] = factors[i] * ratio
        p = p * ratio - square
        up[i] = p
    twist = int(np.abs(down + up + square).argmin())
    z = np.zeros(size)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(twist, size - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Squares of all singular values of R, greatest first, and its first ``count`` right vectors as columns.

    Where squares lie too close together for vectors of their own, inverse iteration
    with the vectors before them taken out finds an orthogonal set.
    """
    diagonal, above, v = bidiagonal(r)
    squares = dqds(diagonal, above)
    count = min(count, len(squares))
    if not squares[0]:
        return squares, v[:, :count]
    full = np.diag(diagonal) + np.diag(above, 1)
    product = full.T @ full
    found = np.zeros((len(squares), count))
    for k in range(count):
        z = twisted_vector(diagonal, above, squares[k])
        close = [m for m in range(k) if squares[m] - squares[k] <= 1e-3 * squares[m]]
        if close:
            near, random = found[:, close], np.random.default_rng(k)
            for _ in range(4):
                z -= near @ (near.T @ z)
                if np.linalg.norm(z) < 0.1:
                    z = random.normal(size=len(z))
                    z -= near @ (near.T @ z)
                z /= np.linalg.norm(z)
                off = squares[k] + 4 * EPS * max(squares[0], 1e-290)
                z = np.linalg.solve(product - off * np.eye(len(z)), z)
                z /= np.linalg.norm(z)
            z -= near @ (near.T @ z)
            z /= np.linalg.norm(z)
        found[:, k] = z
    return squares, v @ found


def triangle(batches: Iterator[np.ndarray], dims: int) -> np.ndarray:
    """R of all rows, block by block."""
    r = np.zeros((0, dims))
    for rows in batches:
        r = np.linalg.qr(np.concatenate([r, rows]), mode="r")
    out = np.zeros((dims, dims))
    out[:len(r)] = r
    return out


def reduced(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the centred rows of ``fit`` (a column x), combined STACK at a time."""
    dims = len(sums)
    mean = fit.sparkSession.sparkContext.broadcast(sums / n)
    schema = "part long, r array<double>"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def one(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))], schema=arrow)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None

        def rows() -> Iterator[np.ndarray]:
            nonlocal part
            for batch in chunks(batches):
                part = batch.column("part")[0].as_py()
                yield matrix(batch.column("x"), dims) - mean.value

        r = triangle(rows(), dims)
        if part is not None:
            yield one(part, r)

    def combine(key: tuple, group: pa.Table) -> pa.Table:
        stacked = (np.array(x).reshape(dims, dims) for x in group.column("r").to_pylist())
        return pa.Table.from_batches([one(key[0].as_py(), triangle(stacked, dims))])

    parts = fit.select("x", F.spark_partition_id().cast("long").alias("part"))
    triangles = stage(to_python(parts).mapInArrow(reduce_rows, schema), "triangles")
    while (count := triangles.count()) > STACK:
        groups = F.pmod("part", F.lit(-(-count // STACK)))
        triangles = stage(triangles.groupBy(groups.alias("pile")).applyInArrow(combine, schema), "triangles")
    left = triangles.orderBy("part").collect()  # at most STACK of them
    return triangle((np.array(row["r"]).reshape(dims, dims) for row in left), dims)


@dataclass(frozen=True)
class Whitening:
    """How many vectors it was fitted on, their exact sums, and for each component its share of the variance and its direction.

    A direction is divided by the root of the component's variance; it is zero where there is none.
    """

    n: int
    sums: tuple[int, ...]
    explained: np.ndarray
    directions: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.sums, np.float64) / self.n) @ self.directions


def usable(vectors: DataFrame, vector: Column, scale: int = 256) -> DataFrame:
    """vec_id and x, the whole vector in longs; rows with a null or non-finite entry, or none, are left out."""
    return vectors.where(finite(vector)).select(F.col("vec_id").cast("long").alias("vec_id"), whole(vector, scale).alias("x"))


def distinct_vectors(rows: DataFrame, dims: int) -> DataFrame:
    """Each different x once, zeros after the shorter ones; equal vectors meet within tasks first."""
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x"))
    return stage(rows.select(F.concat("x", zeros).alias("x")).distinct(), "distinct-vectors")


def fit(vectors: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on a table of different vectors x; None if it is empty or vectors have no entries."""
    sums = [F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]
    row = vectors.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    if not row["n"] or not dims:
        return None
    exact = tuple(int(row[f"s{i}"]) for i in range(dims))
    r = reduced(vectors, row["n"], np.array(exact, np.float64))
    squares, found = directions(r, components)
    total = squares.sum()
    variances = squares / row["n"]
    # What is left of a component by rounding alone has no direction.
    there = variances[:found.shape[1]] > 1e-24 * max(variances[0], 1e-290)
    scaled = np.where(there, found / np.sqrt(np.where(there, variances[:found.shape[1]], 1)), 0)
    return Whitening(row["n"], exact, squares[:found.shape[1]] / total if total else np.zeros(found.shape[1]), scaled)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened fit vectors, less the identity; components without variance are left out."""
    dims, some = len(model.sums), np.flatnonzero(np.abs(model.directions).any(axis=0))
    shared = vectors.sparkSession.sparkContext.broadcast(model)
    size = len(some)
    if not size:
        return 0.0

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in chunks(batches):
            w = shared.value.project(matrix(batch.column("x"), dims))[:, some]
            total += w.T @ w  # x - S/n is centred already
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], names=["at", "value"])

    sums = to_python(vectors).mapInArrow(products, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect()
    covariance = np.array([row["value"] for row in sums]).reshape(size, size) / model.n
    return float(np.abs(covariance - np.eye(size)).max())


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The exact sum of (n x - S)^2 of each row; None where it is beyond a long."""
    top = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if len(sums) * top * top <= _LONG:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    totals = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return [t if t <= _LONG else None for t in totals]


def apply(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, component, n, deviation, whitened and explained of each row and component.

    ``whitened`` is null for a component without variance.
    """
    shared, dims = rows.sparkSession.sparkContext.broadcast(model), len(model.sums)
    schema = to_arrow_schema(StructType.fromDDL(_ROWS))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        count = own.directions.shape[1]
        there = np.abs(own.directions).any(axis=0)
        for batch in chunks(batches):
            x = matrix(batch.column("x"), dims)
            white, size = own.project(x), len(x)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column("vec_id").to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get), count), pa.int64()),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)), pa.array(np.full(size * count, own.n)),
                pa.array([d for d in deviations(x, own.n, own.sums) for _ in range(count)], pa.int64()),
                pa.array(white.ravel(), mask=~np.tile(there, size)), pa.array(np.tile(own.explained, size)),
            ], schema=schema)

    return to_python(rows).mapInArrow(project, _ROWS)


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Each row's whitened components, fitted on its different vectors; one identity_error for all.

    Rows with a null vector or a null or non-finite entry are left out; shorter vectors
    count as if zeros followed; repeated rows are kept, but counted once in the fit. A
    null vec_id is kept. Equal variances give some orthogonal directions of theirs, a
    component without variance a null. No rows, or vectors without entries, give no rows.
    Other columns are not read.
    """
    rows = usable(vectors, F.col(vector))
    dims = longest(rows, "x")
    different = distinct_vectors(rows, dims)
    model = fit(different, dims, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], f"{_ROWS}, identity_error double")
    return apply(rows, model).withColumn("identity_error", F.lit(identity_error(different, model)))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
