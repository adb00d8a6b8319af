"""Hard negatives: rows of another label that are nearly as close to an anchor as its positives.

Each vector is stored with the mean and the deviation of each of its segments. For two
segments of w components the product of the means, times w, differs from the inner
product by no more than the product of the deviations, times w. So the means and
deviations of two vectors bound their score from both sides: first as one segment, then
as two, four and so on; only pairs that still may matter are scored exactly.

Anchors go in blocks of bounded size against all rows. A block is sent to the tasks, the
rows stay where they are, and each task returns the best it has for each anchor.
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
from pyspark.sql.window import Window

from tallyroll.llm.common import table, to_python
from tallyroll.llm.vectors import chunks, finite, longest, matrix, whole
from tallyroll.runtime import stage

#: Components in the shortest segments.
SEGMENT = 8
#: Anchors of a round on average, and how many of them a task compares with a chunk of rows at a time.
ANCHOR_BLOCK, ANCHOR_TILE = 8192, 512
#: Below this share of live pairs they are followed one by one, not as a whole matrix.
SPARSE = 0.02

_LAST = np.iinfo(np.int64).max
_SUMMARY = "rid long, vec_id long, label long, anchor boolean, x array<long>, means array<double>, deviations array<double>"
_POSITIVE = "anchor long, positive_id long, positive_rid long, score long"
_NEGATIVE = "anchor long, place int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_rid long, negative_score long"


def segments(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the shortest segments of each row, a power of two of them; zeros fill the last ones."""
    count = 1 << max(0, (-(-x.shape[1] // SEGMENT) - 1)).bit_length()
    full = np.zeros((len(x), count * SEGMENT))
    full[:, :x.shape[1]] = x
    parts = full.reshape(len(x), count, SEGMENT)
    return parts.mean(axis=2), parts.std(axis=2)


def levels(means: np.ndarray, deviations: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Means and deviations, each times the root of the length, from one segment to the shortest ones."""
    out, width, variances = [], SEGMENT, deviations**2
    while True:
        out.append((means * np.sqrt(width), np.sqrt(variances * width)))
        if means.shape[1] == 1:
            return out[::-1]
        left, right = means[:, ::2], means[:, 1::2]
        variances = (variances[:, ::2] + variances[:, 1::2]) / 2 + ((left - right) / 2) ** 2
        means, width = (left + right) / 2, 2 * width


@dataclass
class Vectors:
    """Rows with their summaries; ids that are missing come last in any order."""

    rid: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def read(batch: pa.RecordBatch | pa.Table, dims: int) -> Vectors:
        column = lambda name: batch.column(name).combine_chunks() if isinstance(batch, pa.Table) else batch.column(name)
        means, deviations = (column(name) for name in ("means", "deviations"))
        count = len(means[0]) if len(means) else 1
        return Vectors(
            column("rid").to_numpy(), column("vec_id").fill_null(_LAST).to_numpy(), column("label").to_numpy(),
            matrix(column("x"), dims), levels(matrix(means, count), matrix(deviations, count)),
        )

    def __getitem__(self, rows: slice) -> Vectors:
        return Vectors(self.rid[rows], self.vec_id[rows], self.label[rows], self.x[rows], [(m[rows], d[rows]) for m, d in self.levels])


def scores(queries: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of query i and row j, pair by pair; those beyond a long are its end."""
    if not len(i):
        return np.empty(0, np.int64)
    q, r = queries.astype(np.float64), rows.astype(np.float64)
    if np.linalg.norm(q, axis=1).max() * np.linalg.norm(r, axis=1).max() < 2.0**53:
        # No partial sum can leave the whole numbers that a double holds.
        found = (q @ r.T)[i, j] if len(i) > SPARSE * len(q) * len(r) else np.einsum("ij,ij->i", q[i], r[j])
        return found.astype(np.int64)
    products = [sum(int(a) * int(b) for a, b in zip(queries[m], rows[n], strict=True)) for m, n in zip(i, j, strict=True)]
    return np.array([max(-_LAST, min(_LAST, p)) for p in products], np.int64)


def screened(queries: Vectors, rows: Vectors, allowed: np.ndarray, floor: np.ndarray, ceiling: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (query, row) whose score can still lie in floor..ceiling of the query, level by level."""
    live, pairs = allowed, None
    for (mq, dq), (mr, dr) in zip(queries.levels, rows.levels, strict=True):
        # Rounding of the summaries; scores themselves are whole.
        norms = [np.sqrt((m * m + d * d).sum(axis=1).max(initial=0)) for m, d in ((mq, dq), (mr, dr))]
        slack = 0.5 + 1e-9 * norms[0] * norms[1]
        if pairs is None:
            middle, reach = mq @ mr.T, dq @ dr.T + slack
            live = live & (middle + reach >= floor[:, None]) & (middle - reach <= ceiling[:, None])
            if live.mean() < SPARSE:
                pairs = np.nonzero(live)
        else:
            i, j = pairs
            middle, reach = np.einsum("ij,ij->i", mq[i], mr[j]), np.einsum("ij,ij->i", dq[i], dr[j]) + slack
            keep = (middle + reach >= floor[i]) & (middle - reach <= ceiling[i])
            pairs = i[keep], j[keep]
    return np.nonzero(live) if pairs is None else pairs


class Best:
    """The first ``count`` rows of each slot: highest score, then smallest id."""

    def __init__(self, slots: int, count: int):
        self.count = count
        self.floor = np.full(slots, -np.inf)
        self.slot, self.score, self.vec_id, self.rid = (np.empty(0, np.int64) for _ in range(4))

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, rid: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score = np.concatenate([self.slot, slot]), np.concatenate([self.score, score])
        vec_id, rid = np.concatenate([self.vec_id, vec_id]), np.concatenate([self.rid, rid])
        order = np.lexsort((rid, vec_id, -score, slot))
        own = slot[order]
        first = np.searchsorted(own, own)
        order = order[np.arange(len(order)) - first < self.count]
        self.slot, self.score, self.vec_id, self.rid = slot[order], score[order], vec_id[order], rid[order]
        # A full slot takes nothing that scores less than its last row.
        last = np.flatnonzero(np.diff(self.slot, append=-1))
        sizes = np.diff(last, prepend=-1)
        full = last[sizes == self.count]
        self.floor[self.slot[full]] = self.score[full]


def summaries(vectors: DataFrame, anchors: Column, vector: str = "embedding") -> tuple[DataFrame, int]:
    """Written rows with a number of their own and the means and deviations of their segments, and the length of vectors.

    Rows with a null label, a null vector, or a null or non-finite component are left out.
    """
    plain = vectors.where(F.col("label").isNotNull() & finite(F.col(vector))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"), whole(F.col(vector)).alias("x"))
    dims = longest(plain, "x")
    schema = to_arrow_schema(StructType.fromDDL(_SUMMARY))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            means, deviations = (pa.array(list(a), pa.list_(pa.float64())) for a in segments(matrix(batch.column("x"), dims)))
            own = [batch.column(name) for name in ("rid", "vec_id", "label", "anchor", "x")]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip([*own, means, deviations], schema, strict=True)], schema=schema)

    numbered = plain.withColumn("rid", F.monotonically_increasing_id())
    return stage(to_python(numbered).mapInArrow(summarise, _SUMMARY), "segment-summaries"), dims


def _ids(values: np.ndarray) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(values.astype(np.int64), values == _LAST)


def _frames(rows: DataFrame, dims: int, search, schema: str) -> DataFrame:
    """``search(chunks of rows)`` in every task; it gives columns of ``schema`` once, at the end."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pd.DataFrame(search(Vectors.read(b, dims) for b in chunks(batches)))
        for start in range(0, len(found), 50_000):
            yield pa.RecordBatch.from_pandas(found.iloc[start:start + 50_000], schema=arrow, preserve_index=False)

    return to_python(rows).mapInArrow(run, schema)


def _positives(rows: DataFrame, dims: int, anchors: Vectors, count: int) -> DataFrame:
    """The first ``count`` other rows of the label of each anchor."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def search(parts: Iterator[Vectors]) -> dict:
        own = shared.value
        best = Best(len(own.rid), count)
        top = np.full(len(own.rid), np.inf)
        for part in parts:
            for at in range(0, len(own.rid), ANCHOR_TILE):
                tile = slice(at, at + ANCHOR_TILE)
                some = own[tile]
                allowed = (some.label[:, None] == part.label) & (some.rid[:, None] != part.rid)
                i, j = screened(some, part, allowed, best.floor[tile], top[tile])
                best.add(i + at, scores(some.x, part.x, i, j), part.vec_id[j], part.rid[j])
        return {"anchor": own.rid[best.slot], "positive_id": _ids(best.vec_id), "positive_rid": best.rid, "score": best.score}

    found = _frames(rows, dims, search, _POSITIVE)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("positive_id"), "positive_rid")
    return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= count)


def _negatives(rows: DataFrame, dims: int, anchors: Vectors, positives: pd.DataFrame, count: int, low: int, high: int) -> DataFrame:
    """The first ``count`` rows of other labels within reach of each positive of each anchor."""
    places = int(positives["place"].max())
    place_of = dict(zip(anchors.rid.tolist(), range(len(anchors.rid)), strict=True))
    at = positives["anchor"].map(place_of).to_numpy(np.int64), positives["place"].to_numpy(np.int64) - 1
    score, there = np.zeros((len(anchors.rid), places), np.int64), np.zeros((len(anchors.rid), places), bool)
    names = np.full((len(anchors.rid), places), _LAST)
    score[at], there[at], names[at] = positives["score"], True, positives["positive_id"].fillna(_LAST)
    # Whole scores with low * positive <= 100 * score <= high * positive; Python's numbers have no end.
    bounds = np.array([[(-(-low * p // 100), high * p // 100) for p in own] for own in score.tolist()], dtype=np.float64)
    least, most = np.where(there, bounds[..., 0], np.inf), np.where(there, bounds[..., 1], -np.inf)
    least[least > most] = np.inf
    shared = rows.sparkSession.sparkContext.broadcast((anchors, score, names, least, most))

    def search(parts: Iterator[Vectors]) -> dict:
        own, score, names, least, most = shared.value
        places = score.shape[1]
        best = Best(score.size, count)
        for part in parts:
            for at in range(0, len(own.rid), ANCHOR_TILE):
                tile = slice(at, at + ANCHOR_TILE)
                some = own[tile]
                wanted = np.maximum(least[tile], best.floor.reshape(score.shape)[tile])
                i, j = screened(some, part, some.label[:, None] != part.label, wanted.min(axis=1), most[tile].max(axis=1))
                value = scores(some.x, part.x, i, j)
                for k in range(places):
                    near = (value >= wanted[i, k]) & (value <= most[tile][i, k])
                    best.add((i[near] + at) * places + k, value[near], part.vec_id[j[near]], part.rid[j[near]])
        anchor, place = best.slot // places, best.slot % places
        return {
            "anchor": own.rid[anchor], "place": place + 1, "anchor_id": _ids(own.vec_id[anchor]), "positive_id": _ids(names[anchor, place]),
            "positive_score": score[anchor, place], "negative_id": _ids(best.vec_id), "negative_rid": best.rid, "negative_score": best.score,
        }

    found = _frames(rows, dims, search, _NEGATIVE)
    first = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative_rid")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= count)


def mine(
    vectors: DataFrame, anchors: Column, vector: str = "embedding", positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` has vec_id, label and a vector; ``anchors`` says which rows are anchors.
    A score is the inner product of floor(256 * component); higher ones come first,
    ties by smaller vec_id, a null one last. An anchor's positives are its first
    ``positives`` other rows of its label; for each, its negatives are the first
    ``negatives`` rows of another label that score from ``low`` to ``high`` percent of it.

    Rows with a null label, a null vector or a null or non-finite component take no part.
    Shorter vectors count as if zeros followed. Repeated rows are rows of their own, and
    repeated anchors have results of their own. No rows in, no rows out; other columns
    are not read. Every pair of an anchor and a row is either scored or shown by its
    bounds not to matter.
    """
    spark = vectors.sparkSession
    rows, dims = summaries(vectors, anchors, vector)
    asked = rows.where("anchor")
    blocks = -(-asked.count() // block)
    out = None
    for number in range(blocks):
        # About ``block`` anchors, so what comes to the driver and goes to the tasks is bounded.
        own = asked.where(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == number).toArrow()
        if not own.num_rows:
            continue
        own = Vectors.read(own, dims)
        best = _positives(rows, dims, own, positives).toPandas()
        if len(best):
            found = stage(_negatives(rows, dims, own, best, negatives, low, high), "negatives")
            out = found if out is None else out.unionByName(found)
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    if out is None:
        out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out.select(*columns)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 100; where 7 divides it, the label is the next of ten."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine(moved, F.col("vec_id") % 100 == 0)
