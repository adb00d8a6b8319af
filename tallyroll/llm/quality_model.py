"""A quality classifier: Naive Bayes support vectors over n-gram indicators.

Indicators of n-grams are scaled by the log ratio of their counts in the two classes;
a linear hinge-loss model is fitted to them by dual coordinate descent, and a sigmoid
on set-aside rows turns margins into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import about, longs, map_texts, table, texts
from tallyroll.llm.hashing import mixed, segment_hashes

#: n-grams are hashed to this many bits.
BITS = 18
#: The model is fitted on about so many labelled rows at most, drawn by a hash of doc_id.
MAX_ROWS = 10_000
PENALTY = 1.0
EPOCHS = 15

_CODES = np.arange(256)
_UPPER = (_CODES >= 65) & (_CODES <= 90)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_LOWER = np.where(_UPPER, _CODES + 32, _CODES).astype(np.uint8)
# 0 white space and control, 1 in a word, 2 a mark
_KIND = np.where(_CODES <= 32, 0, np.where((_CODES >= 128) | _DIGIT | _UPPER | (_CODES >= 97) & (_CODES <= 122), 1, 2)).astype(np.uint8)


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The different n-gram buckets of each text, and where each text's begin.

    Tokens are words and single marks. There are three kinds of n-gram: tokens, two
    tokens in a row, and three shapes in a row. A shape is a mark itself, or the
    case, length and digits of a word, and says if the token repeats the one before.
    """
    encoded = [t.encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
    kind = _KIND[data]
    start = kind == 2
    start[:1] |= kind[:1] == 1
    start[1:] |= (kind[1:] == 1) & (kind[:-1] != 1)
    keep = kind > 0
    chars, at = data[keep], np.flatnonzero(start[keep])
    text = np.searchsorted(np.cumsum([len(e) + 1 for e in encoded]), np.flatnonzero(start), side="right")
    if not len(at):
        return np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    token = segment_hashes(_LOWER[chars], at)
    size = np.diff(at, append=len(chars))
    upper, digits = (np.add.reduceat(x[chars].astype(np.int32), at) for x in (_UPPER, _DIGIT))
    case = np.where(upper == 0, 0, np.where((upper == size) & (size > 1), 2, np.where((upper == 1) & _UPPER[chars[at]], 1, 3)))
    shape = case + 4 * np.minimum(size, 12) // 3 * 4 + 64 * (digits > 0)
    shape = np.where(_KIND[chars[at]] == 2, 256 + chars[at].astype(np.int64), shape)
    again = np.zeros(len(token), bool)
    again[1:] = (token[1:] == token[:-1]) & (text[1:] == text[:-1])
    shape = mixed((shape + 1024 * again).astype(np.uint64), 9)
    two = text[1:] == text[:-1]
    three = two[1:] & two[:-1]
    pairs = mixed(mixed(token[:-1], 5) + token[1:], 6)[two]
    threes = mixed(mixed(mixed(shape[:-2], 7) + shape[1:-1], 7) + shape[2:], 8)[three]
    grams = np.concatenate([token, pairs, threes]) >> np.uint64(64 - BITS)
    owner = np.concatenate([text, text[1:][two], text[2:][three]]).astype(np.uint64)
    once = np.unique((owner << np.uint64(BITS)) | grams)
    where = np.searchsorted(once >> np.uint64(BITS), np.arange(len(texts) + 1, dtype=np.uint64))
    return (once & np.uint64((1 << BITS) - 1)).astype(np.int64), where


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, cost: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model; labels are 1 and -1, cost bounds each row's dual variable.

    A row's features are ``scale`` at its buckets, brought to unit length.
    """
    weight, bias = np.zeros(len(scale)), 0.0
    values = []
    for row in rows:
        value = scale[row]
        length = np.sqrt((value**2).sum())
        values.append(value / length if length else value)
    norms = np.array([(v**2).sum() + 1 for v in values])
    alpha = np.zeros(len(rows))
    random = np.random.default_rng(7)
    for _ in range(epochs):
        most = 0.0
        for i in random.permutation(len(rows)):
            row, value, y = rows[i], values[i], labels[i]
            slope = y * (weight[row] @ value + bias) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                most = max(most, abs(step))
                alpha[i] = new
                weight[row] += step * y * value
                bias += step * y
        if most < 1e-4:
            break
    return weight, bias


def sigmoid_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """slope and shift of the probability of label 1, by Newton's method with a small ridge."""
    x = np.stack([margins, np.ones(len(margins))])
    # Targets short of 0 and 1, as for rows not seen in the fit.
    ones = labels.sum()
    target = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        slope = x @ (p - target) + 1e-3 * (beta - [1, 0])
        curve = (x * (p * (1 - p) + 1e-9)) @ x.T + 1e-3 * np.eye(2)
        beta = beta - np.linalg.solve(curve, slope)
    return float(max(beta[0], 1e-3)), float(beta[1])


@dataclass(frozen=True)
class Model:
    weight: np.ndarray  # of each bucket, its scale included
    scale: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, buckets: np.ndarray, at: np.ndarray) -> np.ndarray:
        n = len(at) - 1
        text = np.repeat(np.arange(n), np.diff(at))
        length = np.sqrt(np.bincount(text, (self.scale[buckets] ** 2).astype(float), n))
        margin = np.bincount(text, self.weight[buckets].astype(float), n) / np.where(length > 0, length, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _fit(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """weight, scale and bias."""
    counts = [np.ones(1 << BITS), np.ones(1 << BITS)]
    for row, label in zip(rows, labels, strict=True):
        counts[label][row] += 1
    scale = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    sign = np.where(labels > 0, 1, -1)
    # Both classes weigh the same.
    share = np.bincount(labels, minlength=2) / len(labels)
    weight, bias = dual_coordinate_descent(rows, scale, sign, PENALTY * 0.5 / share[labels])
    return weight, scale, bias


def fit_rows(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """Fit on the rows; every fifth one is set aside for the sigmoid first.

    With one class only, or no rows, every text scores the share of label 1 (0.5 without rows).
    """
    zero = np.zeros(1 << BITS)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return Model(zero, zero, 0.0, 1.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    aside = np.arange(len(rows)) % 5 == 4
    slope, shift = 1.0, 0.0
    if all(len(set(labels[x].tolist())) == 2 for x in (aside, ~aside)):
        weight, scale, bias = _fit([r for r, a in zip(rows, aside, strict=True) if not a], labels[~aside])
        part = Model(weight * scale, scale, bias, 1.0, 0.0)
        own = [r for r, a in zip(rows, aside, strict=True) if a]
        at = np.concatenate([[0], np.cumsum([len(r) for r in own])])
        p = part.scores(np.concatenate(own), at)
        slope, shift = sigmoid_fit(np.log(p / (1 - p)), labels[aside])
    weight, scale, bias = _fit(rows, labels)
    return Model((weight * scale).astype(np.float32), scale.astype(np.float32), bias, slope, shift)


def held_out() -> Column:
    """Rows whose labels are not learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on about ``max_rows`` labelled rows at most that are not held out.

    Rows without a label of 0 or 1, and doc_ids with both, are not learned from. A
    null text is empty. Neither doc_id nor any other column than text is an input.
    """
    known = labels.where(~held_out() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other")
    chosen = about(known, max_rows, "doc_id").select("doc_id", F.col("label").cast("int").alias("label"))
    rows = texts(docs).join(F.broadcast(chosen), "doc_id")  # about max_rows

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            buckets, at = ngrams(frame["text"].tolist())
            yield pd.DataFrame({"doc_id": longs(frame, "doc_id"), "label": frame["label"].to_numpy(), "grams": [
                buckets[a:b].astype("<i4").tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]})

    found = map_texts(rows, extract, "doc_id long, label int, grams binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["grams"]))
    order = np.random.default_rng(11).permutation(len(found))
    data = [np.frombuffer(found[i]["grams"], "<i4").astype(np.int64) for i in order]
    return fit_rows(data, np.array([found[i]["label"] for i in order], np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; null texts are empty, repeated rows score alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = shared.value.scores(*ngrams(frame["text"].tolist()))
            yield pd.DataFrame({"doc_id": longs(frame, "doc_id"), "score": found, "predicted": (found >= 0.5).astype(np.int32)})

    scored = map_texts(texts(docs), apply, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
