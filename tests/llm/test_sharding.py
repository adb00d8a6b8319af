"""Shards: every row in one, texts together, all three measures balanced."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyroll.llm import sharding
from tallyroll.llm.tokens import public_path

PATH = public_path("word_bpe_49k.json")


def _loads(rows, shards, column):
    out = [0] * shards
    for r in rows:
        out[r.shard] += getattr(r, column)
    return out


def _check(rows, docs, shards=16):
    """Rows against (doc_id, text) pairs: sizes, checksums, tokens and slots."""
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text in docs:
        data = (text or "").encode()
        want[doc_id, len(data) + 1, zlib.crc32(data), len(library.encode(text or "", add_special_tokens=False).ids) + 1] += 1
    assert Counter((r.doc_id, r.bytes, r.text_crc32, r.tokens) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark, sf, sample):
    df = sharding.op12_shards(spark, sf)
    assert df.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = df.withColumnRenamed("size", "bytes").collect()
    _check(rows, sample)
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    loads, largest = _loads(rows, 16, "bytes"), max(r.bytes for r in rows)
    assert max(loads) - min(loads) <= largest


@pytest.mark.parametrize("cell", [8192, 60])
def test_balance_of_all_three(spark, cell):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shard(docs, PATH, 5, cell).collect()
    assert len(rows) == 1000
    # Equal texts are together; no group of this table is large enough to be cut.
    assert all(len(s) == 1 for s in _shards_of(rows).values())
    largest = {m: max(getattr(r, m) for r in rows) for m in ("bytes", "tokens")}
    for measure in ("bytes", "tokens"):
        loads = _loads(rows, 5, measure)
        assert max(loads) - min(loads) <= (0.25 if cell > 1000 else 1) * largest[measure], (measure, loads)
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) <= 1.25 * min(counts.values())


def _shards_of(rows):
    out = defaultdict(set)
    for r in rows:
        out[r.text_crc32, r.bytes].add(r.shard)
    return out


def test_a_hot_group_is_cut(spark):
    """A third of all rows are equal in everything, doc_id too."""
    rows = [(None, "kaban loden mifol") if i % 3 == 0 else (i, f"word{i} " * (1 + i % 7)) for i in range(6000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), PATH, 4, 512).collect()
    _check(out, rows, 4)
    for measure in ("bytes", "tokens"):
        loads = _loads(out, 4, measure)
        assert max(loads) <= 1.03 * min(loads)
    counts = Counter(r.shard for r in out)
    assert max(counts.values()) <= 1.03 * min(counts.values())
    cut = [s for s in _shards_of(out).values() if len(s) > 1]
    assert len(cut) == 1 and len(cut[0]) == 4


def test_slots_over_blocks(spark):
    rows = spark.range(1000).select(F.col("id").alias("rid"), F.col("id").alias("doc_id"), F.pmod("id", F.lit(3)).cast("int").alias("shard"))
    found = sharding.with_slots(rows, 50).collect()
    for s in range(3):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_place_takes_the_highest_dot_product():
    vectors = np.array([[8, 1, 1], [1, 8, 1], [1, 1, 8], [3, 3, 3], [2, 0, 0], [0, 2, 0], [0, 0, 2]], float)
    got = sharding.place(vectors, 2)
    # The rule again, in plain loops.
    total = vectors.sum(axis=0)
    residual, want = [[0.5] * 3, [0.5] * 3], [None] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: (-sum(vectors[i] / total), i)):
        share = [v / t for v, t in zip(vectors[i], total)]
        products = [sum(a * b for a, b in zip(share, r)) for r in residual]
        want[i] = products.index(max(products))
        residual[want[i]] = [a - b for a, b in zip(residual[want[i]], share)]
    assert got.tolist() == want


def test_edge(edge, empty, edge_rows):
    rows = sharding.shard(edge, PATH).collect()
    _check(rows, edge_rows)
    assert sharding.shard(empty, PATH).collect() == []
