"""Token ids, packing and token files."""

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyroll.llm.packing import first_fit_decreasing, op10_pack_sequences, pack
from tallyroll.llm.token_files import PerfectHash, document_keys, fingerprints, op7_token_files, read_documents, read_ids, write_token_files
from tallyroll.llm.tokens import WordEncoder, public_path
from tallyroll.runtime import new_path

PATH = public_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return WordEncoder(PATH, max_words=50)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'srtvelm d!?<|1\n\t\xb2\xe9\xdf\xa0\x1c\x85İ中́"), max_size=25), max_size=6))
def test_ids_are_the_librarys(library, encoder, texts):
    ids, at = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [library(t) for t in texts]


def test_ids_of_whole_documents(library, encoder, sample, edge_rows):
    texts = [t for _, t in sample[:60]] + [t or "" for _, t in edge_rows]
    ids, at = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [library(t) for t in texts]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit_decreasing(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, offsets = first_fit_decreasing(np.array(lengths, np.int64), 64)
    used, want = [], []
    for x in lengths:
        at = next((i for i, u in enumerate(used) if u + x <= 64), len(used))
        if at == len(used):
            used.append(0)
        want.append((at, used[at]))
        used[at] += x
    assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == want


def _check_pieces(rows, docs, library, capacity=2048):
    sequences, whole = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        whole.setdefault(r.doc_id, []).append(r)
    for every in sequences.values():
        at = 0
        for offset, length in sorted(every):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in docs:
        ids = np.array([*library(text), 1], "<u4")
        at = 0
        for r in sorted(whole[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    sizes = [sum(n for _, n in every) for every in sequences.values()]
    return sum(capacity - n for n in sizes if n & (n - 1)), sum(sizes)


def test_pack_query(spark, sf, sample, library):
    padding, total = _check_pieces(op10_pack_sequences(spark, sf).collect(), sample, library)
    assert padding < 0.02 * total + 2048


def test_pack_edge(edge, empty, edge_rows, library):
    rows = pack(edge, PATH, sequence=64, group_docs=4, with_ids=True).collect()
    want = sorted((None if k is None else k, len(library(t or "")) + 1) for k, t in edge_rows if k is not None)
    got = {}
    for r in rows:
        assert len(r.ids) == r.length <= 64
        got.setdefault((r.doc_id, r.doc_tokens), 0)
        got[r.doc_id, r.doc_tokens] += r.length
    assert sum(got.values()) == sum(n for _, n in want) + sum(len(library(t or "")) + 1 for k, t in edge_rows if k is None)
    assert pack(empty, PATH).count() == 0


def test_equal_rows_are_spread_over_all_groups(spark):
    docs = spark.range(40_000).selectExpr("cast(null as bigint) AS doc_id", "'the same few words' AS text").repartition(5)
    rows = pack(docs, PATH).collect()
    groups = Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) == 40_000 and len(groups) == 5 and max(groups.values()) < 1.2 * min(groups.values())
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and sum(used.values()) > 0.95 * 2048 * len(used)


def test_perfect_hash():
    keys = document_keys(list(range(5000)) + [None], [0] * 5001)
    index = PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(5001))
    others = document_keys(list(range(10**6, 10**6 + 3000)), [0] * 3000)
    slots, prints = index.slots(others), np.empty(5001, np.uint32)
    prints[index.slots(keys)] = fingerprints(keys)
    known = slots >= 0
    assert (prints[slots[known]] == fingerprints(others[known])).sum() == 0
    assert len(PerfectHash.build(keys[:0]).slots(keys)) == 5001


def test_token_files_query(spark, sf, sample, library):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op7_token_files(spark, sf).collect()}
    at, want = 0, {}
    for doc_id, text in sorted(sample):
        ids = np.array([*library(text), 2], "<u4")
        want[doc_id] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want


def test_token_files_edge(spark, edge, empty, edge_rows, library):
    folder = new_path(spark, "test-token-files")
    write_token_files(edge, folder, PATH, shard_ids=300)
    rows = read_documents(spark, folder).collect()
    assert sorted((r.n_tokens for r in rows)) == sorted(len(library(t or "")) + 1 for _, t in edge_rows)
    order = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in order] == np.cumsum([0] + [r.n_tokens for r in order])[:-1].tolist()
    keys = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert keys == sorted(keys) and 2**60 + 1 in keys
    found = read_ids(spark, folder, [5, 7, 2**60 + 1, 999])
    texts = dict(edge_rows)
    assert found == {k: [*library(texts[k]), 2] for k in (5, 7, 2**60 + 1)}
    nothing = new_path(spark, "test-token-files")
    write_token_files(empty, nothing, PATH)
    assert read_documents(spark, nothing).count() == 0


def test_a_key_is_read_in_a_bounded_number_of_bytes(spark, library):
    docs = spark.range(0, 40_000, 1, 4).selectExpr("id * 3 AS doc_id", "concat('the words of number ', id) AS text")
    folder = new_path(spark, "test-token-files")
    write_token_files(docs, folder, PATH)
    size = sum(r.length for r in spark.read.format("binaryFile").load(f"{folder}/raw").select("length").collect())
    counts, asked = [], [0, 3, 60_000, 119_997]
    found = read_ids(spark, folder, asked, counts)
    assert found == {k: [*library(f"the words of number {k // 3}"), 2] for k in asked}
    assert len(counts) == 4 and max(counts) < 2000 < size / 100
    assert read_ids(spark, folder, [1, 59_999, 10**9, -1]) == {}


def test_rows_of_one_id_are_spread_over_tasks(spark):
    docs = spark.range(0, 40_000, 1, 4).selectExpr("cast(null as bigint) AS doc_id", "concat('number ', id) AS text")
    folder, setting = new_path(spark, "test-token-files"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        write_token_files(docs, folder, PATH)
    finally:
        spark.conf.unset(setting)
    parts = {r.part: r.n for r in spark.read.parquet(f"{folder}/directory").groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    assert len(parts) > 1 and max(parts.values()) < 2 * min(parts.values())
    assert read_documents(spark, folder).count() == 40_000
