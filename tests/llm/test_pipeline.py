"""The pipeline, each stage held against brute force on what it was given."""

from collections import Counter

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from tallyroll.llm import catalog, near_dups, quality_rules, secrets
from tallyroll.llm.tokens import public_path
from tallyroll.runtime import new_path

from .test_search import _classes, _contained
from .test_tokens import _check_pieces


@pytest.fixture(scope="module")
def steps(spark, sf):
    """What goes into each stage, and what the last one returns."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, "test-pipeline")
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def _rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_stay(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_quality(spark, sf, steps):
    kept = {r.doc_id for r in quality_rules.op8_quality_rules(spark, sf).where("kept").collect()}
    assert Counter(_rows(steps[1])) == Counter(x for x in _rows(steps[0]) if x[0] in kept)


def test_one_of_each_class(steps):
    rows = _rows(steps[1])
    groups = _classes(rows, near_dups.bucket_weights(near_dups.texts(steps[1])))
    want = {min(rows[i][0] for i in g) for g in groups}
    assert sorted(k for k, _ in _rows(steps[2])) == sorted(want)


def test_no_benchmark_item_is_left(spark, sf, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = _rows(steps[2])
    taken = {d for d, _ in _contained(rows, items)}
    assert Counter(_rows(steps[3])) == Counter(x for x in rows if x[0] not in taken) and taken


def test_secrets_are_cut_out(steps):
    before, after = dict(_rows(steps[3])), {r.doc_id: r for r in steps[4].collect()}
    assert before.keys() == after.keys()
    for doc_id, text in before.items():
        clean, at = "", 0
        spans = [s for s in secrets.base_spans(text)]
        if not spans and "[secret]" not in after[doc_id].text:
            assert after[doc_id].text == text
        for start, _, end in spans:
            assert start < at or text[at:start] in after[doc_id].text
            at = max(at, end)
        assert not [s for s in secrets.base_spans(after[doc_id].text) if s[1] != "assign"]
        assert after[doc_id].n_chars == len(after[doc_id].text)


def test_packing(steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    padding, total = _check_pieces(steps[5].collect(), _rows(steps[4]), lambda t: tokenizer.encode(t, add_special_tokens=False).ids)
    assert padding < 0.02 * total + 2048


def test_run_gives_the_last_stage(spark, sf, steps):
    # The packing group of a row depends on its place in the files, so sequences may differ.
    piece = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(corpus_pipeline.run(spark, sf).select(*piece).collect()) == sorted(steps[5].select(*piece).collect())


def test_stages_on_odd_tables(spark, sf, edge, empty):
    for docs in (edge, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= 0


def test_queries_are_registered():
    names = list(driver.queries())
    assert [n for n in names if n.startswith("op")] == list(catalog.QUERIES) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))
