"""Quality rules and the quality classifier."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroll.llm import quality_model, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _counts(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts(spark, sf, sample):
    got = {r.doc_id: r for r in quality_rules.op8_quality_rules(spark, sf).collect()}
    assert len(got) == len(sample)
    for doc_id, text in sample:
        r = got[doc_id]
        n, _, _, _, repeat = want = _counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert r.kept == (not r.base_failed and r.p_good >= 0.5)


def test_counts_of_repeats(spark):
    texts = ["a b c a b c", "a a a a", "a b c d", "a b", "x y z\nx y z\n \n \nx y z", "", " \x0b\x0c ", "p q r s p q r t q r s"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in quality_rules.rule_stats(rows, "s").collect():
        assert (r.s.n_words, r.s.word_chars, r.s.n_symbols, r.s.n_dup_lines, r.s.n_repeat_words) == _counts(texts[r.doc_id])


def _patterns(spark, votes):
    counted = Counter(map(tuple, votes.tolist()))
    names = ", ".join(f"v{j} int" for j in range(votes.shape[1]))
    return spark.createDataFrame([(*k, n) for k, n in counted.items()], f"{names}, n long")


def _cast(draw, good, given_good, given_bad):
    """Votes of one rule: chances of bad, abstain and good among good and among bad documents."""
    edges = np.where(good[:, None], np.cumsum(given_good)[:2], np.cumsum(given_bad)[:2])
    return (draw.random(len(good))[:, None] > edges).sum(axis=1) - 1


#: Rules that vote both ways, only bad, only bad and rarely, and one that votes bad on good documents.
_GIVEN = [
    ((0.05, 0.25, 0.70), (0.65, 0.30, 0.05)), ((0.02, 0.98, 0.0), (0.40, 0.60, 0.0)), ((0.01, 0.99, 0.0), (0.15, 0.85, 0.0)),
    ((0.10, 0.10, 0.80), (0.75, 0.20, 0.05)), ((0.30, 0.70, 0.0), (0.05, 0.95, 0.0)), ((0.20, 0.80, 0.0), (0.20, 0.80, 0.0)),
]


def _em(votes, docs, rounds=300):
    """Expectation-maximisation over all rows, in numpy: chances of the outcomes of each rule and class, and the posterior."""
    size = len(votes)
    hot = np.stack([votes == way for way in (-1, 0, 1)], axis=2).astype(float)
    rates = (hot.sum(axis=0) + 1) / (size + 3)
    a = quality_rules.START_ACCURACY
    start = np.stack([rates * [1 - a, 1, a], rates * [a, 1, 1 - a]])
    start /= start.sum(axis=2, keepdims=True)
    share, table = quality_rules.START_GOOD, start.copy()
    for _ in range(rounds):
        score = np.log(share / (1 - share)) + (hot * np.log(table[0] / table[1])).sum(axis=(1, 2))
        p = 1 / (1 + np.exp(-score))
        share = p.mean()
        table = np.stack([((hot * q[:, None, None]).sum(axis=0) + docs * s) / (q.sum() + docs) for q, s in zip((p, 1 - p), start)])
    return share, table, p


def test_fit_is_expectation_maximisation(spark):
    draw = np.random.default_rng(1)
    good = draw.random(20_000) < 0.8
    votes = np.stack([_cast(draw, good, *given) for given in _GIVEN], axis=1)
    model = quality_rules.fit(_patterns(spark, votes), len(_GIVEN))
    share, table, p = _em(votes, quality_rules.START_DOCS)
    assert model.good == pytest.approx(share, abs=5e-3)
    np.testing.assert_allclose([model.given_good, model.given_bad], table, atol=5e-3)
    # What was planted is found again, one-sided rules included.
    assert model.good == pytest.approx(good.mean(), abs=0.03)
    for found, want in zip((model.given_good, model.given_bad), zip(*_GIVEN)):
        np.testing.assert_allclose(found, want, atol=0.03)
    weight = [np.log(g[0] / b[0]) for g, b in zip(model.given_good, model.given_bad)]
    assert weight[4] > 1  # a vote for bad by the rule that is wrong speaks for good
    assert abs(weight[5]) < 0.3  # and one by the rule that knows nothing says next to nothing
    assert ((p >= 0.5) == good).mean() > 0.93


def test_a_wrong_rule_among_the_documents(spark):
    """Over real votes, a rule that votes bad exactly where ``marks`` votes good gets no weight against them."""
    docs = quality_rules.rule_stats(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "s")
    vote = quality_rules.votes(F.col("s"))
    own = docs.select(*[v.alias(f"v{j}") for j, v in enumerate(vote)])
    wrong = own.withColumn("v7", F.when(F.col("v6") == 1, -1).otherwise(0)).groupBy(*[f"v{j}" for j in range(8)]).agg(F.count("*").alias("n"))
    model = quality_rules.fit(wrong, 8)
    assert model.given_good[7][0] > 0.9 and model.given_bad[7][0] < 0.2
    for j in range(5):  # the rules that only vote bad
        assert model.given_bad[j][0] > 5 * model.given_good[j][0]


def test_verdicts_of_a_table(spark, sf):
    """``kept`` and ``p_good`` by an independent EM over the rows of the query."""
    rows = quality_rules.op8_quality_rules(spark, sf).collect()
    stats = quality_rules.rule_stats(spark.read.parquet(f"{sf}/documents.parquet"), "s")
    votes = np.array([list(r) for r in stats.orderBy("doc_id").select(*quality_rules.votes(F.col("s"))).collect()])
    _, _, p = _em(votes, quality_rules.START_DOCS)
    for r, want in zip(sorted(rows, key=lambda r: r.doc_id), p):
        assert r.p_good == pytest.approx(want, abs=2e-2)
        assert r.kept == (not r.base_failed and r.p_good >= 0.5)


def test_labelled_documents(spark):
    """No label is read, yet bad documents go and good ones that pass the base stay."""
    found = quality_rules.op8_quality_rules(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").collect()
    assert sum(r.kept for r in rows if r.quality == 0) <= 0.02 * sum(r.quality == 0 for r in rows)
    passed = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in passed) >= 0.98 * len(passed)


def test_rules_edge(edge, empty, edge_rows):
    judged = quality_rules.judge(edge, "out")
    assert judged.columns == [*edge.columns, "out"]
    rows = judged.collect()
    assert sorted(r.out.n_words for r in rows) == sorted(_counts(t or "")[0] for _, t in edge_rows)
    assert all(r.out.base_failed for r in rows if not (r.text or "").strip())
    assert quality_rules.keep_good(empty).count() == 0
    kept = quality_rules.keep_good(edge)
    assert kept.columns == edge.columns
    assert {r.doc_id for r in kept.collect()} >= {5, 7, 8, 2**60 + 1}


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = quality_model.op2_quality_classifier(spark, sf)
    rows = {r.doc_id: r for r in scored.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == 1000
    for doc_id, r in rows.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(rows[k].predicted, v) for k, v in labels.items() if rows[k].held_out]
    for label in (0, 1):
        own = [p == v for p, v in held if v == label]
        assert np.mean(own) > 0.9


def test_labels_that_are_held_out_do_not_count(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality_model.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (quality_model.train(docs, x) for x in (labels, turned))
    assert np.array_equal(one.weight, two.weight) and (one.bias, one.slope, one.shift) == (two.bias, two.slope, two.shift)


def test_dual_coordinate_descent_reaches_the_optimum():
    draw = np.random.default_rng(2)
    x = (draw.random((60, 12)) < 0.4).astype(float)
    y = np.where(x[:, 0] + x[:, 1] > x[:, 2] + draw.random(60), 1, -1)
    rows = [np.flatnonzero(r) for r in x]
    weight, bias = quality_model.dual_coordinate_descent(rows, np.ones(12), y, np.full(60, 1.0), epochs=2000)
    unit = np.array([r / max(1, np.sqrt(r.sum())) for r in x])
    loss = lambda w: 0.5 * (w**2).sum() + np.maximum(0, 1 - y * (unit @ w[:-1] + w[-1])).sum()
    best = loss(np.append(weight, bias))
    for _ in range(300):
        assert loss(np.append(weight, bias) + draw.normal(0, 0.05, 13)) >= best - 1e-3


def test_classifier_edge(spark, edge, empty, edge_rows):
    labels = spark.createDataFrame([(5, 1), (7, 1), (3, 0), (10, 0), (6, 0), (6, 1), (None, 1), (9, None)], "doc_id long, quality int")
    model = quality_model.train(edge, labels)
    assert quality_model.score(edge, model).count() == len(edge_rows)
    assert quality_model.score(empty, quality_model.train(empty, labels.limit(0))).count() == 0
    one = quality_model.score(edge, quality_model.train(edge, labels.where("quality = 1"))).collect()
    assert all(r.predicted == 1 for r in one)
