"""Quality rules as weak supervision.

Rules vote for good (1) or bad (-1) or abstain (0). Expectation-maximisation over
the vote patterns of all documents estimates how often each rule votes each way among
good and among bad documents, abstaining included, and how many documents are good; the
posterior of a document's pattern decides. All of it is built-in Spark expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import SPACES, free_name, table
from tallyroll.runtime import stage

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: EM ends when no chance moves by more than this, or after so many rounds.
TOLERANCE, MAX_ROUNDS = 1e-4, 40
#: A rule starts as this reliable, and so many documents as good; what it starts from then weighs as much as so many documents.
START_ACCURACY, START_GOOD, START_DOCS = 0.9, 0.8, 3

RULES = ("length", "symbols", "capitals", "repeats", "lines", "sentences", "marks")


def _windows(hashes: Column) -> Column:
    """A hash of every three words in a row; null if there are fewer than two windows."""
    last = F.size(hashes) - 3
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))
    return F.when(last >= 1, windows)


def rule_stats(docs: DataFrame, out: str = "stats") -> DataFrame:
    """``docs`` with a struct of counts of each whole text (null: empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words, three, twice, at = (free_name(docs, x) for x in ("words", "three", "twice", "at"))
    trimmed = F.btrim(text, F.lit(SPACES))
    letters = F.translate(text, SPACES, "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    step = docs.withColumn(words, F.when(trimmed == "", F.expr("array()").cast("array<bigint>")).otherwise(
        F.transform(F.split(trimmed, "[\\x20\\x09-\\x0D]+"), lambda w: F.xxhash64(w))))
    step = step.withColumn(three, _windows(F.col(words)))
    # Windows side by side with their equals, where some are equal; then the places of those that are.
    placed = F.transform(three, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    step = step.withColumn(twice, F.when(F.size(F.array_distinct(three)) < F.size(three), F.sort_array(placed)))
    step = step.withColumn(at, F.sort_array(F.transform(
        F.filter(
            F.transform(F.col(twice), lambda x, k: F.struct(
                ((x["h"] == F.get(F.col(twice), k - 1)["h"]) | (x["h"] == F.get(F.col(twice), k + 1)["h"])).alias("dup"), x["i"].alias("i"))),
            lambda x: F.coalesce(x["dup"], F.lit(False))),
        lambda x: x["i"])))
    repeat = F.aggregate(
        F.transform(F.col(at), lambda p, k: F.least(F.lit(3), F.coalesce(F.get(F.col(at), k + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, x: total + x)
    step = step.withColumn(out, F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(letters).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeat, F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))).cast("long").alias("n_capitals"),
        (F.length(text) - F.length(F.translate(text, ".!?", ""))).cast("long").alias("n_stops"),
        F.length(F.regexp_replace(text, r"[\p{L}\p{N}\x20\x09-\x0D]+", "")).cast("long").alias("n_marks"),
    ))
    return step.drop(words, three, twice, at)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def votes(s: Column) -> list[Column]:
    """One vote per rule, in the order of RULES; a text without words is too short and plain."""
    n = s["n_words"]

    def vote(bad: Column, good: Column | None = None) -> Column:
        out = F.when(bad, -1)
        return (out if good is None else out.when(good, 1)).otherwise(0).cast("int")

    plain = 20 * s["n_marks"] <= s["word_chars"]
    return [
        vote(n < MIN_WORDS),
        vote(10 * s["n_symbols"] > n),
        vote(10 * s["n_capitals"] > 3 * s["word_chars"]),
        vote(10 * s["n_repeat_words"] > 3 * n),
        vote(10 * s["n_dup_lines"] > 3 * s["n_lines"]),
        vote((s["n_stops"] * 200 < n) | (s["n_stops"] * 2 > n), (s["n_stops"] * 60 >= n) & (s["n_stops"] * 4 <= n) & plain),
        vote(10 * s["n_marks"] > s["word_chars"], plain),
    ]


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents; for each rule the chance that it votes bad, abstains and votes good, among good and among bad documents."""

    good: float
    given_good: tuple[tuple[float, float, float], ...]
    given_bad: tuple[tuple[float, float, float], ...]

    def chances(self) -> list[float]:
        return [self.good, *[x for own in (self.given_good, self.given_bad) for rule in own for x in rule]]

    def posterior(self, vote: list[Column]) -> Column:
        """Probability that a document with these votes is good; abstaining counts for what it says, too."""
        score = F.lit(math.log(self.good / (1 - self.good)))
        for v, good, bad in zip(vote, self.given_good, self.given_bad, strict=True):
            weight = [math.log(g / b) for g, b in zip(good, bad, strict=True)]
            score = score + F.when(v == -1, weight[0]).when(v == 1, weight[2]).otherwise(weight[1])
        return 1 / (1 + F.exp(-score))


def _shares(counts: list[float], belief: tuple[float, float, float], docs: float) -> tuple[float, float, float]:
    total = sum(counts) + docs
    return tuple((c + docs * b) / total for c, b in zip(counts, belief, strict=True))


def fit(patterns: DataFrame, n_rules: int = len(RULES)) -> LabelModel:
    """EM over counted vote patterns: columns v0, v1, ... and n; at most 3 ** n_rules rows.

    For each rule and class the chances of all three outcomes are estimated, so a rule
    that only ever votes bad is learned like any other. Only the start says which class
    is the good one: there, a vote is right with START_ACCURACY. It weighs no more than
    START_DOCS documents after that, so a rule that votes the wrong way is found out.
    With no documents the start is returned.
    """
    vote = [F.col(f"v{j}") for j in range(n_rules)]
    patterns = patterns.coalesce(1)  # so few rows need no exchange
    n = F.col("n")

    def counts(weight: Column, name: str) -> list[Column]:
        return [F.coalesce(F.sum(F.when(v == way, weight)), F.lit(0.0)).alias(f"{name}{j}_{way + 1}") for j, v in enumerate(vote) for way in (-1, 0, 1)]

    row = patterns.agg(F.coalesce(F.sum(n), F.lit(0)).alias("n"), *counts(n * F.lit(1.0), "all")).first()
    beliefs: tuple[list, list] = ([], [])
    for j in range(n_rules):
        bad, none, good = _shares([row[f"all{j}_{k}"] for k in range(3)], (1 / 3, 1 / 3, 1 / 3), 3)
        for own, right in zip(beliefs, (False, True), strict=True):  # among good ones a vote for bad is wrong
            split = (bad * (START_ACCURACY if right else 1 - START_ACCURACY), none, good * (1 - START_ACCURACY if right else START_ACCURACY))
            own.append(tuple(x / sum(split) for x in split))
    model = LabelModel(START_GOOD, tuple(beliefs[0]), tuple(beliefs[1]))
    if not row["n"]:
        return model
    for _ in range(MAX_ROUNDS):
        p = model.posterior(vote)
        row = patterns.agg(F.sum(n).alias("n"), F.sum(n * p).alias("good"), *counts(n * p, "g"), *counts(n * (1 - p), "b")).first()

        def learned(name: str, belief: list, row=row) -> tuple:
            return tuple(_shares([row[f"{name}{j}_{k}"] for k in range(3)], belief[j], START_DOCS) for j in range(n_rules))

        last, model = model, LabelModel(min(0.99, max(0.01, row["good"] / row["n"])), learned("g", beliefs[0]), learned("b", beliefs[1]))
        if max(abs(x - y) for x, y in zip(last.chances(), model.chances(), strict=True)) <= TOLERANCE:
            break
    return model


def judge(docs: DataFrame, out: str = "verdict", drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with a struct: the counts, base_failed, p_good and kept.

    Counts and votes are written once; the model is fitted on the patterns of all
    rows. Null texts are empty and fail; repeated rows are judged alike; no rows give
    no rows; any extra column stays, but for those named in ``drop``.
    """
    stats = free_name(docs, "rule_stats")
    counted = stage(rule_stats(docs, stats).drop(*drop), "rules")
    vote = votes(F.col(stats))
    patterns = counted.groupBy(*[v.alias(f"v{j}") for j, v in enumerate(vote)]).agg(F.count(F.lit(1)).alias("n"))
    model = fit(stage(patterns, "votes"))
    failed, p = base_failed(F.col(stats)), model.posterior(vote)
    return counted.withColumn(out, F.struct(
        F.col(f"{stats}.*"), failed.alias("base_failed"), p.alias("p_good"), (~failed & (p >= 0.5)).alias("kept"),
    )).drop(stats)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that are kept, with the columns of ``docs``."""
    verdict = free_name(docs, "verdict")
    return judge(docs, verdict).where(F.col(verdict)["kept"]).drop(verdict)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, drop=("text",))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
    return judged.select("doc_id", *[F.col("verdict")[x].alias(x) for x in names])
