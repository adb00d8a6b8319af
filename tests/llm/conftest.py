"""Small tables of documents with nulls, empty and long texts, ties and repeated rows."""

import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ne", "ru", "sha", "to", "vi") for b in ("ban", "den", "fol", "gar", "hin", "jor", "kel", "mun")]

#: Columns that operators might use inside.
CLASHING = ("n_words", "stats", "rule_stats", "verdict", "text_hash", "hash", "node", "label", "bucket", "kept_id", "taken_id", "key", "draw", "start", "spans", "item", "words", "three", "twice", "at")


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    out = [draw.choice(WORDS) for _ in range(words)]
    return " ".join(w + "." if i % 9 == 8 else w for i, w in enumerate(out))


@pytest.fixture(scope="session")
def edge_rows():
    long = prose(5, 12_000)
    return [
        (None, None), (None, "kaban loden"), (None, prose(1, 80)), (1, ""), (2, None), (3, " \n\t "), (4, "word"),
        (5, prose(1, 80)), (6, prose(1, 80)), (6, prose(1, 80)), (6, prose(2, 80)), (7, long), (8, long + " tail"),
        (9, "été 中文 \U0001f600 <|endoftext|> don't"), (10, "x" * 5000), (2**60 + 1, prose(3, 60)),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows, "doc_id long, text string")
    return docs.withColumns({c: F.lit(7) for c in CLASHING})


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def sample(spark):
    """A whole small table of documents, as rows."""
    return [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
