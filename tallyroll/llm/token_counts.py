"""Token counts of sections by offset mapping.

A document is encoded once, as a whole, so no token count is changed by cutting it up.
The byte spans of its tokens are joined to the byte spans of its sections, and a token
that crosses a border is allocated by a stated rule:

- ``first``: to the section that holds its first byte;
- ``most``: to the section that holds most of its bytes, the earlier one if equal;
- ``shares``: to all sections it touches, by their shares of its bytes.

Bytes outside all sections, such as line ends, count to the section before them, or to
the first section if there is none before. So the counts of a document always add up
to its tokens.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tallyroll.llm.common import longs, map_texts, table, texts
from tallyroll.llm.tokens import public_path

RULES = ("first", "most", "shares")


class ByteEncoder:
    """Ids by a byte-level vocabulary, whose tokens are byte strings that make up the text."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Where each token ends, in bytes."""
        return np.cumsum(self.sizes[np.asarray(self.encoding.encode_to_numpy(text, disallowed_special=()), np.int64)])


_made: dict[tuple[int, str, str], ByteEncoder] = {}


def _encoder(path: str, pattern: str) -> ByteEncoder:
    """One for each process and vocabulary file."""
    key = (os.getpid(), path, pattern)
    if key not in _made:
        _made[key] = ByteEncoder(path, pattern)
    return _made[key]


def line_sections(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in bytes, of the lines that are not empty; the whole of a text that has none."""
    breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == 10)
    starts = np.concatenate([[0], breaks + 1])
    ends = np.append(breaks, len(data))
    some = ends > starts
    return (starts[some], ends[some]) if some.any() else (np.array([0]), np.array([len(data)]))


def allocate(token_ends: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section by the rule, and how many tokens cross from it into a later one.

    An interval join of two sorted lists: sections reach from their start to the start
    of the next, the first one from 0.
    """
    n = len(starts)
    if not len(token_ends):
        return np.zeros(n), np.zeros(n, np.int64)
    begins = np.concatenate([[0], token_ends[:-1]])
    borders = starts[1:]
    first = np.searchsorted(borders, begins, side="right")
    last = np.searchsorted(borders, token_ends - 1, side="right")
    crossing = last > first
    if rule == "first":
        counts = np.bincount(first, minlength=n).astype(float)
    else:
        counts = np.bincount(first[~crossing], minlength=n).astype(float)
        for i in np.flatnonzero(crossing):
            cuts = np.concatenate([[begins[i]], borders[first[i]:last[i]], [token_ends[i]]])
            share = np.diff(cuts) / (token_ends[i] - begins[i])
            if rule == "most":
                counts[first[i] + int(share.argmax())] += 1
            else:
                counts[first[i]:last[i] + 1] += share
    return counts, np.bincount(first[crossing], minlength=n)


def count_tokens(
    docs: DataFrame, path: str, pattern: str, rule: str = "most", sections: Callable[[bytes], tuple[np.ndarray, np.ndarray]] = line_sections,
) -> DataFrame:
    """doc_id, section, start, end (in characters), n_tokens and n_crossing of every section of every whole text.

    ``sections`` gives the starts and ends in bytes, in order and at least one; they
    must not overlap. Null and empty texts have one empty section without tokens; repeated rows are
    counted alike; other columns are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path, pattern)
        for frame in frames:
            parts = []
            for key, text in zip(longs(frame, "doc_id"), frame["text"], strict=True):
                data = text.encode()
                starts, ends = sections(data)
                counts, crossing = allocate(encoder.ends(text), starts, rule)
                # Characters before each byte: those bytes that begin one.
                chars = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
                parts.append(([key] * len(starts), np.arange(len(starts)), chars[starts], chars[ends], counts, crossing))
            columns = [[x for p in parts for x in p[0]], *[np.concatenate([p[i] for p in parts]) for i in range(1, 6)]]
            yield pd.DataFrame(dict(zip(("doc_id", "section", "start", "end", "n_tokens", "n_crossing"), columns, strict=True)))

    return map_texts(texts(docs), count, "doc_id long, section int, start long, end long, n_tokens double, n_crossing long")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
