"""Hashes of the words of many texts at a time, with numpy."""

from __future__ import annotations

import numpy as np

#: Words are runs of ASCII letters, ASCII digits and any other character outside ASCII, in lower case.
WORD = r"[0-9a-z\x80-\U0010ffff]+"

_IN_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each 64-bit value."""
    x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(256, dtype=np.uint64), 99)


def segment_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes; the runs begin at ``starts`` and fill ``data``."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = np.diff(starts, append=len(data))
    powers = np.cumprod(np.full(int(sizes.max()), _FACTOR, np.uint64))
    inside = np.arange(len(data)) - np.repeat(starts, sizes)
    return mixed(np.add.reduceat(_BYTE[data] * powers[inside], starts))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where each text's words begin, with the total at the end."""
    encoded = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b" ".join([*encoded, b""]), np.uint8)
    inside = _IN_WORD[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    place = np.flatnonzero(start)
    at = np.searchsorted(place, np.concatenate([[0], np.cumsum([len(e) + 1 for e in encoded])]))
    return segment_hashes(data[inside], np.flatnonzero(start[inside])), at


def shingles(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words, and the text each is in.

    A text with fewer words has one shingle of all its words; one without words has none.
    """
    counts = np.diff(at)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), n)
    first = np.repeat(at[:-1] - (np.cumsum(n) - n), n) + np.arange(len(text))
    end = at[1:][text]
    total = np.zeros(len(text), np.uint64)
    for i in range(size):
        here = first + i
        word = words[np.minimum(here, len(words) - 1)] if len(words) else words
        total = total * _FACTOR + np.where(here < end, word, np.uint64(0))
    return mixed(total, 1), text
