"""Token ids of whole texts, many texts at a time.

A word of a text always becomes the same ids, whatever stands around it, so each
different word goes through the tokenizers library once in a task (as long as the
bounded store of words lasts) and its ids are then looked up. Words are found with
numpy for texts in Latin-1; any other text, and any text that spells out a special
token, goes through the library whole.
"""

from __future__ import annotations

import os
import threading
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tallyroll.llm.common import ranges

#: Words whose ids a task keeps; when there are more it starts over.
MAX_WORDS = 250_000

_SPACE, _LETTER, _DIGIT, _OTHER = range(4)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """For each Latin-1 character its class and its lower-case form."""
    kind = np.full(256, _OTHER, np.uint8)
    lower = np.arange(256, dtype=np.uint8)
    for code in range(256):
        char = chr(code)
        # Unlike Python, the pattern's white space leaves out the separators 1C to 1F.
        if char in "\t\n\x0b\x0c\r \x85\xa0":
            kind[code] = _SPACE
        elif char.isalpha():
            kind[code] = _LETTER
        elif char.isnumeric():
            kind[code] = _DIGIT
        if len(char.lower().encode("latin-1", "ignore")) == 1:
            lower[code] = ord(char.lower())
    return kind, lower


_KIND, _LOWER = _classes()


def _byte_letters() -> dict[int, str]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = [_byte_letters()[b] for b in range(256)]


class WordEncoder:
    """Ids by a lower-casing word BPE, such as ``word_bpe_49k.json``."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.max_words = max_words
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.starts, self.sizes = array("I"), array("q"), array("q")

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the store; new words are encoded."""
        known, ids, tokenize = self.known, self.ids, self.model.tokenize
        found = list(map(known.get, words))
        for i in [i for i, at in enumerate(found) if at is None]:
            word = words[i]
            text = word.decode("latin-1")
            if not word.isalnum():  # else plain letters or digits, which stand for themselves
                text = "".join([_LETTERS[b] for b in text.encode()])
            own = [t.id for t in tokenize(text)]
            known[word] = found[i] = len(self.starts)
            self.starts.append(len(ids))
            self.sizes.append(len(own))
            ids.extend(own)
        return np.array(found, np.int64)

    def _words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower-case characters without white space, starts of words in them, and starts in the text."""
        data = _LOWER[data]
        kind = _KIND[data]
        start = np.empty(len(kind), bool)
        start[:1] = True
        np.not_equal(kind[1:], kind[:-1], out=start[1:])
        start |= kind == _DIGIT
        start &= kind != _SPACE
        # An apostrophe that stands alone before letters takes a few endings with it.
        quote = np.flatnonzero(data == 39)
        if len(quote):
            quote = quote[(quote < len(data) - 1) & start[quote]]
            quote = quote[kind[quote + 1] == _LETTER]
            one = data[quote + 1]
            two = data[np.minimum(quote + 2, len(data) - 1)]
            size = np.where(np.isin(one, [115, 116, 109, 100]), 2, 0)  # s t m d
            pair = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)  # re ve ll
            size = np.where(pair & (quote + 2 < len(data)), 3, size)
            quote, size = quote[size > 0], size[size > 0]
            start[quote + 1] = False
            end = quote + size
            end = end[end < len(data)]
            start[end[kind[end] == _LETTER]] = True
        keep = kind != _SPACE
        return data[keep], np.flatnonzero(start[keep]), np.flatnonzero(start)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids begin, with the total at the end."""
        pieces, alone, size = [], {}, []
        for i, text in enumerate(texts):
            try:
                piece = text.encode("latin-1")
                if "<" in text and any(s in text for s in self.special):
                    raise ValueError
            except ValueError:  # also characters outside Latin-1
                alone[i] = self.tokenizer.encode(text, add_special_tokens=False).ids
                piece = b""
            pieces.append(piece)
            size.append(len(piece) + 1)
        buffer = np.frombuffer(b" ".join([*pieces, b""]), np.uint8)
        if len(self.known) > self.max_words:
            self._clear()
        chars, at, place = self._words(buffer)
        count = np.zeros(len(texts), np.int64)
        if len(at):
            offsets = np.append(at, len(chars)).astype(np.int32)
            words = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(chars)])
            coded = words.dictionary_encode()
            number = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
            length = np.frombuffer(self.sizes, np.int64)[number]
            ids = np.frombuffer(self.ids, np.uint32)[ranges(np.frombuffer(self.starts, np.int64)[number], length)]
            sums = np.concatenate([[0], np.cumsum(length)])
            ends = sums[np.searchsorted(place, np.cumsum(size))]
            count = np.diff(ends, prepend=0)
        else:
            ids = np.empty(0, np.uint32)
        if alone:
            cut = np.split(ids, np.cumsum(count)[:-1])
            for i, own in alone.items():
                cut[i] = np.array(own, np.uint32)
            count = np.array([len(x) for x in cut], np.int64)
            ids = np.concatenate(cut)
        return ids, np.concatenate([[0], np.cumsum(count)])


_made: dict[tuple[int, str], WordEncoder] = {}
_lock = threading.Lock()


def word_encoder(path: str) -> WordEncoder:
    """One for each process and vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with _lock:
        key = (os.getpid(), path)
        if key not in _made:
            _made[key] = WordEncoder(path)
        return _made[key]


@lru_cache
def public_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
