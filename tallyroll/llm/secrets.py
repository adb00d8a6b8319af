"""Secrets in texts: fixed patterns, and a linear-chain conditional random field over tokens.

The field tags the tokens of whole texts as the beginning of a secret, inside one, or
outside. It knows tokens by shape, the words around them and traits of the file. It is
fitted on a bounded sample of documents whose windows are labelled in three ways: by the
patterns, half of them with the telling name and sign hidden; by made-up secrets of
shapes that no pattern knows, put into the documents' own words; and by made-up look-alikes
that are none. A token of the documents that could be a secret but is not known to be one
is left open: the fit sums over its tags.

Scores are sums over the words around a token, so tokens are scored with table look-ups.
Viterbi then runs where it can find anything but outside: between such places the path is
outside for certain, whatever has been learned.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import BLOCK_CHARS, about, longs, map_texts, to_python, table, texts

KINDS = ("assign", "access", "hex", "tagged")
# Letters of the names in either case are ASCII letters: no long s, no Kelvin sign.
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_HEX_BYTES = bytes(ord("h") if chr(b) in "0123456789abcdef" else 32 for b in range(256))

#: Words that announce a secret, in any case.
_STEMS = ("passw", "passphrase", "passcode", "pwd", "secret", "token", "bearer", "apikey", "api_key", "api-key", "credential", "key", "auth")
_TELLING = re.compile(f"(?i:{'|'.join(_STEMS)})")
_TOKEN = re.compile(r"[A-Za-z0-9+/_.\-\u0080-\U0010ffff]+|[^\sA-Za-z0-9+/_.\-\u0080-\U0010ffff]")

BEGIN, INSIDE, OUTSIDE = range(3)
_ANY, _ONLY = (1, 1, 1), ((1, 0, 0), (0, 1, 0), (0, 0, 1))

#: Features are hashed to this many bits.
BITS = 16
#: Words around a token that the field looks at.
OFFSETS = (-4, -3, -2, -1, 1, 2)
_PAD = 4
#: The field is fitted on windows of about so many documents, drawn by a hash, and no more than this of them.
MAX_DOCS = 1500
#: Windows by the patterns, of one document; which ones is drawn.
MAX_WINDOWS = 4
#: Tokens on either side of a window's middle, and the least count of a word that is known by name.
SIDE, LEAST_COUNT = 12, 3
EPOCHS = 8
#: Different words whose scores a task keeps; when there are more it starts over.
MAX_WORDS = 300_000

Span = tuple[int, str, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of what the fixed patterns match; an assignment ends with its value."""
    spans: list[Span] = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        spans += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)]
    if b"h" * 24 in text.encode("utf-8", "replace").translate(_HEX_BYTES):
        spans += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return sorted(spans, key=_order)


def secret_parts(text: str, spans: list[Span]) -> list[Span]:
    """The spans without the names and signs that an assignment begins with."""
    return [(_ASSIGN.match(text, start).start(2) if kind == "assign" else start, kind, end) for start, kind, end in spans]


def _order(span: Span) -> tuple[int, int, int]:
    return span[0], KINDS.index(span[1]), span[2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def tokens_of(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def _shape(word: str) -> str:
    out = []
    for c in word[:64]:
        kind = "9" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out[:8])


def _entropy(word: str) -> int:
    n = len(word)
    return round(-2 * sum(c / n * math.log2(c / n) for c in Counter(word).values()))


def _plain(word: str) -> bool:
    """Letters alone, or with one stop or hyphen after them."""
    return word.isalpha() or word[-1:] in (".", "-") and word[:-1].isalpha()


def _case(word: str) -> str:
    case = "X" if word.isupper() else "x" if word.islower() else "Xx" if word[1:].islower() else "xX"
    return case if word[-1].isalpha() else case + word[-1]


def word_features(word: str, words: frozenset[str]) -> tuple[list[str], list[str]]:
    """What a word says of itself, and of the tokens near it. The empty word is the edge of the text."""
    low = word.lower() if len(word) <= 24 else "<long>"
    name, size, telling = low if low in words else "<other>", min(12, len(word) // 4), bool(_TELLING.search(word))
    if not word:
        own = ["edge"] * 10
        shape = ""
    elif _plain(word):
        shape = _case(word)
        own = ["b", f"s{shape}", f"n{size}", f"w{name}", f"t{telling}", "plain", f"plain{size}", f"plain{shape}{size}", "-", "-"]
    else:
        shape = _shape(word)
        digits = sum("0" <= c <= "9" for c in word)
        letters = sum(c.isalpha() for c in word)
        hexed = all(c in "0123456789abcdefABCDEF" for c in word)
        changes = sum((a.isdigit() != b.isdigit()) or (a.isupper() != b.isupper()) for a, b in zip(word, word[1:]))
        own = [
            "b", f"s{shape}", f"n{size}", f"w{name}", f"t{telling}", f"e{_entropy(word)}", f"h{hexed}{size}",
            f"d{digits * 4 // len(word)}{letters * 4 // len(word)}{min(size, 5)}", f"c{min(changes, 12)}{min(size, 5)}", f"p{word[:4]}",
        ]
    near = [f"w{name}", f"t{telling}", f"s{shape if len(shape) < 4 else '~'}"]
    return own, near



def file_features(text: str) -> list[str]:
    """Traits of the file: its size, its lines, and marks of code."""
    size = len(text)
    return [f"f{min(6, size // 1000)}", f"l{text.count(chr(10)) * 200 > size}", f"c{sum(map(text.count, '{};=')) * 50 > size}"]


def _hashed(names: list[str]) -> list[int]:
    return [zlib.crc32(x.encode("utf-8", "replace")) & ((1 << BITS) - 1) for x in names]


def _near_names(near: list[str]) -> list[list[str]]:
    return [[f"{step}{x}" for x in near] for step in OFFSETS]


@dataclass(frozen=True)
class Field:
    """emit[tag, feature] and move[tag before, tag]; a text starts and ends outside. ``words`` are known by name."""

    emit: np.ndarray
    move: np.ndarray
    words: frozenset[str] = frozenset()


class Tagger:
    """Scores and tags the tokens of texts with a field. Scores of words are kept, as words repeat."""

    def __init__(self, field: Field, max_words: int = MAX_WORDS):
        self.field, self.max_words = field, max_words
        self.files: dict[tuple[str, ...], np.ndarray] = {}
        self._clear()
        # Against the path outside, which all scores are taken relative to.
        move = field.move - field.move[OUTSIDE, OUTSIDE]
        inner = move[:OUTSIDE, :OUTSIDE]
        into, out = move[OUTSIDE, BEGIN], move[:OUTSIDE, OUTSIDE]
        #: What each token inside a run may gain by moves at most, and a run besides.
        self.step = max(0.0, inner.max())
        self.once = max(0.0, into + out.max() - self.step)
        #: What a cut of a run may cost at most, but for a token that then begins one.
        finite = [x for x in (into, *out, *inner.ravel()) if np.isfinite(x)]
        self.cut = 4 * max(map(abs, finite)) + self.step

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.count = 0
        self.own, self.near = np.zeros((1024, 3), np.float32), np.zeros((1024, len(OFFSETS), 3), np.float32)
        self._number("")

    def _number(self, word: str) -> int:
        low = word.lower()
        key = word
        if low not in self.field.words and len(word) > 3 and _plain(word) and not _TELLING.search(word):
            # Words that look alike in everything the field can see share a place.
            key = f" {_case(word)}{'<long>' if len(word) > 24 else ''}{min(12, len(word) // 4)}"
        place = self.known.get(key)
        if place is None:
            own, near = word_features(word, self.field.words)
            emit = self.field.emit
            place = self.known[key] = self.count
            self.count += 1
            if place == len(self.own):
                self.own, self.near = (np.concatenate([x, np.zeros_like(x)]) for x in (self.own, self.near))
            self.own[place] = emit[:, _hashed(own)].sum(axis=1)
            self.near[place] = [emit[:, _hashed(x)].sum(axis=1) for x in _near_names(near)]
        self.known[word] = place
        return place

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the tokens of all texts, and where each text's tokens begin, with the end."""
        if len(self.known) > self.max_words:
            self._clear()
        known, number = self.known, self._number
        numbers: list[int] = [0] * _PAD
        at, files = [], []
        for text in texts:
            at.append(len(numbers))
            numbers += [place if (place := known.get(w)) is not None else number(w) for w in _TOKEN.findall(text)]
            files.append(len(numbers) - at[-1])
            numbers += [0] * _PAD
        ids = np.array(numbers)
        out = self.own[ids]
        for k, step in enumerate(OFFSETS):
            here = slice(max(0, -step), len(ids) - max(0, step))
            there = slice(max(0, step), len(ids) - max(0, -step))
            out[here] += self.near[ids[there], k]
        keep = np.ones(len(ids), bool)
        starts = np.array(at, np.int64)
        for begin, size in zip([0, *(starts + files).tolist()], [_PAD, *([_PAD] * len(at))], strict=True):
            keep[begin:begin + size] = False
        traits = np.array([self._file(text) for text in texts]).reshape(len(texts), 3)
        return out[keep] + np.repeat(traits, files, axis=0), np.concatenate([[0], np.cumsum(files)]).astype(np.int64)

    def _file(self, text: str) -> np.ndarray:
        names = tuple(file_features(text))
        if names not in self.files:
            self.files[names] = self.field.emit[:, _hashed(list(names))].sum(axis=1)
        return self.files[names]

    def viterbi(self, scores: np.ndarray) -> list[int]:
        """The best tags of tokens in a row that start and end outside; ties go to the earlier tag."""
        move = self.field.move
        best = move[OUTSIDE] + scores[0]
        back = []
        for row in scores[1:]:
            paths = best[:, None] + move
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        tag = int((best + move[:, OUTSIDE]).argmax())
        out = [tag]
        for step in reversed(back):
            tag = int(step[tag])
            out.append(tag)
        return out[::-1]

    def tags(self, scores: np.ndarray) -> dict[int, int]:
        """The tags of one text's tokens by Viterbi, of those that are not outside.

        A run that is not outside needs a token that gains by it. On either side of
        such tokens, the path is followed until tokens have lost more than leaving and
        beginning again can cost; beyond, outside is best.
        """
        if not len(scores):
            return {}
        gain = scores[:, :OUTSIDE].max(axis=1) - scores[:, OUTSIDE] + self.step
        places = np.flatnonzero(gain + self.once > 0)
        if not len(places):
            return {}
        least = self.cut + np.maximum(0, scores[:, INSIDE] - scores[:, BEGIN]).max()
        areas: list[list[int]] = []
        for i in places.tolist():
            if areas and i < areas[-1][1]:
                low = areas.pop()[0]
            else:
                low, lost = i, 0.0
                while low > 0 and lost <= least:
                    low -= 1
                    lost += max(0.0, -gain[low])
            high, lost = i + 1, 0.0
            while high < len(scores) and lost <= least:
                lost += max(0.0, -gain[high])
                high += 1
            while areas and areas[-1][1] >= low:
                low = min(low, areas.pop()[0])
            areas.append([low, high])
        out = {}
        for low, high in areas:
            for i, tag in enumerate(self.viterbi(scores[low:high]), low):
                if tag != OUTSIDE:
                    out[i] = tag
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _moves() -> np.ndarray:
    """Inside follows only a beginning or inside."""
    move = np.zeros((3, 3))
    move[OUTSIDE, INSIDE] = -np.inf
    return move


def beliefs(scores: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By forward-backward: log of the sum over all paths, chances of tags, and of neighbouring tags; (sequence, token, tag)."""
    longest = scores.shape[1]
    forward, backward = np.empty_like(scores), np.empty_like(scores)
    forward[:, 0] = move[OUTSIDE] + scores[:, 0]
    for t in range(1, longest):
        forward[:, t] = _log_sum(forward[:, t - 1, :, None] + move, 1) + scores[:, t]
    backward[:, -1] = move[:, OUTSIDE]
    for t in range(longest - 2, -1, -1):
        backward[:, t] = _log_sum(move + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
    total = _log_sum(forward[:, -1] + move[:, OUTSIDE], 1)
    both = np.exp(forward[:, :-1, :, None] + move + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None])
    return total, np.exp(forward + backward - total[:, None, None]), both


def fit_field(samples: list[tuple[list[list[int]], list[tuple]]], words: frozenset[str] = frozenset(), epochs: int = EPOCHS, seed: int = 3) -> Field:
    """Maximum likelihood with a small ridge, on batches of sequences with adaptive steps.

    A sample has the features of each token and the tags it may have. Its likelihood is
    the sum over all paths within these, so tokens that are left open teach nothing
    themselves. Without samples, no token is tagged.
    """
    emit, move = np.zeros((3, 1 << BITS)), _moves()
    if not samples:
        emit[OUTSIDE] = 1.0
        return Field(emit, move, words)
    draw = np.random.default_rng(seed)
    seen_emit, seen_move = np.full_like(emit, 1e-6), np.full((3, 3), 1e-6)
    by_length = sorted(range(len(samples)), key=lambda i: len(samples[i][0]))
    batches = [by_length[i:i + 64] for i in range(0, len(by_length), 64)]
    width = len(samples[0][0][0])
    outside = np.eye(3)[OUTSIDE]
    for _ in range(epochs):
        for b in draw.permutation(len(batches)):
            batch = [samples[i] for i in batches[b]]
            n, longest = len(batch), max(len(s[0]) for s in batch)
            feats = np.zeros((n, longest, width), np.int64)
            allowed, real = np.tile(np.array(_ONLY[OUTSIDE], bool), (n, longest, 1)), np.zeros((n, longest), bool)
            for i, (rows, own) in enumerate(batch):
                feats[i, :len(rows)], allowed[i, :len(rows)], real[i, :len(rows)] = rows, own, True
            scores = emit[:, feats].sum(axis=3).transpose(1, 2, 0) * real[:, :, None]
            free = scores.copy()
            free[~real, :OUTSIDE] = -np.inf  # padding stays outside
            _, belief, both = beliefs(free, move)
            _, wanted, pairs = beliefs(np.where(allowed, scores, -np.inf), move)
            gap = (wanted - belief) * real[:, :, None]
            slope_move = ((pairs - both) * real[:, 1:, None, None]).sum(axis=(0, 1)) + np.einsum("i,nj->ij", outside, gap[:, 0])
            flat = feats[real].ravel()
            for tag in range(3):
                slope = np.bincount(flat, np.repeat(gap[real][:, tag], width), 1 << BITS)
                touched = np.flatnonzero(slope)
                step = slope[touched] - 1e-3 * emit[tag, touched]
                seen_emit[tag, touched] += step**2
                emit[tag, touched] += 0.3 * step / np.sqrt(seen_emit[tag, touched])
            seen_move += slope_move**2
            move = np.where(np.isfinite(move), move + 0.3 * slope_move / np.sqrt(seen_move), move)
    return Field(emit.astype(np.float32), move, words)


# Beginnings of keys, names that stand before secrets, and how they are written.
_PREFIXES = ("sk_live_", "sk_test_", "pk_live_", "rk_live_", "ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "npm_", "hf_", "pypi-", "SG.", "AIza", "ya29.", "sk-")
_NAMES = (
    "secret_key", "secret key", "api key", "api-key", "access token", "access_key", "auth_token", "client_secret", "private key", "private_key", "credentials",
    "key", "auth", "bearer", "Authorization: Bearer", "X-Api-Key", "SECRET_KEY", "AUTH_TOKEN", "signing key", "webhook secret", "refresh token",
)
_PASSWORDS = ("password", "passphrase", "passwd", "passcode", "pwd", "Password", "PASSWORD", "login password", "db_password", "wifi password", "root password")
_SAID = ("{n} is {v}", "{n} {v}", "{n} -> {v}", "{n} => {v}", "{n} was {v}", "{n} '{v}'", "my {n} is {v}", "{n} ({v})", "{n}: <{v}>", "the {n} is \"{v}\"", "{n} | {v}", "{n}={v}", "{n}: {v}")
_BARE = ("{v}", "({v})", "\"{v}\"", "see {v} for it", "curl -H {v}", "<{v}>", "id {v},")
# Telling words in sentences that give nothing away.
_HARMLESS = (
    "the {n} was lost", "{n} is required", "a {n} of {w}", "{n} must be changed every {d} days", "no {n} here", "{n} of the {w}", "forgot the {n} again", "{n} {w} {w}",
    "enter the {n} and {w}", "the {n} is {w}", "{n}: {w}", "{n} has {d} letters", "{d} {n} were {w}", "his {n} is safe with {w}", "{n} = {w}",
)


def _run(draw: random.Random, alphabet: str, least: int, most: int) -> str:
    return "".join(draw.choices(alphabet, k=draw.randint(least, most)))


_MIXED = string.ascii_letters + string.digits


def made_secret(draw: random.Random, words: list[str]) -> tuple[str, str]:
    """A phrase with a made-up secret, and the secret."""
    kind = draw.randrange(8)
    name, bare = draw.choice(_NAMES), draw.random() < 0.5
    if kind <= 1:
        prefix = draw.choice(_PREFIXES) if draw.random() < 0.6 else _run(draw, string.ascii_lowercase, 2, 4) + draw.choice(("_", "-", "_live_", "_test_"))
        value = prefix + _run(draw, draw.choice((_MIXED, string.ascii_letters, string.ascii_lowercase + string.digits)), 16, 40)
    elif kind == 2:
        value = f"eyJ{_run(draw, _MIXED, 12, 36)}.eyJ{_run(draw, _MIXED, 16, 60)}.{_run(draw, _MIXED + '_-', 20, 43)}"
    elif kind == 3:
        value = _run(draw, _MIXED + "+/", 28, 64) + draw.choice(("", "=", "=="))
    elif kind == 4:
        value = _run(draw, string.ascii_uppercase + string.digits, 16, 32)
        bare = bare and len(value) >= 20
    elif kind == 5:
        value = _run(draw, _MIXED, 10, 32)
        bare = bare and len(value) >= 20
    else:
        name, bare = draw.choice(_PASSWORDS), False
        first, last = (draw.choice(words)[:8] for _ in range(2))
        value = draw.choice((f"{first}{draw.randrange(10, 9999)}{last}", f"{first}{draw.choice('@!#$%&')}{last}{draw.randrange(100)}", _run(draw, _MIXED, 8, 14),
                             f"{first.capitalize()}{draw.randrange(10, 9999)}{draw.choice('!?#*')}", f"{first}-{last}-{draw.randrange(10, 9999)}"))
    phrase = draw.choice(_BARE).format(v=value) if bare else draw.choice(_SAID).format(n=name, v=value)
    return phrase, value


def made_decoy(draw: random.Random, words: list[str]) -> str:
    """A phrase that looks alike and gives nothing away."""
    word, d = (lambda: draw.choice(words)), (lambda n: _run(draw, string.digits, n, n))
    kind = draw.randrange(14)
    if kind <= 5:
        return draw.choice(_HARMLESS).format(n=draw.choice(_NAMES + _PASSWORDS + ("token", "secret", "tokens", "secrets")), w=word(), d=draw.randrange(2, 400))
    return (
        d(draw.randrange(9, 20)), f"+{d(2)} {d(3)}-{d(4)}", f"{draw.randrange(256)}.{draw.randrange(256)}.{draw.randrange(256)}.{draw.randrange(256)}",
        f"{word()}@mail{d(1)}.{word()}.com", f"20{d(2)}-0{draw.randrange(1, 10)}-1{d(1)}T1{d(1)}:0{d(1)}:2{d(1)}Z",
        f"https://www.{word()}.com/{word()}/{word()}-{word()}/{d(draw.randrange(2, 9))}.html", f"/{word()}/{word()}_{word()}/{word()}{d(2)}.{draw.choice(('txt', 'py', 'pdf', 'png'))}",
        draw.choice((f"v{d(1)}.{d(2)}.{d(1)}-{word()}", f"{word()}_{word()}_{word()}", f"{word()}{word().capitalize()}{word().capitalize()}", f"ORD-20{d(2)}-{d(6)}", f"{word().upper()}-{d(4)}", f"ISBN {d(3)}-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"x86_64-{word()}-gnu", f"{word()}.{word()}.{word()}()", f"{d(2)}/{d(2)}/{d(4)}")),
    )[kind - 6]


def _open_token(word: str) -> bool:
    """Whether a token of a document that no pattern matches could be a secret all the same."""
    return len(word) >= 20 and "/" not in word and sum(c.isdigit() for c in word) >= 3 and sum(c.isalpha() for c in word) >= 3


def labelled(text: str, tokens: list[tuple[int, int]], secret: list[tuple[int, int]], real: bool) -> tuple[list[str], list[tuple]]:
    """The words of a window and the tags each may have."""
    words, allowed, before = [], [], False
    for start, end in tokens:
        word = text[start:end]
        mine = [s for s in secret if s[0] < end and start < s[1]]
        if mine:
            allowed.append(_ONLY[INSIDE if before and min(s[0] for s in mine) < start else BEGIN])
        else:
            allowed.append(_ANY if real and _open_token(word) else _ONLY[OUTSIDE])
        before = bool(mine)
        words.append(word)
    return words, allowed


def training_windows(text: str, draw: random.Random) -> list[tuple[list[str], list[tuple]]]:
    """Labelled windows of one document. The draws depend on nothing but ``draw``."""
    tokens = tokens_of(text)
    names = [w for w in (text[a:b] for a, b in tokens[:400]) if _plain(w) and len(w) > 2] or ["word"]
    parts = [(a, b) for a, _, b in secret_parts(text, base_spans(text))]
    starts = np.array([a for a, _ in tokens])

    def around(middle: int) -> list[tuple[int, int]]:
        return tokens[max(0, middle - SIDE):middle + SIDE]

    out = []
    for a, _ in draw.sample(parts, min(MAX_WINDOWS, len(parts))):
        words, allowed = labelled(text, around(int(np.searchsorted(starts, a))), parts, True)
        out.append((words, allowed))
        # The same with what the patterns go by hidden.
        hidden = [(draw.choice(names) if _TELLING.search(w) and tags == _ONLY[OUTSIDE] else w, tags) for w, tags in zip(words, allowed, strict=True)]
        hidden = [(w, tags) for w, tags in hidden if w not in ":=" or tags != _ONLY[OUTSIDE] or draw.random() < 0.5]
        out.append(([w for w, _ in hidden], [tags for _, tags in hidden]))
    if tokens:
        for _ in range(2):
            out.append(labelled(text, around(draw.randrange(len(tokens))), parts, True))
    for secret in (True, False):
        near = around(draw.randrange(len(tokens))) if tokens and draw.random() < 0.8 else []
        left, right = near[:len(near) // 2], near[len(near) // 2:]
        phrase, value = made_secret(draw, names) if secret else (made_decoy(draw, names), "")
        before = text[left[0][0]:left[-1][1]] + draw.choice((" ", "\n", ". ")) if left else ""
        after = draw.choice((" ", "\n", ". ")) + text[right[0][0]:right[-1][1]] if right else ""
        whole = before + phrase + after
        inside = [(a, b) for a, b in parts if near and near[0][0] <= a < near[-1][1]]
        if inside:
            continue  # one window, one kind of label
        at = len(before) + phrase.index(value) if secret else 0
        out.append(labelled(whole, tokens_of(whole), [(at, at + len(value))] if secret else [], not secret))
    return out


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> Field:
    """Fit on windows of at most ``max_docs`` documents, drawn by a hash; whole windows only."""

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text, draw in zip(frame["text"], frame["draw"], strict=True):
                traits = file_features(text)
                for number, (words, allowed) in enumerate(training_windows(text, random.Random(int(draw)))):
                    rows.append((int(draw), number, words, [sum(1 << k for k, x in enumerate(tags) if x) for tags in allowed], traits))
            yield pd.DataFrame(rows, columns=["draw", "number", "words", "allowed", "traits"])

    drawn = about(texts(docs), max_docs, "doc_id", "text").withColumn("draw", F.xxhash64("text"))
    # What comes to the driver has a bound: documents, windows of each, and tokens of a window.
    rows = map_texts(drawn, extract, "draw long, number long, words array<string>, allowed array<int>, traits array<string>")
    rows = rows.orderBy("draw", "number", "words").limit(2 * max_docs * (MAX_WINDOWS + 2)).collect()
    counts = Counter(w.lower() for r in rows for w in set(r["words"]) if len(w) <= 24)
    words = frozenset(w for w, n in counts.items() if n >= LEAST_COUNT)
    known: dict[str, tuple] = {}

    def parts(word: str) -> tuple:
        if word not in known:
            own, near = word_features(word, words)
            known[word] = _hashed(own), [_hashed(x) for x in _near_names(near)]
        return known[word]

    samples = []
    for row in rows:
        traits, own = _hashed(row["traits"]), [parts("")] * _PAD + [parts(w) for w in row["words"]] + [parts("")] * _PAD
        features = [
            [*own[i][0], *[x for k, step in enumerate(OFFSETS) for x in own[i + step][1][k]], *traits] for i in range(_PAD, len(own) - _PAD)
        ]
        if features:
            samples.append((features, [tuple(mask >> k & 1 for k in range(3)) for mask in row["allowed"]]))
    return fit_field(samples, words)


def _added(text: str, tags: dict[int, int], base: list[Span]) -> list[Span]:
    """Spans of tagged tokens. What lies within a pattern's span adds nothing; what reaches beyond it does."""
    if not tags:
        return []
    tokens, out = tokens_of(text), []
    for i in sorted(tags):
        start, end = tokens[i]
        if tags[i] == BEGIN:
            out.append((start, end))
        else:
            out[-1] = (out[-1][0], end)
    whole = [(a, a + len(text[a:b].rstrip(".")) or b) for a, b in out]  # a full stop ends the sentence
    return [(a, "tagged", b) for a, b in whole if not any(s[0] <= a and b <= s[2] for s in base)]


def find_all(texts: list[str], tagger: Tagger) -> Iterator[list[Span]]:
    """All spans of each text: those of the patterns, and those the field adds beside them."""
    mark = np.cumsum([len(t) for t in texts]) // BLOCK_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(mark)) + 1).tolist(), len(texts)]
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        scores, at = tagger.scores(texts[low:high])
        for text, begin, end in zip(texts[low:high], at[:-1], at[1:], strict=True):
            base = base_spans(text)
            yield sorted(base + _added(text, tagger.tags(scores[begin:end]), base), key=_order)


def find(text: str, field: Field) -> list[Span]:
    return next(find_all([text], Tagger(field)))


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts by kind, the digest of the patterns' spans, and all spans, of every row.

    Null texts are empty and have no spans; repeated rows are scanned alike; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(shared.value)
        for frame in frames:
            rows = []
            for key, spans in zip(longs(frame, "doc_id"), find_all(frame["text"].tolist(), tagger), strict=True):
                base = [s for s in spans if s[1] != "tagged"]
                counts = Counter(s[1] for s in spans)
                rows.append((key, *[counts[k] for k in KINDS], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            yield pd.DataFrame(rows, columns=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return map_texts(texts(docs), apply, "doc_id long, n_assign long, n_access long, n_hex long, n_tagged long, base_sha256 string, spans string")


def redact(docs: DataFrame, field: Field, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret of a text replaced by ``mark``, of an assignment the value.

    Null texts stay null, and all other columns stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    place = docs.columns.index("text")

    def clean(text: str | None, spans: list[Span]) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for start, _, end in sorted(secret_parts(text, spans)):
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for batch in batches:
            own = batch.column(place)
            found = own.to_pylist()
            kept = [clean(text, spans) for text, spans in zip(found, find_all([x or "" for x in found], tagger), strict=True)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(kept, own.type))

    return to_python(docs).mapInArrow(apply, docs.schema)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scan(docs, train(docs))
