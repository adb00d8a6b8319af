"""Removal of repeated bytes: prefix-free parsing into phrases, and suffix arrays of their dictionary.

A byte goes if a string of LENGTH bytes over it also starts earlier in the corpus, in
a document of smaller doc_id or earlier in the same one. All is judged on the input.

1. Parse. A rolling hash over WIDTH bytes is taken everywhere; the smallest hash in a
   string of LENGTH bytes is its trigger, so every such string holds one, and equal
   strings have it at the same place. The strings that share a trigger where it stands
   make up a phrase, which overlaps the next one by LENGTH - 1 bytes: no string is lost
   between phrases, and equal strings lie in phrases of the same trigger.
2. Dictionary. Of equal phrases the first in corpus order stays; all others are repeats
   as a whole. A highly repetitive corpus is thereby reduced to its different phrases.
3. Suffix arrays. Different phrases of the same trigger may still share strings. Their
   suffixes are sorted by LENGTH bytes, with the first place of each phrase in the corpus
   order; of equal neighbours all but the first in corpus order are repeats.

Phrases are dealt by trigger. Triggers that are frequent in a part of the corpus are
dealt by phrase instead, and suffixes by what surrounds the trigger, so no common passage
ends up in one task. Nothing is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import longs, map_groups, map_texts, table, texts
from tallyroll.llm.hashing import mixed
from tallyroll.operators.relational import row_positions
from tallyroll.runtime import stage

LENGTH = 100
WIDTH = 32
#: Bytes of text that a task parses at a time, phrases it collects before it passes them on, and strings it sorts at a time.
SEGMENT, FLUSH, SORTED = 1 << 20, 300_000, 200_000
#: Different phrases of one trigger in one flush, beyond which they are dealt by phrase.
CROWD = 8
#: Characters of text for each group of phrases.
GROUP_CHARS = 16_000_000

_HASHES = LENGTH - WIDTH + 1
_SIDE = (LENGTH - WIDTH) // 2
_PLACE = np.uint64((1 << 28) - 1)
_BASE = 0x9E3779B97F4A7C15
_BYTE = mixed(np.arange(256, dtype=np.uint64), 77)
_FIELDS = {"trigger": "<u8", "phrase": "<u8", "doc": "<i8", "start": "<i8", "left": "u1", "span": "u1"}
_PACKED = "bucket int, sure boolean, done boolean, " + ", ".join(f"{x} binary" for x in _FIELDS)

_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SEGMENT + 2 * LENGTH)
        inverse = np.uint64(pow(_BASE, -1, 2**64))
        ones = [np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)]) for b in (np.uint64(_BASE), inverse)]
        _powers[:] = [np.cumprod(x, dtype=np.uint64) for x in ones]
    return _powers[0][:n], _powers[1][:n]


def phrases(data: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """The phrases of byte strings that stand one after the other and end at ``ends``.

    trigger, phrase: hashes; first: place of the first string of LENGTH bytes; left:
    bytes from there to the trigger; span: how many further strings there are.
    """
    n = len(data)
    none = {x: np.empty(0, np.int64) for x in ("trigger", "phrase", "first", "left", "span")}
    if n < LENGTH:
        return none
    power, inverse = _power(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power[:n], dtype=np.uint64)])
    hashes = mixed((sums[WIDTH:] - sums[:-WIDTH]) * inverse[:n - WIDTH + 1], 1)
    marked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    # The least in each window, from the least up to and from the edges of fixed blocks.
    blocks = np.full(-(-len(marked) // _HASHES) * _HASHES, np.uint64(2**64 - 1))
    blocks[:len(marked)] = marked
    blocks = blocks.reshape(-1, _HASHES)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    strings = n - LENGTH + 1
    at = (np.minimum(ahead[:strings], behind[_HASHES - 1:_HASHES - 1 + strings]) & _PLACE).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(n + 1, np.int64)
    some = ends - starts >= LENGTH
    np.add.at(inside, starts[some], 1)
    np.add.at(inside, ends[some] - LENGTH + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside[:strings]) > 0)
    if not len(valid):
        return none
    at = at[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
    # A trigger that two documents share would lie across their border, which no valid string does.
    begin = np.flatnonzero(new)
    first, last, trigger = valid[begin], valid[np.append(begin[1:], len(valid)) - 1], at[begin]
    left, span = trigger - first, last - first
    whole = (sums[last + LENGTH] - sums[first]) * inverse[first]
    return {
        "trigger": hashes[trigger], "phrase": mixed(whole + (left * 256 + span).astype(np.uint64) * np.uint64(_BASE), 2),
        "first": first, "left": left, "span": span,
    }


def _places(doc: np.ndarray, start: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """An order by the keys, then by corpus order."""
    return np.lexsort((start, doc, *keys[::-1]))


def _new(*keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys[0]), bool)
    out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def _packed(held: list[dict[str, np.ndarray]], groups: int) -> Iterator[pd.DataFrame]:
    """One row for each group of phrases; phrases that are repeated within ``held`` are done."""
    runs = {x: np.concatenate([h[x] for h in held]) for x in _FIELDS}
    order = _places(runs["doc"], runs["start"], runs["trigger"], runs["phrase"])
    runs = {x: v[order] for x, v in runs.items()}
    first = _new(runs["trigger"], runs["phrase"])
    head = _new(runs["trigger"])
    number = np.cumsum(head) - 1
    different = np.bincount(number, first)[number]
    rank = np.cumsum(first) - np.cumsum(first)[head][number]
    crowd = different > CROWD
    by_trigger = (runs["trigger"] % np.uint64(groups)).astype(np.int64)
    by_phrase = (runs["phrase"] % np.uint64(groups)).astype(np.int64)
    rows = []
    # Of a crowd two phrases stay with the trigger, to show others there that they are not alone.
    for sure, done, chosen, bucket in (
        (False, False, first & (~crowd | (rank < 2)), by_trigger), (True, False, first & crowd, by_phrase), (False, True, ~first, by_phrase),
    ):
        index = np.flatnonzero(chosen)
        index = index[np.argsort(bucket[index], kind="stable")]
        cuts = np.flatnonzero(_new(bucket[index])) if len(index) else []
        for part in np.split(index, cuts[1:]) if len(index) else []:
            rows.append((int(bucket[part[0]]), sure, done, *[runs[x][part].astype(t).tobytes() for x, t in _FIELDS.items()]))
    yield pd.DataFrame(rows, columns=["bucket", "sure", "done", *_FIELDS])


def _parse(groups: int):
    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0
        for frame in frames:
            pieces, size = [], 0
            rows = [(d, t.encode("utf-8", "replace")) for d, t in zip(longs(frame, "doc_id"), frame["text"], strict=True)]
            # Each string of a long text starts in one piece.
            todo = [(d, s, b[s:s + SEGMENT + LENGTH - 1]) for d, b in rows for s in range(0, max(1, len(b) - LENGTH + 1), SEGMENT)]
            for i, piece in enumerate(todo):
                pieces.append(piece)
                size += len(piece[2])
                if size < SEGMENT and i + 1 < len(todo):
                    continue
                ends = np.cumsum([len(b) for _, _, b in pieces])
                found = phrases(np.frombuffer(b"".join([b for _, _, b in pieces]), np.uint8), ends)
                own = np.searchsorted(ends, found["first"], side="right")
                begin = np.concatenate([[0], ends[:-1]])
                held.append({
                    "trigger": found["trigger"].astype(np.uint64), "phrase": found["phrase"].astype(np.uint64),
                    "doc": np.array([d for d, _, _ in pieces], np.int64)[own],
                    "start": np.array([s for _, s, _ in pieces], np.int64)[own] + found["first"] - begin[own],
                    "left": found["left"], "span": found["span"],
                })
                count += len(own)
                pieces, size = [], 0
                if count >= FLUSH:
                    yield from _packed(held, groups)
                    held, count = [], 0
        if count:
            yield from _packed(held, groups)

    return parse


_FOUND = "doc_id long, start long, left int, span int, trigger long"


def _dictionary(group: pd.DataFrame) -> pd.DataFrame:
    """Repeats as a whole (trigger null), and the phrases whose strings are still to be compared."""
    out = []
    kinds = {}
    for (sure, done), part in group.groupby(["sure", "done"]):
        kinds[bool(sure), bool(done)] = {x: np.frombuffer(b"".join(part[x]), t) for x, t in _FIELDS.items()}

    def add(runs: dict[str, np.ndarray], chosen: np.ndarray, open_: bool) -> None:
        trigger = pd.array(runs["trigger"][chosen].view(np.int64), "Int64") if open_ else pd.array([None] * int(chosen.sum()), "Int64")
        out.append(pd.DataFrame({
            "doc_id": runs["doc"][chosen], "start": runs["start"][chosen], "left": runs["left"][chosen].astype(np.int32),
            "span": runs["span"][chosen].astype(np.int32), "trigger": trigger,
        }))

    for (sure, done), runs in kinds.items():
        if done:
            add(runs, np.ones(len(runs["doc"]), bool), False)
            continue
        order = _places(runs["doc"], runs["start"], runs["trigger"], runs["phrase"])
        runs = {x: v[order] for x, v in runs.items()}
        first = _new(runs["trigger"], runs["phrase"])
        number = np.cumsum(_new(runs["trigger"])) - 1
        several = np.bincount(number, first)[number] > 1
        add(runs, ~first, False)
        add(runs, first & (several | sure), True)
    return pd.concat(out, ignore_index=True)


def _sides(asked: DataFrame) -> DataFrame:
    """The bytes of each phrase, once with the strings that reach far to the left of the trigger and once with the others."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, text, asks in zip(longs(frame, "doc_id"), frame["text"], frame["asks"], strict=True):
                data = text.encode("utf-8", "replace")
                for ask in asks:
                    start, left, span, trigger = ask["start"], ask["left"], ask["span"], ask["trigger"]
                    at = start + left
                    # Strings that begin _SIDE bytes or more before the trigger, and those that end as far behind it.
                    far = min(span, left - _SIDE)
                    if far >= 0:
                        near = hashlib.blake2b(data[at - _SIDE:at], digest_size=8, person=b"left").digest()
                        rows.append((trigger, near, doc, start, data[start:start + far + LENGTH]))
                    if span > far:
                        begin = start + max(0, far + 1)
                        near = hashlib.blake2b(data[at + WIDTH:at + WIDTH + _SIDE], digest_size=8, person=b"right").digest()
                        rows.append((trigger, near, doc, begin, data[begin:start + span + LENGTH]))
            yield pd.DataFrame(rows, columns=["trigger", "near", "doc_id", "start", "bytes"])

    return map_texts(asked, cut, "trigger long, near binary, doc_id long, start long, bytes binary")


def equal_strings(data: list[bytes], doc: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
    """(doc, start, end) of the runs of strings of LENGTH bytes that are also at an earlier place.

    The suffix array of the byte strings, sorted to LENGTH bytes and then by place.
    """
    sizes = np.array([len(b) for b in data])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(data)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    docs, places = doc[owner], start[owner] + inside
    order = _places(docs, places)
    buffer = np.frombuffer(b"".join(data), np.uint8)
    suffixes = np.lib.stride_tricks.sliding_window_view(buffer, LENGTH)[(begins[owner] + inside)[order]]
    suffixes = np.ascontiguousarray(suffixes).view(f"S{LENGTH}").ravel()
    array = np.argsort(suffixes, kind="stable")
    new = _new(suffixes[array])
    place = order[array]
    head = place[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = (docs[place] != docs[head]) | (places[place] != places[head])
    hits = np.sort(place[later])
    if not len(hits):
        return []
    cut = np.ones(len(hits), bool)
    cut[1:] = (np.diff(hits) != 1) | (owner[hits[1:]] != owner[hits[:-1]])
    begin = np.flatnonzero(cut)
    end = np.append(begin[1:], len(hits)) - 1
    return [(int(docs[hits[b]]), int(places[hits[b]]), int(places[hits[e]]) + LENGTH) for b, e in zip(begin, end, strict=True)]


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    group = group.drop_duplicates(["trigger", "near", "doc_id", "start"]).sort_values(["trigger", "near"], ignore_index=True)
    keys = (group["trigger"].to_numpy(np.int64), group["near"].to_numpy())
    number = np.cumsum(_new(*keys)) - 1 if len(group) else np.empty(0, np.int64)
    # A phrase without another of its kind has nothing to be compared with.
    many = np.bincount(number)[number] > 1 if len(group) else np.empty(0, bool)
    group, number = group[many], number[many]
    rows: list[tuple[int, int, int]] = []
    if len(group):
        strings = group["bytes"].str.len().to_numpy() - LENGTH + 1
        # Whole kinds together, about SORTED strings at a time.
        total = pd.Series(strings).groupby(number).transform("sum").to_numpy()
        head = _new(number)
        block = np.cumsum(np.where(head, total, 0)) // SORTED
        for _, part in group.groupby(block):
            rows += equal_strings(part["bytes"].tolist(), part["doc_id"].to_numpy(np.int64), part["start"].to_numpy(np.int64))
    return pd.DataFrame(rows, columns=["doc_id", "start", "end"], dtype="int64")


def numbered(docs: DataFrame) -> DataFrame:
    """doc_id, text, and ``key``: doc_id itself where it is there and unique, else a number in the order of doc_id and text hash.

    Rows with equal doc_id and text have the same key and are one document.
    """
    rows = texts(docs)
    odd = rows.groupBy("doc_id").count().where(F.col("doc_id").isNull() | (F.col("count") > 1))
    if not odd.limit(1).count():
        return rows.withColumn("key", F.col("doc_id"))
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    pairs = hashed.select("doc_id", "text_hash").distinct().orderBy("doc_id", "text_hash")
    keys = row_positions(pairs, "key").withColumnsRenamed({"doc_id": "key_id", "text_hash": "key_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("text_hash") == F.col("key_hash"))
    return hashed.join(keys, same).select("doc_id", "text", "key")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """key, start, end of byte ranges that are repeats; they may overlap. Rows have ``key`` and ``text``."""
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = int(chars // GROUP_CHARS) + 8
    plain = rows.select(F.col("key").alias("doc_id"), "text").dropDuplicates(["doc_id"]) if _repeats_keys(rows) else rows.select(F.col("key").alias("doc_id"), "text")
    packed = map_texts(plain, _parse(groups), _PACKED)
    found = stage(map_groups(packed, "bucket", _dictionary, _FOUND), "repeats-found")
    whole = found.where("trigger is null").select("doc_id", "start", (F.col("start") + F.col("span") + LENGTH).alias("end"))
    asks = found.where("trigger is not null").groupBy("doc_id").agg(F.collect_list(F.struct("start", "left", "span", "trigger")).alias("asks"))
    sides = _sides(plain.join(asks, "doc_id"))
    parts = map_groups(sides, F.pmod(F.xxhash64("trigger", "near"), F.lit(groups)).alias("bucket"), _compare, "doc_id long, start long, end long")
    return whole.union(stage(parts, "repeats-parts")).withColumnRenamed("doc_id", "key")


def _repeats_keys(rows: DataFrame) -> bool:
    return bool(rows.groupBy("key").count().where("count > 1").limit(1).count())


def strip_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the bytes that are kept, of every row of ``docs``.

    Null texts are empty. Null doc_ids come first in the order; rows that repeat a
    doc_id come in the order of a hash of their text, and equal rows are one document,
    reported for each row. Texts under LENGTH bytes lose nothing. No rows give no rows.
    """
    rows = numbered(docs)
    spans = repeated_spans(rows).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def strip(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, text, spans in zip(longs(frame, "doc_id"), frame["text"], frame["spans"], strict=True):
                data = text.encode("utf-8", "replace")
                kept, at, runs, reach = [], 0, 0, -1
                for start, end in sorted((s["start"], s["end"]) for s in (spans if spans is not None else ())):
                    if start > reach:
                        runs += 1
                        kept.append(data[at:start])
                    at = reach = max(reach, end)
                kept.append(data[at:])
                whole = b"".join(kept)
                out.append((key, len(data), len(data) - len(whole), runs, whole))
            yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(spans, "key", "left").select("doc_id", "text", "spans")
    return map_texts(joined, strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = strip_repeats(table(spark, sf_dir, "documents"))
    return stripped.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
