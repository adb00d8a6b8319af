"""Token ids of documents in shard files, with a minimal perfect hash index over the document keys.

A folder has two parts. ``raw`` holds one file of raw bytes for each shard, in the
ascending doc_id order of its documents; ``directory`` is a Parquet table of one row a
shard: where it lies, how many ids come before it, and its first and last doc_id.

A shard file is, in little-endian bytes: a header of fixed size; the bits of a minimal
perfect hash in blocks of 512, each after the count of set bits before it; 16 bytes a
slot (a 32-bit fingerprint of the key, the number of ids, and where they begin); the ids
one after the other, 16 bits each if the vocabulary allows, else 32; and last, for those
who list whole shards, the doc_ids. To look up a key is to read the header, one block a
level of the hash, one slot and the ids: the bytes read do not depend on the shard's size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tallyroll.llm.common import longs, map_texts, to_python, table, texts
from tallyroll.llm.hashing import mixed
from tallyroll.llm.tokens import public_path, word_encoder
from tallyroll.runtime import new_path

END_ID = 2
#: A shard ends with the document that reaches this many ids.
SHARD_IDS = 1 << 21

_MAGIC, _LEVELS, _BLOCK = 0x31444C4B4F54, 64, 512
# magic, documents, ids, bytes an id, blocks, levels, ids before it of the same task, then the bits of each level.
_HEADER = np.dtype([("numbers", "<u8", 7), ("levels", "<u8", _LEVELS)])
_RANKED = np.dtype([("before", "<u8"), ("bits", "u1", _BLOCK // 8)])
_SLOT = np.dtype([("print", "<u4"), ("length", "<u4"), ("start", "<u8")])
_KEY = np.dtype([("doc_id", "<i8"), ("copy", "<u4"), ("known", "u1")])

_SHARD = "part int, shard int, bytes binary"
_NULL_KEY = np.uint64(0x9AE16A3B2F90404F)


def document_keys(doc_ids: list[int | None], copies: list[int]) -> np.ndarray:
    """One number for each (doc_id, copy); a null doc_id has a number of its own."""
    plain = np.array([0 if x is None else x for x in doc_ids], np.int64).view(np.uint64)
    known = np.array([x is not None for x in doc_ids], bool)
    return mixed(np.where(known, mixed(plain, 1), _NULL_KEY), 2) + mixed(np.array(copies, np.uint64), 3)


class PerfectHash:
    """Sends n different keys to 0 .. n-1.

    Every level has twice as many bits as keys are left. A key that is alone at its
    bit stays there; the others go on to the next level. A key's number is the count
    of set bits before its own.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.ranks = np.concatenate([[0], np.cumsum(bits)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], keys
        while len(left):
            if len(sizes) == _LEVELS:
                raise ValueError("the keys are not all different")
            size = max(8, 2 * len(left))
            at = mixed(left, 16 + len(sizes)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at.astype(np.int64)]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some keys that were not built in."""
        found = np.full(len(keys), -1, np.int64)
        base = 0
        for level, size in enumerate(self.sizes):
            at = (mixed(keys, 16 + level) % np.uint64(size)).astype(np.int64) + base
            here = (found < 0) & self.bits[at]
            found[here] = self.ranks[at[here]]
            base += size
        return found


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return mixed(keys, 4).astype(np.uint32)


class ShardFile:
    """The reading side of one file; ``read(position, length)`` gives its bytes."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        head = np.frombuffer(read(0, _HEADER.itemsize), _HEADER)[0]
        magic, self.documents, self.n_ids, self.width, self.blocks, levels, self.before = (int(x) for x in head["numbers"])
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        self.levels = [int(x) for x in head["levels"][:levels]]
        self.slots_at = _HEADER.itemsize + self.blocks * _RANKED.itemsize
        self.ids_at = self.slots_at + self.documents * _SLOT.itemsize
        self.keys_at = self.ids_at + self.n_ids * self.width

    def find(self, key: np.uint64) -> np.void | None:
        """The slot of one key, or None where the shard does not hold it."""
        one, base = np.array([key], np.uint64), 0
        for level, size in enumerate(self.levels):
            block, bit = divmod(base + int(mixed(one, 16 + level)[0] % np.uint64(size)), _BLOCK)
            ranked = np.frombuffer(self.read(_HEADER.itemsize + block * _RANKED.itemsize, _RANKED.itemsize), _RANKED)[0]
            bits = np.unpackbits(ranked["bits"])
            if bits[bit]:
                number = int(ranked["before"]) + int(bits[:bit].sum())
                slot = np.frombuffer(self.read(self.slots_at + number * _SLOT.itemsize, _SLOT.itemsize), _SLOT)[0]
                return slot if slot["print"] == fingerprints(one)[0] else None
            base += size
        return None

    def ids(self, slot: np.void) -> np.ndarray:
        at, size = self.ids_at + int(slot["start"]) * self.width, int(slot["length"]) * self.width
        return np.frombuffer(self.read(at, size), f"<u{self.width}")

    def keys(self) -> tuple[list[int | None], np.ndarray]:
        """doc_id and copy of every document, in order."""
        keys = np.frombuffer(self.read(self.keys_at, self.documents * _KEY.itemsize), _KEY)
        known = keys["known"].astype(bool)
        return [x if k else None for x, k in zip(keys["doc_id"].tolist(), known.tolist(), strict=True)], keys["copy"]

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slots of many keys, all of which must be held, from one read of the whole index."""
        ranked = np.frombuffer(self.read(_HEADER.itemsize, self.blocks * _RANKED.itemsize), _RANKED)
        bits = np.unpackbits(ranked["bits"].reshape(-1))[:sum(self.levels)].astype(bool)
        numbers = PerfectHash(self.levels, bits).slots(keys)
        slots = np.frombuffer(self.read(self.slots_at, self.documents * _SLOT.itemsize), _SLOT)[numbers]
        if (numbers < 0).any() or (slots["print"] != fingerprints(keys)).any():
            raise ValueError("a document is missing from its shard's index")
        return slots


def _shard_bytes(before: int, width: int, doc_ids: list[int | None], copies: list[int], ids: list[np.ndarray]) -> bytes:
    lengths = np.array([len(x) for x in ids], np.int64)
    keys = document_keys(doc_ids, copies)
    index = PerfectHash.build(keys)
    head = np.zeros((), _HEADER)
    ranked = np.zeros(-(-len(index.bits) // _BLOCK), _RANKED)
    head["numbers"] = (_MAGIC, len(keys), lengths.sum(), width, len(ranked), len(index.sizes), before)
    head["levels"][:len(index.sizes)] = index.sizes
    bits = np.zeros(len(ranked) * _BLOCK, bool)
    bits[:len(index.bits)] = index.bits
    ranked["bits"] = np.packbits(bits).reshape(-1, _BLOCK // 8)
    ranked["before"] = index.ranks[np.arange(len(ranked)) * _BLOCK]
    slots, own = np.zeros(len(keys), _SLOT), index.slots(keys)
    slots["print"][own], slots["length"][own], slots["start"][own] = fingerprints(keys), lengths, np.cumsum(lengths) - lengths
    listed = np.zeros(len(keys), _KEY)
    listed["doc_id"], listed["copy"] = [0 if x is None else x for x in doc_ids], copies
    listed["known"] = [x is not None for x in doc_ids]
    payload = np.concatenate(ids).astype(f"<u{width}")
    return b"".join(x.tobytes() for x in (head, ranked, slots, payload, listed))


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encode every whole text and write the shards below ``folder``.

    A null text is empty and has the end id alone. Null doc_ids come first. Rows that
    repeat a doc_id are all written, in the order of a hash of their text, which may
    spread them over tasks; those of one task are numbered by ``copy`` from 0. No rows
    give an empty folder that can be read.

    Spark's text sink writes the raw files (a string keeps the bytes it was cast from), so a
    task that runs again leaves no second file. A line feed ends each file.
    """

    def shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, part = word_encoder(path), TaskContext.get().partitionId()
        width = 2 if max(encoder.vocabulary, end_id + 1) <= 1 << 16 else 4
        names = [x.split()[0] for x in _SHARD.split(", ")]
        doc_ids, copies, ids, size, before, number = [], [], [], 0, 0, 0
        last, copy = object(), 0
        for block in frames:
            found, at = encoder.encode(block["text"].tolist())
            for i, key in enumerate(longs(block, "doc_id")):
                copy = copy + 1 if key == last else 0
                last = key
                doc_ids.append(key)
                copies.append(copy)
                ids.append(np.append(found[at[i]:at[i + 1]], np.uint32(end_id)))
                size += len(ids[-1])
                if size >= shard_ids:
                    yield pd.DataFrame([(part, number, _shard_bytes(before, width, doc_ids, copies, ids))], columns=names)
                    before, number = before + size, number + 1
                    doc_ids, copies, ids, size = [], [], [], 0
        if ids:
            yield pd.DataFrame([(part, number, _shard_bytes(before, width, doc_ids, copies, ids))], columns=names)

    spark, spread = docs.sparkSession, ["doc_id", F.xxhash64("text")]
    ordered = texts(docs).repartitionByRange(*spread).sortWithinPartitions(*spread)
    rows = map_texts(ordered, shards, _SHARD).select("part", "shard", F.col("bytes").cast("string").alias("value"))
    rows.write.partitionBy("part", "shard").text(f"{folder}/raw")

    def entries(shard: ShardFile) -> dict[str, list]:
        known = [x for x in shard.keys()[0] if x is not None]
        return {"before": [shard.before], "n_ids": [shard.n_ids], "first_id": known[:1] or [None], "last_id": known[-1:] or [None]}

    _from_shards(spark, folder, entries, "before long, n_ids long, first_id long, last_id long").write.parquet(f"{folder}/directory")


def _from_shards(spark: SparkSession, folder: str, function: Callable[[ShardFile], dict[str, list]], schema: str) -> DataFrame:
    """The rows that ``function`` gives for each shard file, after its part and shard."""
    schema = f"part int, shard int, {schema}"
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, number, content in zip(batch["part"].to_pylist(), batch["shard"].to_pylist(), batch["content"], strict=True):
                data = memoryview(content.as_buffer())
                columns = function(ShardFile(lambda at, size, data=data: data[at:at + size]))
                n = len(next(iter(columns.values())))
                yield pa.RecordBatch.from_pydict({"part": [part] * n, "shard": [number] * n, **columns}, schema=arrow)

    place = r"part=(\d+)/shard=(\d+)/[^/]*$"
    raw = spark.read.format("binaryFile").load(f"{folder}/raw").select(
        F.regexp_extract("path", place, 1).cast("int").alias("part"), F.regexp_extract("path", place, 2).cast("int").alias("shard"), "content"
    )
    return to_python(raw).mapInArrow(run, schema)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, copy, start (ids before it in the whole corpus), n_tokens and ids_crc32 of each document.

    Each is found through its shard's index and read from the raw ids.
    """
    directory = spark.read.parquet(f"{folder}/directory")
    parts = directory.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    # One row for each task that wrote.
    parts = parts.select("part", (F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")).alias("part_start"))
    starts = directory.join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("before")).alias("shard_start"))

    def documents(shard: ShardFile) -> dict[str, list]:
        doc_ids, copies = shard.keys()
        slots = shard.slots(document_keys(doc_ids, copies))
        return {
            "doc_id": doc_ids, "copy": copies.astype(np.int32), "inside": slots["start"].astype(np.int64),
            "n_tokens": slots["length"].astype(np.int64),
            "ids_crc32": [zlib.crc32(shard.ids(slot).astype("<u4").tobytes()) for slot in slots],
        }

    read = _from_shards(spark, folder, documents, "doc_id long, copy int, inside long, n_tokens long, ids_crc32 long")
    start = (F.col("shard_start") + F.col("inside")).alias("start")
    return read.join(starts, ["part", "shard"]).select("doc_id", start, "n_tokens", "ids_crc32", "copy")


class RawFile:
    """Ranges of the one file in a folder, by Hadoop's own reader, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark._jvm
        path = self.jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.stream = system.open(next(x.getPath() for x in system.listStatus(path) if x.getPath().getName().startswith("part-")))
        self.bytes_read = 0

    def read(self, at: int, size: int) -> bytes:
        self.stream.seek(at)
        self.bytes_read += size
        return self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.stream, size)

    def close(self) -> None:
        self.stream.close()


def read_ids(spark: SparkSession, folder: str, doc_ids: list[int], counts: list[int] | None = None) -> dict[int, list[int]]:
    """The ids of a few documents (copy 0); unknown keys are left out.

    One job finds the shards whose range holds a key, in the directory; then a bounded
    number of bytes beside the ids is read for each key. ``counts`` takes the bytes read for each.
    """
    if not doc_ids:
        return {}
    held = reduce(Column.__or__, [(F.col("first_id") <= k) & (F.col("last_id") >= k) for k in doc_ids])
    shards = spark.read.parquet(f"{folder}/directory").where(held).orderBy("part", "shard")
    found = {}
    for row in shards.toLocalIterator():
        raw = RawFile(spark, f"{folder}/raw/part={row.part}/shard={row.shard}")
        for doc_id in doc_ids:
            if row.first_id <= doc_id <= row.last_id and doc_id not in found:
                raw.bytes_read = 0
                shard = ShardFile(raw.read)
                slot = shard.find(document_keys([doc_id], [0])[0])
                if slot is not None:
                    found[doc_id] = shard.ids(slot).tolist()
                if counts is not None:
                    counts.append(raw.bytes_read)
        raw.close()
    return found


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, public_path("word_bpe_49k.json"))
    return read_documents(spark, folder)
