"""Packing of token ids into sequences: first-fit decreasing in randomised groups of documents."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import longs, map_groups, map_texts, table, texts
from tallyroll.llm.tokens import public_path, word_encoder

SEQUENCE = 2048
END_ID = 1
#: Documents in a group on average; a group is packed by one task.
GROUP_DOCS = 8192

_PIECE = "doc_id long, draw long, start long, length long, ids_crc32 long, doc_tokens long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each length (descending) its bin, the first one with room, and its offset there.

    A tournament tree over the bins holds the largest room below each node, so the
    first bin that fits is found from the root in as many steps as the tree is deep.
    """
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i, length in enumerate(lengths.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= length
        while node > 1:
            node //= 2
            left, right = room[2 * node], room[2 * node + 1]
            most = left if left > right else right
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets


def pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Each document's ids, with the end id, cut every ``sequence`` ids.

    ``draw`` is a hash of the row and its place, by which documents are dealt to groups, so
    equal rows are spread like any others. A null text
    is empty and gives the end id alone; a null doc_id is kept; repeated rows are
    documents of their own.
    """
    schema = _PIECE + (", ids array<int>" if with_ids else "")

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_encoder(path)
        for part in frames:
            ids, at = encoder.encode(part["text"].tolist())
            keys, draws = longs(part, "doc_id"), part["draw"].tolist()
            rows = []
            for i, key in enumerate(keys):
                own = np.append(ids[at[i]:at[i + 1]], np.uint32(end_id)).astype("<u4")
                for start in range(0, len(own), sequence):
                    piece = own[start:start + sequence]
                    row = (key, draws[i], start, len(piece), zlib.crc32(piece.tobytes()), len(own))
                    rows.append((*row, piece.astype(np.int32)) if with_ids else row)
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])

    drawn = texts(docs).withColumn("draw", F.xxhash64("doc_id", "text", F.monotonically_increasing_id()))
    return map_texts(drawn, cut, schema)


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, end_id: int = END_ID, group_docs: int = GROUP_DOCS, with_ids: bool = False) -> DataFrame:
    """The pieces with the sequence each one is in and its offset there.

    Documents are dealt by a hash of the row and its place to as many groups as there are
    ``group_docs`` documents; each group is packed alone by first-fit decreasing, so
    no task sees more than a group. Full pieces are a sequence of their own. A
    sequence is padded to its full length unless it is a power of two long.

    Ties go by doc_id, then start. No rows in, no rows out. ``with_ids`` carries the
    ids along, so that sequences can be written. Other columns of ``docs`` are not kept.
    """
    groups = max(1, -(-docs.count() // group_docs))
    cut = pieces(docs, path, sequence, end_id, with_ids)
    cut = cut.withColumn("pack_group", F.pmod("draw", F.lit(groups)))

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "draw", "start"], ascending=[False, True, True, True], ignore_index=True)
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(), sequence)
        frame["sequence_id"] = frame["pack_group"] * 2**32 + bins
        frame["offset"] = offsets
        return frame

    fields = cut.schema.simpleString()[len("struct<"):-1]
    packed = map_groups(cut, "pack_group", fill, f"{fields},sequence_id:bigint,offset:bigint")
    return packed.drop("draw", "pack_group")


def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))
