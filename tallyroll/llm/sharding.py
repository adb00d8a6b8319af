"""Shards of near equal bytes, tokens and rows, by vector bin packing of groups of equal texts.

A group is a vector of three shares: of all bytes, all tokens and all rows. Greatest
first, it goes to the shard where its dot product with the residual capacity is highest.

The packing runs in cells of bounded size: a cell deals its groups to as many bins as
there are shards, the bins of many cells are groups of a cell one level up, and so on
until one cell is left, whose bins are the shards. Some light groups are kept back to the
end and fill what the shards still lack. A group with more than half a shard
of anything is cut into small parts by row first, so copies without end can be shared out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroll.llm.common import longs, map_groups, map_texts, table, texts
from tallyroll.llm.tokens import public_path, word_encoder
from tallyroll.runtime import stage

SHARDS = 16
#: Groups in a cell on average.
CELL = 8192
#: A group with more than 1 / WHOLE of a shard in bytes, tokens or rows is cut, so no more than 3 * WHOLE * shards are;
#: a part has no more than about 1 / PARTS of a shard.
WHOLE, PARTS = 2, 64
#: One light group of so many is held back to fill the shards at the end; light ones have no more than 1 / LIGHT of a shard.
FILL, FILL_ROUNDS, LIGHT = 8, 4, 512
#: Rows whose places in their shards are counted together.
SLOT_ROWS = 16384

_MEASURES = ("bytes", "tokens", "rows")
_FACTS = "rid long, doc_id long, bytes long, tokens long, text_crc32 long, text_hash binary"


def facts(docs: DataFrame, path: str) -> DataFrame:
    """rid, doc_id, bytes (of the text, and one), tokens (with an end), text_crc32 and a hash of the text, of every row; written.

    ``rid`` tells rows apart that are equal in everything.
    """

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_encoder(path)
        for frame in frames:
            own = frame["text"].tolist()
            _, at = encoder.encode(own)
            data = [t.encode("utf-8", "replace") for t in own]
            yield pd.DataFrame({
                "rid": frame["rid"].to_numpy(), "doc_id": longs(frame, "doc_id"), "bytes": [len(d) + 1 for d in data], "tokens": np.diff(at) + 1,
                "text_crc32": [zlib.crc32(d) for d in data], "text_hash": [hashlib.blake2b(d, digest_size=16).digest() for d in data],
            })

    return stage(map_texts(texts(docs).withColumn("rid", F.monotonically_increasing_id()), measure, _FACTS), "shard-facts")


def place(vectors: np.ndarray, shards: int, total: np.ndarray | None = None, residual: np.ndarray | None = None, rounds: int = 1) -> np.ndarray:
    """The shard of each vector: greatest first, where the dot product of its shares with the residual capacity is highest.

    Shares are of ``total``, the sum of the vectors if not given; capacity is an equal
    part of each share unless some ``residual`` is given. Equal products go to the first
    shard. With ``rounds``, every so-many-th vector goes in each round: what the small
    ones of a round do to the bytes, the large ones of the next mend.
    """
    total = vectors.sum(axis=0) if total is None else total
    shares = vectors / np.where(total > 0, total, 1)
    residual = np.full((shards, vectors.shape[1]), 1 / shards) if residual is None else residual.copy()
    out = np.empty(len(vectors), np.int32)
    order = np.argsort(-shares.sum(axis=1), kind="stable")
    for i in np.concatenate([order[k::rounds] for k in range(rounds)]):
        out[i] = best = int((residual @ shares[i]).argmax())
        residual[best] -= shares[i]
    return out


def _packed(items: DataFrame, shards: int, cells: int, order: list[str], *given: np.ndarray | int) -> DataFrame:
    """``items`` with their cell and the bin of each in it; ``given`` goes to :func:`place`."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, ignore_index=True)
        frame["bin"] = place(frame[list(_MEASURES)].to_numpy(np.float64), shards, *given)
        return frame

    dealt = items.withColumn("cell", F.pmod(F.xxhash64(*order), F.lit(cells)))
    fields = dealt.schema.simpleString()[len("struct<"):-1]
    return stage(map_groups(dealt, "cell", pack, f"{fields},bin:int"), "shard-cells")


def _pack_levels(items: DataFrame, shards: int, cell: int) -> DataFrame:
    """``items`` with their shard: cells to bins, bins to bins of cells one level up, and so on."""
    keys, count, levels, below = ["text_hash", "part"], items.count(), [], items
    while True:
        cells = max(1, -(-count // cell))
        below = _packed(below, shards, cells, keys)
        levels.append(below)
        if cells == 1:
            break
        sums = [F.sum(m).alias(m) for m in _MEASURES]
        below = below.groupBy(F.col("cell").alias("low_cell"), F.col("bin").alias("low_bin")).agg(*sums)
        keys, count = ["low_cell", "low_bin"], cells * shards
    # From the top down: where the bin that a bin or group is in has gone.
    placed = levels[-1].withColumnRenamed("bin", "shard").drop("cell")
    for level in levels[-2::-1]:
        above = placed.select(F.col("low_cell").alias("cell"), F.col("low_bin").alias("bin"), "shard")
        placed = level.join(above, ["cell", "bin"]).drop("cell", "bin")
    return placed


def assign(rows: DataFrame, shards: int = SHARDS, cell: int = CELL) -> DataFrame:
    """``rows`` (of :func:`facts`) with their shard.

    Some of the light groups are held back from the packing in levels; they go last, to
    fill what the shards still lack, an equal part of it in each of their cells.
    """
    sums = [F.sum(m).alias(m) for m in _MEASURES]
    single = rows.withColumn("rows", F.lit(1).cast("long"))
    groups = stage(single.groupBy("text_hash").agg(*sums), "shard-groups")
    total = groups.agg(*sums).first()
    if not total["rows"]:
        return rows.withColumn("shard", F.lit(0))
    share = F.greatest(*[F.col(m) / F.lit(float(total[m])) for m in _MEASURES])
    # One row cannot be cut. No more than 3 * WHOLE * shards groups are.
    parts = F.least(F.ceil(share * shards * PARTS), F.col("rows"))
    hot = stage(groups.where(share * shards * WHOLE > 1).withColumn("parts", parts).where("parts > 1").select("text_hash", "parts"), "shard-hot")
    cut = single.join(F.broadcast(hot), "text_hash", "left")
    cut = cut.withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("rid"), F.col("parts"))).cast("int"))
    whole = groups.join(F.broadcast(hot), "text_hash", "left_anti").withColumn("part", F.lit(0))
    halves = cut.where(F.col("parts").isNotNull()).groupBy("text_hash", "part").agg(*sums)
    items = whole.select("text_hash", "part", *_MEASURES).unionByName(halves.select("text_hash", "part", *_MEASURES))
    last = (share * shards * LIGHT <= 1) & (F.pmod(F.xxhash64("part", "text_hash"), F.lit(FILL)) == 0)
    items = stage(items.withColumn("last", last), "shard-items")

    placed = stage(_pack_levels(items.where("not last").drop("last"), shards, cell).select("text_hash", "part", *_MEASURES, "shard"), "shard-placed")
    fill = items.where("last").drop("last")
    if count := fill.count():
        cells = -(-count // cell)
        whole_share = np.array([total[m] for m in _MEASURES], np.float64)
        residual = np.full((shards, len(_MEASURES)), 1 / shards)
        for row in placed.groupBy("shard").agg(*sums).collect():  # one row a shard
            residual[row["shard"]] -= np.array([row[m] for m in _MEASURES]) / whole_share
        filled = _packed(fill, shards, cells, ["text_hash", "part"], whole_share, residual / cells, FILL_ROUNDS)
        placed = placed.unionByName(filled.withColumnRenamed("bin", "shard").drop("cell"))
    return cut.drop("rows", "parts").join(placed.select("text_hash", "part", "shard"), ["text_hash", "part"]).drop("part")


def with_slots(rows: DataFrame, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``rows`` (rid, shard) with a place in the shard, gapless from 0.

    Rows are dealt to blocks by hash, numbered within a block of a shard, and moved up by
    what the blocks before it hold, so no task sees a whole shard.
    """
    blocks = max(1, -(-rows.count() // slot_rows))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(blocks)))
    counts = dealt.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("own"))
    before = F.sum("own").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    moved = counts.select("shard", "block", F.coalesce(before, F.lit(0)).cast("long").alias("moved"))
    number = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "rid"))
    return dealt.withColumn("number", number).join(moved, ["shard", "block"]).withColumn("slot", F.col("moved") + F.col("number") - 1).drop("number", "moved", "block")


def shard(docs: DataFrame, path: str, shards: int = SHARDS, cell: int = CELL) -> DataFrame:
    """doc_id, bytes, tokens, text_crc32, shard and slot of every row.

    Bytes, tokens and rows of all shards are near equal. Equal texts are one group and
    stay together, but for groups with more than 1 / WHOLE of a shard, which are cut. A
    null text is empty; a null doc_id is kept; equal rows are rows of their own; no rows
    give no rows. Fewer groups than shards leave shards empty. Other columns are not read.
    """
    placed = stage(assign(facts(docs, path), shards, cell), "shard-rows")
    return with_slots(placed).select("doc_id", "bytes", "tokens", "text_crc32", "shard", "slot")


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards by the law ``bytes``."""
    placed = shard(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))
    return placed.select(
        "doc_id", F.col("bytes").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "tokens")
