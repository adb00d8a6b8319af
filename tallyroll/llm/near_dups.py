"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles, banded and verified.

1. Document frequencies of shingle buckets over all documents give each shingle a weight.
2. Improved consistent weighted sampling draws SAMPLES shingles of each text; two texts
   agree on a draw as often as their weighted Jaccard similarity says. Texts with equal
   shingles are one node from here on.
3. Draws are banded; nodes that share a band are candidates. Each node of a bucket is first
   compared with one of them only, the one that shares most bands with others.
4. A pair is a link if the weighted Jaccard similarity of the whole texts is 0.8 or more.
   A class is what links connect.
5. Buckets that still hold more than one class are cut into chunks of bounded size, and
   each two chunks are compared at once as matrices. No pair becomes a row: two chunks
   return no more links than it takes to connect what they hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import free_name, longs, map_texts, to_python, table, texts
from tallyroll.llm.hashing import mixed, shingles, word_hashes
from tallyroll.runtime import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 9, 3
SAMPLES = BANDS * ROWS
#: Shingles share a document frequency by this many bits of their hash, so the table of frequencies has a fixed size.
BUCKET_BITS = 18
#: Weight of a shingle that all documents have, against one of the rarest. Kept near 1, as the copies in
#: a large group make what they share frequent and would otherwise drift apart by the size of their group.
LEAST_WEIGHT = 0.85
#: Nodes in a chunk of a bucket, on average; two chunks are compared by one task at a time.
CHUNK = 1024
#: Shingles that more nodes of two chunks have than this are compared as a matrix, others pair by pair.
DENSE = 16

_DRAWS = 1 << 14


def frequencies(docs: DataFrame) -> DataFrame:
    """bucket, n: in how many documents some shingle of the bucket stands. At most 2 ** BUCKET_BITS rows."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << BUCKET_BITS, np.int64)
        for frame in frames:
            grams, text = shingles(*word_hashes(frame["text"].tolist()), SHINGLE)
            once = np.unique((text.astype(np.uint64) << np.uint64(BUCKET_BITS)) | (grams >> np.uint64(64 - BUCKET_BITS)))
            total += np.bincount((once & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    return map_texts(docs, count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_weights(docs: DataFrame) -> np.ndarray:
    """The weight of each bucket, by inverse document frequency over all documents."""
    total = max(1, docs.count())
    counted = frequencies(docs).toPandas()  # of fixed size
    idf = np.full(1 << BUCKET_BITS, np.log1p(total), np.float64)
    idf[counted["bucket"].to_numpy(np.int64)] = np.log1p(total / counted["n"].to_numpy(np.float64))
    return (LEAST_WEIGHT + (1 - LEAST_WEIGHT) * idf / idf.max()).astype(np.float32)


def vectors(words: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text in ascending order, their weights (count by bucket weight), and where texts begin."""
    grams, text = shingles(*words, SHINGLE)
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(at, append=len(grams))
    grams = grams[at]
    weight = counts * weights[(grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.float64)
    return grams, weight, np.searchsorted(text[at], np.arange(len(words[1])))


def _draw_tables() -> tuple[np.ndarray, ...]:
    """Random values of each draw, by _DRAWS classes of shingle hashes: gamma(2, 1) twice and uniform."""
    random = np.random.Generator(np.random.PCG64(20240229))
    shape = (SAMPLES, _DRAWS)
    r, c, beta = random.gamma(2, 1, shape), random.gamma(2, 1, shape), random.random(shape)
    return (1 / r).astype(np.float32), r.astype(np.float32), beta.astype(np.float32), (np.log(c) - r).astype(np.float32)


_tables: list[tuple[np.ndarray, ...]] = []


def samples(grams: np.ndarray, weight: np.ndarray, at: np.ndarray) -> np.ndarray:
    """SAMPLES draws of each text that has shingles, as hashes; one row per draw.

    Where two shingles of a text have the same least value, the smaller hash is drawn.
    """
    if not _tables:
        _tables.append(_draw_tables())
    sizes = np.diff(at)
    some = sizes > 0
    starts, sizes = at[:-1][some], sizes[some]
    out = np.empty((SAMPLES, len(starts)), np.uint64)
    logs = np.log(weight).astype(np.float32)
    text = np.repeat(np.arange(len(starts)), sizes)
    shift = np.uint64(64 - (_DRAWS - 1).bit_length())
    for k, (inverse, r, beta, c) in enumerate(zip(*_tables[0], strict=True)):
        kind = ((grams * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0xD1B54A32D192ED03 & 2**64 - 1)) >> shift).astype(np.int64)
        shift_by = beta[kind]
        t = np.floor(logs * inverse[kind] + shift_by)
        value = c[kind] - r[kind] * (t - shift_by)
        least = np.flatnonzero(value == np.minimum.reduceat(value, starts)[text])
        first = least[np.searchsorted(text[least], np.arange(len(starts)))]
        out[k] = mixed(grams[first] + t[first].astype(np.int64).view(np.uint64) * np.uint64(0xA24BAED4963EE407), 50 + k)
    return out


def _nodes(grams: np.ndarray, weight: np.ndarray, at: np.ndarray) -> list[bytes]:
    """16 bytes that name the shingles of each text and their counts."""
    # Sums over no rows are zero, so texts without words are one node.
    lanes = []
    for seed in (2, 3):
        own = mixed(mixed(grams, seed) + np.round(weight * 1e4).astype(np.uint64), seed)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own, dtype=np.uint64)])
        lanes.append(sums[at[1:]] - sums[at[:-1]])
    return [x.tobytes() for x in np.stack(lanes, axis=1)]


def sketch(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, text_hash, node, weight and bands of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            grams, weight, at = vectors(word_hashes(frame["text"].tolist()), shared.value)
            drawn = samples(grams, weight, at)
            keys = np.zeros((BANDS, drawn.shape[1]), np.uint64)
            for k in range(SAMPLES):
                keys[k // ROWS] = mixed(keys[k // ROWS] + drawn[k], k)
            bands = iter(keys.T.view(np.int64).copy())
            sums = np.concatenate([[0.0], np.cumsum(weight)])
            yield pd.DataFrame({
                "doc_id": longs(frame, "doc_id"), "text_hash": frame["text_hash"].to_numpy(),
                "node": _nodes(grams, weight, at), "weight": sums[at[1:]] - sums[at[:-1]],
                "bands": [next(bands) if size else [] for size in np.diff(at)],
            })

    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    return map_texts(hashed, draw, "doc_id long, text_hash long, node binary, weight double, bands array<long>")


def node_vectors(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """node and shingles (with repeats, ascending, 8 bytes each) of the nodes in ``needed``, each from one of its texts."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words, at = word_hashes(frame["text"].tolist())
            grams, text = shingles(words, at, SHINGLE)
            grams = grams[np.lexsort((grams, text))]
            ends = np.searchsorted(text, np.arange(len(frame) + 1))
            yield pd.DataFrame({"node": frame["node"], "shingles": [grams[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:], strict=True)]})

    same = F.col("doc_id").eqNullSafe(F.col("row_id")) & (F.col("text_hash") == F.col("row_hash"))
    read = docs.withColumn("text_hash", F.xxhash64("text")).join(needed, same).select("node", "text").dropDuplicates(["node"])
    return map_texts(read, cut, "node binary, shingles binary")


def _weighted(shingle_bytes: bytes, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items, one for each time that a shingle stands in the text, in ascending order, and their weights."""
    grams = np.frombuffer(shingle_bytes, np.uint64)
    weight = weights[(grams >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.float64)
    first = np.searchsorted(grams, grams)
    items = mixed(grams + (np.arange(len(grams)) - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 7)
    order = np.argsort(items)
    return items[order], weight[order]


def _similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; two texts without words are equal."""
    (ga, wa), (gb, wb) = a, b
    if not len(ga) or not len(gb):
        return float(len(ga) == len(gb))
    place = np.searchsorted(gb, ga)
    place[place == len(gb)] = 0
    common = wa[gb[place] == ga].sum()
    return float(common / (wa.sum() + wb.sum() - common))


def _similarities(pairs: DataFrame, weights: np.ndarray) -> DataFrame:
    """a, b and similarity of pairs with their shingles."""
    shared = pairs.sparkSession.sparkContext.broadcast(weights)
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, tuple] = (b"", ())
        for batch in batches:
            out = []
            for a, b, own, other in zip(*(batch.column(x).to_pylist() for x in ("a", "b", "a_shingles", "b_shingles")), strict=True):
                if last[0] != b:  # rows come in the order of b
                    last = b, _weighted(other, shared.value)
                out.append(_similarity(_weighted(own, shared.value), last[1]))
            yield pa.RecordBatch.from_arrays([batch.column("a").cast(pa.binary()), batch.column("b").cast(pa.binary()), pa.array(out, pa.float64())], schema=schema)

    return to_python(pairs).mapInArrow(compare, "a binary, b binary, similarity double")


def common_weights(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """How much each two rows of items and weights have in common, to about six digits."""
    n = len(rows)
    out = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(g) for g, _ in rows])
    items, weight = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
    order = np.lexsort((owner, items))
    items, weight, owner = items[order], weight[order], owner[order]
    new = np.flatnonzero(np.diff(items, prepend=items[:1] ^ np.uint64(1)))
    counts = np.diff(new, append=len(items))
    spread = np.repeat(counts, counts)
    rare = (spread > 1) & (spread <= DENSE)
    items_r, weight_r, owner_r = items[rare], weight[rare], owner[rare]
    for step in range(1, DENSE):
        same = np.flatnonzero(items_r[step:] == items_r[:-step])
        if not len(same):
            break
        np.add.at(out, (owner_r[same], owner_r[same + step]), weight_r[same])
    out += out.T
    column = np.repeat(np.cumsum(counts > DENSE) - 1, counts)
    often = spread > DENSE
    column, weight, owner = column[often], np.sqrt(weight[often]), owner[often]
    for start in range(0, int(column.max(initial=-1)) + 1, 2048):
        here = (column >= start) & (column < start + 2048)
        block = np.zeros((n, 2048), np.float32)
        block[owner[here], column[here] - start] = weight[here]
        out += block @ block.T
    return out


def chunk_links(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, side: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links across classes that connect all that links of these rows can connect.

    Rows of one side are not compared with each other if there are two sides. As in
    building a spanning tree, each class takes its closest row of another class, is
    merged with its class if they are a link, and so on until none is left.
    """
    total = np.array([w.sum() for _, w in rows])
    common = common_weights(rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        near = common / (total[:, None] + total - common)
    near[~(near >= similarity - 1e-4)] = -1  # rounding; links are compared exactly
    none = total == 0
    near[np.ix_(none, none)] = 1
    if (side != side[0]).any():
        near[side[:, None] == side] = -1
    label, out = np.unique(labels, return_inverse=True)[1].ravel(), []
    while True:
        near[label[:, None] == label] = -1
        best = near.argmax(axis=1)
        value = near[np.arange(len(rows)), best]
        if value.max(initial=-1) < 0:
            return out
        for i in np.argsort(-value, kind="stable"):
            j = best[i]
            if value[i] < 0:
                break
            if label[i] == label[j]:
                continue
            if _similarity(rows[i], rows[j]) >= similarity:
                out.append((int(i), int(j)))
                label[label == label[j]] = label[i]
            else:
                near[i, j] = near[j, i] = -1


def _open_links(members: DataFrame, labels: DataFrame | None, vectors: DataFrame, weights: np.ndarray, similarity: float) -> DataFrame:
    """Links within buckets of more than one class and of three nodes or more (two are compared already)."""
    shared = vectors.sparkSession.sparkContext.broadcast(weights)
    here = members.select("bucket", "node")
    here = here.withColumn("label", F.col("node")) if labels is None else here.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    parted = here.groupBy("bucket").agg(F.count(F.lit(1)).alias("own"), F.min("label").alias("least"), F.max("label").alias("most"))
    parted = parted.where("own > 2 AND least <> most").select("bucket", F.ceil(F.col("own") / CHUNK).alias("chunks"))
    open_ = here.join(parted, "bucket").withColumn("chunk", F.pmod(F.xxhash64("node", "bucket"), F.col("chunks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    tiles = open_.withColumn("other", other).select("bucket", "node", "label", "chunk", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"))
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        nodes, side = group.column("node").to_pylist(), group.column("chunk").to_numpy()
        rows = [_weighted(x, shared.value) for x in group.column("shingles").to_pylist()]
        found = chunk_links(rows, np.array(group.column("label").to_pylist(), object), side, similarity)
        return pa.table({"a": [nodes[i] for i, _ in found], "b": [nodes[j] for _, j in found]}, schema=schema)

    full = to_python(tiles.join(vectors, "node"))
    return full.groupBy("bucket", "low", "high").applyInArrow(compare, "a binary, b binary").distinct()


def connected(links: DataFrame) -> DataFrame:
    """node, label: nodes that links (a, b) connect have the same label, the smallest node among them."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stage(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label")), "near-labels")
    while True:
        known = labels.select(F.col("node").alias("b"), "label")
        near = both.join(known, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        next_labels = labels.join(near, "node", "left").select("node", "label", F.least("label", "near").alias("least"))
        # The label of the label is nearer to the end.
        jump = labels.select(F.col("node").alias("least"), F.col("label").alias("further"))
        moved = next_labels.join(jump, "least", "left").select("node", F.least("least", "further").alias("label"), F.col("label").alias("old"))
        labels = stage(moved, "near-labels")
        if not labels.where("label <> old").limit(1).count():
            return labels.drop("old")


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after further links: classes, not nodes, are connected."""
    if labels is None:
        return connected(links)
    ends = links
    for x in ("a", "b"):
        known = labels.select(F.col("node").alias(x), F.col("label").alias("known"))
        ends = ends.join(known, x, "left").withColumn(f"label_{x}", F.coalesce("known", x)).drop("known")
    new = connected(ends.select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).where("a <> b").distinct())
    moved = labels.join(new.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return stage(moved.union(new.join(labels.select("node"), "node", "left_anti").select("node", "label")), "near-labels")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, class_id and copies of every row of ``docs``.

    class_id is the smallest doc_id of the rows that are connected by links of
    ``similarity`` or more; null where none of them has a doc_id. Null texts are empty;
    texts without words are copies of each other; texts with fewer than five words have
    one shingle of all of them. Repeated rows stay, in one class. Other columns are not read.
    """
    rows = texts(docs)
    weights = bucket_weights(rows)
    drawn = stage(sketch(rows, weights), "near-sketches")
    nodes = drawn.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("row"), F.first("weight").alias("weight"), F.first("bands").alias("bands"))
    band = nodes.select("node", "weight", F.explode("bands").alias("bucket"))
    crowds = band.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("crowd"), F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("two"))
    # Of buckets with the same nodes, which near copies share over many bands, one is enough.
    crowds = crowds.where("crowd > 1").groupBy("crowd", "one", "two").agg(F.min("bucket").alias("bucket"))
    members = stage(band.join(crowds.select("bucket", "crowd"), "bucket"), "near-members")
    fame = members.groupBy("node").agg(F.sum("crowd").alias("fame"))
    members = stage(members.join(fame, "node").drop("crowd"), "near-members")
    needed = nodes.join(fame, "node", "left_semi").select("node", F.col("row.doc_id").alias("row_id"), F.col("row.text_hash").alias("row_hash"))
    vectors = stage(node_vectors(rows, needed), "near-vectors")

    leader = members.groupBy("bucket").agg(F.max(F.struct("fame", "node", "weight")).alias("leader"))
    # Sums of weights bound the similarity from above.
    near = F.least("weight", "leader.weight") >= similarity * F.greatest("weight", "leader.weight") - 1e-6
    pairs = members.join(leader, "bucket").where((F.col("node") != F.col("leader.node")) & near)
    pairs = stage(pairs.select(F.col("node").alias("a"), F.col("leader.node").alias("b")).distinct(), "near-pairs")
    full = pairs.join(vectors.withColumnsRenamed({"node": "a", "shingles": "a_shingles"}), "a")
    full = full.join(vectors.withColumnsRenamed({"node": "b", "shingles": "b_shingles"}), "b")
    links = stage(_similarities(full, weights), "near-similarities").where(F.col("similarity") >= similarity).select("a", "b")
    labels = _joined(None, links) if links.limit(1).count() else None
    further = stage(_open_links(members, labels, vectors, weights, similarity), "near-links")
    if further.limit(1).count():
        labels = _joined(labels, further)
    named = drawn.join(labels, "node", "left") if labels is not None else drawn.withColumn("label", F.col("node"))
    named = named.withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_rows"))
    return named.join(least, "label").select("doc_id", "text_hash", "class_id", "class_rows", "label")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class, that of the smallest doc_id; of equal rows, any one."""
    found = classes(docs, similarity)
    row = F.struct("doc_id", "text_hash")
    equal = found.groupBy("label", "doc_id", "text_hash").agg(F.count("*").alias("times"))
    first = equal.groupBy("label").agg(F.min(row).alias("row"), F.min_by("times", row).alias("times"))
    names = [free_name(docs, x) for x in ("kept_id", "kept_hash", "kept_times", "text_hash")]
    kept = stage(first.select(F.col("row.doc_id").alias(names[0]), F.col("row.text_hash").alias(names[1]), F.col("times").alias(names[2])), "near-kept")
    hashed = docs.withColumn(names[3], F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col(names[0])) & (F.col(names[3]) == F.col(names[1]))
    left = hashed.join(kept, same, "left_semi")
    if kept.where(F.col(names[2]) > 1).limit(1).count():
        left = left.dropDuplicates(["doc_id", names[3]])
    return left.drop(names[3])


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_rows")
