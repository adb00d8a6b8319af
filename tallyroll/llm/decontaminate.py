"""Test items inside documents: MinHash containment search, then exact containment.

Words are runs of letters and digits in lower case, shingles are five words in a row.
Items are put into classes by size. The sketch of an item is the shingles with the
smallest hashes: as many as the threshold lets a document miss, and one more, so a
document that holds enough of the item always holds one of the sketch, wherever in a
long text the item stands. A document is looked up in the classes whose items it is
large enough to hold, by its shingles up to the largest hash in any sketch of the class.
What is found is verified by the exact share of the item's shingles. Items of one to
four words are one shingle of all their words; they are size classes of their own, and
documents are searched for them by windows of that length. All of it is built-in Spark
expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import free_name, table
from tallyroll.runtime import stage

SHINGLE = 5
#: Least share of an item's shingles, in percent.
PERCENT = 80


def _word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(hashes: Column, size: int = SHINGLE) -> Column:
    """Structs of ``size`` hashes in a row; the last ones lack some."""
    ahead = [F.slice(hashes, i + 1, F.size(hashes)) for i in range(size)]
    return F.arrays_zip(*[x.alias(f"h{i}") for i, x in enumerate(ahead)])


def shingle_rows(rows: DataFrame, keys: list[str], hashes: str, size: int = SHINGLE) -> DataFrame:
    """One row for each window of ``size`` in ``hashes``, an array of word hashes: the keys and ``shingle``."""
    parts = [f"h{i}" for i in range(size)]
    zipped = rows.where(F.size(hashes) >= size).select(*keys, F.inline(_windows(F.col(hashes), size)).alias(*parts))
    return zipped.where(F.col(parts[-1]).isNotNull()).select(*keys, F.xxhash64(*parts).alias("shingle"))


def _shingle_set(hashes: Column) -> Column:
    windows = F.filter(_windows(hashes), lambda x: x[f"h{SHINGLE - 1}"].isNotNull())
    return F.array_distinct(F.transform(windows, lambda x: F.xxhash64(*[x[f"h{i}"] for i in range(SHINGLE)])))


def sketches(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """item, its shingle set, the count it needs, its size class and its sketch.

    The class of an item with fewer than five words is their number, below zero. Items
    without words are left out.
    """
    words = F.size("hashes")
    few = F.coalesce(*[F.when(words == n, F.array(F.xxhash64(*[F.get("hashes", F.lit(i)) for i in range(n)]))) for n in range(1, SHINGLE)])
    sets = items.where(words > 0).select("item", F.coalesce(few, _shingle_set(F.col("hashes"))).alias("shingles"), words.alias("words"))
    n = F.size("shingles")
    need = F.ceil(n * percent / 100).cast("int")
    size_class = F.when(F.col("words") < SHINGLE, -F.col("words")).otherwise(F.floor(F.log2(n))).cast("int")
    sized = sets.withColumns({"need": need, "size_class": size_class})
    return sized.withColumn("sketch", F.slice(F.array_sort("shingles"), 1, F.size("shingles") - F.col("need") + 1))


def find_items(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment, of every document that holds ``percent`` of an item's shingles.

    Null texts are empty and hold nothing. A key is the id with a hash of the text, so
    null and repeated ids stay apart, while rows that are equal are searched together
    and reported once. Other columns are not read.
    """
    docs = docs.select(F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("doc"), "text")
    items = items.select(F.struct("item_id", F.xxhash64("text").alias("text_hash")).alias("item"), _word_hashes(F.col("text")).alias("hashes"))
    found = stage(sketches(items.dropDuplicates(["item"]), percent), "decontaminate-items")
    lookup = found.select("item", "need", "size_class", F.explode("sketch").alias("shingle"))
    # A class is searched up to the largest hash in its sketches; classes are few, as each is twice as large as the
    # last, but for the four of short items.
    classes = lookup.groupBy("size_class").agg(F.max("shingle").alias("most"), F.min("need").alias("least")).collect()
    hashed = docs.select("doc", _word_hashes(F.col("text")).alias("hashes"))
    hashed = hashed.select("doc", "hashes", (F.size("hashes") - (SHINGLE - 1)).alias("room"))
    rows = shingle_rows(hashed.select(F.col("doc"), "hashes", "room"), ["doc", "room"], "hashes")
    searched = F.lit(False)
    for c in classes:
        if c["size_class"] >= 0:
            searched = searched | ((F.col("shingle") <= c["most"]) & (F.col("room") >= c["least"]))
    hits = rows.where(searched).join(lookup.where("size_class >= 0"), "shingle").where(F.col("room") >= F.col("need"))
    pairs = stage(hits.select("doc", "item").distinct(), "decontaminate-pairs")
    # Only documents with a candidate are read again.
    again = docs.join(pairs.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])
    sets = again.select("doc", _shingle_set(_word_hashes(F.col("text"))).alias("doc_shingles"))
    both = pairs.join(sets, "doc").join(found.select("item", "shingles", "need"), "item")
    shared = both.withColumn("shared", F.size(F.array_intersect("shingles", "doc_shingles"))).where("shared >= need")
    out = shared.select("doc", "item", "shared", F.size("shingles").alias("item_shingles"))
    for c in classes:
        if c["size_class"] < 0:
            # All words of a short item are its one shingle, so a hit is the whole item.
            short = shingle_rows(hashed, ["doc"], "hashes", -c["size_class"]).where(F.col("shingle") <= c["most"])
            own = lookup.where(F.col("size_class") == c["size_class"]).select("shingle", "item")
            one = short.join(own, "shingle").select("doc", "item").distinct()
            out = out.unionByName(one.withColumns({"shared": F.lit(1), "item_shingles": F.lit(1)}))
    return out.select(
        F.col("doc.doc_id").alias("doc_id"), F.col("doc.text_hash").alias("text_hash"), F.col("item.item_id").alias("item_id"),
        "shared", "item_shingles", (F.col("shared") / F.col("item_shingles")).alias("containment"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, least_words: int = SHINGLE) -> DataFrame:
    """``docs`` without the rows that hold a test item of ``least_words`` words or more.

    One to four words in common with a test item are no sign that it was copied.
    """
    items = items.where(F.size(_word_hashes(F.col("text"))) >= least_words)
    taken = find_items(docs, items, percent).select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_")).distinct()
    left = [free_name(docs, x) for x in ("taken_id", "taken_hash", "hash")]
    taken = taken.toDF(*left[:2])
    same = F.col("doc_id").eqNullSafe(F.col(left[0])) & (F.col(left[2]) == F.col(left[1]))
    return docs.withColumn(left[2], F.xxhash64("text")).join(taken, same, "left_anti").drop(left[2])


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")
