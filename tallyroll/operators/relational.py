"""Projection, joins, sorting and set operations.

Joins carry no hint: the planner broadcasts a side when its measured size allows
and otherwise sorts and merges. ``left_join`` is made for a wide side
that may have hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyroll.functions.draws import draw
from tallyroll.operators.aggregates import group_agg
from tallyroll.runtime import stage


def project(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def reorder(df: DataFrame, *first: str, last: Sequence[str] = ()) -> DataFrame:
    """Put some columns first and some last; the rest keep their order."""
    middle = [c for c in df.columns if c not in first and c not in last]
    return df.select(*first, *middle, *last)


def cast_int_cols(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Cast columns to the given integer types, cutting towards zero; null for text that is no number."""
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in columns.items()})


def fill_all_zero(df: DataFrame) -> DataFrame:
    """0 for null in every numeric column."""
    return df.fillna(0)


def _join_on_own_shuffles(df: DataFrame, other: DataFrame, keys: str | Sequence[str], how: str) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    own = F.pmod(F.hash(*keys), F.lit(1))
    return df.withColumn("_own", own).join(other.withColumn("_own", own), [*keys, "_own"], how).drop("_own")


def left_join(df: DataFrame, stats: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Left join with a table of one row per key, safe when a key holds much of ``df``.

    Adaptive execution splits a hot key among tasks only if both sides of the
    join are read straight from their own shuffles. A side that was grouped by
    the same keys is not shuffled again, and two joins on the same keys share
    one shuffle, so neither would be split. The extra key column, always 0, is
    not part of any earlier partitioning: it gives each join its own shuffles.
    For the grouped side that is one more pass over a row per key.
    """
    return _join_on_own_shuffles(df, stats, keys, "left")


def right_join(stats: DataFrame, df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The same with the wide side, whose rows are all kept, on the right."""
    return _join_on_own_shuffles(stats, df, keys, "right")


def agg_join_back(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """Aggregate by ``keys`` and put the result on every row of the key.

    Unlike a window this sums before the shuffle, so a hot key costs one row
    from each task. Rows with a null key get null.
    """
    return left_join(df, group_agg(df, keys, *aggs), keys)


def count_over(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Number of rows with the same ``keys``, on every row."""
    return agg_join_back(df, keys, F.count("*").alias(out))


def sort_values(df: DataFrame, *order: str | Column) -> DataFrame:
    """Sort; nulls of a column given by name come last."""
    return df.orderBy(*[F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order])


def top_k(df: DataFrame, k: int, by: str, *ties: str | Column) -> DataFrame:
    """The k greatest rows; each task keeps k, and one task puts them together: for small k."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def arg_max(df: DataFrame, by: str, *ties: str) -> DataFrame:
    """The one row that is greatest by ``by``, then by ``ties``."""
    order = F.struct(by, *ties)
    return df.agg(F.max_by(F.struct(*df.columns), order).alias("row")).select("row.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], ascending: bool = True) -> DataFrame:
    """For each key the first row by ``order``, as one struct minimum or maximum.

    A missing order value comes last either way. The columns that are not keys or
    order follow as ties, so the row is the same on every run. Aggregates before
    the shuffle, unlike a row number.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    pick = F.min if ascending else F.max
    ranked = [x for i, c in enumerate(order) for x in ((F.col(c).isNull() if ascending else F.col(c).isNotNull()).alias(f"_missing{i}"), F.col(c))]
    return (
        group_agg(df, keys, pick(F.struct(*ranked, *rest)).alias("row"))
        .select(*keys, "row.*")
        .select(*df.columns)
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_projection(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def union_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def sample_rows(df: DataFrame, k: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """k rows without replacement, drawn by a hash of their unique ``keys``.

    Each task keeps its k smallest draws, and one task puts them together: for small k.
    """
    return df.orderBy(draw(keys, seed), *keys).limit(k)


def row_positions(df: DataFrame, out: str = "position") -> DataFrame:
    """``df`` with the place of each row, from 0, as written to files in the order of its partitions.

    A row's place is its number in its file, which the reader knows, and the rows of the
    files before it, from a table of one row a file. Nothing is sorted, and the places
    do not depend on how many tasks read the files. The result is a written table.
    """
    written = stage(df, "positions").select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = written.groupBy("_file").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1))
    # One row a file.
    files = files.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    return stage(written.join(files, "_file").withColumn(out, F.col("_before") + F.col("_row")).drop("_file", "_row", "_before"), "positions")


def zip_columns(left: DataFrame, right: DataFrame, position: str = "position") -> DataFrame:
    """The columns of both side by side, row by row of the same place; where one is shorter, its columns are null."""
    return left.join(right, position, "full")
