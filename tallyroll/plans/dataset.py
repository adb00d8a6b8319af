"""From raw receipts to the three model tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroll.features import history as hist
from tallyroll.features import label as lab
from tallyroll.functions import (
    discount_rate, distance_fill, have_discount, is_manjian, label_within, parse_day, price_before,
)
from tallyroll.operators.filters import split_windows
from tallyroll.operators.relational import cast_int_cols, left_join, reorder
from tallyroll.runtime import stage

KEYS = ("User_id", "Coupon_id", "Date_received")


def preprocess(df: DataFrame, has_outcome: bool = True) -> DataFrame:
    """Typed days, discount columns and filled distance, in one projection."""
    columns = {
        "received_day": parse_day("Date_received"),
        "have_discount": have_discount("Discount_rate"),
        "discount": discount_rate("Discount_rate"),
        "is_manjian": is_manjian("Discount_rate"),
        "price_before": price_before("Discount_rate"),
        "Distance": distance_fill("Distance"),
    }
    if has_outcome:
        columns["use_day"] = parse_day("Date")
    return df.withColumns(columns)


def add_label(df: DataFrame, min_days: int | None = None) -> DataFrame:
    return df.withColumn("label", label_within("use_day", "received_day", min_days=min_days))


def prepare(receipts: DataFrame) -> DataFrame:
    return add_label(preprocess(receipts))


def _packed(df: DataFrame, name: str, columns: dict[str, Column], *spent: Sequence[str]) -> DataFrame:
    """Put new columns into one struct and drop the ones they were made from.

    Later joins then copy one field in place of a dozen, which keeps their
    generated code small enough to be compiled to machine code.
    """
    pack = F.struct(*[c.alias(out) for out, c in columns.items()])
    return df.withColumn(name, pack).drop(*[c for group in spent for c in group], *columns)


def build_features(
    history: DataFrame, all_history: DataFrame, label: DataFrame, dump: Callable[[DataFrame], None] | None = None
) -> DataFrame:
    """All seven feature groups on the label frame.

    The same columns as the single functions give, but with five joins of the
    wide side instead of nine: statistics of one key are joined to each other
    first, where they already share the partitioning by that key. The pair sums
    serve three of them, so they are staged. Joins that add few columns come first,
    as each later one shuffles them again. The last is by user and discount: equal
    rows of the model table are in one task then, and a hot user is in as many as it
    has discounts.
    """
    pairs = stage(hist.pair_stats(history, all_history), "pairs")
    by_user = lab.rank_stats(label, "User_id").join(hist.user_stats(pairs), "User_id", "left")
    by_coupon = lab.rank_stats(label, "Coupon_id").join(hist.coupon_history_stats(history), "Coupon_id", "left")
    by_merchant = lab.merchant_stats(label).join(
        hist.merchant_history_stats(pairs, F.sum("n"), F.sum("used")), "Merchant_id", "left"
    )
    out = left_join(label, lab.user_coupon_stats(label), lab.USER_COUPON_DAY)
    out = left_join(out, hist.pair_usage(pairs), ["User_id", "Merchant_id"])
    out = lab.attach_stats(out, by_coupon, "Coupon_id")
    out = _packed(out, "_coupon", lab.coupon_columns() | hist.coupon_history_fills(), lab.STATS_COLUMNS)
    out = lab.attach_stats(out, by_merchant, "Merchant_id")
    out = _packed(
        out, "_merchant", lab.merchant_columns() | hist.merchant_history_fills(), lab.MERCHANT_STATS_COLUMNS
    )
    out = lab.attach_stats(out, by_user, "User_id")
    out = _packed(
        out, "_user", lab.user_columns() | hist.user_fills(), lab.STATS_COLUMNS, ["u_h_timedelta_rec_use_days"]
    )
    out = _packed(out, "_pair", hist.pair_fills(), hist.USAGE)
    packs = [f"{pack}.*" for pack in ("_user", "_pair", "_coupon", "_merchant")]
    out = out.select(*label.columns, *lab.USER_COUPON_COLUMNS, *packs)
    if dump is not None:
        out = stage(out, "features")
        dump(out)
    return out


def build_dataset(features: DataFrame) -> DataFrame:
    """Model table: keys, features, label last; copies dropped.

    The two helpers say no more than the discount. With them the rows compared are
    dealt as the features are by their last join, and need no shuffle.
    """
    out = features.drop("Merchant_id", "Discount_rate", "Date", "received_day", "use_day")
    types = {"User_id": "bigint", "Coupon_id": "bigint", "Date_received": "bigint", "Distance": "int"}
    last = []
    if "label" in out.columns:
        types["label"], last = "int", ["label"]
    out = reorder(cast_int_cols(out, types), *KEYS, last=last)
    dealt = {f"_dealt{i}": by for i, by in enumerate(lab.dealt_by("discount"))}
    return out.withColumns(dealt).dropDuplicates().drop(*dealt)


def stage_receipts(receipts: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Prepared receipts as a staged table.

    Nine window frames and many aggregates read it, each only its own columns
    and days. The files are sorted by day, without a shuffle, so that a window
    skips the pages of other days. ``columns`` names those that will be read beside
    the days; without it all are kept.
    """
    ready = prepare(receipts)
    if columns:
        ready = ready.select(*columns, "Date_received", "Date")
    return stage(ready.sortWithinPartitions("Date_received"), "receipts")


def stage_inputs(receipts: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prepared receipts and test rows as staged tables."""
    return stage_receipts(receipts), stage(preprocess(test, has_outcome=False), "receipts-test")


def train_validate_test(
    receipts: DataFrame, test: DataFrame, names: Sequence[str] = ("train", "validate", "test")
) -> dict[str, DataFrame]:
    """The three model tables, or those that are named; the test file is read for its own table only."""
    staged = stage_inputs(receipts, test) if "test" in names else (stage_receipts(receipts), preprocess(test, has_outcome=False))
    frames = split_windows(*staged)
    return {
        name: build_dataset(build_features(f["history"], f["all_history"], f["label"]))
        for name, f in frames.items() if name in names
    }
