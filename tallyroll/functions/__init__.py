from tallyroll.functions.scalars import (
    abs_value, const_one, date_later_flag, diff_or_default, discount_rate, distance_fill, fill_sentinel,
    fill_sentinel_int, have_discount, is_manjian, label_within, null_flags, parse_day, price_before,
    price_before_or_rate, ratio,
)

__all__ = [
    "abs_value", "const_one", "date_later_flag", "diff_or_default", "discount_rate", "distance_fill",
    "fill_sentinel", "fill_sentinel_int", "have_discount", "is_manjian", "label_within", "null_flags",
    "parse_day", "price_before", "price_before_or_rate", "ratio",
]
