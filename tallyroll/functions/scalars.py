"""Column expressions. All are built-in functions, so they stay in generated code.

Missing values are SQL null throughout, never NaN.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = -1
USE_WITHIN_DAYS = 15


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(text: Column) -> Column:
    """Text to double; bad text and the word nan are missing."""
    return F.nullif(text.try_cast("double"), F.lit(float("nan")))


def _part(c: Column, at: int) -> Column:
    """Side 0 or 1 of ``a:b``; a second colon stays in side 1 and makes it bad text."""
    return F.get(F.split(c, ":", 2), at)


def parse_day(c: str | Column, fmt: str = "yyyyMMdd") -> Column:
    """Text day to date; bad text is missing.

    Days written yyyyMMdd are cast from their ISO form, which is several times
    faster than a formatter.
    """
    text = _col(c).cast("string")
    if fmt != "yyyyMMdd":
        return F.try_to_date(text, fmt)
    iso = F.concat(F.substr(text, F.lit(1), F.lit(4)), F.lit("-"), F.substr(text, F.lit(5), F.lit(2)),
                   F.lit("-"), F.substr(text, F.lit(7)))
    return F.when(F.char_length(text) == 8, iso.try_cast("date"))


def is_manjian(c: str | Column) -> Column:
    """True for a "spend a, save b" coupon, written ``a:b``."""
    return F.coalesce(F.contains(_col(c), F.lit(":")), F.lit(False))


def have_discount(c: str | Column) -> Column:
    return _col(c).isNotNull()


def discount_rate(c: str | Column) -> Column:
    """``a:b`` gives (a - b) / a, other text its number."""
    c = _col(c)
    a, b = _part(c, 0).try_cast("bigint"), _part(c, 1).try_cast("bigint")
    return F.when(is_manjian(c), F.try_divide(a - b, a)).otherwise(_number(c))


def price_before(c: str | Column) -> Column:
    """The amount to spend of an ``a:b`` coupon, else -1."""
    c = _col(c)
    return F.when(is_manjian(c), _number(_part(c, 0))).otherwise(F.lit(float(MISSING)))


def price_before_or_rate(c: str | Column) -> Column:
    """The amount to spend of an ``a:b`` coupon, else the rate itself."""
    c = _col(c)
    return F.when(is_manjian(c), _number(_part(c, 0))).otherwise(_number(c))


def distance_fill(c: str | Column) -> Column:
    return F.coalesce(_col(c).cast("int"), F.lit(MISSING))


def fill_sentinel(c: str | Column, sentinel: float = MISSING) -> Column:
    return F.coalesce(_col(c), F.lit(sentinel))


def fill_sentinel_int(c: str | Column, sentinel: int = MISSING) -> Column:
    """Cut towards zero, then fill."""
    return F.coalesce(_col(c).cast("int"), F.lit(sentinel))


def label_within(
    use_day: str | Column, received_day: str | Column,
    days: int = USE_WITHIN_DAYS, min_days: int | None = None,
) -> Column:
    """1 when the coupon was used at most ``days`` after receipt, else 0.

    A use before the receipt counts unless ``min_days`` is given.
    """
    gap = F.datediff(_col(use_day), _col(received_day))
    hit = gap <= days if min_days is None else gap.between(min_days, days)
    return F.when(hit, 1).otherwise(0)


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b; null when b is 0 or either is missing."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def diff_or_default(x: str | Column, y: str | Column, default: int = MISSING) -> Column:
    """y - x, or the default when either is missing."""
    return F.coalesce(_col(y) - _col(x), F.lit(default))


def date_later_flag(x: str | Column, y: str | Column) -> Column:
    """True when x is after y; a missing side gives False."""
    return F.coalesce(_col(x) > _col(y), F.lit(False))


def abs_value(c: str | Column) -> Column:
    return F.abs(_col(c))


def null_flags(c: str | Column) -> tuple[Column, Column]:
    """(is null, is not null)."""
    return _col(c).isNull(), _col(c).isNotNull()


def const_one() -> Column:
    return F.lit(1)
