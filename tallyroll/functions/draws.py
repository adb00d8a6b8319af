"""Random numbers that depend on a key and a seed only.

They are the same in any partitioning and when a task runs again, and any engine
with MD5 can repeat them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(keys: Sequence[str], seed: int) -> Column:
    """32 hexadecimal digits; rows with equal keys draw the same."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def uniform(keys: Sequence[str], seed: int) -> Column:
    """A number between 0 and 1, neither included, with 52 random bits."""
    bits = F.conv(F.substring(draw(keys, seed), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def normal(keys: Sequence[str], seed: int) -> Column:
    """A standard normal number."""
    angle = 2 * F.pi() * uniform([*keys], seed + 1_000_003)
    return F.sqrt(-2 * F.ln(uniform(keys, seed))) * F.cos(angle)
