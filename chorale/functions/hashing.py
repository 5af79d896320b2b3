"""Repeatable pseudo-random numbers that any SQL engine with md5 can recompute."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first 8 hex digits of an md5 digest span [0, 2^32).
HEX_DIGITS = 8
HEX_SPAN = 2**32


def unit_hash(columns: list[str], seed: int) -> Column:
    """A number in [0, 1) that depends only on the row's values and the seed."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed)))
    digits = F.substring(F.md5(text), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(HEX_SPAN))
