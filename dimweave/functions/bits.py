"""Bit helpers for 32-bit activity integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a BIT(32) cast keeps the low 32 bits.
MASK32 = 0xFFFFFFFF


def day_bit(days_ago: Column, include_today: bool = False) -> Column:
    """``2 ** (32 - days_ago)`` kept to 32 bits (as-of day wraps to 0), or
    ``2 ** (31 - days_ago)`` with ``include_today``."""
    top = 31 if include_today else 32
    shift = F.lit(top) - days_ago
    one = F.lit(1).cast("bigint")
    return F.call_function("shiftleft", one, shift.cast("int")).bitwiseAND(F.lit(MASK32))


def bits32_text(c: Column) -> Column:
    """32-character 0/1 text of the low 32 bits."""
    return F.lpad(F.bin(c.bitwiseAND(F.lit(MASK32))), 32, "0")


def masked_count(c: Column, mask: int) -> Column:
    return F.bit_count(c.bitwiseAND(F.lit(mask))).cast("int")
