"""Small text helpers used by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the default the reference substitutes for a missing referrer.
DEFAULT_REFERRER = "unknow"


def substring_flag(c: Column, marker: str) -> Column:
    """Does the text contain ``marker``?  NULL text counts as no."""
    return F.coalesce(F.instr(c, marker) > 0, F.lit(False))


def minutes_from_text(c: Column) -> Column:
    """'MM:SS' -> fractional minutes.  Text without a colon (or empty) has no
    seconds part; its cast fails, so the result is NULL (try_cast)."""
    mm = F.split_part(c, F.lit(":"), F.lit(1)).try_cast("double")
    ss = F.split_part(c, F.lit(":"), F.lit(2)).try_cast("double")
    return mm + ss / 60


def first_word(c: Column) -> Column:
    return F.split(c, " ").getItem(0)
