"""Numbers written with a unit (`4076 Ribu`) and fixed-point averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each unit word multiplies by.
UNIT_FACTORS = {
    "rb": 1_000,
    "jt": 1_000_000,
    "m": 1_000_000_000,
    "t": 1_000_000_000_000,
    "ribu": 1_000,
    "juta": 1_000_000,
    "milyar": 1_000_000_000,
    "triliun": 1_000_000_000_000,
}


def unit_factor(unit: Column) -> Column:
    """Multiplier of a unit word in any case; 1 when the word is unknown."""
    pairs = [F.lit(item) for pair in UNIT_FACTORS.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(unit)), F.lit(1)).cast("decimal(13,0)")


def amount_from_text(text: Column) -> Column:
    """BIGINT value of `number` or `number unit`; commas group digits, the dot is the decimal point.

    Fractions are cut off toward zero. Text of any other shape gives NULL.
    """
    words = F.split(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), " ")
    number = F.replace(F.get(words, F.lit(0)), F.lit(","), F.lit("")).try_cast("decimal(20,6)")
    bare = text.rlike(r"^\s*[\d,.]+\s*$")
    factor = F.when(bare, F.lit(1).cast("decimal(13,0)")).when(F.size(words) == 2, unit_factor(F.get(words, F.lit(1))))
    return (number * factor).try_cast("bigint")


# Holds every digit a double shows from 10**-2 up to 10**20, and every fixed-point amount.
_WIDE = "decimal(38,18)"


def exact_mean(column: Column) -> Column:
    """Mean as DOUBLE, from a sum that does not depend on how rows are partitioned, as a sum of doubles would.

    Values are not rounded before they are added. NULLs are left out.
    """
    total = F.sum(column.cast(_WIDE)).cast("double")
    return F.try_divide(total, F.count(column).cast("double"))


def exact_sum(column: Column) -> Column:
    """Sum as decimal of the unrounded values, independent of row order."""
    return F.sum(column.cast(_WIDE))
