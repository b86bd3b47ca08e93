"""Distinct counts that can be added up: sets of whole-number ids as bitmaps.

A state row holds, for a group and a bucket of 64 neighbouring ids, the bits of the ids met as one long. Bitmaps of parts (days,
loads, files) are or-ed, so exact distinct counts over any union of parts come from the states without reading the rows
again, and repeating a part changes nothing. A group is never more state rows than it has ids, each of a few numbers, so a group
of one id costs no more than its row did, and the aggregation buffers have a fixed small size.

A null id is in no set; its rows keep the group in the states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, BITS = "bucket", "bits"


def _ored(bits: str) -> Column:
    """No bits where there is no id."""
    return F.coalesce(F.bit_or(bits), F.lit(0).cast("bigint"))


def states(rows: DataFrame, group: Sequence[str], id_column: str, *sums: Column) -> DataFrame:
    """group, bucket, bits and the given aggregates (sums, counts, maxima: what can be combined again by bucket)."""
    ids = F.col(id_column).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), ids.bitwiseAND(F.lit(63)).cast("int"))
    keyed = rows.withColumns({BUCKET: F.shiftright(ids, 6), "_bit": bit})
    return keyed.groupBy(*group, BUCKET).agg(_ored("_bit").alias(BITS), *sums)


def united(parts: DataFrame, group: Sequence[str | Column], *sums: Column) -> DataFrame:
    """States of a coarser group: bitmaps or-ed, aggregates combined."""
    return parts.groupBy(*group, BUCKET).agg(_ored(BITS).alias(BITS), *sums)


def counted(parts: DataFrame, group: Sequence[str], name: str, *sums: Column) -> DataFrame:
    """One row per group with its number of distinct ids. `parts` has each (group, bucket) once, as `united` gives it."""
    return parts.groupBy(*group).agg(F.sum(F.bit_count(BITS).cast("bigint")).alias(name), *sums)


def common(a: DataFrame, b: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """Ids that two sides, each united, have in common per group; groups without any are left out."""
    both = a.select(*group, BUCKET, BITS).unionByName(b.select(*group, BUCKET, BITS)).where(F.col(BUCKET).isNotNull())
    met = both.groupBy(*group, BUCKET).agg(F.count(F.lit(1)).alias("_sides"), F.bit_and(BITS).alias(BITS)).where("_sides = 2")
    return met.groupBy(*group).agg(F.sum(F.bit_count(BITS).cast("bigint")).alias(name)).where(F.col(name) > 0)
