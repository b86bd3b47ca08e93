"""Aggregates kept by changes: rows that came, left or were corrected, instead of whole groups read again.

A change set has the old and the new form of every changed row with the sign -1 and 1. Sums and counts of a group move by
its signed sums, whatever the number of its rows. A maximum moves by what came; only where a row that held it left is the
group looked up in the new rows, by a semi join on those groups alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGN = "_sign"


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def _among(target: DataFrame, chosen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's rows whose key is among the chosen rows; nulls equal each other.

    Rows with complete keys are joined by plain equality, which rows that lie by their key already need no exchange for.
    """
    complete = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    wanted = chosen.select(*keys)
    plain = reduce(lambda a, b: a & b, (F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys))
    whole = target.where(complete).alias("t").join(wanted.where(complete).alias("s"), plain, "left_semi")
    partial = target.where(~complete).alias("t").join(wanted.where(~complete).alias("s"), _same("t", "s", keys), "left_semi")
    return whole.unionByName(partial)


def change_set(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The incoming rows with sign 1 and the target's rows that they replace with sign -1.

    A row that comes again unchanged cancels out. The incoming rows have each key once; the target is read once, against the
    small side's keys.
    """
    columns = target.columns
    old = _among(target, incoming, keys)
    return incoming.select(*columns, F.lit(1).alias(SIGN)).unionByName(old.select(*columns, F.lit(-1).alias(SIGN)))


def removals(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's rows whose key is in `gone`, with sign -1."""
    old = _among(target, gone, keys)
    return old.select(*target.columns, F.lit(-1).alias(SIGN))


def group_states(rows: DataFrame, group: Sequence[str], sums: dict[str, Column], maxima: dict[str, Column]) -> DataFrame:
    """States of whole groups: `_rows`, per sum its total and the number of values, per maximum its value."""
    return rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()),
        *(F.count(c).alias(f"{n}_n") for n, c in sums.items()),
        *(F.max(c).alias(n) for n, c in maxima.items()),
    )


def moved_states(
    states: DataFrame, changes: DataFrame, rows_after: DataFrame, group: Sequence[str], sums: dict[str, Column], maxima: dict[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """(new states of the groups that the changes touch, keys of groups that have no rows left).

    `rows_after` are the rows with the changes in effect; only groups that lost a maximum are read from them.
    """
    sign = F.col(SIGN)
    moves = changes.groupBy(*group).agg(
        F.sum(sign).cast("bigint").alias("_rows"),
        *(F.coalesce(F.sum(c * sign), F.lit(0)).alias(n) for n, c in sums.items()),
        *(F.coalesce(F.sum(F.when(c.isNotNull(), sign)), F.lit(0)).cast("bigint").alias(f"{n}_n") for n, c in sums.items()),
        *(F.max(F.when(sign > 0, c)).alias(n) for n, c in maxima.items()),
        *(F.max(F.when(sign < 0, c)).alias(f"_lost_{n}") for n, c in maxima.items()),
    )
    totals = ["_rows", *sums, *(f"{n}_n" for n in sums)]
    joined = moves.alias("m").join(states.alias("s"), _same("m", "s", group), "left")
    lost = [F.coalesce(F.col(f"m._lost_{n}") >= F.col(f"s.{n}"), F.lit(False)) & ~F.coalesce(F.col(f"m.{n}") >= F.col(f"s.{n}"), F.lit(False)) for n in maxima]
    new = joined.select(
        *(F.col(f"m.{g}").alias(g) for g in group),
        *((F.coalesce(F.col(f"s.{n}"), F.lit(0)) + F.col(f"m.{n}")).cast(states.schema[n].dataType).alias(n) for n in totals),
        *(F.greatest(F.col(f"s.{n}"), F.col(f"m.{n}")).alias(n) for n in maxima),
        reduce(lambda a, b: a | b, lost, F.lit(False)).alias("_lost"),
    )
    left = new.where("_rows > 0")
    gone = new.where("_rows <= 0").select(*group)
    if not maxima:
        return left.drop("_lost"), gone
    again = left.where("_lost").select(*group)
    found = rows_after.alias("r").join(again.alias("g"), _same("r", "g", group), "left_semi")
    found = found.groupBy(*group).agg(*(F.max(c).alias(n) for n, c in maxima.items()))
    looked = left.where("_lost").drop(*maxima, "_lost").alias("l").join(found.alias("f"), _same("l", "f", group), "left")
    looked = looked.select(*(F.col(f"l.{c}").alias(c) for c in [*group, *totals]), *(F.col(f"f.{n}").alias(n) for n in maxima))
    return left.where("not _lost").drop("_lost").unionByName(looked), gone


def applied_states(
    states: DataFrame, changes: DataFrame, rows_after: DataFrame, group: Sequence[str], sums: dict[str, Column], maxima: dict[str, Column]
) -> DataFrame:
    """All states with the changes in effect: those of `moved_states` and the untouched ones.

    States and signed moves meet in one aggregation by group, instead of joins of the states with what moved and what went.
    """
    sign, held = F.col(SIGN), F.lit(None).cast("boolean")
    totals = ["_rows", *sums, *(f"{n}_n" for n in sums)]
    signed = {"_rows": sign, **{n: c * sign for n, c in sums.items()}, **{f"{n}_n": F.when(c.isNotNull(), sign) for n, c in sums.items()}}
    kinds = {n: states.schema[n].dataType for n in [*totals, *maxima]}
    moves = changes.select(
        *group,
        *(F.coalesce(c, F.lit(0)).cast(kinds[n]).alias(n) for n, c in signed.items()),
        *(c.cast(kinds[n]).alias(n) for n, c in maxima.items()),
        (sign > 0).alias("_came"),
    )
    met = states.select(*group, *totals, *maxima, held.alias("_came")).unionByName(moves)
    stays, came, left = F.col("_came").isNull(), F.col("_came"), ~F.col("_came")
    new = met.groupBy(*group).agg(
        *(F.sum(n).cast(kinds[n]).alias(n) for n in totals),
        *(F.max(F.when(stays | came, F.col(n))).alias(n) for n in maxima),
        *(F.max(F.when(stays, F.col(n))).alias(f"_held_{n}") for n in maxima),
        *(F.max(F.when(came, F.col(n))).alias(f"_came_{n}") for n in maxima),
        *(F.max(F.when(left, F.col(n))).alias(f"_left_{n}") for n in maxima),
    ).where("_rows > 0")
    if not maxima:
        return new
    fewer = [F.coalesce(F.col(f"_left_{n}") >= F.col(f"_held_{n}"), F.lit(False)) & ~F.coalesce(F.col(f"_came_{n}") >= F.col(f"_held_{n}"), F.lit(False)) for n in maxima]
    new = new.select(*group, *totals, *maxima, reduce(lambda a, b: a | b, fewer).alias("_lost"))
    again = new.where("_lost").select(*group)
    found = rows_after.select(*group, *(c.alias(n) for n, c in maxima.items())).alias("r").join(again.alias("g"), _same("r", "g", group), "left_semi")
    found = found.groupBy(*group).agg(*(F.max(n).alias(n) for n in maxima))
    looked = new.where("_lost").drop(*maxima, "_lost").alias("l").join(found.alias("f"), _same("l", "f", group), "left")
    looked = looked.select(*(F.col(f"l.{c}").alias(c) for c in [*group, *totals]), *(F.col(f"f.{n}").alias(n) for n in maxima))
    return new.where("not _lost").drop("_lost").unionByName(looked)
