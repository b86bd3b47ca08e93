"""Upserts, conflict handling and deletes as set operations.

Plain Parquet has no MERGE, so each function returns the table's new content; `sources.tables` writes it.
Every function reads the large target once and joins it with the small source by an anti or semi join:
Catalyst broadcasts the source keys when their size is below its threshold, and otherwise AQE may split a
skewed target partition, since both join kinds allow splitting the left side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import keep_first
from .frames import require_columns


class DuplicateKeyError(ValueError):
    """A key occurs more often than the operation allows."""


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _key_match(left: str, right: str, keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [(F.col(f"{left}.{k}"), F.col(f"{right}.{k}")) for k in keys]
    return _all([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def _complete_keys(keys: Sequence[str]) -> Column:
    return _all([F.col(k).isNotNull() for k in keys])


def assert_unique(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> None:
    """Raise if a key occurs twice. Keys with a NULL never equal one another unless `null_safe`."""
    rows = df if null_safe else df.where(_complete_keys(keys))
    repeated = rows.groupBy(*keys).count().where("count > 1").select(*keys).first()
    if repeated is not None:
        raise DuplicateKeyError(f"key occurs more than once in the source: {repeated.asDict()}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: bool = False,
    check_unique: bool = True,
    newer_by: str | None = None,
) -> DataFrame:
    """The target after updating matched rows with, and inserting unmatched rows from, the source.

    The target holds each complete key once, as every table written by this function does. A repeated
    key in the source is an error. Rows whose key contains NULL match nothing, so they are kept and
    inserted again on every run, unless `null_safe`. With `newer_by`, a source row replaces a target row
    only if it is greater in that column.
    """
    require_columns(source, target.columns)
    if check_unique:
        assert_unique(source, keys, null_safe)
    incoming = source.select(*target.columns)
    if newer_by is not None:
        stale = incoming.alias("s").join(
            target.select(*keys, newer_by).alias("t"),
            _key_match("s", "t", keys, null_safe) & ~F.coalesce(F.col(f"s.{newer_by}") > F.col(f"t.{newer_by}"), F.lit(False)),
            "left_semi",
        )
        incoming = incoming.alias("s").join(
            stale.select(*keys).alias("t"), _key_match("s", "t", keys, null_safe), "left_anti"
        )
    # Rows whose key has a NULL match nothing: they need not meet in one partition of the join.
    matchable = target if null_safe else target.where(_complete_keys(keys))
    untouched = matchable.alias("t").join(
        incoming.select(*keys).alias("s"), _key_match("t", "s", keys, null_safe), "left_anti"
    )
    kept = untouched if null_safe else untouched.unionByName(target.where(~_complete_keys(keys)))
    return kept.unionByName(incoming)


def insert_strict(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append; a key already present, or present twice among the rows, is an error."""
    assert_unique(rows, keys)
    clash = rows.alias("s").join(
        target.select(*keys).alias("t"), _key_match("s", "t", keys, False), "left_semi"
    )
    found = clash.select(*keys).first()
    if found is not None:
        raise DuplicateKeyError(f"key already in the table: {found.asDict()}")
    return target.unionByName(rows.select(*target.columns))


def insert_ignore(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """Append the rows whose key is new; of rows sharing a key, the first under `order`."""
    incoming = rows.select(*target.columns)
    complete = keep_first(incoming.where(_complete_keys(keys)), keys, order)
    fresh = complete.alias("s").join(
        target.select(*keys).alias("t"), _key_match("s", "t", keys, False), "left_anti"
    )
    return target.unionByName(fresh).unionByName(incoming.where(~_complete_keys(keys)))


def upsert_keep(
    existing: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), keep: str = "last"
) -> DataFrame:
    """Stack existing rows and new rows, keeping per key the first or the last one.

    Every existing row comes before every new one; `order` (ascending Columns) tells rows of one side
    apart. NULL keys count as equal here, as in a keyed distinct.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    side = existing.withColumn("_side", F.lit(0)).unionByName(rows.withColumn("_side", F.lit(1)))
    by_side = F.col("_side").asc() if keep == "first" else F.col("_side").desc()
    return keep_first(side, keys, [by_side, *order]).drop("_side")


def delete_where(df: DataFrame, condition: Column | str) -> DataFrame:
    """Rows left after DELETE ... WHERE: a NULL condition deletes nothing."""
    test = F.expr(condition) if isinstance(condition, str) else condition
    return df.where(~F.coalesce(test, F.lit(False)))


def cascade_prune(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose parent still exists; a child without a parent reference stays."""
    survivors = parents.select(F.col(parent_key).alias("_parent"))
    linked = children.where(F.col(child_key).isNotNull())
    kept = linked.join(survivors, F.col(child_key) == F.col("_parent"), "left_semi")
    return kept.unionByName(children.where(F.col(child_key).isNull()))
