"""One row per key.

A filter `row_number() = 1` lets Catalyst put a WindowGroupLimit on the map side, so only one candidate
per key leaves each map task: a key holding a third of the table does not become one huge reduce group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _tie_breakers(df: DataFrame, used: Sequence[str]) -> list[Column]:
    return [
        F.col(f.name).asc_nulls_first()
        for f in df.schema
        if f.name not in used and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_breakers: Sequence[Column] | None = None
) -> DataFrame:
    """The first row of each key under `order`.

    Rows equal under `order` are told apart by `tie_breakers`; by default by all non-key columns, which
    makes the choice repeatable.
    """
    ties = _tie_breakers(df, keys) if tie_breakers is None else list(tie_breakers)
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_latest(
    df: DataFrame, keys: Sequence[str], by: str, tie_breakers: Sequence[Column] | None = None, wanted: Sequence[str] | None = None
) -> DataFrame:
    """The row with the greatest `by` per key; NULL counts as oldest.

    With `wanted`, the keys and these columns of the same rows: of the default tie breakers those after the last wanted
    column cannot change them, so they need not be sorted by or travel.
    """
    if wanted is not None and tie_breakers is None:
        last = max((df.columns.index(c) for c in wanted if c not in keys), default=-1)
        df = df.select(*dict.fromkeys([*keys, by, *(c for k, c in enumerate(df.columns) if k <= last)]))
        if last < 0:
            return df.select(*keys).distinct()
    ties = _tie_breakers(df, [*keys, by]) if tie_breakers is None else tie_breakers
    latest = keep_first(df, keys, [F.col(by).desc_nulls_last()], ties)
    return latest if wanted is None else latest.select(*dict.fromkeys([*keys, *wanted]))


def keep_earliest(
    df: DataFrame, keys: Sequence[str], by: str, tie_breakers: Sequence[Column] | None = None
) -> DataFrame:
    """The row with the smallest `by` per key; NULL counts as earliest."""
    ties = _tie_breakers(df, [*keys, by]) if tie_breakers is None else tie_breakers
    return keep_first(df, keys, [F.col(by).asc_nulls_first()], ties)
