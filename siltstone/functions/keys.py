"""Row keys hashed over a canonical text form of the key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_text(column: Column, data_type: T.DataType) -> Column:
    """Text form that does not depend on the engine's number or timestamp formatting.

    Doubles print in plain notation with at least one decimal (`1.2E7` -> `12000000.0`); timestamps as
    `yyyy-MM-dd HH:mm:ss`; decimals at their declared scale; NULL as the empty string, so that it keeps
    its slot between separators.
    """
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        short = column.cast("string")
        exact = column.cast("string").try_cast("decimal(38,18)").cast("string")
        plain = F.regexp_replace(F.regexp_replace(exact, "0+$", ""), r"\.$", ".0")
        text = F.when(short.contains("E"), F.coalesce(plain, short)).otherwise(short)
    elif isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        # The cast prints in this form, with a fraction only if there is one; unlike date_format it does not
        # take a TIMESTAMP_NTZ through the session zone.
        text = F.substring(column.cast("string"), 1, 19)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(""))


def _joined(df: DataFrame, columns: Sequence[str], separator: str) -> Column:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing key columns: {missing}")
    parts = [canonical_text(F.col(c), df.schema[c].dataType) for c in columns]
    return F.concat_ws(separator, *parts)


def with_md5_key(df: DataFrame, columns: Sequence[str], name: str = "md5_key") -> DataFrame:
    """Append the md5 of the `|`-joined key columns."""
    return df.withColumn(name, F.md5(_joined(df, columns, "|")))


def with_sha256_id(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Put the SHA-256 of the `-`-joined key columns in front of the other columns."""
    others = [c for c in df.columns if c != name]
    return df.select(F.sha2(_joined(df, columns, "-"), 256).alias(name), *others)
