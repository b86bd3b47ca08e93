"""Column naming, selection and typing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates


class MissingColumnsError(ValueError):
    """A frame lacks columns the job needs."""


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip, lower-case and underscore the column names; refuse names that become equal."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names collide after normalisation: {clashes}")
    return df.toDF(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename; names the frame does not have are ignored."""
    return df.withColumnsRenamed(dict(names))


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")


def select_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require_columns(df, columns)
    return df.select(*columns)


def stamp_run_date(df: DataFrame, name: str, instant: Column | None = None) -> DataFrame:
    """Append the run date: the Jakarta calendar date of a UTC instant."""
    return df.withColumn(name, dates.run_date(instant))


def _as_timestamp(df: DataFrame, column: str) -> Column:
    return F.col(column).try_cast("timestamp_ntz")


def check_readable(df: DataFrame, column: str) -> None:
    """Raise if a non-empty frame has no value that can be read as a timestamp; stops at the first readable row."""
    if df.where(_as_timestamp(df, column).isNotNull()).isEmpty() and not df.isEmpty():
        raise ValueError(f"no value of {column!r} could be read as a timestamp")


def expand_datetime(df: DataFrame, column: str) -> DataFrame:
    """Coerce a column to a timestamp and append its year, month, day, hour and weekday (Monday = 0).

    Text that is no timestamp becomes NULL; see `check_readable` for a column that cannot be read at all.
    """
    require_columns(df, [column])
    typed = df.withColumn(column, _as_timestamp(df, column))
    value = F.col(column)
    return typed.withColumns(
        {
            f"{column}_year": F.year(value),
            f"{column}_month": F.month(value),
            f"{column}_day": F.dayofmonth(value),
            f"{column}_hour": F.hour(value),
            f"{column}_day_of_week": F.weekday(value),
        }
    )


def _to_long(column: Column, source: T.DataType) -> Column:
    if isinstance(source, T.IntegralType):
        return column.cast("bigint")
    # A fractional value has no integer reading: NULL, not a truncated number.
    number = column.try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def coerce(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Column of type `target`; values that cannot be read become NULL, NULL stays NULL."""
    if isinstance(target, T.IntegralType):
        return _to_long(column, source).cast(target)
    if isinstance(target, T.DecimalType):
        if isinstance(source, T.DecimalType):
            return F.round(column, 2).try_cast("decimal(38,2)")
        return F.round(column.try_cast("double"), 2).try_cast("decimal(38,2)")
    return column.try_cast(target)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Coerce the columns named in `schema` to its types; the others pass through unchanged."""
    return df.withColumns(
        {f.name: coerce(F.col(f.name), df.schema[f.name].dataType, f.dataType) for f in schema if f.name in df.columns}
    )


def cast_dates_and_integers(df: DataFrame, schema: T.StructType) -> DataFrame:
    """As `align_to_schema`, but only for DATE and integer fields."""
    wanted = [f for f in schema if isinstance(f.dataType, (T.DateType, T.IntegralType))]
    return align_to_schema(df, T.StructType(wanted))


def computed_once(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The same rows, with the columns other than `keep` handed through a generator.

    Catalyst pushes a filter on a computed column below the projection by repeating the expression. For a
    chain of regular expressions or a JSON parse that doubles the work, or worse inside lambdas. A filter
    on a generated column stays above its generator.
    """
    others = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.inline_outer(F.array(F.struct(*others))))
