"""Which source rows an incremental run has to read.

The bound is one scalar read from the target and put into the plan as a literal on the raw column, so it
reaches the Parquet scan and prunes partitions; a subquery or a function around the column would not.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates

# Fixed value: where the trip history starts when the target is still empty.
TRIP_HISTORY_START = dt.date(2023, 1, 1)


def high_water_mark(target: DataFrame, column: str):
    """MAX(column) of the target, or None; the only value that comes back to the driver."""
    return target.agg(F.max(column).alias("mark")).first()["mark"]


def last_id(table: DataFrame, column: str) -> DataFrame:
    """One row: the greatest id, 0 for an empty table."""
    return table.agg(F.coalesce(F.max(column), F.lit(0)).alias("last_id"))


def _no_rows(source: DataFrame) -> DataFrame:
    return source.where(F.lit(False))


def since_mark(
    source: DataFrame, target: DataFrame, column: str, inclusive: bool = False, empty_loads_all: bool = False
) -> DataFrame:
    """Rows whose `column` (a load date) is above the target's maximum.

    An empty target gives no rows, because nothing compares with NULL; `empty_loads_all` loads
    everything instead. `inclusive` re-reads the day of the mark, for a second run on one day.
    """
    mark = high_water_mark(target, column)
    if mark is None:
        return source if empty_loads_all else _no_rows(source)
    value = F.col(column)
    return source.where(value >= F.lit(mark) if inclusive else value > F.lit(mark))


def since_event_date(
    source: DataFrame,
    target: DataFrame,
    event_time: str,
    date_key: str,
    inclusive: bool = False,
    empty_loads_all: bool = False,
) -> DataFrame:
    """Rows whose event date is after the target's latest `date_key`.

    `date(event) > d` is written as `event >= d + 1 day`. Late rows of a day already loaded are missed
    unless `inclusive`.
    """
    mark = high_water_mark(target, date_key)
    if mark is None:
        return source if empty_loads_all else _no_rows(source)
    bound = mark if inclusive else mark + dt.timedelta(days=1)
    return source.where(F.col(event_time) >= F.lit(dt.datetime.combine(bound, dt.time())).cast("timestamp_ntz"))


def lookback_bound(target: DataFrame, event_time: str, months: int = 2) -> dt.date:
    """First day of the target's latest month, shifted `months` back."""
    mark = high_water_mark(target, event_time)
    latest = TRIP_HISTORY_START if mark is None else mark.date()
    return dates.add_months(latest.replace(day=1), -months)


def lookback_months(source: DataFrame, target: DataFrame, event_time: str, months: int = 2) -> DataFrame:
    """Rows from the latest loaded month and the `months` before it."""
    bound = lookback_bound(target, event_time, months)
    return source.where(F.col(event_time) >= F.lit(dt.datetime.combine(bound, dt.time())).cast("timestamp_ntz"))


def trailing_months(source: DataFrame, date_column: str, as_of: dt.date, months: int = 2) -> DataFrame:
    """Rows whose month starts on or after `as_of` minus `months`.

    As a month start is compared with a day inside a month, the oldest month is left out on every day
    but the first of a month.
    """
    bound = dates.first_month_on_or_after(dates.add_months(as_of, -months))
    return source.where(F.col(date_column) >= F.lit(bound))


def trailing_whole_months(source: DataFrame, date_column: str, as_of: dt.date, months: int = 2) -> DataFrame:
    """Rows of the month of `as_of` and of the whole `months` before it."""
    return source.where(F.col(date_column) >= F.lit(dates.add_months(as_of.replace(day=1), -months)))


def source_month(logical: dt.date, lag: int = 2) -> tuple[int, int]:
    """Year and month to ingest in a run, given the publication lag."""
    target = dates.add_months(logical.replace(day=1), -lag)
    return target.year, target.month


def _midnight(day: dt.date):
    return F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")


def created_on(source: DataFrame, column: str, day: dt.date) -> DataFrame:
    """Rows created on one day, as a half-open range that can be pushed down."""
    value = F.col(column)
    return source.where((value >= _midnight(day)) & (value < _midnight(day + dt.timedelta(days=1))))


def created_before(source: DataFrame, column: str, day: dt.date) -> DataFrame:
    """Rows created before a day: the initial load."""
    return source.where(F.col(column) < _midnight(day))


def month_window(source: DataFrame, column: str, year: int, month: int) -> DataFrame:
    """Rows of one month, as a half-open range on the raw column."""
    first = dt.date(year, month, 1)
    value = F.col(column)
    return source.where((value >= _midnight(first)) & (value < _midnight(dates.add_months(first, 1))))
