"""Dates, month arithmetic and durations. Nothing here reads the clock unless asked to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

RUN_ZONE = "Asia/Jakarta"

# Month names; the listing site spells the eleventh month with a p, court texts with a v.
MONTH_NUMBERS = {
    "januari": 1,
    "februari": 2,
    "maret": 3,
    "april": 4,
    "mei": 5,
    "juni": 6,
    "juli": 7,
    "agustus": 8,
    "september": 9,
    "oktober": 10,
    "november": 11,
    "nopember": 11,
    "desember": 12,
}


def run_date(instant: Column | None = None, zone: str = RUN_ZONE) -> Column:
    """Calendar date in `zone` of a UTC instant (default: now). Jobs pass the instant in."""
    return F.to_date(F.from_utc_timestamp(F.current_timestamp() if instant is None else instant, zone))


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM")


def day_tag(date: Column) -> Column:
    """`yyyyMMdd`, from the date's text form: no zone and no formatter per row."""
    return F.replace(date.cast("string"), F.lit("-"), F.lit(""))


def month_tag(date: Column) -> Column:
    """`yyyyMM`."""
    return F.substring(day_tag(date), 1, 6)


def whole_minutes(start: Column, end: Column) -> Column:
    """Complete minutes between two timestamps, as BIGINT.

    Interval arithmetic rather than `timestampdiff`, which would convert TIMESTAMP_NTZ through the
    session zone.
    """
    return (end - start).cast("interval minute").cast("bigint")


def month_number(name: Column) -> Column:
    """Month number of an Indonesian month name in any case; NULL when unknown."""
    pairs = [F.lit(item) for pair in MONTH_NUMBERS.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), F.lower(name))


def _date_by(text: Column, pattern: str) -> Column:
    """Date from a pattern with groups day, month name and year; NULL for no match or an impossible date.

    An unknown month leaves `year-day`, which does not parse.
    """
    day, name, year = (F.regexp_extract(text, pattern, group) for group in (1, 2, 3))
    return F.try_to_date(F.concat_ws("-", year, month_number(name).cast("string"), day), "yyyy-M-d")


def indonesian_date(text: Column) -> Column:
    """A date whose whole text is `13 Januari 2025`; anything else, or an impossible date, is NULL."""
    return _date_by(text, r"^\s*(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})\s*$")


def indonesian_date_within(text: Column) -> Column:
    """The first `dd month yyyy` found inside a longer text, e.g. `44 tahun/10 Januari 1980`."""
    return _date_by(text, r"(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})")


def add_months(day: dt.date, months: int) -> dt.date:
    """Driver-side month shift that clamps to the last day of the month, for literal bounds."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    next_first = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return dt.date(year, month + 1, min(day.day, (next_first - dt.timedelta(days=1)).day))


def first_month_on_or_after(day: dt.date) -> dt.date:
    """The earliest month start that is not before `day`."""
    first = day.replace(day=1)
    return first if first == day else add_months(first, 1)
