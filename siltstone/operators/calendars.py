"""Calendar dimensions.

Bounds come as a one-row frame (first_day, last_day), so a range can be given literally or derived from
the facts it has to cover.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Days that count as weekend (Sunday = 1) and their labels.
WEEKEND_LABELS = {6: "Friday", 7: "Saturday", 1: "Sunday"}

# Default ranges.
DATE_DIMENSION_START = dt.date(1970, 1, 1)
DATE_DIMENSION_DAYS = 3650
HOLIDAY_START = dt.date(2023, 1, 1)


def literal_bounds(spark: SparkSession, first_day: dt.date, last_day: dt.date) -> DataFrame:
    return spark.range(1).select(F.lit(first_day).alias("first_day"), F.lit(last_day).alias("last_day"))


def default_date_bounds(spark: SparkSession) -> DataFrame:
    return literal_bounds(spark, DATE_DIMENSION_START, DATE_DIMENSION_START + dt.timedelta(days=DATE_DIMENSION_DAYS))


def default_holiday_bounds(spark: SparkSession, as_of: dt.date) -> DataFrame:
    """From the start of the trip history to the end of the year of `as_of`."""
    return literal_bounds(spark, HOLIDAY_START, dt.date(as_of.year, 12, 31))


def bounds_of(facts: DataFrame, column: str, whole_years: bool = False) -> DataFrame:
    """The range of dates in a fact column, optionally widened to the end of the last year."""
    last = F.to_date(F.max(column))
    if whole_years:
        last = F.make_date(F.year(last), F.lit(12), F.lit(31))
    return facts.agg(F.to_date(F.min(column)).alias("first_day"), last.alias("last_day"))


def _days(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date"))


def date_dimension(bounds: DataFrame) -> DataFrame:
    """One row per day with its calendar attributes; day_of_week has Sunday = 1."""
    day = F.col("date")
    return _days(bounds).select(
        day.alias("date_key"),
        day.alias("full_date"),
        F.dayofweek(day).cast("bigint").alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.month(day).cast("bigint").alias("month"),
        F.date_format(day, "MMM").alias("month_name"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.year(day).cast("bigint").alias("year"),
    )


def weekend_days(bounds: DataFrame) -> DataFrame:
    """The Fridays, Saturdays and Sundays of a range with their label."""
    day_of_week = F.dayofweek("date")
    labels = F.create_map(*[F.lit(x) for pair in WEEKEND_LABELS.items() for x in pair])
    return (
        _days(bounds)
        .where(day_of_week.isin(list(WEEKEND_LABELS)))
        .select("date", F.element_at(labels, day_of_week).alias("holiday_type"))
    )


def holiday_dimension(bounds: DataFrame) -> DataFrame:
    """Every hour of every weekend day. Hours are generated per row, so no cross join is planned."""
    hours = weekend_days(bounds).select("date", "holiday_type", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
    midnight = F.col("date").cast("timestamp_ntz")
    return hours.select(
        "date",
        "holiday_type",
        F.col("h").cast("bigint").alias("hour"),
        (midnight + F.make_dt_interval(F.lit(0), F.col("h"))).alias("holiday_hour"),
    )
