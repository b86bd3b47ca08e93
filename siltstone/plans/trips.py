"""Weekend-night taxi trips: ingest, cleaning, facts and zone flow marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.amounts import exact_mean, exact_sum
from ..functions.keys import with_md5_key
from ..operators.dedup import keep_earliest
from ..operators.frames import normalize_columns, rename_columns, require_columns
from ..sources.readers import check_taxi_type

# The columns that identify a trip.
TRIP_KEY = (
    "vendorid",
    "taxi_type",
    "pickup_datetime",
    "dropoff_datetime",
    "pulocationid",
    "dolocationid",
    "trip_distance",
    "payment_type",
    "total_amount",
)

# Raw names of the pickup and dropoff time per taxi type.
TIME_PREFIX = {"yellow": "tpep", "green": "lpep"}

# Payment codes.
PAYMENT_TYPES = (
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
)

# Friday to Sunday (Monday = 0) from six in the evening to midnight.
WEEKEND = (4, 5, 6)
NIGHT_FROM, NIGHT_TO = 18, 23

# The columns of a prepared trip.
TRIP_COLUMNS = (
    "md5_key",
    "taxi_type",
    "vendorid",
    "pickup_datetime",
    "dropoff_datetime",
    "pulocationid",
    "dolocationid",
    "payment_type",
    "passenger_count",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "trip_distance",
)


# ---- ingest ----------------------------------------------------------------------------------------


def is_weekend_night(pickup: Column, dropoff: Column) -> Column:
    """Picked up on a weekend evening; dropped off in the evening hours of whichever day."""
    return (
        F.weekday(pickup).isin(list(WEEKEND))
        & (F.hour(pickup) >= NIGHT_FROM)
        & F.hour(dropoff).between(NIGHT_FROM, NIGHT_TO)
    )


def weekend_night_trips(raw: DataFrame, taxi_type: str) -> DataFrame:
    """Distinct weekend-night rows of a raw month; no such row is a valid, empty result."""
    check_taxi_type(taxi_type)
    pickup, dropoff = (f"{TIME_PREFIX[taxi_type]}_{side}_datetime" for side in ("pickup", "dropoff"))
    require_columns(raw, [pickup, dropoff])
    return raw.where(is_weekend_night(F.col(pickup), F.col(dropoff))).distinct()


def ingest_trips(raw: DataFrame, taxi_type: str) -> DataFrame:
    """Weekend-night trips with unified column names, their taxi type and an integer payment type."""
    names = {
        f"{prefix}_{side}_datetime": f"{side}_datetime"
        for prefix in TIME_PREFIX.values()
        for side in ("pickup", "dropoff")
    }
    unified = rename_columns(normalize_columns(weekend_night_trips(raw, taxi_type)), names)
    return unified.withColumn("taxi_type", F.lit(taxi_type)).withColumn(
        "payment_type", F.round("payment_type").cast("bigint")
    )


def keyed_trips(ingested: DataFrame) -> DataFrame:
    return with_md5_key(ingested, TRIP_KEY)


# ---- preparation -----------------------------------------------------------------------------------


def union_trips(yellow: DataFrame, green: DataFrame) -> DataFrame:
    columns = [F.round("payment_type").cast("bigint").alias(c) if c == "payment_type" else F.col(c) for c in TRIP_COLUMNS]
    return yellow.select(*columns).unionByName(green.select(*columns))


def clean_trips(trips: DataFrame) -> DataFrame:
    """Positive distance, fare, total and passengers, and a dropoff after the pickup; NULL fails."""
    return trips.where(
        (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
        & (F.col("total_amount") > 0)
        & (F.col("passenger_count") > 0)
        & (F.col("pickup_datetime") < F.col("dropoff_datetime"))
    )


def dedup_trips(trips: DataFrame) -> DataFrame:
    return keep_earliest(trips, ["md5_key"], "pickup_datetime")


def prep_taxi_trip(yellow: DataFrame, green: DataFrame, run_date: dt.date) -> DataFrame:
    """Both types stacked, cleaned, then one row per key. Cleaning stays before the deduplication: the
    other order could keep an invalid row and lose the valid one."""
    return dedup_trips(clean_trips(union_trips(yellow, green))).withColumn("run_date_bq", F.lit(run_date))


# ---- model -----------------------------------------------------------------------------------------


def fact_taxi_trip(prep: DataFrame, run_date: dt.date) -> DataFrame:
    return prep.select(
        "md5_key",
        "taxi_type",
        "pickup_datetime",
        "dropoff_datetime",
        "pulocationid",
        "dolocationid",
        "passenger_count",
        F.col("payment_type").cast("bigint").alias("payment_type"),
        "fare_amount",
        "tip_amount",
        "total_amount",
        "trip_distance",
        F.lit(run_date).alias("run_date_bq"),
    )


def with_pickup_month(trips: DataFrame) -> DataFrame:
    """Add the month partition column; a trip's key contains its pickup time, so it never moves."""
    return trips.withColumn("pickup_month", F.trunc(F.to_date("pickup_datetime"), "MM"))


def dim_location(zones: DataFrame) -> DataFrame:
    return zones.select("locationid", "borough", "zone", "service_zone")


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAYMENT_TYPES, "payment_type bigint, payment_desc string")


# ---- marts -----------------------------------------------------------------------------------------


def in_holiday_hours(trips: DataFrame, holidays: DataFrame) -> DataFrame:
    """Trips picked up in an hour of the holiday calendar (a semi join on date and hour)."""
    calendar = holidays.select(F.col("date").alias("_date"), F.col("hour").alias("_hour"))
    pickup = F.col("pickup_datetime")
    return trips.join(
        calendar,
        (F.to_date(pickup) == F.col("_date")) & (F.hour(pickup).cast("bigint") == F.col("_hour")),
        "left_semi",
    )


def _zone(locations: DataFrame, side: str) -> DataFrame:
    return locations.select(F.col("locationid").alias(f"_{side}_id"), F.col("zone").alias(f"{side}_zone"))


def _flow_totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_trip"),
        exact_mean(F.col("total_amount")).alias("avg_total_amount"),
        exact_sum(F.col("total_amount")).alias("total_revenue"),
        exact_mean(F.col("trip_distance")).alias("avg_distance"),
    ]


def zone_flow(facts: DataFrame, locations: DataFrame, holidays: DataFrame, run_date: dt.date) -> DataFrame:
    """Trips, revenue and distance per date, hour, pickup zone and dropoff zone.

    Zone names are joined before the aggregation because the mart is keyed by name: two ids of one name,
    and all unknown ids, share a group.
    """
    pickup = F.col("pickup_datetime")
    return (
        in_holiday_hours(facts, holidays)
        .join(_zone(locations, "pickup"), F.col("pulocationid") == F.col("_pickup_id"), "left")
        .join(_zone(locations, "dropoff"), F.col("dolocationid") == F.col("_dropoff_id"), "left")
        .groupBy(
            F.to_date(pickup).alias("trip_date"), F.hour(pickup).cast("bigint").alias("trip_hour"), "pickup_zone", "dropoff_zone"
        )
        .agg(*_flow_totals())
        .withColumn("run_date_bq", F.lit(run_date))
    )


ZONE_FLOW_KEY = ["trip_date", "trip_hour", "pickup_zone", "dropoff_zone"]


def _weighted() -> list[Column]:
    trips = F.sum("total_trip")
    distance = exact_sum(F.col("avg_distance") * F.col("total_trip")).cast("double")
    revenue = F.sum("total_revenue")
    return [
        trips.alias("total_trip"),
        revenue.alias("total_revenue"),
        F.try_divide(revenue.cast("double"), trips.cast("double")).alias("avg_total_amount"),
        F.try_divide(distance, trips.cast("double")).alias("avg_distance"),
    ]


def holiday_daily(flow: DataFrame, run_date: dt.date) -> DataFrame:
    """Daily totals, means weighted by trips; a day without trips has NULL means."""
    return flow.groupBy("trip_date").agg(*_weighted()).withColumn("run_date_bq", F.lit(run_date))


def _summary(daily: DataFrame, labels: DataFrame, run_date: dt.date) -> DataFrame:
    joined = daily.join(labels, daily["trip_date"] == labels["date"], "left")
    return (
        joined.groupBy(
            F.year("trip_date").cast("bigint").alias("year"),
            F.month("trip_date").cast("bigint").alias("month"),
            "holiday_type",
        )
        .agg(*_weighted(), F.count_distinct("trip_date").alias("holiday_days"))
        .withColumn("run_date_bq", F.lit(run_date))
        .orderBy("year", "month", "holiday_type")
    )


def holiday_summary(daily: DataFrame, holidays: DataFrame, run_date: dt.date) -> DataFrame:
    """Totals per month and weekend day.

    The calendar has 24 rows per date, so trips and revenue come out 24-fold; means and the number of days
    are unaffected. `holiday_summary_by_date` joins each date once.
    """
    return _summary(daily, holidays.select("date", "holiday_type"), run_date)


def holiday_summary_by_date(daily: DataFrame, holidays: DataFrame, run_date: dt.date) -> DataFrame:
    return _summary(daily, holidays.select("date", "holiday_type").distinct(), run_date)


def trips_by_payment_type(facts: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Trips and revenue per payment description, reading the payment dimension beside the fact."""
    totals = facts.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("total_trip"), exact_sum(F.col("total_amount")).alias("total_revenue")
    )
    return totals.join(payment_types, "payment_type", "left").select(
        "payment_type", "payment_desc", "total_trip", "total_revenue"
    )
