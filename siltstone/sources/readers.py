"""Batch readers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.frames import normalize_columns

# The taxi types the trip source serves.
TAXI_TYPES = ("yellow", "green")


def check_taxi_type(taxi_type: str) -> None:
    if taxi_type not in TAXI_TYPES:
        raise ValueError(f"taxi_type must be one of {TAXI_TYPES}, not {taxi_type!r}")


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_trips(spark: SparkSession, root: str, taxi_type: str, year: int, month: int) -> DataFrame:
    """One month of raw trips of one type, column names in lower case."""
    check_taxi_type(taxi_type)
    return lower_names(spark.read.parquet(f"{root}/{taxi_type}_tripdata_{year}-{month:02d}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Give a schema for large inputs: inferring one reads the files twice."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Taxi zone lookup, column names normalised."""
    schema = T.StructType(
        [
            T.StructField("LocationID", T.LongType()),
            T.StructField("Borough", T.StringType()),
            T.StructField("Zone", T.StringType()),
            T.StructField("service_zone", T.StringType()),
        ]
    )
    return normalize_columns(read_csv(spark, path, schema))


def month_slice(df: DataFrame, year_column: str, month_column: str, year: int, month: int) -> DataFrame:
    """Rows of one month by a year and a month column; prunes directories partitioned by them."""
    return df.where((F.col(year_column) == year) & (F.col(month_column) == month))


def read_csv_month(
    spark: SparkSession,
    path: str,
    year_column: str,
    month_column: str,
    year: int,
    month: int,
    schema: T.StructType | None = None,
) -> DataFrame:
    return month_slice(read_csv(spark, path, schema), year_column, month_column, year, month)


def read_with_schema(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet") -> DataFrame:
    """Files under an explicit schema: extra columns are not read, missing ones are NULL."""
    if file_format == "parquet":
        return spark.read.schema(schema).parquet(path)
    if file_format == "csv":
        # Columns are found by header name: with a declared schema Spark would take them by position.
        # Only the requested columns are kept, as text first, so one bad cell is one NULL.
        text = spark.read.option("header", True).csv(path)
        return text.select(
            *[
                (F.col(f.name).try_cast(f.dataType) if f.name in text.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema
            ]
        )
    raise ValueError("file_format must be 'parquet' or 'csv'")


def day_slices(column: str, first: dt.date, last: dt.date) -> list[str]:
    """One predicate per day, so that a JDBC extract reads days in parallel and in index ranges."""
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    return [f"{column} >= '{d}' AND {column} < '{d + dt.timedelta(days=1)}'" for d in days]


def read_relational(
    spark: SparkSession, url: str, table: str, predicates: list[str], properties: Mapping[str, str]
) -> DataFrame:
    """Relational extract, one task per predicate."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=dict(properties))
