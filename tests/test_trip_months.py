from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from support import values

from siltstone.sources import trip_months

MONTHS = [f"2024-{m:02d}" for m in range(1, 7)]
STRAY = dt.datetime(2024, 2, 9, 3)


def trips(month, hours):
    first = dt.datetime.fromisoformat(f"{month}-01")
    return [first + dt.timedelta(hours=h) for h in hours]


@pytest.fixture
def folder(tmp_path):
    """Six months of yellow trips, ten a file; April also holds a trip of February, and lacks a column."""
    for n, month in enumerate(MONTHS):
        times = trips(month, range(0, 300, 30)) + ([STRAY] if month == "2024-04" else [])
        columns = {"VendorID": pa.array([n] * len(times), pa.int64()), "tpep_pickup_datetime": pa.array(times, pa.timestamp("us"))}
        if month != "2024-04":
            columns["Fee"] = pa.array([1.5] * len(times))
        pq.write_table(pa.table(columns), tmp_path / f"yellow_tripdata_{month}.parquet", row_group_size=5 if month == "2024-04" else 4)
    pq.write_table(pa.table({"lpep_pickup_datetime": pa.array([], pa.timestamp("us"))}), tmp_path / "green_tripdata_2024-01.parquet")
    (tmp_path / "yellow_tripdata_2024-13.parquet").write_text("no month")
    (tmp_path / "notes.txt").write_text("no trips")
    return str(tmp_path)


def reader(folder, **options):
    source = trip_months.TripMonths({"path": folder, "type": "yellow"} | options)
    return source.reader(source.schema())


def opened(folder, filters=(), **options):
    one = reader(folder, **options)
    assert list(one.pushFilters(list(filters))) == list(filters)
    return [(p.month, p.groups) for p in one.partitions()]


def test_all_months(spark, folder):
    df = trip_months.read_trip_months(spark, folder, "yellow")
    assert df.dtypes == [("vendorid", "bigint"), ("tpep_pickup_datetime", "timestamp_ntz"), ("fee", "double")]
    assert df.count() == 61
    assert df.where("fee IS NULL").count() == 11
    assert df.where("vendorid = 3").count() == 11


def test_equals_spark_reader(spark, folder):
    df = trip_months.read_trip_months(spark, folder, "yellow").drop("fee")
    plain = [spark.read.parquet(f"{folder}/yellow_tripdata_{m}.parquet").select("VendorID", "tpep_pickup_datetime") for m in MONTHS]
    want = plain[0]
    for other in plain[1:]:
        want = want.unionAll(other)
    assert values(df) == values(want)


def test_months_by_name(spark, folder):
    assert values(trip_months.read_trip_months(spark, folder, "yellow", "2024-02", "2024-03").select("vendorid").distinct()) == [(1,), (2,)]


def test_filter_opens_only_its_months(spark, folder):
    """March alone for March; for February also the file with the stray trip, and the trip is found."""
    pickup = ("tpep_pickup_datetime",)
    march = [trip_months.GreaterThanOrEqual(pickup, dt.datetime(2024, 3, 1)), trip_months.LessThan(pickup, dt.datetime(2024, 4, 1))]
    assert opened(folder, march) == [("2024-03", (0, 1, 2))]
    late = [trip_months.GreaterThan(pickup, dt.datetime(2024, 3, 11)), march[1]]
    assert opened(folder, late) == [("2024-03", (2,))]
    february = [trip_months.GreaterThanOrEqual(pickup, dt.datetime(2024, 2, 1)), trip_months.LessThan(pickup, dt.datetime(2024, 3, 1))]
    assert [m for m, _ in opened(folder, february)] == ["2024-02", "2024-04"]
    assert opened(folder, [trip_months.EqualTo(pickup, dt.datetime(2023, 1, 1))]) == [("", ())]
    assert opened(folder, [trip_months.In(pickup, (dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2)))]) == [("2024-05", (0,))]
    assert len(opened(folder, [trip_months.EqualTo(pickup, "2024-03-01")])) == 6
    df = trip_months.read_trip_months(spark, folder, "yellow")
    picked = df.where((F.col("tpep_pickup_datetime") >= F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")) & (F.col("tpep_pickup_datetime") < F.lit(dt.datetime(2024, 3, 1)).cast("timestamp_ntz")))
    assert picked.rdd.getNumPartitions() == 2
    assert picked.count() == 11
    none = df.where(F.col("tpep_pickup_datetime") > F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz"))
    assert none.count() == 0


def test_hot_month_is_split(folder):
    assert [g for m, g in opened(folder, split_bytes="1") if m == "2024-01"] == [(0,), (1,), (2,)]


def test_declared_schema(spark, folder):
    trip_months.register(spark)
    df = spark.read.format("trips").schema("fee double, other string").option("path", folder).option("type", "yellow").load()
    assert values(df.groupBy("fee", "other").count()) == [(1.5, None, 50), (None, None, 11)]


def test_empty_month(spark, folder):
    assert trip_months.read_trip_months(spark, folder, "green").count() == 0


def test_refused(spark, folder):
    with pytest.raises(ValueError):
        trip_months.read_trip_months(spark, folder, "blue")
    with pytest.raises(PySparkException, match="no yellow month"):
        trip_months.read_trip_months(spark, folder, "yellow", first="2030-01")
    with pytest.raises(PySparkException, match="option 'path'"):
        spark.read.format("trips").option("type", "yellow").load()
