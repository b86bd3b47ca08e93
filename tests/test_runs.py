from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from support import values

from siltstone.operators import quality
from siltstone.plans import checks, movies, runs, trips
from siltstone.sources import writers

D, T = dt.date, dt.datetime


def sessions(spark):
    """Loaded over three days; the last load brings late rows for earlier days and a newer and an older version."""
    rows = []
    for n in range(40):
        at = T(2024, 1 + n % 3, 1 + n % 25, n % 24)
        load = D(2024, 4, 1) if n < 25 else D(2024, 4, 2) if n < 33 else D(2024, 4, 3)
        rows.append((n, n % 5, n % 4, "tv", at, at + dt.timedelta(minutes=20 + n), 0.5 + n % 2 / 2, at, load))
    rows.append((3, 3, 3, "phone", T(2024, 3, 9), T(2024, 3, 9, 1), 1.0, T(2024, 3, 9), D(2024, 4, 3)))
    rows.append((4, 4, 0, "old", T(2023, 1, 1), T(2023, 1, 1, 1), 1.0, T(2023, 1, 1), D(2024, 4, 3)))
    return spark.createDataFrame(
        rows,
        "session_id long, user_id long, movie_id long, device_type string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "completion_rate double, created_at timestamp_ntz, run_date_bq date",
    )


def payments(spark):
    rows = []
    for n in range(30):
        at = T(2024, 1 + n % 4, 1 + n % 20)
        load = D(2024, 5, 1) if n < 20 else D(2024, 5, 2)
        rows.append((n, n % 7, n % 7, Decimal(n), at, "card", ("completed", "failed")[n % 2], at, load))
    rows.append((100, 1, 6, Decimal(5), T(2023, 12, 31), "card", "completed", T(2023, 12, 31), D(2024, 5, 2)))
    return spark.createDataFrame(
        rows,
        "payment_id long, user_id long, subscription_id long, amount decimal(10,2), payment_date timestamp_ntz, method string, "
        "status string, created_at timestamp_ntz, run_date_bq date",
    )


def trip_rows(spark):
    rows = []
    for n in range(20):
        at = T(2024, 1 + n % 3, 3, 19)
        rows.append((f"k{n % 15}", "yellow", 1, at, at + dt.timedelta(minutes=9), 1, 2, 1, 1.0, 9.0, 1.0, 10.0, 2.0, D(2024, 4, 1) if n < 12 else D(2024, 4, 2)))
    return spark.createDataFrame(
        rows,
        "md5_key string, taxi_type string, vendorid long, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, pulocationid long, "
        "dolocationid long, payment_type long, passenger_count double, fare_amount double, tip_amount double, total_amount double, "
        "trip_distance double, run_date_bq date",
    )


def source_of(spark, name):
    if "taxi" in name:
        return trip_rows(spark) if name == "prep_taxi_trip" else trips.dedup_trips(trip_rows(spark))
    if "payments" in name or "revenue" in name:
        return payments(spark) if name == "prep_payments" else movies.fact_payments(payments(spark)).withColumn("created_at", F.lit(None)) if "mart" in name else movies.prep_payments(payments(spark))
    if name == "prep_watch_sessions":
        return sessions(spark)
    if name == "fact_user_activity":
        return movies.prep_watch_sessions(sessions(spark))
    activity = movies.fact_user_activity(movies.prep_watch_sessions(sessions(spark)))
    return movies.fact_movie_popularity(activity) if name == "mart_movie_popularity_monthly" else activity


ALIKE = ("prep_subscriptions", "prep_ratings", "fact_ratings", "mart_movie_rating_monthly")
NAMES = [n for n, m in runs.MODELS.items() if m.rule not in ("table", "all") and n not in ALIKE]


@pytest.mark.parametrize("name", NAMES)
def test_steps_give_the_full_refresh(spark, tmp_path, name):
    """Two loads and a repeated one under the fixed rule, late rows included, against one load of everything."""
    source = source_of(spark, name)
    loads = [r[0] for r in source.select("run_date_bq").distinct().orderBy("run_date_bq").collect()]
    steps, whole = f"steps_{name}", f"whole_{name}"
    for load in [*loads, loads[-1]]:
        runs.run(name, source.where(F.col("run_date_bq") <= F.lit(load)), steps, str(tmp_path / "steps"), fixed=True)
    runs.run(name, source, whole, str(tmp_path / "whole"), full_refresh=True)
    # A trip that is delivered again keeps its values and gets the later load date.
    columns = [c for c in spark.table(whole).columns if c != "run_date_bq" or "taxi" not in name]
    assert values(spark.table(steps), *columns) == values(spark.table(whole), *columns)
    assert spark.table(steps).count() > 0


def test_declared_rule_skips_late_rows(spark, tmp_path):
    source = source_of(spark, "fact_payments")
    for load in (D(2024, 5, 1), D(2024, 5, 2)):
        runs.run("fact_payments", source.where(F.col("run_date_bq") <= F.lit(load)), "declared_payments", str(tmp_path / "t"))
    assert spark.table("declared_payments").where("payment_id = 100").count() == 0


def test_partitions_and_clustering_are_those_declared(spark, tmp_path):
    runs.run("prep_taxi_trip", trip_rows(spark), "declared_trips", str(tmp_path / "t"))
    assert [c.name for c in spark.catalog.listColumns("declared_trips") if c.isPartition] == ["pickup_month"]


def files_of(spark, table):
    """Files of a table with the time they were written."""
    return {f: os.stat(f.removeprefix("file:")).st_mtime_ns for f in (r[0] for r in spark.table(table).select("_metadata.file_path").distinct().collect())}


def test_a_run_rewrites_only_the_months_it_touches(spark, tmp_path):
    table, root = "touched_trips", str(tmp_path / "t")
    # Loads on or after the last one are read again: those are March's.
    rows = trip_rows(spark).withColumn("run_date_bq", F.make_date(F.lit(2024), F.lit(4), F.month("pickup_datetime")))
    runs.run("prep_taxi_trip", rows, table, root, fixed=True)
    before, n = files_of(spark, table), spark.table(table).count()
    march = rows.where("month(pickup_datetime) = 3").withColumn("md5_key", F.concat("md5_key", F.lit("new"))).withColumn("run_date_bq", F.lit(D(2024, 4, 9)))
    runs.run("prep_taxi_trip", rows.unionByName(march), table, root, fixed=True)
    after = files_of(spark, table)
    kept = {f for f in before if after.get(f) == before[f]}
    assert {f.split("pickup_month=")[1][:7] for f in kept} == {"2024-01", "2024-02"}
    assert {f.split("pickup_month=")[1][:7] for f in set(after) - kept} == {"2024-03"}
    assert spark.table(table).count() == n + march.select("md5_key").distinct().count()


def zone_tables(spark):
    locations = spark.createDataFrame([(1, "East"), (2, "West")], "locationid long, zone string")
    days = [(D(2024, m, 3), h, "Sunday") for m in (1, 2, 3) for h in range(24)]
    return {"locations": locations, "holidays": spark.createDataFrame(days, "date date, hour long, holiday_type string")}


def test_zone_flow_is_kept_by_day(spark, tmp_path):
    """Unknown zones are part of the key: the declared merge repeats their rows, the complete one does not."""
    facts = trips.dedup_trips(trip_rows(spark)).withColumn("pulocationid", F.when(F.month("pickup_datetime") < 3, F.col("pulocationid")).otherwise(F.lit(99)))
    name, sides = "mart_taxi_trip_holiday_zone_flow", zone_tables(spark)
    first = facts.where("run_date_bq = date '2024-04-01'")
    for _ in range(2):
        runs.run(name, first, "flow_steps", str(tmp_path / "a"), fixed=True, **sides)
    runs.run(name, facts, "flow_steps", str(tmp_path / "a"), fixed=True, **sides)
    runs.run(name, facts, "flow_whole", str(tmp_path / "b"), full_refresh=True, **sides)
    columns = [c for c in spark.table("flow_whole").columns if c != "run_date_bq"]
    assert values(spark.table("flow_steps"), *columns) == values(spark.table("flow_whole"), *columns)
    assert [c.name for c in spark.catalog.listColumns("flow_whole") if c.isPartition] == ["trip_date"]
    assert spark.table("flow_whole").where("pickup_zone is null").count() == 1
    runs.run(name, facts, "flow_whole", str(tmp_path / "b"), **sides)
    assert spark.table("flow_whole").where("pickup_zone is null").count() == 2


def test_table_models_are_built_anew(spark, tmp_path):
    facts, sides = trips.dedup_trips(trip_rows(spark)), zone_tables(spark)
    runs.run("mart_taxi_trip_holiday_zone_flow", facts, "tm_flow", str(tmp_path / "f"), **sides)
    for _ in range(2):
        runs.run("mart_taxi_trip_holiday_daily", spark.table("tm_flow"), "tm_daily", str(tmp_path / "d"))
        runs.run("mart_taxi_trip_holiday_summary", spark.table("tm_daily"), "tm_summary", str(tmp_path / "s"), holidays=sides["holidays"])
    run_date = facts.agg(F.max("run_date_bq")).first()[0]
    daily = trips.holiday_daily(trips.zone_flow(facts, sides["locations"], sides["holidays"], run_date), run_date)
    assert values(spark.table("tm_daily")) == values(daily)
    assert values(spark.table("tm_summary")) == values(trips.holiday_summary(daily, sides["holidays"], run_date))
    with pytest.raises(ValueError, match="holidays"):
        runs.run("mart_taxi_trip_holiday_summary", spark.table("tm_daily"), "tm_summary", str(tmp_path / "s"))


def test_every_reference_model_is_declared():
    """Names of the models: fixed values."""
    assert set(runs.MODELS) == {
        "prep_users", "prep_movies", "prep_subscriptions", "prep_watch_sessions", "prep_payments", "prep_ratings", "prep_taxi_trip",
        "dim_movies", "dim_subscriptions", "dim_users", "dim_location",
        "fact_user_activity", "fact_payments", "fact_ratings", "fact_movie_popularity", "fact_taxi_trip",
        "mart_movie_popularity_monthly", "mart_movie_rating_monthly", "mart_user_activity_monthly", "mart_subscription_revenue_monthly",
        "mart_taxi_trip_holiday_zone_flow", "mart_taxi_trip_holiday_daily", "mart_taxi_trip_holiday_summary",
    }


def test_trailing_window_needs_its_date(spark, tmp_path):
    source = source_of(spark, "mart_user_activity_monthly")
    runs.run("mart_user_activity_monthly", source, "dated", str(tmp_path / "t"), full_refresh=True)
    with pytest.raises(ValueError, match="as_of"):
        runs.run("mart_user_activity_monthly", source, "dated", str(tmp_path / "t"))


def test_checks_are_counted_while_rows_are_written(spark, tmp_path):
    """The runs' reports, added up, are the report over the whole table; a check with a range counts like the scan."""
    source, root, reports = payments(spark), str(tmp_path / "t"), str(tmp_path / "r")
    source = source.withColumn("method", F.when(F.col("payment_id") % 4 > 0, F.col("method"))).withColumn("user_id", F.when(F.col("payment_id") % 9 > 0, F.col("user_id")))
    for load in (D(2024, 5, 1), D(2024, 5, 2)):
        runs.run("prep_payments", source.where(F.col("run_date_bq") == F.lit(load)), "checked_payments", root, reports=reports)
    merged = quality.merged_reports(spark.read.parquet(reports))
    table = spark.table("checked_payments")
    want = quality.not_null(table, "checked_payments", checks.NOT_NULL["prep_payments"])
    assert values(merged.drop("checked")) == values(want)
    assert {r["checked"] for r in merged.collect()} == {table.count()}
    assert any(r["violations"] for r in merged.collect())
    valid, accepted = {"amount": F.col("amount") > 10}, {"status": ["completed"]}
    report = writers.materialize(table, "checked_copy", str(tmp_path / "c"), ["payment_id"], checks=quality.failing(accepted=accepted, valid=valid))
    scanned = quality.accepted_values(table, "checked_copy", accepted).unionByName(quality.in_range(table, "checked_copy", valid))
    assert values(report.drop("checked")) == values(scanned)
    assert values(spark.table("checked_copy")) == values(table)
