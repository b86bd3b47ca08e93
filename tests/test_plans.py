from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from support import values
from pyspark.sql import functions as F

from siltstone.operators import calendars, incremental, merge
from siltstone.plans import checks, loans, movies, registry, trips

D, T = dt.date, dt.datetime
RUN = D(2024, 5, 1)

# ---- subscription video ----------------------------------------------------------------------------

PAYMENTS = (
    "payment_id long, user_id long, subscription_id long, amount decimal(10,2), payment_date timestamp_ntz, "
    "method string, status string, created_at timestamp_ntz, run_date_bq date"
)


def payment(number, subscription, day, status="completed", amount="10.00", created=None):
    at = T(day.year, day.month, day.day)
    return (number, 1, subscription, Decimal(amount), at, "card", status, created or at, day)


def test_subscription_months(spark):
    raw = spark.createDataFrame(
        [
            payment(1, 7, D(2024, 1, 5)),
            payment(2, 7, D(2024, 1, 20), "failed"),
            payment(3, 7, D(2024, 3, 1)),
            payment(4, 8, D(2024, 3, 2), "pending"),
            payment(4, 8, D(2024, 3, 2), "completed", created=T(2024, 3, 3)),
            payment(5, None, D(2024, 2, 2)),
        ],
        PAYMENTS,
    )
    facts = movies.fact_payments(movies.prep_payments(raw))
    assert facts.count() == 5
    mart = movies.mart_subscription_revenue(movies.subscription_revenue(facts))
    rows = {(r["subscription_id"], r["month_key"].month): r for r in mart.collect()}
    january = rows[(7, 1)]
    assert (january["total_amount"], january["total_payments"]) == (Decimal("20.00"), 2)
    assert (january["status_completed"], january["status_failed"], january["status_pending"]) == (1, 1, 0)
    assert january["subscription_month_key"] == "7_202401"
    assert (rows[(7, 3)]["total_active_users"], rows[(7, 3)]["new_users"]) == (2, 1)
    assert rows[(8, 3)]["status_completed"] == 1
    # A payment without a subscription is revenue, but nobody's activity.
    assert rows[(None, 2)]["total_active_users"] == 0 and rows[(None, 2)]["new_users"] == 0
    assert {r["churned_users"] for r in rows.values()} == {0}


def test_churn_is_the_month_after_the_last_payment(spark):
    raw = spark.createDataFrame(
        [payment(1, 7, D(2024, 1, 5)), payment(2, 8, D(2024, 1, 9)), payment(3, 8, D(2024, 2, 9)), payment(4, 9, D(2024, 3, 9))],
        PAYMENTS,
    )
    assert values(movies.subscription_churn(raw)) == [(D(2024, 2, 1), 1), (D(2024, 3, 1), 1)]


SESSIONS = (
    "session_id long, user_id long, movie_id long, device_type string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "completion_rate decimal(5,2), created_at timestamp_ntz, run_date_bq date"
)


def session(number, user, movie, start, minutes, rate="0.90"):
    return (number, user, movie, "tv", start, start + dt.timedelta(minutes=minutes), rate and Decimal(rate), start, start.date())


def sessions(spark):
    return spark.createDataFrame(
        [
            session(1, 1, 5, T(2024, 1, 1, 10), 30),
            session(2, 1, 5, T(2024, 1, 1, 20), 60, "0.84"),
            session(3, 2, 5, T(2024, 1, 2, 9), 10, None),
            session(4, 1, 5, T(2024, 1, 2, 9), 20),
            session(5, 1, 6, T(2024, 2, 2, 9), 20),
        ],
        SESSIONS,
    )


def test_movie_popularity(spark):
    activity = movies.fact_user_activity(movies.prep_watch_sessions(sessions(spark)))
    assert values(activity, "session_id", "completed_flag") == [(1, True), (2, False), (3, False), (4, True), (5, True)]
    daily = movies.fact_movie_popularity(activity)
    assert values(daily, "movie_id_date", "total_watch_count", "unique_viewers", "avg_watch_duration", "total_watch_time") == [
        ("5_20240101", 2, 1, 45.0, 90),
        ("5_20240102", 2, 2, 15.0, 30),
        ("6_20240202", 1, 1, 20.0, 20),
    ]
    # The roll-up adds daily viewers up and averages averages; the exact mart does not.
    assert values(movies.mart_movie_popularity(daily).where("movie_id = 5"), "unique_viewers", "avg_watch_duration") == [(3, 30.0)]
    assert values(movies.mart_movie_popularity_exact(activity).where("movie_id = 5"), "unique_viewers", "avg_watch_duration") == [
        (2, 30.0)
    ]
    users = movies.mart_user_activity(activity).where("user_id = 1 and month_key = '2024-01-01'").first()
    assert (users["total_sessions"], users["completed_sessions"], users["total_watch_time_minutes"]) == (3, 2, 110)


def test_incremental_equals_full_refresh_without_late_rows(spark):
    raw = sessions(spark)
    full = movies.fact_movie_popularity(movies.fact_user_activity(raw))
    early = raw.where("start_time < '2024-01-02'")
    target = movies.fact_movie_popularity(movies.fact_user_activity(early))
    fresh = incremental.since_event_date(raw, target, "start_time", "date_key")
    step = movies.fact_movie_popularity(movies.fact_user_activity(fresh))
    merged = merge.merge_upsert(target, step, movies.KEYS["fact_movie_popularity"])
    assert values(merged, *full.columns) == values(full)


def test_dim_users_keeps_users_without_subscription(spark):
    users = spark.createDataFrame(
        [(1, " ann lee ", " A@X.Y ", "id", "new-york", T(2024, 1, 1), "active", T(2024, 1, 1), RUN)] * 2
        + [(2, "b", "b", "c", "d", T(2024, 1, 1), "active", T(2024, 1, 1), RUN)],
        "user_id long, name string, email string, country string, city string, join_date timestamp_ntz, "
        "subscription_status string, created_at timestamp_ntz, run_date_bq date",
    )
    subscriptions = spark.createDataFrame([(1, 10), (1, 11)], "user_id long, subscription_id long")
    got = movies.dim_users(movies.prep_users(users), subscriptions)
    assert values(got, "user_id", "name", "email", "city", "subscription_id") == [
        (1, "Ann Lee", "a@x.y", "New-York", 10),
        (1, "Ann Lee", "a@x.y", "New-York", 11),
        (2, "B", "b", "D", None),
    ]


# ---- trips -----------------------------------------------------------------------------------------

RAW = (
    "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID long, "
    "DOLocationID long, payment_type double, passenger_count double, trip_distance double, fare_amount double, "
    "tip_amount double, total_amount double"
)


def raw_trip(pickup, dropoff, zone=1, payment=1.0, passengers=1.0, distance=2.0, fare=10.0, total=12.0):
    return (1, pickup, dropoff, zone, 2, payment, passengers, distance, fare, 2.0, total)


def test_weekend_nights(spark):
    friday = T(2024, 3, 1, 18)
    rows = [
        raw_trip(friday, friday + dt.timedelta(minutes=5)),
        raw_trip(friday, friday + dt.timedelta(minutes=5)),
        raw_trip(friday.replace(hour=17), friday),
        raw_trip(friday.replace(hour=23), friday + dt.timedelta(hours=6)),
        raw_trip(T(2024, 2, 29, 20), T(2024, 2, 29, 21)),
        # Dropped off in the evening of a later day: only the hour is tested.
        raw_trip(T(2024, 3, 3, 20), T(2024, 3, 5, 19), payment=None),
    ]
    raw = spark.createDataFrame(rows, RAW)
    lower = raw.toDF(*[c.lower() for c in raw.columns])
    got = trips.keyed_trips(trips.ingest_trips(lower, "yellow"))
    assert values(got, "taxi_type", "pickup_datetime", "payment_type") == [
        ("yellow", friday, 1),
        ("yellow", T(2024, 3, 3, 20), None),
    ]
    assert got.select("md5_key").distinct().count() == 2
    assert trips.ingest_trips(lower.where("false"), "yellow").count() == 0


def loaded(spark, rows, taxi_type):
    raw = spark.createDataFrame([r[:-1] for r in rows], RAW)
    keys = [r[-1] for r in rows]
    named = raw.toDF(*[c.lower().replace("tpep_", "") for c in raw.columns]).withColumn("taxi_type", F.lit(taxi_type))
    # Give each row its key by its distinct total.
    pairs = spark.createDataFrame([(r[10], k) for r, k in zip(rows, keys)], "total_amount double, md5_key string")
    return named.join(pairs, "total_amount")


def test_trip_chain(spark):
    saturday = T(2024, 3, 2, 20)
    later = saturday + dt.timedelta(minutes=10)
    yellow = loaded(
        spark,
        [
            (*raw_trip(saturday, later, zone=1, total=10.0), "a"),
            (*raw_trip(saturday + dt.timedelta(minutes=1), later, zone=1, total=11.0), "a"),
            (*raw_trip(saturday - dt.timedelta(hours=1), later, zone=1, total=12.0, distance=0.0), "a"),
            (*raw_trip(saturday, later, zone=99, total=13.0), "b"),
            (*raw_trip(later, saturday, total=14.0), "c"),
            (*raw_trip(saturday, later, passengers=None, total=15.0), "d"),
            (*raw_trip(T(2024, 3, 4, 20), T(2024, 3, 4, 21), total=16.0), "monday"),
        ],
        "yellow",
    )
    green = loaded(spark, [(*raw_trip(saturday, later, zone=1, total=20.0), "e")], "green")
    prep = trips.prep_taxi_trip(yellow, green, RUN)
    # Cleaning comes first: the earliest row of key a is invalid and does not win.
    assert values(prep, "md5_key", "total_amount") == [("a", 10.0), ("b", 13.0), ("e", 20.0), ("monday", 16.0)]
    zones = spark.createDataFrame(
        [(1, "B", "North", "s"), (2, "B", "South", "s")], "locationid long, borough string, zone string, service_zone string"
    )
    holidays = calendars.holiday_dimension(calendars.literal_bounds(spark, D(2024, 1, 1), D(2024, 12, 31)))
    flow = trips.zone_flow(trips.fact_taxi_trip(prep, RUN), zones, holidays, RUN)
    assert values(flow, "trip_date", "trip_hour", "pickup_zone", "dropoff_zone", "total_trip", "avg_total_amount") == [
        (D(2024, 3, 2), 20, "North", "South", 2, 15.0),
        (D(2024, 3, 2), 20, None, "South", 1, 13.0),
    ]
    daily = trips.holiday_daily(flow, RUN)
    assert values(daily, "total_trip", "total_revenue") == [(3, Decimal("43.00"))]
    inflated = trips.holiday_summary(daily, holidays, RUN).first()
    exact = trips.holiday_summary_by_date(daily, holidays, RUN).first()
    assert (inflated["total_trip"], exact["total_trip"]) == (72, 3)
    assert inflated["avg_total_amount"] == exact["avg_total_amount"]
    assert inflated["holiday_days"] == exact["holiday_days"] == 1
    # A flow with an unknown zone is inserted again by every merge, unless NULLs are taken as equal.
    assert merge.merge_upsert(flow, flow, trips.ZONE_FLOW_KEY).count() == 3
    assert merge.merge_upsert(flow, flow, trips.ZONE_FLOW_KEY, null_safe=True).count() == 2


def test_payment_types(spark):
    dim = trips.dim_payment_type(spark)
    assert values(dim)[0] == (0, "Flex Fare trip") and dim.count() == 7


# ---- loans -----------------------------------------------------------------------------------------


def test_loan_snapshots(spark):
    rows = [(1, p, f"{p + 1} Ribu") for p in range(10)]
    rows += [(2, p, "5") for p in range(9)]
    rows += [(3, p, "5") for p in range(10)] + [(3, 0, "5")]
    rows += [(4, p, "n/a" if p == 6 else "5") for p in range(10)]
    counters = spark.createDataFrame(rows, "snapshot_id long, position long, amount_text string")
    statistics = loans.loan_statistics(counters, RUN)
    assert values(statistics, "snapshot_id") == [(1,)]
    row = statistics.first()
    assert (row["penerima_dana_total"], row["dana_tersalurkan_total"], row["pemberi_dana_total"]) == (1000, 4000, 8000)
    assert values(loans.incomplete_snapshots(counters), "snapshot_id") == [(2,), (3,), (4,)]
    message = loans.daily_report(statistics).first()["message"]
    assert message == (
        "date 2024-05-01\n**Penerima Dana** - Posisi Akhir: 3,000\n**Pemberi Dana** - Posisi Akhir: 10,000"
        "\n**Dana Tersalurkan** - Posisi Akhir: 6,000"
    )


def test_suite_size():
    assert sum(map(len, checks.NOT_NULL.values())) == 92
    assert sum(map(len, checks.UNIQUE.values())) == 25
    assert len(checks.RELATIONSHIPS) == 10


@pytest.mark.parametrize("name", ["dq_unique", "dq_relationships"])
def test_quality_suite_removes_duplicates_once_per_source(spark, name):
    """Every key's window in the plan is one and the same, however many models read it."""
    df = registry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = set(re.findall(r"Window \[row_number\(\) windowspecdefinition\((\w+)#(\d+)", plan))
    assert windows
    assert len({key for key, _ in windows}) == len(windows)
    spark.catalog.clearCache()


def test_facts_of_unique_rows_have_no_window(spark):
    df = registry.queries()["mart_user_activity"](spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Window [row_number") == 1


def _dirty(spark, folder):
    """Session rows that come again with other users and times, references without parents, nulls."""
    n = F.col("id")
    null = F.lit(None).cast("long")
    customers = spark.range(20).select(
        n.alias("c_custkey"), F.concat(F.lit("c#"), (n % 15).cast("string")).alias("c_name"), (n % 3).cast("int").alias("c_nationkey"),
        (n - 5).cast("double").alias("c_acctbal"), F.lit("X").alias("c_mktsegment"),
    )
    day = F.timestamp_add("DAY", (n % 90).cast("int"), F.lit("1998-03-01").cast("timestamp_ntz"))
    tables = {
        "customer": customers.unionByName(customers.where("c_custkey = 3").withColumn("c_mktsegment", F.lit("Y"))),
        "nation": spark.range(3).select(n.cast("int").alias("n_nationkey"), F.concat(F.lit("N"), n.cast("string")).alias("n_name"), F.lit(0).alias("n_regionkey")),
        "region": spark.range(1).select(n.cast("int").alias("r_regionkey"), F.lit("R").alias("r_name")),
        "supplier": spark.range(5).select(n.alias("s_suppkey"), F.lit("s").alias("s_name"), (n % 3).cast("int").alias("s_nationkey"), F.lit(0.0).alias("s_acctbal")),
        "part": spark.range(12).select(n.alias("p_partkey"), F.when(n > 1, F.lit("p")).alias("p_name"), F.lit("B").alias("p_brand"), F.lit("T").alias("p_type"), n.cast("int").alias("p_size"), F.lit(1.0).alias("p_retailprice")),
        "orders": spark.range(60).select(
            (n % 50).alias("o_orderkey"), F.when(n % 7 == 0, null).otherwise(n % 24).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            F.lit(5.0).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("1").alias("o_orderpriority"),
        ),
        "lineitem": spark.range(400).select(
            (n % 50).alias("l_orderkey"), F.when(n % 11 == 0, null).otherwise(n % 14).alias("l_partkey"), (n % 5).alias("l_suppkey"), (n % 6).cast("int").alias("l_linenumber"),
            (n % 40 + 1).cast("double").alias("l_quantity"), F.lit(10.0).alias("l_extendedprice"), F.lit(0.05).alias("l_discount"), F.lit(0.0).alias("l_tax"),
            F.lit("N").alias("l_returnflag"), F.when(n % 2 == 0, "O").otherwise("F").alias("l_linestatus"), F.when(n % 13 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(day).alias("l_shipdate"),
        ),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_suites_report_of_narrow_models_as_of_whole_ones(spark, tmp_path):
    folder = _dirty(spark, str(tmp_path))
    whole = registry.Warehouse(spark, folder)
    columns = ["table", "check", "column", "violations"]
    old = checks.quality.report(*[checks.quality.relationships(whole.model(c), c, k, whole.model(p), x) for c, k, p, x in checks.RELATIONSHIPS])
    for name, want in (("dq_not_null", checks.not_null_report(whole.model)), ("dq_unique", checks.unique_report(whole.model)), ("dq_relationships", old)):
        found = values(registry.queries()[name](spark, folder), *columns)
        assert found == values(want, *columns)
        assert any(r[3] > 0 for r in found)
    spark.catalog.clearCache()


def test_relationships_read_each_child_once_and_keep_no_frame(spark):
    plan = registry.queries()["dq_relationships"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan
    assert plan.count("Window [row_number()") == 5


@pytest.mark.parametrize("name", ["dq_not_null", "dq_unique"])
def test_suites_leave_unread_columns_behind(spark, name):
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number()" in line and "session_id#" in line]
    assert windows and not any("end_time" in w or "completion_rate" in w for w in windows)
    assert name == "dq_unique" or "InMemoryRelation [session_id" not in plan
    spark.catalog.clearCache()
