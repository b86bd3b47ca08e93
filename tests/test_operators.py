from __future__ import annotations

import datetime as dt

import pytest
from support import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import calendars, dedup, frames, incremental, merge, quality


# ---- frames ----------------------------------------------------------------------------------------


def test_column_names(spark):
    rows = spark.createDataFrame([(1, 2)], [" First Col ", "B"])
    assert frames.normalize_columns(rows).columns == ["first_col", "b"]
    assert frames.rename_columns(rows, {"B": "b", "absent": "x"}).columns == [" First Col ", "b"]
    with pytest.raises(ValueError):
        frames.normalize_columns(spark.createDataFrame([(1, 2)], ["a b", "A B"]))
    with pytest.raises(frames.MissingColumnsError):
        frames.select_required(rows, ["absent"])


def test_expand_datetime(spark):
    rows = spark.createDataFrame([("2024-03-02 23:10:00",), ("bad",)], "t string")
    got = frames.expand_datetime(rows, "t").orderBy(F.col("t").asc_nulls_last()).collect()
    assert tuple(got[0])[1:] == (2024, 3, 2, 23, 5)
    assert tuple(got[1]) == (None,) * 6
    with pytest.raises(ValueError):
        frames.check_readable(rows.where("t = 'bad'"), "t")
    frames.check_readable(rows, "t")
    frames.check_readable(rows.where("t = 'none'"), "t")
    assert frames.expand_datetime(rows.where("t = 'none'"), "t").count() == 0


def test_align_to_schema_coerces(spark):
    rows = spark.createDataFrame(
        [("12", "1.005", "2024-01-05", "true", "x"), ("12.7", "abc", "no", None, None), (None, None, None, "false", "y")],
        "i string, d string, t string, b string, s string",
    )
    schema = T.StructType(
        [
            T.StructField("i", T.LongType()),
            T.StructField("d", T.DecimalType(38, 2)),
            T.StructField("t", T.DateType()),
            T.StructField("b", T.BooleanType()),
            T.StructField("s", T.StringType()),
            T.StructField("absent", T.LongType()),
        ]
    )
    got = frames.align_to_schema(rows, schema)
    assert got.columns == ["i", "d", "t", "b", "s"]
    from decimal import Decimal

    assert [tuple(r) for r in got.collect()] == [
        (12, Decimal("1.01"), dt.date(2024, 1, 5), True, "x"),
        (None, None, None, None, None),
        (None, None, None, False, "y"),
    ]


def test_cast_dates_and_integers_leaves_the_rest(spark):
    rows = spark.createDataFrame([("7", "2024-01-05", "1.5")], "i string, t string, d string")
    schema = T.StructType(
        [T.StructField("i", T.LongType()), T.StructField("t", T.DateType()), T.StructField("d", T.DoubleType())]
    )
    assert tuple(frames.cast_dates_and_integers(rows, schema).first()) == (7, dt.date(2024, 1, 5), "1.5")


# ---- dedup -----------------------------------------------------------------------------------------


def test_dedup_is_repeatable_and_skew_safe(spark):
    rows = spark.createDataFrame(
        [(1, 10, "b"), (1, 10, "a"), (1, 9, "c"), (2, None, "x"), (2, 1, "y"), (None, 1, "n")], "k long, t long, v string"
    )
    assert values(dedup.keep_latest(rows, ["k"], "t")) == [(1, 10, "a"), (2, 1, "y"), (None, 1, "n")]
    assert values(dedup.keep_earliest(rows, ["k"], "t")) == [(1, 9, "c"), (2, None, "x"), (None, 1, "n")]
    plan = dedup.keep_latest(rows, ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    # One limit below the exchange, so that a hot key sends one row per task, and one above it.
    assert plan.count("WindowGroupLimit") == 2


# ---- merge -----------------------------------------------------------------------------------------

SCHEMA = "k long, v string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "B"), (3, "C"), (None, "m")], SCHEMA)


def test_merge_upsert(target, source):
    merged = merge.merge_upsert(target, source, ["k"])
    assert values(merged) == [(1, "a"), (2, "B"), (3, "C"), (None, "m"), (None, "n")]
    safe = merge.merge_upsert(target, source, ["k"], null_safe=True)
    assert values(safe) == [(1, "a"), (2, "B"), (3, "C"), (None, "m")]


def test_merge_is_idempotent(target, source):
    complete = source.where("k is not null")
    once = merge.merge_upsert(target, complete, ["k"])
    assert values(merge.merge_upsert(once, complete, ["k"])) == values(once)


def test_merge_rejects_repeated_source_keys(spark, target):
    twice = spark.createDataFrame([(2, "x"), (2, "y")], SCHEMA)
    with pytest.raises(merge.DuplicateKeyError):
        merge.merge_upsert(target, twice, ["k"])


def test_merge_newer_by(spark):
    target = spark.createDataFrame([(1, 5, "old"), (2, 5, "old")], "k long, t long, v string")
    source = spark.createDataFrame([(1, 4, "late"), (2, 6, "new"), (3, 1, "ins")], "k long, t long, v string")
    assert values(merge.merge_upsert(target, source, ["k"], newer_by="t")) == [
        (1, 5, "old"),
        (2, 6, "new"),
        (3, 1, "ins"),
    ]


def test_insert_modes(spark, target, source):
    with pytest.raises(merge.DuplicateKeyError):
        merge.insert_strict(target, source, ["k"])
    assert values(merge.insert_strict(target, source.where("k = 3"), ["k"])) == [(1, "a"), (2, "b"), (3, "C"), (None, "n")]
    rows = spark.createDataFrame([(2, "B"), (3, "z"), (3, "C"), (None, "m")], SCHEMA)
    assert values(merge.insert_ignore(target, rows, ["k"], [F.col("v").asc()])) == [
        (1, "a"),
        (2, "b"),
        (3, "C"),
        (None, "m"),
        (None, "n"),
    ]


def test_upsert_keep(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    new = spark.createDataFrame([(2, "B"), (3, "C")], SCHEMA)
    assert values(merge.upsert_keep(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert values(merge.upsert_keep(old, new, ["k"], keep="first")) == [(1, "a"), (2, "b"), (3, "C")]
    with pytest.raises(ValueError):
        merge.upsert_keep(old, new, ["k"], keep="any")


def test_delete_where_keeps_unknown(target):
    assert values(merge.delete_where(target, "k > 1")) == [(1, "a"), (None, "n")]


def test_cascade_prune(spark):
    parents = spark.createDataFrame([(1,)], "id long")
    children = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "p long, v string")
    assert values(merge.cascade_prune(children, parents, "p", "id")) == [(1, "a"), (None, "c")]


# ---- incremental -----------------------------------------------------------------------------------


def test_since_mark(spark):
    d = dt.date
    source = spark.createDataFrame([(d(2024, 1, 1),), (d(2024, 1, 2),), (d(2024, 1, 3),)], "run date")
    target = source.where("run < '2024-01-03'")
    assert values(incremental.since_mark(source, target, "run")) == [(d(2024, 1, 3),)]
    assert incremental.since_mark(source, target, "run", inclusive=True).count() == 2
    empty = target.where("false")
    assert incremental.since_mark(source, empty, "run").count() == 0
    assert incremental.since_mark(source, empty, "run", empty_loads_all=True).count() == 3


def test_since_event_date_misses_late_rows_of_the_marked_day(spark):
    t = dt.datetime
    source = spark.createDataFrame([(t(2024, 1, 2, 23),), (t(2024, 1, 3),)], "at timestamp_ntz")
    target = spark.createDataFrame([(dt.date(2024, 1, 2),)], "date_key date")
    assert values(incremental.since_event_date(source, target, "at", "date_key")) == [(t(2024, 1, 3),)]
    assert incremental.since_event_date(source, target, "at", "date_key", inclusive=True).count() == 2


def test_lookback_months(spark):
    t = dt.datetime
    target = spark.createDataFrame([(t(2024, 3, 20),)], "at timestamp_ntz")
    assert incremental.lookback_bound(target, "at") == dt.date(2024, 1, 1)
    assert incremental.lookback_bound(target.where("false"), "at") == dt.date(2022, 11, 1)


def test_trailing_months_compares_month_starts(spark):
    days = spark.createDataFrame([(dt.date(2024, 4, 30),), (dt.date(2024, 5, 1),), (dt.date(2024, 6, 2),)], "d date")
    for as_of in (dt.date(2024, 6, 1), dt.date(2024, 6, 15)):
        kept = incremental.trailing_months(days, "d", as_of)
        bound = dt.date(2024, 4, 1) if as_of.day == 1 else dt.date(2024, 4, 15)
        expected = [(x,) for (x,) in values(days) if x.replace(day=1) >= bound]
        assert values(kept) == expected


def test_source_month():
    assert incremental.source_month(dt.date(2024, 1, 31)) == (2023, 11)


def test_windows_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(dt.datetime(2024, 2, 1),), (dt.datetime(2024, 3, 1),)], "at timestamp_ntz").write.parquet(path)
    rows = incremental.month_window(spark.read.parquet(path), "at", 2024, 2)
    assert rows.count() == 1
    assert "GreaterThanOrEqual(at,2024-02-01" in rows._jdf.queryExecution().executedPlan().toString()
    assert incremental.created_on(spark.read.parquet(path), "at", dt.date(2024, 3, 1)).count() == 1
    assert incremental.created_before(spark.read.parquet(path), "at", dt.date(2024, 3, 1)).count() == 1


def test_last_id(spark):
    rows = spark.createDataFrame([(3,), (9,)], "id long")
    assert incremental.last_id(rows, "id").first()[0] == 9
    assert incremental.last_id(rows.where("false"), "id").first()[0] == 0


# ---- quality ---------------------------------------------------------------------------------------


def test_checks(spark):
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, None, 0), (None, "z", 9)], "id long, s string, n long")
    parents = spark.createDataFrame([(1,)], "pid long")
    got = quality.report(
        quality.not_null(rows, "t", ["id", "s", "n"]),
        quality.unique(rows, "t", "id"),
        quality.relationships(rows, "t", "id", parents, "pid"),
        quality.accepted_values(rows, "t", {"s": ["a", "b"]}),
        quality.in_range(rows, "t", {"n": F.col("n") > 0}),
    )
    assert values(got) == sorted(
        [
            ("t", "not_null", "id", 1),
            ("t", "not_null", "s", 1),
            ("t", "not_null", "n", 1),
            ("t", "unique", "id", 1),
            ("t", "relationships", "id", 1),
            ("t", "accepted_values", "s", 1),
            ("t", "range", "n", 1),
        ],
        key=repr,
    )
    with pytest.raises(quality.QualityError):
        quality.raise_on_violations(got)
    quality.raise_on_violations(got.where("violations = 0"))
    assert quality.not_null(rows.where("false"), "t", ["id"]).first()["violations"] == 0


def test_reconcile_counts(spark):
    found = spark.createDataFrame([(1,), (1,), (2,)], "m long")
    declared = spark.createDataFrame([(1, 3), (3, 4)], "m long, declared_total long")
    assert values(quality.reconcile_counts(found, declared, ["m"])) == [(1, 2, 3, 1), (2, 1, 0, -1), (3, 0, 4, 4)]


# ---- calendars -------------------------------------------------------------------------------------


def test_date_dimension(spark):
    rows = calendars.date_dimension(calendars.default_date_bounds(spark))
    assert rows.count() == 3651
    last = rows.orderBy(F.col("date_key").desc()).first()
    assert last["date_key"] == dt.date(1979, 12, 30)
    first = rows.orderBy("date_key").first()
    assert tuple(first) == (dt.date(1970, 1, 1), dt.date(1970, 1, 1), 5, False, 1, "Jan", 1, 1970)


def test_holiday_dimension(spark):
    rows = calendars.holiday_dimension(calendars.default_holiday_bounds(spark, dt.date(2023, 6, 1)))
    expected = sum(1 for n in range(365) if (dt.date(2023, 1, 1) + dt.timedelta(n)).weekday() >= 4)
    assert rows.count() == expected * 24
    assert rows.select("holiday_hour").distinct().count() == expected * 24
    friday = rows.where("date = '2023-01-06' and hour = 23").first()
    assert friday["holiday_type"] == "Friday"
    assert friday["holiday_hour"] == dt.datetime(2023, 1, 6, 23)
