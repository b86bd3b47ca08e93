from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from support import values

from siltstone.operators import deltas, distinct_states
from siltstone.plans import movies

T = dt.datetime
SCHEMA = "session_id long, user_id long, movie_id long, start_time timestamp_ntz, end_time timestamp_ntz, date_key date, watch_duration_minutes long, completed_flag boolean, run_date_bq date"


def sessions(spark, n=400):
    """Ids at the bounds of buckets, none, and below 0; minutes that are missing."""
    users = [0, 1, 32768, 32769, 65537, -1, -32768, -40000, 10**12, None]
    rows = []
    for k in range(n):
        at = T(2024, 1 + k % 3, 1 + k % 27, k % 24)
        minutes = None if k % 11 == 0 else 10 + k % 50
        rows.append((k, users[(k * 7 + k // 9) % len(users)], k % 5, at, at, at.date(), minutes, k % 4 == 0, dt.date(2024, 5, 1 + k % 3)))
    return spark.createDataFrame(rows, SCHEMA)


def test_bitmaps_count_like_sets(spark):
    rows = sessions(spark)
    parts = distinct_states.states(rows, ["movie_id"], "user_id")
    got = distinct_states.counted(parts, ["movie_id"], "users")
    assert values(got, "movie_id", "users") == values(rows.groupBy("movie_id").agg(F.count_distinct("user_id").alias("users")))


def test_parts_add_up_in_any_cut_and_repetition(spark):
    rows = sessions(spark)
    cuts = [rows.where(f"session_id % 3 = {k}") for k in range(3)] + [rows.where("session_id < 50")]
    parts = [distinct_states.states(c, ["movie_id", "date_key"], "user_id") for c in cuts]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    whole = distinct_states.counted(distinct_states.united(union, ["movie_id"]), ["movie_id"], "users")
    assert values(whole, "movie_id", "users") == values(rows.groupBy("movie_id").agg(F.count_distinct("user_id").alias("users")))


def test_common_ids(spark):
    rows = sessions(spark)
    a, b = (distinct_states.states(rows.where(f"month(date_key) = {m}"), ["movie_id"], "user_id") for m in (1, 2))
    got = {r["movie_id"]: r["users"] for r in distinct_states.common(a, b, ["movie_id"], "users").collect()}
    sets = {}
    for r in rows.where("user_id is not null").collect():
        sets.setdefault((r["movie_id"], r["date_key"].month), set()).add(r["user_id"])
    want = {m: len(sets.get((m, 1), set()) & sets.get((m, 2), set())) for m in range(5)}
    assert got == {m: n for m, n in want.items() if n}


def test_monthly_viewers_from_appended_states(spark, tmp_path):
    """Three loads append their states to a file; the month is exact, and the sessions are not read for it."""
    rows, path = sessions(spark), str(tmp_path / "states")
    for load in (1, 2, 3):
        movies.popularity_states(rows.where(F.col("run_date_bq") == F.lit(dt.date(2024, 5, load)))).write.mode("append").parquet(path)
    got = movies.mart_movie_popularity_from_states(spark.read.parquet(path))
    want = movies.mart_movie_popularity_exact(rows)
    assert values(got, *want.columns) == values(want)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_no_rows_no_states(spark):
    assert movies.mart_movie_popularity_from_states(movies.popularity_states(sessions(spark).limit(0))).count() == 0
    assert movies.activity_states(sessions(spark).limit(0)).count() == 0


def corrected(rows):
    """Late sessions, other minutes, another month, another user, and unchanged ones."""
    return (
        rows.where("session_id % 10 = 0 or session_id % 7 = 1 or session_id < 20")
        .withColumn("watch_duration_minutes", F.when(F.col("session_id") % 7 == 1, F.col("watch_duration_minutes") + 3).otherwise(F.col("watch_duration_minutes")))
        .withColumn("date_key", F.when(F.col("session_id") % 14 == 1, F.lit(dt.date(2024, 2, 9))).otherwise(F.col("date_key")))
        .withColumn("user_id", F.when(F.col("session_id") % 21 == 1, F.lit(0)).otherwise(F.col("user_id")))
        .withColumn("run_date_bq", F.when(F.col("session_id") % 28 == 1, F.lit(dt.date(2024, 4, 1))).otherwise(F.col("run_date_bq")))
    )


def test_changes_bring_the_mart_to_its_refresh(spark):
    rows = sessions(spark)
    before, incoming = rows.where("session_id % 10 <> 0"), corrected(rows)
    held = movies.corrected_activity_states(movies.activity_states(before), before, incoming)
    after = before.join(incoming.select("session_id"), "session_id", "left_anti").select(*rows.columns).unionByName(incoming)
    want = movies.mart_user_activity(after)
    assert values(movies.mart_user_activity_from_states(held), *want.columns) == values(want)


@pytest.mark.parametrize("gone", ["session_id < 30", "user_id = 1", "run_date_bq = date '2024-05-03'", "true"])
def test_removed_sessions(spark, gone):
    """A maximum that leaves is looked up again; a group without sessions goes."""
    rows = sessions(spark)
    left = rows.where(f"not coalesce({gone}, false)")
    changes = deltas.removals(rows, rows.where(gone), ["session_id"])
    states = movies.activity_states(rows)
    moved, empty = movies.moved_activity_states(states, changes, left)
    held = movies.kept_activity_states(states, moved, empty)
    want = movies.mart_user_activity(left)
    assert values(movies.mart_user_activity_from_states(held), *want.columns) == values(want)


def test_states_have_buffers_of_fixed_size(spark):
    """Groups of single ids, as movies per day are, neither hold a bitmap each nor leave the hash aggregate."""
    rows = spark.createDataFrame([(k, k, 64 * k - 1) for k in range(50)], "id long, movie_id long, user_id long")
    parts = distinct_states.states(rows, ["movie_id"], "user_id")
    plan = distinct_states.united(parts, ["movie_id"])._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert dict(parts.dtypes)["bits"] == "bigint"
    counts = distinct_states.counted(parts, ["movie_id"], "users")
    assert {(r["movie_id"], r["users"]) for r in counts.collect()} == {(k, 1) for k in range(50)}


@pytest.mark.parametrize("change", ["correct", "remove"])
def test_applied_states_are_moved_and_kept_ones(spark, change):
    rows = sessions(spark)
    null_key = rows.where("session_id = 5").withColumn("session_id", F.lit(None).cast("long"))
    before = rows.where("session_id % 10 <> 0").unionByName(null_key)
    if change == "correct":
        changes = deltas.change_set(before, corrected(rows).unionByName(null_key), ["session_id"])
    else:
        changes = deltas.removals(before, rows.where("session_id < 30 or user_id = 1 or run_date_bq = date '2024-05-03'").unionByName(null_key), ["session_id"])
    # The rows after: every row as often as its signs add up to.
    after = before.withColumn("_sign", F.lit(1)).unionByName(changes)
    after = after.groupBy(*before.columns).agg(F.sum("_sign").alias("_times")).where("_times > 0").drop("_times")
    held = movies.activity_states(before)
    want = movies.kept_activity_states(held, *movies.moved_activity_states(held, changes, after))
    months = movies.activity_months
    got = deltas.applied_states(held, months(changes), months(after), movies.ACTIVITY_GROUP, *movies._activity_measures())
    assert values(got, *want.columns) == values(want)
    assert values(movies.mart_user_activity_from_states(got)) == values(movies.mart_user_activity(after), *movies.mart_user_activity_from_states(got).columns)


def test_corrections_read_states_by_one_aggregation(spark):
    """Held states meet the moves without joins by group but for the lookup of lost maxima, and unread columns stay behind."""
    rows = sessions(spark)
    states = movies.corrected_activity_states(movies.activity_states(rows), rows, corrected(rows))
    plan = states._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1
