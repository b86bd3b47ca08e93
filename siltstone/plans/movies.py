"""Subscription video: preparation, star schema and monthly marts.

Every function takes the whole or the incrementally filtered input (see `operators.incremental`) and
returns the model's rows; `sources.writers.materialize` merges them on `KEYS`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import exact_mean
from ..functions.dates import day_tag, month_start, month_tag, whole_minutes
from ..functions.text import initcap_words
from ..operators.dedup import keep_latest
from ..operators.deltas import applied_states, change_set, group_states, moved_states
from ..operators.distinct_states import counted, states, united
from ..operators.merge import merge_upsert

# Share of a title watched that counts as completed.
COMPLETION_THRESHOLD = 0.85

KEYS = {
    "prep_payments": ["payment_id"],
    "prep_ratings": ["rating_id"],
    "prep_subscriptions": ["subscription_id"],
    "prep_watch_sessions": ["session_id"],
    "fact_payments": ["payment_id"],
    "fact_ratings": ["rating_id"],
    "fact_user_activity": ["session_id"],
    "fact_movie_popularity": ["movie_id_date"],
    "mart_movie_popularity_monthly": ["movie_month_key"],
    "mart_movie_rating_monthly": ["movie_month_key"],
    "mart_user_activity_monthly": ["user_month_key"],
    "mart_subscription_revenue_monthly": ["subscription_month_key"],
}

# Keys of the preparation models, by source.
KEY_COLUMNS = {
    "users": ["user_id"],
    "movies": ["movie_id"],
    "subscriptions": ["subscription_id"],
    "watch_sessions": ["session_id"],
    "payments": ["payment_id"],
    "ratings": ["rating_id"],
}


# ---- preparation -----------------------------------------------------------------------------------


def _newest(rows: DataFrame, key: str, wanted: Sequence[str] | None) -> DataFrame:
    """The newest row of each key. With `wanted`, only these columns and the key are read; the others are NULL."""
    if wanted is None:
        return keep_latest(rows, [key], "created_at")
    latest = keep_latest(rows, [key], "created_at", wanted=wanted)
    return latest.select(*[F.col(f.name) if f.name in latest.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])


def prep_users(raw: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    latest = _newest(raw, "user_id", wanted)
    return latest.select(
        "user_id",
        initcap_words(F.trim("name")).alias("name"),
        F.lower(F.trim("email")).alias("email"),
        initcap_words(F.trim("country")).alias("country"),
        initcap_words(F.trim("city")).alias("city"),
        F.to_date("join_date").alias("join_date"),
        "subscription_status",
        "created_at",
        "run_date_bq",
    )


def prep_movies(raw: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    latest = _newest(raw, "movie_id", wanted)
    return latest.select(
        "movie_id",
        initcap_words(F.trim("title")).alias("title"),
        initcap_words(F.trim("genre")).alias("genre"),
        "release_year",
        "duration_min",
        initcap_words(F.col("language")).alias("language"),
        "created_at",
        "run_date_bq",
    )


def _latest(raw: DataFrame, columns: list[str], wanted: Sequence[str] | None) -> DataFrame:
    """Project first: only the needed columns travel through the deduplication."""
    return _newest(raw.select(*columns), columns[0], wanted)


def prep_subscriptions(raw: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    return _latest(
        raw,
        ["subscription_id", "user_id", "plan_type", "start_date", "end_date", "price", "status", "created_at", "run_date_bq"],
        wanted,
    )


def prep_watch_sessions(raw: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    return _latest(
        raw,
        [
            "session_id",
            "user_id",
            "movie_id",
            "device_type",
            "start_time",
            "end_time",
            "completion_rate",
            "created_at",
            "run_date_bq",
        ],
        wanted,
    )


def prep_payments(raw: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    return _latest(
        raw,
        [
            "payment_id",
            "user_id",
            "subscription_id",
            "amount",
            "payment_date",
            "method",
            "status",
            "created_at",
            "run_date_bq",
        ],
        wanted,
    )


def prep_ratings(raw: DataFrame, wanted: Sequence[str] | None = None) -> DataFrame:
    return _latest(
        raw,
        ["rating_id", "user_id", "movie_id", "rating_score", "rating_date", "review_text", "created_at", "run_date_bq"],
        wanted,
    )


# ---- dimensions ------------------------------------------------------------------------------------


def dim_movies(movies: DataFrame) -> DataFrame:
    return movies.select("movie_id", "title", "genre", "release_year", "duration_min", "language", "run_date_bq")


def dim_subscriptions(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.select(
        "subscription_id", "user_id", "plan_type", "start_date", "end_date", "price", "status", "run_date_bq"
    )


def dim_users(users: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Users with their subscriptions: one row per pair, one row for a user without any."""
    return users.join(subscriptions.select("user_id", "subscription_id"), "user_id", "left").select(
        "user_id",
        "name",
        "email",
        "country",
        "city",
        "subscription_id",
        "join_date",
        "subscription_status",
        "run_date_bq",
    )


# ---- facts -----------------------------------------------------------------------------------------


def _one_per_key(rows: DataFrame, key: str, unique: bool) -> DataFrame:
    """The newest row of each key; `unique` says that the rows, like a preparation model's, have one already."""
    return rows if unique else keep_latest(rows, [key], "created_at")


def fact_user_activity(sessions: DataFrame, threshold: float = COMPLETION_THRESHOLD, unique: bool = False) -> DataFrame:
    latest = _one_per_key(sessions, "session_id", unique)
    return latest.select(
        "session_id",
        "user_id",
        "movie_id",
        "start_time",
        "end_time",
        whole_minutes(F.col("start_time"), F.col("end_time")).alias("watch_duration_minutes"),
        F.coalesce(F.col("completion_rate") >= F.lit(threshold), F.lit(False)).alias("completed_flag"),
        "device_type",
        F.to_date("start_time").alias("date_key"),
        "run_date_bq",
    )


def fact_payments(payments: DataFrame, unique: bool = False) -> DataFrame:
    latest = _one_per_key(payments, "payment_id", unique)
    return latest.select(
        "payment_id",
        "user_id",
        "subscription_id",
        "amount",
        "payment_date",
        "method",
        "status",
        F.to_date("payment_date").alias("date_key"),
        "run_date_bq",
    )


def fact_ratings(ratings: DataFrame, unique: bool = False) -> DataFrame:
    latest = _one_per_key(ratings, "rating_id", unique)
    return latest.select(
        "rating_id",
        "user_id",
        "movie_id",
        "rating_score",
        "rating_date",
        "review_text",
        F.to_date("rating_date").alias("date_key"),
        "run_date_bq",
    )


def fact_movie_popularity(activity: DataFrame) -> DataFrame:
    """Daily views per movie from `fact_user_activity`.

    That fact holds each session once, so counting sessions needs no DISTINCT; with one DISTINCT left
    (viewers) Spark aggregates without expanding the rows.
    """
    minutes = whole_minutes(F.col("start_time"), F.col("end_time"))
    return (
        activity.select(
            "movie_id",
            F.to_date("start_time").alias("date_key"),
            "session_id",
            "user_id",
            minutes.alias("minutes"),
            "run_date_bq",
        )
        .groupBy("movie_id", "date_key")
        .agg(
            F.count("session_id").alias("total_watch_count"),
            F.count_distinct("user_id").alias("unique_viewers"),
            F.avg("minutes").alias("avg_watch_duration"),
            F.sum("minutes").alias("total_watch_time"),
            F.max("run_date_bq").alias("run_date_bq"),
        )
        .withColumn("movie_id_date", F.concat(F.col("movie_id").cast("string"), F.lit("_"), day_tag(F.col("date_key"))))
    )


# ---- monthly marts ---------------------------------------------------------------------------------


def _month_key(entity: str):
    return F.concat(F.col(entity).cast("string"), F.lit("_"), month_tag(F.col("month_key")))


def mart_movie_popularity(popularity: DataFrame) -> DataFrame:
    """Monthly roll-up of the daily fact.

    `unique_viewers` adds up daily distinct viewers and `avg_watch_duration` is the unweighted mean of
    daily means; `mart_movie_popularity_exact` has the monthly figures proper.
    """
    return (
        popularity.withColumn("month_key", month_start(F.col("date_key")))
        .groupBy("movie_id", "month_key")
        .agg(
            F.sum("total_watch_count").alias("total_watch_count"),
            F.sum("unique_viewers").alias("unique_viewers"),
            exact_mean(F.col("avg_watch_duration")).alias("avg_watch_duration"),
            F.sum("total_watch_time").alias("total_watch_time"),
            F.max("run_date_bq").alias("run_date_bq"),
        )
        .withColumn("movie_month_key", _month_key("movie_id"))
    )


def mart_movie_popularity_exact(activity: DataFrame) -> DataFrame:
    """Monthly popularity from the sessions: viewers counted once a month, mean over all sessions."""
    return (
        activity.withColumn("month_key", month_start(F.col("date_key")))
        .groupBy("movie_id", "month_key")
        .agg(
            F.count("session_id").alias("total_watch_count"),
            F.count_distinct("user_id").alias("unique_viewers"),
            F.avg("watch_duration_minutes").alias("avg_watch_duration"),
            F.sum("watch_duration_minutes").alias("total_watch_time"),
            F.max("run_date_bq").alias("run_date_bq"),
        )
        .withColumn("movie_month_key", _month_key("movie_id"))
    )


def popularity_states(activity: DataFrame) -> DataFrame:
    """Mergeable daily states per movie: viewers as bitmaps, counts and sums. A load's states are appended to earlier ones."""
    return states(
        activity, ["movie_id", "date_key"], "user_id",
        F.count("session_id").alias("total_watch_count"),
        F.sum("watch_duration_minutes").alias("total_watch_time"),
        F.count("watch_duration_minutes").alias("timed"),
        F.max("run_date_bq").alias("run_date_bq"),
    )


def mart_movie_popularity_from_states(daily: DataFrame) -> DataFrame:
    """`mart_movie_popularity_exact` from the daily states, without the sessions."""
    sums = [F.sum(c).alias(c) for c in ("total_watch_count", "total_watch_time", "timed")] + [F.max("run_date_bq").alias("run_date_bq")]
    months = united(daily.withColumn("month_key", month_start(F.col("date_key"))), ["movie_id", "month_key"], *sums)
    mean = F.try_divide(F.col("total_watch_time").cast("double"), F.col("timed").cast("double"))
    return counted(months, ["movie_id", "month_key"], "unique_viewers", *sums).select(
        "movie_id", "month_key", "total_watch_count", "unique_viewers", mean.alias("avg_watch_duration"), "total_watch_time", "run_date_bq",
        _month_key("movie_id").alias("movie_month_key"),
    )


def mart_movie_rating(ratings: DataFrame) -> DataFrame:
    return (
        ratings.withColumn("month_key", month_start(F.col("date_key")))
        .groupBy("movie_id", "month_key")
        .agg(
            F.avg("rating_score").alias("avg_rating"),
            F.count("rating_id").alias("total_ratings"),
            F.count_distinct("user_id").alias("unique_raters"),
            F.max("run_date_bq").alias("run_date_bq"),
        )
        .withColumn("movie_month_key", _month_key("movie_id"))
    )


def mart_user_activity(activity: DataFrame) -> DataFrame:
    return (
        activity.withColumn("month_key", month_start(F.col("date_key")))
        .groupBy("user_id", "month_key")
        .agg(
            F.sum("watch_duration_minutes").alias("total_watch_time_minutes"),
            F.count("session_id").alias("total_sessions"),
            F.avg("watch_duration_minutes").alias("avg_watch_duration"),
            F.sum(F.when(F.col("completed_flag"), 1).otherwise(0).cast("bigint")).alias("completed_sessions"),
            F.max("run_date_bq").alias("run_date_bq"),
        )
        .withColumn("user_month_key", _month_key("user_id"))
    )


# The user activity mart kept by changes: its sums and maximum over sessions with their month.
ACTIVITY_GROUP = ["user_id", "month_key"]
# What the states read of a session: only these columns travel through the joins.
ACTIVITY_READ = ["session_id", "user_id", "date_key", "watch_duration_minutes", "completed_flag", "run_date_bq"]


def activity_months(activity: DataFrame) -> DataFrame:
    return activity.withColumn("month_key", month_start(F.col("date_key")))


def _activity_measures() -> tuple[dict, dict]:
    completed = F.when(F.col("completed_flag"), 1).otherwise(0).cast("bigint")
    sums = {"minutes": F.col("watch_duration_minutes"), "sessions": F.when(F.col("session_id").isNotNull(), F.lit(1).cast("bigint")), "completed": completed}
    return sums, {"run_date_bq": F.col("run_date_bq")}


def activity_states(activity: DataFrame) -> DataFrame:
    """Sums, counts and latest load per user and month, from all sessions."""
    return group_states(activity_months(activity), ACTIVITY_GROUP, *_activity_measures())


def moved_activity_states(held: DataFrame, changes: DataFrame, activity_after: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(states of the user months that the session changes touch, user months without sessions now)."""
    return moved_states(held, activity_months(changes), activity_months(activity_after), ACTIVITY_GROUP, *_activity_measures())


def kept_activity_states(held: DataFrame, moved: DataFrame, gone: DataFrame) -> DataFrame:
    """All states after a change: the untouched, the moved, and none of the groups without sessions."""
    left = held.join(gone.withColumnsRenamed({c: f"_{c}" for c in ACTIVITY_GROUP}), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ACTIVITY_GROUP], "left_anti")
    return merge_upsert(left, moved, ACTIVITY_GROUP, null_safe=True, check_unique=False)


def corrected_activity_states(held: DataFrame, activity: DataFrame, incoming: DataFrame) -> DataFrame:
    """States after sessions came late or were corrected; `activity` are the sessions before."""
    activity, incoming = activity.select(*ACTIVITY_READ), incoming.select(*ACTIVITY_READ)
    changes = change_set(activity, incoming, KEYS["fact_user_activity"])
    after = merge_upsert(activity, incoming, KEYS["fact_user_activity"], check_unique=False)
    return applied_states(held, activity_months(changes), activity_months(after), ACTIVITY_GROUP, *_activity_measures())


def mart_user_activity_from_states(held: DataFrame) -> DataFrame:
    """`mart_user_activity` from its states."""
    minutes = F.when(F.col("minutes_n") > 0, F.col("minutes"))
    return held.select(
        "user_id", "month_key", minutes.alias("total_watch_time_minutes"), F.col("sessions").alias("total_sessions"),
        F.try_divide(minutes.cast("double"), F.col("minutes_n").cast("double")).alias("avg_watch_duration"),
        F.col("completed").alias("completed_sessions"), "run_date_bq", _month_key("user_id").alias("user_month_key"),
    )


def _status_count(status: str):
    return F.sum(F.when(F.col("status") == status, 1).otherwise(0).cast("bigint")).alias(f"status_{status}")


def subscription_revenue(payments: DataFrame) -> DataFrame:
    """Revenue and payment outcomes per subscription and month."""
    return (
        payments.withColumn("month_key", month_start(F.to_date("payment_date")))
        .groupBy("subscription_id", "month_key")
        .agg(
            F.sum("amount").alias("total_amount"),
            F.count("payment_id").alias("total_payments"),
            _status_count("completed"),
            _status_count("pending"),
            _status_count("failed"),
            F.max("run_date_bq").alias("run_date_bq"),
        )
        .withColumn("subscription_month_key", _month_key("subscription_id"))
    )


def subscription_cohorts(revenue: DataFrame) -> DataFrame:
    """Active, new and churned subscriptions per month, from `subscription_revenue`.

    Revenue has one row per subscription and month, so counting rows counts subscriptions, and a
    subscription's window holds at most one row per calendar month.
    `churned_users` is always 0: a month on record cannot lie after the subscription's last month. See
    `subscription_churn` for the month after the last payment.
    """
    of_subscription = Window.partitionBy("subscription_id")
    spans = revenue.select(
        "subscription_id",
        "month_key",
        F.min("month_key").over(of_subscription).alias("first_month"),
        F.max("month_key").over(of_subscription).alias("last_month"),
    )
    known = F.col("subscription_id").isNotNull()
    is_new = known & (F.col("first_month") == F.col("month_key"))
    is_gone = known & (F.col("last_month") < F.col("month_key"))
    return spans.groupBy("month_key").agg(
        F.count("subscription_id").alias("total_active_users"),
        F.sum(F.when(is_new, 1).otherwise(0).cast("bigint")).alias("new_users"),
        F.sum(F.when(is_gone, 1).otherwise(0).cast("bigint")).alias("churned_users"),
    )


def mart_subscription_revenue(revenue: DataFrame) -> DataFrame:
    """Revenue rows (of `subscription_revenue`, which is read twice) with the month's cohort figures.

    The cohort side has one row per calendar month: even the whole DATE range (9999 years) is under
    120 000 rows of about 40 bytes, so broadcasting it is bounded whatever the number of payments.
    """
    return revenue.join(F.broadcast(subscription_cohorts(revenue)), "month_key", "left")


def subscription_churn(payments: DataFrame) -> DataFrame:
    """Subscriptions lost per month: those whose last payment, over the full history, was the month before.

    The newest month of the data is no evidence of loss, so it produces no churn after it.
    """
    months = payments.select("subscription_id", month_start(F.to_date("payment_date")).alias("month_key")).where(
        F.col("subscription_id").isNotNull()
    )
    last = months.groupBy("subscription_id").agg(F.max("month_key").alias("last_month"))
    per_month = last.groupBy("last_month").agg(F.count(F.lit(1)).alias("churned_users"))
    newest = per_month.agg(F.max("last_month").alias("newest"))
    # One row on the right by construction (a global aggregate).
    return (
        per_month.join(F.broadcast(newest), F.col("last_month") < F.col("newest"))
        .select(F.add_months("last_month", 1).alias("month_key"), "churned_users")
    )
