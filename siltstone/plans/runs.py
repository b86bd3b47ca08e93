"""How each incremental model is kept: its rule, keys, partitions and clustering, and one function that runs it.

The rules as declared by the original jobs can miss rows: an empty target loads nothing, rows that arrive late for a day
already loaded are skipped, and the oldest month of a trailing window is left out. With `fixed`, a run instead takes
what was loaded on or after the target's last load date; a model of groups rebuilds every group these rows touch from its
whole source; and the cohort mart, in which one late payment can change other months, is rebuilt. Models that the original jobs
build as tables are built anew each time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..operators import incremental, quality
from ..sources import writers
from . import checks, movies, trips

LOAD_DATE = "run_date_bq"


BUCKETS = 64


@dataclass(frozen=True)
class Model:
    """`build` makes the model's rows from source rows, and from the tables named by `sides`, handed over by name.

    `rule` is load_date, event_date, lookback, trailing, all (every source row, merged) or table (built anew each time);
    `time` is the source column it reads, `mark` the target column with the latest one loaded. `group` gives the part of
    a source row's group that has to be rebuilt as a whole; None for models with a row per source row. Tables with partitions have the
    partition in their key, so a run reads and writes the partitions its rows fall into; other merged tables are bucketed by key.
    `null_safe` says that parts of the key may be unknown; the declared merge then repeats such rows, the complete one does not."""

    build: Callable[..., DataFrame]
    rule: str
    keys: list[str] = field(default_factory=list)
    time: str = LOAD_DATE
    mark: str = LOAD_DATE
    group: Callable[[], Column] | None = None
    partition_by: list[str] = field(default_factory=list)
    cluster_by: list[str] = field(default_factory=list)
    newer_by: str | None = None
    null_safe: bool = False
    rebuilt: bool = False
    sides: tuple[str, ...] = ()

    @property
    def buckets(self) -> int:
        return BUCKETS if self.keys and not self.partition_by else 0


def _prepared(name: str) -> Model:
    return Model(getattr(movies, name), "load_date", movies.KEYS[name], newer_by="created_at")


def _fact(build: Callable[[DataFrame], DataFrame], name: str, time: str) -> Model:
    return Model(build, "event_date", movies.KEYS[name], time=time, mark="date_key")


def _monthly(build: Callable[[DataFrame], DataFrame], name: str, time: str, entity: str, **more) -> Model:
    return Model(
        build, "trailing", movies.KEYS[name], time=time, group=lambda: month_start(F.to_date(time)),
        partition_by=["month_key"], cluster_by=[entity], **more,
    )


def _table(build: Callable[..., DataFrame], *sides: str) -> Model:
    return Model(build, "table", sides=sides)


def _revenue_mart(payments: DataFrame) -> DataFrame:
    return movies.mart_subscription_revenue(movies.subscription_revenue(payments))


def _trip_month(build: Callable[[DataFrame], DataFrame]) -> Model:
    return Model(
        lambda rows: trips.with_pickup_month(build(rows)), "lookback", ["md5_key"], time="pickup_datetime", mark="pickup_datetime",
        partition_by=["pickup_month"], cluster_by=["taxi_type", "pulocationid"],
    )


def _run_date(rows: DataFrame) -> dt.date:
    """A table model's run date: that of the newest rows it is built from."""
    return rows.agg(F.max(LOAD_DATE)).first()[0]


MODELS: dict[str, Model] = {
    "prep_users": _table(movies.prep_users),
    "prep_movies": _table(movies.prep_movies),
    "prep_subscriptions": _prepared("prep_subscriptions"),
    "prep_watch_sessions": _prepared("prep_watch_sessions"),
    "prep_payments": _prepared("prep_payments"),
    "prep_ratings": _prepared("prep_ratings"),
    "dim_movies": _table(movies.dim_movies),
    "dim_subscriptions": _table(movies.dim_subscriptions),
    "dim_users": _table(movies.dim_users, "subscriptions"),
    "fact_user_activity": _fact(movies.fact_user_activity, "fact_user_activity", "start_time"),
    "fact_payments": _fact(movies.fact_payments, "fact_payments", "payment_date"),
    "fact_ratings": _fact(movies.fact_ratings, "fact_ratings", "rating_date"),
    "fact_movie_popularity": Model(
        movies.fact_movie_popularity, "event_date", movies.KEYS["fact_movie_popularity"], time="start_time", mark="date_key",
        group=lambda: F.to_date("start_time"),
    ),
    "mart_movie_popularity_monthly": _monthly(movies.mart_movie_popularity, "mart_movie_popularity_monthly", "date_key", "movie_id"),
    "mart_movie_rating_monthly": _monthly(movies.mart_movie_rating, "mart_movie_rating_monthly", "date_key", "movie_id"),
    "mart_user_activity_monthly": _monthly(movies.mart_user_activity, "mart_user_activity_monthly", "date_key", "user_id"),
    "mart_subscription_revenue_monthly": _monthly(
        _revenue_mart, "mart_subscription_revenue_monthly", "payment_date", "subscription_id", rebuilt=True
    ),
    "dim_location": _table(trips.dim_location),
    "prep_taxi_trip": _trip_month(lambda rows: trips.dedup_trips(trips.clean_trips(rows))),
    "fact_taxi_trip": _trip_month(lambda rows: rows),
    "mart_taxi_trip_holiday_zone_flow": Model(
        lambda facts, locations, holidays: trips.zone_flow(facts, locations, holidays, _run_date(facts)), "all", trips.ZONE_FLOW_KEY,
        time="pickup_datetime", group=lambda: F.to_date("pickup_datetime"), partition_by=["trip_date"],
        cluster_by=["pickup_zone", "dropoff_zone"], null_safe=True, sides=("locations", "holidays"),
    ),
    "mart_taxi_trip_holiday_daily": _table(lambda flow: trips.holiday_daily(flow, _run_date(flow))),
    "mart_taxi_trip_holiday_summary": _table(lambda daily, holidays: trips.holiday_summary(daily, holidays, _run_date(daily)), "holidays"),
}


def fresh_rows(model: Model, source: DataFrame, target: DataFrame, as_of: dt.date | None) -> DataFrame:
    """The source rows of a run under the declared rule."""
    if model.rule == "load_date":
        return incremental.since_mark(source, target, model.mark)
    if model.rule == "event_date":
        return incremental.since_event_date(source, target, model.time, model.mark)
    if model.rule == "lookback":
        return incremental.lookback_months(source, target, model.time)
    if model.rule == "all":
        return source
    if as_of is None:
        raise ValueError("a trailing window needs the run's date: as_of")
    return incremental.trailing_months(source, model.time, as_of)


def complete_rows(model: Model, source: DataFrame, target: DataFrame) -> DataFrame:
    """The source rows that bring the target to what a full refresh gives."""
    loaded = incremental.since_mark(source, target, LOAD_DATE, inclusive=True, empty_loads_all=True)
    if model.group is None:
        return loaded
    touched = loaded.select(model.group().alias("_touched")).distinct()
    return source.join(touched, model.group().eqNullSafe(F.col("_touched")), "left_semi")


def run(
    name: str, source: DataFrame, table: str, root: str, as_of: dt.date | None = None, full_refresh: bool = False, fixed: bool = False,
    reports: str | None = None, **sides: DataFrame,
) -> None:
    """Bring a model's table up to date from its source and side tables. `as_of` is the run's date, for trailing windows.

    With `reports`, a folder, the declared not-null checks are counted while the run's rows are written, and their report is
    appended there with the run's load date; `quality.merged_reports` adds runs up.
    """
    model, spark = MODELS[name], source.sparkSession
    if set(sides) != set(model.sides):
        raise ValueError(f"{name} needs the tables {sorted(model.sides)}")
    first = full_refresh or model.rule == "table" or not writers.exists(spark, table) or (fixed and model.rebuilt)
    if first:
        rows = source
    elif fixed:
        rows = complete_rows(model, source, spark.table(table))
    else:
        rows = fresh_rows(model, source, spark.table(table), as_of)
    if not first and rows.isEmpty():
        return
    built = model.build(rows, **sides)
    declared = [c for c in checks.NOT_NULL.get(name, ()) if c in built.columns] if reports else []
    report = writers.materialize(
        built, table, root, model.keys, model.partition_by, model.cluster_by, full_refresh=first,
        key_fixes_partition=True, null_safe=fixed and model.null_safe, newer_by=model.newer_by, buckets=model.buckets,
        checks=quality.failing(not_null=declared) or None,
    )
    if report is not None:
        report.withColumns({"model": F.lit(name), LOAD_DATE: F.lit(_run_date(rows))}).coalesce(1).write.mode("append").parquet(reports)
