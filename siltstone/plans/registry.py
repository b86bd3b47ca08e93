"""Every query by name, on the supplied test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import decisions as text
from ..functions.dates import indonesian_date
from ..operators import calendars, dedup, frames, incremental, merge, quality, summarise
from ..operators.rounds import scratch_folder
from ..sources.readers import lower_names, month_slice
from ..sources.trip_months import read_trip_months
from ..streaming import playback
from . import checks, decisions, inputs, loans, movies, trips

RUN_DATE = dt.date(2025, 10, 28)
AS_OF = dt.date(1999, 7, 15)
CUT = dt.datetime(1999, 7, 1)
OVERLAP = dt.datetime(1999, 4, 1)
FILES = "files"

Query = Callable[[SparkSession, str], DataFrame]


class Warehouse:
    """The models over one folder of test tables, each derived from its source tables on demand.

    A model is built once per warehouse. With `shared`, preparation models are also computed once: a query that
    reads many models (the quality suite) then reads each source table and removes its duplicates once. `read` names, per
    video preparation model, the columns beside its key that the query's answers depend on; the others are then NULL.
    """

    def __init__(self, spark: SparkSession, folder: str, shared: bool = False, read: Mapping[str, Sequence[str]] | None = None):
        self.spark = spark
        self.folder = folder
        self.shared = shared
        self.read = read or {}
        self._built: dict[str, DataFrame] = {}

    @staticmethod
    def kept(df: DataFrame) -> DataFrame:
        """The frame, computed once where a query uses it several times; a lost block is computed again."""
        return df.persist(StorageLevel.MEMORY_AND_DISK)

    def _once(self, name: str, build: Callable[[], DataFrame], share: bool = False) -> DataFrame:
        if name not in self._built:
            built = build()
            self._built[name] = self.kept(built) if share and self.shared else built
        return self._built[name]

    def source(self, name: str) -> DataFrame:
        return self._once(f"source_{name}", lambda: getattr(inputs, name)(self.spark, self.folder))

    def table(self, name: str) -> DataFrame:
        return inputs.table(self.spark, self.folder, name)

    # subscription video
    def prep(self, name: str) -> DataFrame:
        return self._once(f"prep_{name}", lambda: getattr(movies, f"prep_{name}")(self.source(name), self.read.get(name)), share=True)

    def key(self, model: str, column: str) -> DataFrame:
        """A model's key column: of a preparation model, the distinct values of its source."""
        name = model.removeprefix("prep_")
        if model.startswith("prep_") and column in movies.KEY_COLUMNS.get(name, ()):
            return getattr(movies, model)(self.source(name), []).select(column)
        return self.model(model).select(column)

    # A preparation model has one row per key: its facts need not look for duplicates again.
    def fact_user_activity(self) -> DataFrame:
        return self._once("fact_user_activity", lambda: movies.fact_user_activity(self.prep("watch_sessions"), unique=True))

    def fact_payments(self) -> DataFrame:
        return self._once("fact_payments", lambda: movies.fact_payments(self.prep("payments"), unique=True))

    def fact_ratings(self) -> DataFrame:
        return self._once("fact_ratings", lambda: movies.fact_ratings(self.prep("ratings"), unique=True))

    def fact_movie_popularity(self) -> DataFrame:
        return self._once("fact_movie_popularity", lambda: movies.fact_movie_popularity(self.fact_user_activity()))

    def subscription_revenue(self) -> DataFrame:
        return self._once("subscription_revenue", lambda: self.kept(movies.subscription_revenue(self.fact_payments())))

    def dim_date(self) -> DataFrame:
        stamps = self.table("lineitem").select(F.col("l_shipdate").alias("ts"))
        stamps = stamps.unionByName(self.table("orders").select(F.col("o_orderdate").alias("ts")))
        return calendars.date_dimension(calendars.bounds_of(stamps, "ts"))

    # trips
    def loaded(self) -> tuple[DataFrame, DataFrame]:
        """The raw warehouse table of each type: its files ingested one by one, with the trips' key."""

        def of(kind: str) -> DataFrame:
            files = inputs.delivered_trips(self.spark, self.folder, kind)
            return reduce(DataFrame.unionByName, [trips.keyed_trips(trips.ingest_trips(lower_names(f), kind)) for f in files])

        return of("yellow"), of("green")

    def prep_taxi_trip(self) -> DataFrame:
        return self._once("prep_taxi_trip", lambda: trips.prep_taxi_trip(*self.loaded(), RUN_DATE), share=True)

    def fact_taxi_trip(self) -> DataFrame:
        return self._once("fact_taxi_trip", lambda: trips.fact_taxi_trip(self.prep_taxi_trip(), RUN_DATE))

    def dim_location(self) -> DataFrame:
        return self._once("dim_location", lambda: trips.dim_location(self.source("zones")))

    def dim_holiday(self) -> DataFrame:
        """Covers the pickups: they fall on the day the line was shipped."""
        bounds = calendars.bounds_of
        return self._once(
            "dim_holiday", lambda: calendars.holiday_dimension(bounds(self.table("lineitem"), "l_shipdate", whole_years=True)), share=True
        )

    def zone_flow(self) -> DataFrame:
        return self._once(
            "zone_flow",
            lambda: trips.zone_flow(self.fact_taxi_trip(), self.dim_location(), self.dim_holiday(), RUN_DATE),
        )

    def holiday_daily(self) -> DataFrame:
        return self._once("holiday_daily", lambda: trips.holiday_daily(self.zone_flow(), RUN_DATE))

    # decisions
    def cleaned_decisions(self) -> DataFrame:
        return decisions.clean_documents(self.source("decision_documents"))

    def model(self, name: str) -> DataFrame:
        """A model by the name it has in the quality suite."""
        builders: dict[str, Callable[[], DataFrame]] = {
            **{f"prep_{n}": (lambda n=n: self.prep(n)) for n in ("users", "subscriptions", "movies", "watch_sessions", "payments", "ratings")},
            "dim_users": lambda: movies.dim_users(self.prep("users"), self.prep("subscriptions")),
            "dim_subscriptions": lambda: movies.dim_subscriptions(self.prep("subscriptions")),
            "dim_movies": lambda: movies.dim_movies(self.prep("movies")),
            "dim_payment_type": lambda: trips.dim_payment_type(self.spark),
            "mart_movie_popularity_monthly": lambda: movies.mart_movie_popularity(self.fact_movie_popularity()),
            "mart_movie_rating_monthly": lambda: movies.mart_movie_rating(self.fact_ratings()),
            "mart_user_activity_monthly": lambda: movies.mart_user_activity(self.fact_user_activity()),
            "mart_subscription_revenue_monthly": lambda: movies.mart_subscription_revenue(self.subscription_revenue()),
            "mart_taxi_trip_holiday_zone_flow": self.zone_flow,
            "mart_taxi_trip_holiday_daily": self.holiday_daily,
            "mart_taxi_trip_holiday_summary": lambda: trips.holiday_summary(self.holiday_daily(), self.dim_holiday(), RUN_DATE),
        }
        return self._once(f"model_{name}", builders.get(name) or getattr(self, name))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparison across engines."""
    return df.withColumns(
        {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    )


_QUERIES: dict[str, Query] = {}


def _query(function: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    _QUERIES[function.__name__] = lambda spark, folder: plain(function(Warehouse(spark, folder)))
    return function


def _suite_query(read: Mapping[str, Sequence[str]], shared: bool) -> Callable[[Query], Query]:
    """A query over many models. They are shared only where the same rows would be made ready several times."""

    def register(function: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        _QUERIES[function.__name__] = lambda spark, folder: function(Warehouse(spark, folder, shared, read))
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# ---- sources and sinks -----------------------------------------------------------------------------


@_query
def trip_source_lower(w: Warehouse) -> DataFrame:
    return lower_names(inputs.raw_trips(w.spark, w.folder, "yellow"))


@_query
def trip_months_pruned(w: Warehouse) -> DataFrame:
    """The first quarter of 1998 from a folder with a file per month, which the data source finds by its pickups."""
    raw = inputs.raw_trips(w.spark, w.folder, "yellow")
    path = f"{scratch_folder(w.spark)}/yellow"
    pickup = F.col("tpep_pickup_datetime")
    months = raw.withColumn("month", F.date_format(pickup, "yyyy-MM")).hint("rebalance", "month")
    months.write.partitionBy("month").parquet(path)
    found = read_trip_months(w.spark, path, "yellow", layout="month={month}")
    return found.where(
        (pickup >= F.lit("1998-01-01").cast("timestamp_ntz")) & (pickup < F.lit("1998-04-01").cast("timestamp_ntz"))
    )


@_query
def month_slice_query(w: Warehouse) -> DataFrame:
    """The month as a range on the raw column, which the scan can use, and its year and month columns."""
    orders = incremental.month_window(w.table("orders"), "o_orderdate", 1998, 3).select(
        F.year("o_orderdate").cast("bigint").alias("order_year"),
        F.month("o_orderdate").cast("bigint").alias("order_month"),
        "o_orderkey",
        "o_totalprice",
    )
    return month_slice(orders, "order_year", "order_month", 1998, 3)


_QUERIES["month_slice"] = _QUERIES.pop("month_slice_query")


@_query
def extract_day(w: Warehouse) -> DataFrame:
    return incremental.created_on(w.source("payments"), "created_at", dt.date(1998, 3, 14))


@_query
def extract_before(w: Warehouse) -> DataFrame:
    return incremental.created_before(w.source("payments"), "created_at", dt.date(1998, 3, 14))


@_query
def month_window_scan(w: Warehouse) -> DataFrame:
    return incremental.month_window(w.source("payments"), "created_at", 1998, 3)


@_query
def events_to_json(w: Warehouse) -> DataFrame:
    return playback.to_messages(w.source("playback_events"))


@_query
def events_parse_json(w: Warehouse) -> DataFrame:
    return playback.valid_events(playback.parse_messages(playback.to_messages(w.source("playback_events"))))


@_query
def delete_where(w: Warehouse) -> DataFrame:
    return merge.delete_where(w.source("payments"), "status = 'failed' and amount > 100000")


def _raised(payments: DataFrame) -> DataFrame:
    return payments.withColumn("amount", (F.col("amount") + 1).cast("decimal(12,2)"))


@_query
def merge_upsert(w: Warehouse) -> DataFrame:
    """Rows up to the cut merged with changed rows from three months before it."""
    payments = w.source("payments")
    target = payments.where(F.col("created_at") < CUT)
    return merge.merge_upsert(target, _raised(payments.where(F.col("created_at") >= OVERLAP)), ["payment_id"])


@_query
def merge_upsert_composite(w: Warehouse) -> DataFrame:
    """The zone flow up to the cut merged with the whole recomputed flow, on its four key columns."""
    flow = w.kept(w.zone_flow())
    target = flow.where(F.col("trip_date") < F.lit(CUT.date()))
    # The flow is grouped by its key, so that it is unique needs no check.
    return merge.merge_upsert(target, flow, trips.ZONE_FLOW_KEY, check_unique=False)


@_query
def zone_flow_merge_fixed(w: Warehouse) -> DataFrame:
    """The whole flow merged twice into its part up to the cut: NULL zones match, so no run adds rows."""
    flow = w.kept(w.zone_flow())
    target = flow.where(F.col("trip_date") < F.lit(CUT.date()))
    for _ in range(2):
        target = merge.merge_upsert(target, flow, trips.ZONE_FLOW_KEY, null_safe=True, check_unique=False)
    return target


@_query
def insert_ignore(w: Warehouse) -> DataFrame:
    payments = w.source("payments")
    return merge.insert_ignore(payments.where(F.col("created_at") < CUT), _raised(payments), ["payment_id"])


@_query
def file_upsert_keep_last(w: Warehouse) -> DataFrame:
    lines = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    newer = F.col("l_shipdate") >= CUT
    return merge.upsert_keep(
        lines.where(~newer), lines.where(newer), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()]
    )


@_query
def last_id(w: Warehouse) -> DataFrame:
    return incremental.last_id(w.table("orders"), "o_orderkey")


# ---- projection, typing, keys, predicates ----------------------------------------------------------


@_query
def normalize_columns(w: Warehouse) -> DataFrame:
    customers = w.table("customer").select(
        F.col("c_custkey").alias(" Customer Key "), F.col("c_name").alias("Full Name"), F.col("c_acctbal").alias("BALANCE")
    )
    return frames.normalize_columns(customers)


@_query
def rename_columns(w: Warehouse) -> DataFrame:
    """Both types' raw time names to the unified ones; names a type does not have are ignored."""
    names = {f"{prefix}_{side}_datetime": f"{side}_datetime" for prefix in trips.TIME_PREFIX.values() for side in ("pickup", "dropoff")}
    yellow, green = (
        frames.rename_columns(lower_names(inputs.raw_trips(w.spark, w.folder, kind)), names) for kind in ("yellow", "green")
    )
    return yellow.unionByName(green)


@_query
def select_required(w: Warehouse) -> DataFrame:
    return frames.select_required(w.table("customer"), ["c_custkey", "c_mktsegment"])


@_query
def datetime_expand(w: Warehouse) -> DataFrame:
    return frames.expand_datetime(w.table("orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@_query
def run_date_stamp(w: Warehouse) -> DataFrame:
    """An instant late on one UTC day is the next day in Jakarta."""
    instant = F.lit("2025-10-27 20:30:00").cast("timestamp_ntz").cast("timestamp")
    return frames.stamp_run_date(w.table("orders").select("o_orderkey"), "run_date", instant)


@_query
def sha256_key(w: Warehouse) -> DataFrame:
    from ..functions.keys import with_sha256_id

    orders = w.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return with_sha256_id(orders, ["o_orderkey", "o_custkey", "o_orderdate"], "row_id")


@_query
def md5_key(w: Warehouse) -> DataFrame:
    rows = w.source("trips").withColumn("payment_type", F.col("payment_type").cast("bigint"))
    return trips.keyed_trips(rows).select(*trips.TRIP_COLUMNS)


@_query
def align_schema(w: Warehouse) -> DataFrame:
    """Text that is no number becomes NULL; money becomes a decimal of scale 2."""
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_totalprice", T.DecimalType(38, 2)),
            T.StructField("o_orderdate", T.TimestampNTZType()),
            T.StructField("o_orderpriority", T.LongType()),
            T.StructField("not_there", T.LongType()),
        ]
    )
    texts = w.table("orders").select(
        *[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")],
        "o_orderstatus",
    )
    return frames.align_to_schema(texts, schema)


@_query
def cast_date_int(w: Warehouse) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_orderdate", T.DateType()),
            T.StructField("o_orderstatus", T.LongType()),
            T.StructField("o_totalprice", T.StringType()),
        ]
    )
    orders = w.table("orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_orderstatus", "o_totalprice")
    return frames.cast_dates_and_integers(orders, schema)


@_query
def weekend_night_trips(w: Warehouse) -> DataFrame:
    return trips.weekend_night_trips(lower_names(inputs.raw_trips(w.spark, w.folder, "yellow")), "yellow")


@_query
def trip_ingest(w: Warehouse) -> DataFrame:
    ingested = [
        trips.ingest_trips(lower_names(inputs.raw_trips(w.spark, w.folder, kind)), kind) for kind in ("yellow", "green")
    ]
    return ingested[0].unionByName(ingested[1])


@_query
def doc_path(w: Warehouse) -> DataFrame:
    links = w.source("decision_links")
    path = decisions.document_path(F.col("no_putusan"), FILES, "pdf", F.year("tgl_putusan"), "pdf")
    return links.select("no_putusan", path.alias("path"))


# ---- joins, calendars, trips -----------------------------------------------------------------------


@_query
def dedup_latest(w: Warehouse) -> DataFrame:
    lines = w.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return dedup.keep_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


@_query
def semi_holiday(w: Warehouse) -> DataFrame:
    return trips.in_holiday_hours(w.fact_taxi_trip(), w.dim_holiday())


@_query
def cascade_prune(w: Warehouse) -> DataFrame:
    active = w.source("users").where(F.col("subscription_status") == "active")
    return merge.cascade_prune(w.source("payments"), active, "user_id", "user_id")


@_query
def trip_union(w: Warehouse) -> DataFrame:
    return trips.union_trips(*w.loaded())


@_query
def trip_clean(w: Warehouse) -> DataFrame:
    return trips.clean_trips(trips.union_trips(*w.loaded()))


@_query
def trip_dedup(w: Warehouse) -> DataFrame:
    return trips.dedup_trips(trips.clean_trips(trips.union_trips(*w.loaded())))


@_query
def prep_taxi_trip(w: Warehouse) -> DataFrame:
    return w.prep_taxi_trip()


@_query
def fact_taxi_trip(w: Warehouse) -> DataFrame:
    return w.fact_taxi_trip()


@_query
def dim_location(w: Warehouse) -> DataFrame:
    return w.dim_location()


@_query
def dim_holiday(w: Warehouse) -> DataFrame:
    return w.dim_holiday()


@_query
def trips_by_payment_type(w: Warehouse) -> DataFrame:
    return trips.trips_by_payment_type(w.fact_taxi_trip(), trips.dim_payment_type(w.spark))


@_query
def zone_flow(w: Warehouse) -> DataFrame:
    return w.zone_flow()


@_query
def holiday_daily(w: Warehouse) -> DataFrame:
    return w.holiday_daily()


@_query
def holiday_summary(w: Warehouse) -> DataFrame:
    return trips.holiday_summary(w.holiday_daily(), w.dim_holiday(), RUN_DATE)


@_query
def holiday_summary_fixed(w: Warehouse) -> DataFrame:
    return trips.holiday_summary_by_date(w.holiday_daily(), w.dim_holiday(), RUN_DATE)


# ---- subscription video ----------------------------------------------------------------------------


def _register_models() -> None:
    for name in ("prep_users", "prep_movies", "prep_subscriptions", "prep_watch_sessions", "prep_payments", "prep_ratings",
                 "dim_users", "dim_movies", "dim_subscriptions", "dim_date", "fact_user_activity", "fact_payments",
                 "fact_ratings", "fact_movie_popularity"):
        _QUERIES[name] = lambda spark, folder, name=name: plain(Warehouse(spark, folder).model(name))
    for name in ("mart_movie_popularity", "mart_movie_rating", "mart_user_activity", "mart_subscription_revenue"):
        _QUERIES[name] = lambda spark, folder, name=name: plain(Warehouse(spark, folder).model(f"{name}_monthly"))


_register_models()


@_query
def mart_movie_popularity_fixed(w: Warehouse) -> DataFrame:
    return movies.mart_movie_popularity_exact(w.fact_user_activity())


@_query
def mart_movie_popularity_states(w: Warehouse) -> DataFrame:
    """States of two loads, of which the second repeats a day of viewers, appended and rolled up."""
    activity = w.fact_user_activity()
    loads = [movies.popularity_states(activity.where(F.col("session_id") % 3 == 0)), movies.popularity_states(activity.where(F.col("session_id") % 3 != 0))]
    return movies.mart_movie_popularity_from_states(loads[0].unionByName(loads[1]))


@_query
def mart_user_activity_deltas(w: Warehouse) -> DataFrame:
    """States of sessions of which some were still missing and some wrong, moved by the late and the corrected ones."""
    activity = w.kept(w.fact_user_activity().select(*movies.ACTIVITY_READ))
    late, wrong = F.col("session_id") % 10 == 0, F.col("session_id") % 7 == 1
    before = activity.where(~late).withColumn("watch_duration_minutes", F.when(wrong, F.col("watch_duration_minutes") + 5).otherwise(F.col("watch_duration_minutes")))
    states = movies.corrected_activity_states(movies.activity_states(before), before, activity.where(late | wrong))
    return movies.mart_user_activity_from_states(states)


@_query
def subscription_cohorts(w: Warehouse) -> DataFrame:
    return movies.subscription_cohorts(w.subscription_revenue())


@_query
def subscription_churn_fixed(w: Warehouse) -> DataFrame:
    return movies.subscription_churn(w.fact_payments())


# ---- incremental rules -----------------------------------------------------------------------------


@_query
def incremental_since_max(w: Warehouse) -> DataFrame:
    payments = w.source("payments")
    return incremental.since_mark(payments, payments.where(F.col("created_at") < CUT), "run_date_bq")


@_query
def incremental_event_date(w: Warehouse) -> DataFrame:
    sessions = w.source("watch_sessions")
    loaded = movies.fact_user_activity(movies.prep_watch_sessions(sessions.where(F.col("created_at") < CUT)))
    return incremental.since_event_date(sessions, loaded, "start_time", "date_key")


@_query
def incremental_lookback_months(w: Warehouse) -> DataFrame:
    rows = w.source("trips")
    return incremental.lookback_months(rows, rows.where(F.col("pickup_datetime") < CUT), "pickup_datetime")


@_query
def incremental_trailing_window(w: Warehouse) -> DataFrame:
    return incremental.trailing_months(w.fact_movie_popularity(), "date_key", AS_OF)


@_query
def trailing_window_fixed(w: Warehouse) -> DataFrame:
    return incremental.trailing_whole_months(w.fact_movie_popularity(), "date_key", AS_OF)


@_query
def subscription_cohorts_incremental_fixed(w: Warehouse) -> DataFrame:
    """Revenue up to the cut, brought up to date for the months that later loads touch, and the cohorts of all of it."""
    payments = w.fact_payments()
    month = F.trunc(F.to_date("payment_date"), "MM")
    touched = payments.where(F.col("payment_date") >= OVERLAP).select(month.alias("_month")).distinct()
    base = movies.subscription_revenue(payments.where(F.col("payment_date") < CUT))
    again = movies.subscription_revenue(payments.join(touched, month == F.col("_month"), "left_semi"))
    merged = merge.merge_upsert(base, again, ["subscription_id", "month_key"], null_safe=True, check_unique=False)
    return movies.subscription_cohorts(merged)


# ---- quality ---------------------------------------------------------------------------------------


@_suite_query(checks.READ_FOR_NOT_NULL, shared=False)
def dq_not_null(w: Warehouse) -> DataFrame:
    return checks.not_null_report(w.model)


@_suite_query(checks.READ_FOR_UNIQUE, shared=True)
def dq_unique(w: Warehouse) -> DataFrame:
    return checks.unique_report(w.model)


@_suite_query(checks.READ_FOR_RELATIONSHIPS, shared=False)
def dq_relationships(w: Warehouse) -> DataFrame:
    return checks.relationship_report(w.model, key=w.key)


@_query
def dq_accepted_values(w: Warehouse) -> DataFrame:
    return checks.accepted_report(w.source)


@_query
def dq_range(w: Warehouse) -> DataFrame:
    return checks.range_report(w.source, RUN_DATE.year)


@_query
def dq_count_reconcile(w: Warehouse) -> DataFrame:
    """Entries collected from the listing pages against the totals the pages declare, per month."""
    pages = w.source("listing_pages")
    year, month = F.year("tgl_putusan").cast("bigint"), F.month("tgl_putusan").cast("bigint")
    records = decisions.listing_records(pages).select("page_id", year.alias("year"), month.alias("month"))
    years = records.select("page_id", "year").distinct()
    declared = (
        decisions.listing_totals(pages)
        .join(years, "page_id")
        .groupBy("year", F.col("month").cast("bigint").alias("month"))
        .agg(F.sum("declared_total").alias("declared_total"))
    )
    return quality.reconcile_counts(records, declared, ["year", "month"])


# ---- playback events -------------------------------------------------------------------------------


def _alerts(w: Warehouse) -> DataFrame:
    instant = F.lit("2025-10-27 20:30:00").cast("timestamp_ntz").cast("timestamp")
    return playback.playback_alerts(w.source("playback_events"), instant)


@_query
def playback_alerts(w: Warehouse) -> DataFrame:
    return _alerts(w)


@_query
def alert_windows(w: Warehouse) -> DataFrame:
    return playback.alert_windows(_alerts(w))


@_query
def alert_digest(w: Warehouse) -> DataFrame:
    return playback.alert_digest(_alerts(w))


# ---- pages and texts -------------------------------------------------------------------------------


@_query
def page_links(w: Warehouse) -> DataFrame:
    return decisions.page_links(w.table("pages"))


@_query
def listing_records(w: Warehouse) -> DataFrame:
    return decisions.listing_records(w.source("listing_pages"))


@_query
def listing_totals(w: Warehouse) -> DataFrame:
    return decisions.listing_totals(w.source("listing_pages"))


@_query
def detail_fields(w: Warehouse) -> DataFrame:
    return decisions.detail_fields(w.source("detail_pages"))


@_query
def decision_details(w: Warehouse) -> DataFrame:
    details = decisions.detail_fields(w.source("detail_pages"))
    return decisions.decision_details(w.source("decision_links"), details, FILES).select(
        "no_putusan",
        "tgl_putusan",
        "link_page_putusan",
        "nama_terdakwa",
        "link_pdf_putusan",
        "gcs_pdf_path",
        "tahun",
        "tgl_register",
    )


@_query
def indonesian_date_query(w: Warehouse) -> DataFrame:
    return w.source("decisions").select("doc_id", "born", indonesian_date(F.col("born")).alias("birth_date"))


_QUERIES["indonesian_date"] = _QUERIES.pop("indonesian_date_query")


@_query
def doc_clean(w: Warehouse) -> DataFrame:
    return decisions.clean_documents(w.table("documents"))


@_query
def decision_clean(w: Warehouse) -> DataFrame:
    return w.cleaned_decisions()


@_query
def doc_number(w: Warehouse) -> DataFrame:
    return w.cleaned_decisions().select("doc_id", text.decision_number(F.col("clean_text")).alias("no_putusan"))


@_query
def biodata(w: Warehouse) -> DataFrame:
    return decisions.biodata(w.cleaned_decisions()).drop("clean_text")


@_query
def legal_references(w: Warehouse) -> DataFrame:
    return w.cleaned_decisions().select("doc_id", text.legal_references(F.col("clean_text")).alias("rujukan_hukum"))


@_query
def ruling_text(w: Warehouse) -> DataFrame:
    return w.cleaned_decisions().select("doc_id", text.ruling_text(F.col("clean_text")).alias("amar_putusan"))


@_query
def evidence_text(w: Warehouse) -> DataFrame:
    return w.cleaned_decisions().select("doc_id", text.evidence_text(F.col("clean_text")).alias("barang_bukti"))


@_query
def summary_topn(w: Warehouse) -> DataFrame:
    top = summarise.top_sentences(w.table("documents"), "doc_id", "text", decisions.SUMMARY_SENTENCES)
    return top.select("doc_id", F.inline("chosen"))


@_query
def keyword_sentences(w: Warehouse) -> DataFrame:
    short = summarise.summaries(w.table("documents"), "doc_id", "text", decisions.SUMMARY_SENTENCES)
    return short.select("doc_id", summarise.keyword_sentences(F.col("summary")).alias("summary_extractive_short"))


@_query
def decision_extracts(w: Warehouse) -> DataFrame:
    valid, _ = decisions.split_quarantine(decisions.document_extracts(w.source("decision_documents")))
    return decisions.decision_extracts(w.source("decision_links"), valid, FILES, RUN_DATE)


# ---- loans -----------------------------------------------------------------------------------------


@_query
def normalize_amount_text(w: Warehouse) -> DataFrame:
    return loans.normalized_amounts(w.source("loan_counters"))


@_query
def loan_stats(w: Warehouse) -> DataFrame:
    return loans.loan_statistics(w.source("loan_counters"), RUN_DATE)


@_query
def daily_report(w: Warehouse) -> DataFrame:
    return loans.daily_report(loans.loan_statistics(w.source("loan_counters"), RUN_DATE))
