"""Reference SQL for the registered queries, written for DuckDB over the same Parquet tables.

Written independently of the DataFrame code: named relations below, and one final SELECT per query.
"""

from __future__ import annotations

import re

from .inputs import MONTH_NAMES

_RELATIONS: dict[str, str] = {}


def _relation(name: str, body: str) -> None:
    _RELATIONS[name] = body


def _with(final: str) -> str:
    """Prefix a SELECT with the relations it uses, directly or through others."""
    needed: set[str] = set()
    open_texts = [final]
    while open_texts:
        text = open_texts.pop()
        for name in set(re.findall(r"\b[a-z_0-9]+\b", text)) & _RELATIONS.keys() - needed:
            needed.add(name)
            open_texts.append(_RELATIONS[name])
    parts = [f"{name} as ({body})" for name, body in _RELATIONS.items() if name in needed]
    return f"with {', '.join(parts)} {final}" if parts else final


def _pick(index: str, *choices: str) -> str:
    quoted = ", ".join(f"'{c}'" for c in choices)
    return f"list_extract([{quoted}], cast({index} as int) + 1)"


def _wide(column: str) -> str:
    """The digits a value shows, unrounded."""
    return f"cast(cast({column} as varchar) as decimal(38,18))"


def _mean(column: str) -> str:
    return f"cast(sum({_wide(column)}) as double) / nullif(count({column}), 0)"


def _sum(column: str) -> str:
    return f"sum({_wide(column)})"


# ---- source views ----------------------------------------------------------------------------------

_relation(
    "trips",
    """
    select case when l_linestatus = 'O' then 'yellow' else 'green' end as taxi_type, l_suppkey % 2 + 1 as vendorid,
           l_shipdate + to_hours(cast(l_suppkey % 24 as int)) + to_minutes(cast(l_linenumber * 7 as int)) as pickup_datetime,
           l_shipdate + to_hours(cast(l_suppkey % 24 as int))
             + to_minutes(cast(l_linenumber * 7 + cast(l_quantity as int) - 2 as int)) as dropoff_datetime,
           cast(s_nationkey as bigint) as pulocationid, cast(c_nationkey as bigint) as dolocationid,
           cast(l_orderkey % 7 as double) as payment_type, cast(l_linenumber - 1 as double) as passenger_count,
           round(l_discount * 100, 1) as trip_distance, cast(cast(l_extendedprice as decimal(12,2)) as double) as fare_amount,
           cast(cast(l_quantity as decimal(12,2)) as double) as tip_amount,
           cast(cast(l_extendedprice as decimal(12,2)) + cast(l_quantity as decimal(12,2)) as double) as total_amount
    from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey
         join customer on o_custkey = c_custkey""",
)
_relation(
    "zones",
    """
    select cast(n_nationkey as bigint) as locationid, r_name as borough, n_name as zone,
           case when n_nationkey % 2 = 0 then 'Boro' else 'Yellow' end as service_zone
    from nation join region on n_regionkey = r_regionkey""",
)
_START = "timestamp '1995-01-01'"
_relation(
    "users",
    f"""
    select c_custkey as user_id, ' ' || lower(c_name) || ' ' as name,
           upper(replace(c_name, '#', '.')) || '@EXAMPLE.COM' as email, n_name as country, c_mktsegment as city,
           {_START} as join_date, case when c_acctbal >= 0 then 'active' else 'inactive' end as subscription_status,
           {_START} as created_at, date '1995-01-01' as run_date_bq
    from customer join nation on c_nationkey = n_nationkey""",
)
_relation(
    "subscriptions",
    f"""
    select c_custkey as subscription_id, c_custkey as user_id, {_pick("c_custkey % 3", "Basic", "Standard", "Premium")} as plan_type,
           {_START} as start_date, {_START} + to_days(cast(30 + c_custkey % 336 as int)) as end_date,
           cast({_pick("c_custkey % 3", "4.99", "9.99", "14.99")} as double) as price,
           case when c_acctbal >= 0 then 'active' else 'expired' end as status, {_START} as created_at,
           date '1995-01-01' as run_date_bq
    from customer""",
)
_relation(
    "movies",
    f"""
    select p_partkey as movie_id, p_name as title, case when p_size % 2 = 0 then 'sci-fi' else lower(p_type) end as genre,
           cast(1990 + p_size % 30 as bigint) as release_year, cast(60 + p_size as bigint) as duration_min,
           lower(p_brand) as language, {_START} as created_at, date '1995-01-01' as run_date_bq
    from part""",
)
_relation(
    "watch_sessions",
    """
    select l_orderkey * 10 + l_linenumber as session_id, o_custkey as user_id, l_partkey as movie_id,
           l_returnflag as device_type, l_shipdate + to_hours(cast(l_suppkey % 24 as int)) as start_time,
           l_shipdate + to_hours(cast(l_suppkey % 24 as int)) + to_minutes(cast(10 + 3 * l_quantity as int))
             + to_seconds(17 * l_linenumber) as end_time,
           cast(round(l_discount * 10, 2) as double) as completion_rate, l_shipdate as created_at,
           cast(l_shipdate as date) as run_date_bq
    from lineitem join orders on l_orderkey = o_orderkey""",
)
_relation(
    "payments",
    """
    select o_orderkey as payment_id, o_custkey as user_id, o_custkey as subscription_id,
           cast(o_totalprice as decimal(12,2)) as amount, o_orderdate as payment_date, o_orderpriority as method,
           case o_orderstatus when 'F' then 'completed' when 'P' then 'pending' else 'failed' end as status,
           o_orderdate as created_at, cast(o_orderdate as date) as run_date_bq
    from orders""",
)
_relation(
    "ratings",
    """
    select l_orderkey * 10 + l_linenumber as rating_id, o_custkey as user_id, l_partkey as movie_id,
           l_partkey % 5 + 1 as rating_score, l_shipdate as rating_date, l_returnflag || l_linestatus as review_text,
           l_shipdate as created_at, cast(l_shipdate as date) as run_date_bq
    from lineitem join orders on l_orderkey = o_orderkey""",
)
_relation(
    "playback",
    """
    select event_id, event_id % 100 + 1 as session_id, user_id, cast(json_extract(props, '$.k') as bigint) as movie_id,
           case event_type when 'view' then 'buffer' when 'click' then 'start' when 'purchase' then 'resume'
                when 'signup' then 'stop' else event_type end as event_type,
           ts as event_timestamp, cast(floor(value * 20) as bigint) as buffer_duration_ms
    from events""",
)

# ---- subscription video ----------------------------------------------------------------------------

# Upper-case the first character of each run of non-separators.
_SEPARATORS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def _initcap(text: str) -> str:
    pieces = f"regexp_extract_all(lower({text}), '([^{_SEPARATORS}]+|[{_SEPARATORS}]+)')"
    return f"array_to_string(list_transform({pieces}, lambda p: upper(p[1]) || p[2:]), '')"


def _first(key: str, by: str, direction: str, ties: str) -> str:
    nulls = "last" if direction == "desc" else "first"
    order = ", ".join(f"{t} asc nulls first" for t in ties.split())
    return f"qualify row_number() over (partition by {key} order by {by} {direction} nulls {nulls}, {order}) = 1"


_relation(
    "prep_users",
    f"""
    select user_id, {_initcap("trim(name)")} as name, lower(trim(email)) as email, {_initcap("trim(country)")} as country,
           {_initcap("trim(city)")} as city, cast(join_date as date) as join_date, subscription_status, created_at, run_date_bq
    from users qualify row_number() over (partition by user_id order by created_at desc) = 1""",
)
_relation(
    "prep_movies",
    f"""
    select movie_id, {_initcap("trim(title)")} as title, {_initcap("trim(genre)")} as genre, release_year, duration_min,
           {_initcap("language")} as language, created_at, run_date_bq
    from movies qualify row_number() over (partition by movie_id order by created_at desc) = 1""",
)
_relation(
    "prep_subscriptions",
    "select * from subscriptions qualify row_number() over (partition by subscription_id order by created_at desc) = 1",
)
_relation(
    "prep_watch_sessions",
    "select * from watch_sessions "
    + _first("session_id", "created_at", "desc", "user_id movie_id device_type start_time end_time completion_rate run_date_bq"),
)
_relation(
    "prep_payments",
    "select * from payments qualify row_number() over (partition by payment_id order by created_at desc) = 1",
)
_relation(
    "prep_ratings",
    "select * from ratings "
    + _first("rating_id", "created_at", "desc", "user_id movie_id rating_score rating_date review_text run_date_bq"),
)
_relation(
    "dim_users",
    """
    select u.user_id, name, email, country, city, subscription_id, join_date, subscription_status, u.run_date_bq
    from prep_users u left join prep_subscriptions s on u.user_id = s.user_id""",
)
_relation(
    "dim_subscriptions",
    "select subscription_id, user_id, plan_type, start_date, end_date, price, status, run_date_bq from prep_subscriptions",
)
_relation("dim_movies", "select movie_id, title, genre, release_year, duration_min, language, run_date_bq from prep_movies")
_relation(
    "fact_user_activity",
    """
    select session_id, user_id, movie_id, start_time, end_time, date_sub('minute', start_time, end_time) as watch_duration_minutes,
           completion_rate >= 0.85 as completed_flag, device_type, cast(start_time as date) as date_key, run_date_bq
    from prep_watch_sessions""",
)
_relation(
    "fact_payments",
    """
    select payment_id, user_id, subscription_id, amount, payment_date, method, status, cast(payment_date as date) as date_key,
           run_date_bq
    from prep_payments""",
)
_relation(
    "fact_ratings",
    """
    select rating_id, user_id, movie_id, rating_score, rating_date, review_text, cast(rating_date as date) as date_key, run_date_bq
    from prep_ratings""",
)
_relation(
    "fact_movie_popularity",
    """
    select movie_id, date_key, count(distinct session_id) as total_watch_count, count(distinct user_id) as unique_viewers,
           avg(watch_duration_minutes) as avg_watch_duration, cast(sum(watch_duration_minutes) as bigint) as total_watch_time,
           movie_id || '_' || strftime(date_key, '%Y%m%d') as movie_id_date, max(run_date_bq) as run_date_bq
    from fact_user_activity group by movie_id, date_key""",
)
_MONTH = "cast(date_trunc('month', date_key) as date)"
_relation(
    "mart_movie_popularity",
    f"""
    select movie_id, {_MONTH} as month_key, cast(sum(total_watch_count) as bigint) as total_watch_count,
           cast(sum(unique_viewers) as bigint) as unique_viewers, {_mean("avg_watch_duration")} as avg_watch_duration,
           cast(sum(total_watch_time) as bigint) as total_watch_time,
           movie_id || '_' || strftime({_MONTH}, '%Y%m') as movie_month_key, max(run_date_bq) as run_date_bq
    from fact_movie_popularity group by movie_id, {_MONTH}""",
)
_relation(
    "mart_movie_popularity_exact",
    f"""
    select movie_id, {_MONTH} as month_key, count(session_id) as total_watch_count, count(distinct user_id) as unique_viewers,
           avg(watch_duration_minutes) as avg_watch_duration, cast(sum(watch_duration_minutes) as bigint) as total_watch_time,
           movie_id || '_' || strftime({_MONTH}, '%Y%m') as movie_month_key, max(run_date_bq) as run_date_bq
    from fact_user_activity group by movie_id, {_MONTH}""",
)
_relation(
    "mart_movie_rating",
    f"""
    select movie_id, {_MONTH} as month_key, avg(rating_score) as avg_rating, count(rating_id) as total_ratings,
           count(distinct user_id) as unique_raters, movie_id || '_' || strftime({_MONTH}, '%Y%m') as movie_month_key,
           max(run_date_bq) as run_date_bq
    from fact_ratings group by movie_id, {_MONTH}""",
)
_relation(
    "mart_user_activity",
    f"""
    select user_id, {_MONTH} as month_key, cast(sum(watch_duration_minutes) as bigint) as total_watch_time_minutes,
           count(session_id) as total_sessions, avg(watch_duration_minutes) as avg_watch_duration,
           cast(sum(case when completed_flag then 1 else 0 end) as bigint) as completed_sessions,
           user_id || '_' || strftime({_MONTH}, '%Y%m') as user_month_key, max(run_date_bq) as run_date_bq
    from fact_user_activity group by user_id, {_MONTH}""",
)
_relation(
    "revenue",
    """
    select subscription_id, cast(date_trunc('month', payment_date) as date) as month_key,
           cast(sum(amount) as double) as total_amount, count(payment_id) as total_payments,
           cast(sum(case when status = 'completed' then 1 else 0 end) as bigint) as status_completed,
           cast(sum(case when status = 'pending' then 1 else 0 end) as bigint) as status_pending,
           cast(sum(case when status = 'failed' then 1 else 0 end) as bigint) as status_failed,
           subscription_id || '_' || strftime(date_trunc('month', payment_date), '%Y%m') as subscription_month_key,
           max(run_date_bq) as run_date_bq
    from fact_payments group by subscription_id, date_trunc('month', payment_date)""",
)
_relation(
    "cohorts",
    """
    select month_key, count(distinct subscription_id) as total_active_users,
           count(distinct case when first_month = month_key then subscription_id end) as new_users,
           count(distinct case when last_month < month_key then subscription_id end) as churned_users
    from (select subscription_id, month_key, min(month_key) over (partition by subscription_id) as first_month,
                 max(month_key) over (partition by subscription_id) as last_month from revenue)
    group by month_key""",
)
_relation(
    "mart_subscription_revenue",
    "select r.*, total_active_users, new_users, churned_users from revenue r left join cohorts c on r.month_key = c.month_key",
)

# ---- trips -----------------------------------------------------------------------------------------

_CLEAN = (
    "trip_distance > 0 and fare_amount > 0 and total_amount > 0 and passenger_count > 0 "
    "and pickup_datetime < dropoff_datetime"
)
_TRIP_COLUMNS = (
    "md5_key, taxi_type, vendorid, pickup_datetime, dropoff_datetime, pulocationid, dolocationid, "
    "cast(payment_type as bigint) as payment_type, passenger_count, fare_amount, tip_amount, total_amount, trip_distance"
)
_TRIP_KEY_TEXT = (
    "concat_ws('|', vendorid, taxi_type, strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S'), "
    "strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S'), pulocationid, dolocationid, trip_distance, "
    "cast(payment_type as bigint), total_amount)"
)
_NIGHT = (
    "isodow(pickup_datetime) in (5, 6, 7) and hour(pickup_datetime) >= 18 and hour(dropoff_datetime) between 18 and 23"
)
# Weekend-night trips with their key, and those of March 1998 a second time.
_relation("trip_load", f"select distinct *, md5({_TRIP_KEY_TEXT}) as md5_key from trips where {_NIGHT}")
_relation(
    "trip_union",
    f"select {_TRIP_COLUMNS} from trip_load union all "
    f"select {_TRIP_COLUMNS} from trip_load where pickup_datetime >= timestamp '1998-03-01' and pickup_datetime < timestamp '1998-04-01'",
)
_relation("trip_clean", f"select * from trip_union where {_CLEAN}")
_relation(
    "trip_dedup",
    "select * from trip_clean "
    + _first(
        "md5_key",
        "pickup_datetime",
        "asc",
        "taxi_type vendorid dropoff_datetime pulocationid dolocationid payment_type passenger_count fare_amount "
        "tip_amount total_amount trip_distance",
    ),
)
RUN_DATE = "2025-10-28"
_relation("prep_taxi_trip", f"select *, date '{RUN_DATE}' as run_date_bq from trip_dedup")
_relation("fact_taxi_trip", "select * exclude (vendorid) from prep_taxi_trip")
_LABEL = "case dayofweek(d) when 5 then 'Friday' when 6 then 'Saturday' when 0 then 'Sunday' end"
_relation(
    "trip_days",
    """
    select cast(unnest(generate_series(date_trunc('day', min(l_shipdate)),
                                       make_timestamp(year(max(l_shipdate)), 12, 31, 0, 0, 0), interval 1 day)) as date) as d
    from lineitem""",
)
_relation(
    "dim_holiday",
    f"""
    select d as date, {_LABEL} as holiday_type, h as hour, d + to_hours(cast(h as int)) as holiday_hour
    from trip_days cross join range(24) hours(h) where dayofweek(d) in (5, 6, 0)""",
)


def _flow(source: str) -> str:
    return f"""
    select cast(pickup_datetime as date) as trip_date, hour(pickup_datetime) as trip_hour, p.zone as pickup_zone,
           d.zone as dropoff_zone, count(*) as total_trip, {_mean("total_amount")} as avg_total_amount,
           {_sum("total_amount")} as total_revenue, {_mean("trip_distance")} as avg_distance, date '{RUN_DATE}' as run_date_bq
    from {source} f left join zones p on f.pulocationid = p.locationid left join zones d on f.dolocationid = d.locationid
    where exists (select 1 from dim_holiday h where h.date = cast(f.pickup_datetime as date) and h.hour = hour(f.pickup_datetime))
    group by 1, 2, 3, 4"""


_relation("zone_flow", _flow("fact_taxi_trip"))
_WEIGHTED = f"""
    cast(sum(total_trip) as bigint) as total_trip, sum(total_revenue) as total_revenue,
    cast(sum(total_revenue) as double) / cast(sum(total_trip) as double) as avg_total_amount,
    cast({_sum('avg_distance * total_trip')} as double) / cast(sum(total_trip) as double) as avg_distance"""
_relation("holiday_daily", f"select trip_date, {_WEIGHTED}, date '{RUN_DATE}' as run_date_bq from zone_flow group by trip_date")


def _summary(labels: str) -> str:
    return f"""
    select year(trip_date) as year, month(trip_date) as month, holiday_type, {_WEIGHTED},
           count(distinct trip_date) as holiday_days, date '{RUN_DATE}' as run_date_bq
    from holiday_daily left join ({labels}) l on trip_date = l.date group by 1, 2, 3"""


def _as_double(*columns: str) -> str:
    return ", ".join(f"cast({c} as double) as {c}" for c in columns)


_DOUBLE_REVENUE = f"* replace ({_as_double('total_revenue')})"

# ---- quality suite ---------------------------------------------------------------------------------


def _violations(table: str, check: str, column: str, count: str, source: str) -> str:
    return (
        f"""select '{table}' as "table", '{check}' as "check", '{column}' as "column", """
        f"cast(coalesce({count}, 0) as bigint) as violations from {source}"
    )


_SUITE_RELATION = {
    "mart_movie_popularity_monthly": "mart_movie_popularity",
    "mart_movie_rating_monthly": "mart_movie_rating",
    "mart_user_activity_monthly": "mart_user_activity",
    "mart_subscription_revenue_monthly": "mart_subscription_revenue",
    "mart_taxi_trip_holiday_zone_flow": "zone_flow",
    "mart_taxi_trip_holiday_daily": "holiday_daily",
    "mart_taxi_trip_holiday_summary": "holiday_summary",
    "dim_location": "zones",
    "dim_date": "dim_date",
}
_relation("holiday_summary", _summary("select date, holiday_type from dim_holiday"))
_relation("dim_payment_type", "select * from (values (0), (1), (2), (3), (4), (5), (6)) t(payment_type)")
_relation(
    "dim_date",
    """
    select d as date_key, d as full_date, dayofweek(d) + 1 as day_of_week, dayofweek(d) in (0, 6) as is_weekend, month(d) as month,
           strftime(d, '%b') as month_name, quarter(d) as quarter, year(d) as year
    from (select cast(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), interval 1 day)) as date) as d
          from (select l_shipdate as ts from lineitem union all select o_orderdate from orders))""",
)


# The declared checks, stated apart from the suite so that a slip in one shows against the other.

# Columns that must not be NULL, per model.
_NOT_NULL = {
    "prep_users": ["user_id", "email", "subscription_status"],
    "prep_subscriptions": ["subscription_id", "user_id", "plan_type"],
    "prep_movies": ["movie_id", "title", "release_year"],
    "prep_watch_sessions": ["session_id", "user_id", "movie_id", "start_time"],
    "prep_payments": ["payment_id", "user_id", "subscription_id", "amount"],
    "prep_ratings": ["rating_id", "user_id", "movie_id", "rating_score"],
    "dim_users": ["user_id", "name", "email", "country", "join_date"],
    "dim_subscriptions": ["subscription_id", "plan_type", "start_date", "status"],
    "dim_movies": ["movie_id", "title", "release_year"],
    "dim_date": ["date_key"],
    "fact_user_activity": ["session_id", "user_id", "movie_id", "date_key"],
    "fact_movie_popularity": ["movie_id", "date_key"],
    "fact_payments": ["payment_id", "user_id", "subscription_id", "amount", "payment_date", "date_key"],
    "fact_ratings": ["rating_id", "user_id", "movie_id", "rating_score", "rating_date", "date_key"],
    "mart_movie_popularity_monthly": ["movie_id", "month_key", "movie_month_key"],
    "mart_movie_rating_monthly": ["movie_id", "month_key", "movie_month_key"],
    "mart_user_activity_monthly": ["user_id", "month_key", "user_month_key"],
    "mart_subscription_revenue_monthly": ["subscription_id", "month_key", "subscription_month_key", "run_date_bq"],
    "prep_taxi_trip": ["md5_key", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid"],
    "fact_taxi_trip": ["md5_key", "taxi_type", "pickup_datetime", "pulocationid", "dolocationid"],
    "dim_payment_type": ["payment_type"],
    "dim_location": ["locationid"],
    "dim_holiday": ["date", "holiday_type", "hour", "holiday_hour"],
    "mart_taxi_trip_holiday_zone_flow": ["trip_date", "trip_hour", "pickup_zone", "dropoff_zone", "total_trip"],
    # The declared test on trip_hour is left out: this mart has no such column.
    "mart_taxi_trip_holiday_daily": ["trip_date", "total_trip"],
    "mart_taxi_trip_holiday_summary": ["year", "month", "holiday_type", "total_trip"],
}

# Columns whose values must not repeat.
_UNIQUE = {
    "prep_users": ["user_id", "email"],
    "prep_subscriptions": ["subscription_id"],
    "prep_movies": ["movie_id"],
    "prep_watch_sessions": ["session_id"],
    "prep_payments": ["payment_id"],
    "prep_ratings": ["rating_id"],
    "dim_users": ["user_id", "email"],
    "dim_subscriptions": ["subscription_id"],
    "dim_movies": ["movie_id"],
    "dim_date": ["date_key"],
    "fact_user_activity": ["session_id"],
    "fact_payments": ["payment_id"],
    "fact_ratings": ["rating_id"],
    "mart_movie_popularity_monthly": ["movie_month_key"],
    "mart_movie_rating_monthly": ["movie_month_key"],
    "mart_user_activity_monthly": ["user_month_key"],
    "mart_subscription_revenue_monthly": ["subscription_month_key"],
    "prep_taxi_trip": ["md5_key"],
    "fact_taxi_trip": ["md5_key"],
    "dim_payment_type": ["payment_type"],
    "dim_location": ["locationid"],
    "dim_holiday": ["holiday_hour"],
    "mart_taxi_trip_holiday_daily": ["trip_date"],
}

# References, as (child, column, parent, parent column).
_RELATIONSHIPS = [
    ("prep_subscriptions", "user_id", "prep_users", "user_id"),
    ("prep_watch_sessions", "user_id", "prep_users", "user_id"),
    ("prep_watch_sessions", "movie_id", "prep_movies", "movie_id"),
    ("prep_payments", "user_id", "prep_users", "user_id"),
    ("prep_payments", "subscription_id", "prep_subscriptions", "subscription_id"),
    ("prep_ratings", "user_id", "prep_users", "user_id"),
    ("prep_ratings", "movie_id", "prep_movies", "movie_id"),
    ("fact_taxi_trip", "pulocationid", "dim_location", "locationid"),
    ("fact_taxi_trip", "dolocationid", "dim_location", "locationid"),
    ("fact_taxi_trip", "payment_type", "dim_payment_type", "payment_type"),
]

# Allowed values of source columns.
_ACCEPTED = {
    "users": {"subscription_status": ["active", "inactive"]},
    "subscriptions": {"plan_type": ["Basic", "Standard", "Premium"], "status": ["active", "expired"]},
    "payments": {"status": ["pending", "completed", "failed"]},
}


def _named(model: str) -> str:
    return _SUITE_RELATION.get(model, model)


def _not_null_suite() -> str:
    selects = [
        _violations(model, "not_null", column, f'sum(case when "{column}" is null then 1 else 0 end)', _named(model))
        for model, columns in _NOT_NULL.items()
        for column in columns
    ]
    return " union all ".join(selects)


def _unique_suite() -> str:
    selects = [
        _violations(
            model,
            "unique",
            column,
            "count(*)",
            f"(select {column} from {_named(model)} where {column} is not null group by {column} having count(*) > 1)",
        )
        for model, columns in _UNIQUE.items()
        for column in columns
    ]
    return " union all ".join(selects)


def _relationship_suite() -> str:
    selects = [
        _violations(
            child,
            "relationships",
            column,
            "count(*)",
            f"(select c.{column} from {_named(child)} c left join {_named(parent)} p on c.{column} = p.{key} "
            f"where c.{column} is not null and p.{key} is null)",
        )
        for child, column, parent, key in _RELATIONSHIPS
    ]
    return " union all ".join(selects)


_VALID = {
    "subscriptions": {"price": "price > 0"},
    "movies": {"release_year": "release_year between 1900 and 2025", "duration_min": "duration_min > 0"},
    "watch_sessions": {"completion_rate": "completion_rate between 0 and 100"},
    "payments": {"amount": "amount > 0"},
    "ratings": {"rating_score": "rating_score between 1 and 5"},
}


def _accepted_suite() -> str:
    selects = []
    for table, columns in _ACCEPTED.items():
        for column, values in columns.items():
            listed = ", ".join(f"'{v}'" for v in values)
            selects.append(
                _violations(table, "accepted_values", column, f"sum(case when {column} not in ({listed}) then 1 else 0 end)", table)
            )
    return " union all ".join(selects)


def _range_suite() -> str:
    return " union all ".join(
        _violations(table, "range", column, f"sum(case when not ({test}) then 1 else 0 end)", table)
        for table, columns in _VALID.items()
        for column, test in columns.items()
    )


# ---- loans -----------------------------------------------------------------------------------------

_relation(
    "counters",
    f"""
    select p_partkey // 10 as snapshot_id, p_partkey % 10 as position, p_size, p_partkey,
           case when p_partkey % 97 = 5 then 'n/a' when p_partkey % 10 = 8 then p_size || ',250 orang'
                when p_partkey % 10 = 9 then p_size || ',125.75'
                else p_size || '.5 ' || {_pick("p_partkey % 8", "rb", "jt", "m", "t", "Ribu", "Juta", "Milyar", "Triliun")}
           end as amount_text
    from part""",
)
# The value each text was written from.
_relation(
    "amounts",
    """
    select snapshot_id, position, amount_text,
           case when p_partkey % 97 = 5 then null when p_partkey % 10 = 8 then p_size * 1000 + 250
                when p_partkey % 10 = 9 then p_size * 1000 + 125
                else cast((p_size + 0.5) * list_extract([1000, 1000000, 1000000000, 1000000000000, 1000, 1000000, 1000000000,
                                                         1000000000000], cast(p_partkey % 8 as int) + 1) as bigint)
           end as amount
    from counters""",
)
_MEASURES = {
    "penerima_dana_total": 0,
    "penerima_dana_tahun_berjalan": 1,
    "penerima_dana_posisi_akhir": 2,
    "dana_tersalurkan_total": 3,
    "dana_tersalurkan_tahun_berjalan": 4,
    "dana_tersalurkan_posisi_akhir": 5,
    "pemberi_dana_total": 7,
    "pemberi_dana_tahun_berjalan": 8,
    "pemberi_dana_posisi_akhir": 9,
}
_relation(
    "loan_stats",
    "select snapshot_id, "
    + ", ".join(f"max(case when position = {p} then amount end) as {name}" for name, p in _MEASURES.items())
    + f", date '{RUN_DATE}' as run_date_bq from amounts group by snapshot_id having count(amount) = 10 and count(*) = 10",
)

# ---- decisions -------------------------------------------------------------------------------------

_MONTHS = ", ".join(f"'{m}'" for m in MONTH_NAMES)
_relation(
    "decisions",
    f"""
    select c_custkey as doc_id, c_custkey || '/Pid.B/' || (2020 + c_custkey % 5) || '/PN ' || n_name as number,
           make_date(cast(2020 + c_custkey % 5 as int), cast(1 + c_custkey % 12 as int), cast(1 + c_custkey % 28 as int)) as decided,
           lower(c_name) as person, lower(n_name) as place,
           make_date(cast(1960 + c_custkey % 40 as int), cast(1 + c_custkey % 12 as int), cast(1 + c_custkey % 28 as int)) as birth,
           (1 + c_custkey % 28) || ' ' || list_extract([{_MONTHS}], cast(c_custkey % 12 as int) + 1) || ' '
             || (1960 + c_custkey % 40) as born,
           {_pick("c_custkey % 2", "Laki-laki", "Perempuan")} as gender, 'Jalan ' || c_custkey || ' ' || lower(c_mktsegment) as address,
           {_pick("c_custkey % 4", "Islam", "Kristen", "Hindu", "Budha")} as religion,
           {_pick("c_custkey % 3", "Swasta", "Petani", "Nelayan")} as job, cast(300 + c_custkey % 90 as varchar) as article,
           cast(10 + c_custkey % 30 as varchar) as law, (1 + c_custkey % 9) || ' (satu) buah ' || lower(c_mktsegment) as evidence,
           'https://decisions.example.org/direktori/putusan/' || md5(cast(c_custkey as varchar)) || '.html' as link
    from customer join nation on c_nationkey = n_nationkey""",
)
# Expected fields, stated from the facts the documents were written from.
_relation(
    "decision_fields",
    """
    select doc_id, number as no_putusan, upper(person[1]) || person[2:] as nama_terdakwa, place as tempat_lahir_terdakwa,
           birth as tanggal_lahir_terdakwa, lower(gender) as jenis_kelamin_terdakwa, 'indonesia' as kebangsaan_terdakwa,
           lower(address) as tempat_tinggal_terdakwa, lower(religion) as agama_terdakwa, lower(job) as pekerjaan_terdakwa,
           evidence || '; dan satu lembar surat;' as barang_bukti,
           'Pasal ' || article || ' ayat (1), Undang-Undang Nomor ' || law || ' Tahun 2009, jo. Undang-Undang Nomor '
             || law || ' Tahun 2009' as rujukan_hukum,
           'Menjatuhkan pidana kepada ' || person || '.' as amar_putusan
    from decisions""",
)
# The cleaned text, stated as a template of its own.
_relation(
    "decision_texts",
    """
    select doc_id, 'P U T U S A N' || chr(10) || prose || 'Nomor : ' || number || chr(10)
      || 'DEMI KEADILAN BERDASARKAN KETUHANAN YANG MAHA ESA' || chr(10) || prose || '1. Nama lengkap : ' || person || ';' || chr(10)
      || '2. Tempat lahir : ' || place || ';' || chr(10) || '3. Umur/Tanggal lahir : 44 tahun/' || born || ';' || chr(10)
      || '4. Jenis kelamin : ' || gender || ';' || chr(10) || '5. Kebangsaan : Indonesia;' || chr(10)
      || '6. Tempat tinggal : ' || address || ';' || chr(10) || '7. Agama : ' || religion || ';' || chr(10)
      || '8. Pekerjaan : ' || job || ';' || chr(10) || 'Terdakwa ditahan oleh penyidik.' || chr(10)
      || 'Menimbang, bahwa perbuatan ' || person || ' diatur dalam Pasal ' || article
      || ' ayat (1) KUHP. Menimbang, bahwa pidana dijatuhkan menurut Undang-Undang Nomor ' || law
      || '  Tahun 2009, jo. Undang-Undang Nomor ' || law || ' Tahun 2009. Barang bukti berupa: ' || evidence || ';' || chr(10)
      || '  dan satu lembar surat;' || chr(10) || 'Dirampas untuk dimusnahkan. Saksi di ' || place
      || ' melihat perbuatan itu! Apakah putusan itu adil?' || chr(10) || 'M E N G A D I L I :' || chr(10)
      || 'Menjatuhkan pidana kepada ' || person || '.' || chr(10) || 'Demikianlah diputuskan dalam rapat.' as text
    from (select d.*, coalesce(t.text || chr(10), '') as prose from decisions d left join documents t on t.doc_id = d.doc_id)""",
)


# ---- summaries -------------------------------------------------------------------------------------


def _lexrank(prefix: str, source: str, iterations: int, n_sentences: int) -> None:
    """Relations <prefix>_sentences ... <prefix>_top: continuous LexRank by joins over (document, term)."""
    _relation(
        f"{prefix}_sentences",
        f"""
        select doc_id, n, position, sentences[position + 1] as sentence from (
          select doc_id, len(sentences) as n, sentences, unnest(range(len(sentences))) as position from (
            select doc_id, list_filter(list_transform(
              string_split_regex(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(10) || chr(10), 'g'), '\\n\\s*\\n'),
              lambda s: trim(regexp_replace(s, '\\s+', ' ', 'g'))), lambda s: s <> '') as sentences
            from {source}))""",
    )
    _relation(
        f"{prefix}_tf",
        f"""
        select doc_id, n, position, term, count(*) as tf from (
          select doc_id, n, position, unnest(regexp_extract_all(lower(sentence), '[\\p{{L}}\\p{{N}}]+')) as term
          from {prefix}_sentences) group by all""",
    )
    _relation(
        f"{prefix}_w",
        f"""
        select doc_id, position, term, tf * ln(n / df) as w from {prefix}_tf
        join (select doc_id, term, count(*) as df from {prefix}_tf group by all) using (doc_id, term)""",
    )
    _relation(
        f"{prefix}_a",
        f"""
        select doc_id, position, term, w / norm as a from {prefix}_w
        join (select doc_id, position, sqrt(sum(w * w)) as norm from {prefix}_w group by all) using (doc_id, position)
        where norm > 0""",
    )

    def step(vector: str, value: str) -> str:
        """Similarity-weighted sum of a per-sentence value, as one sum per term and one per sentence."""
        return f"""
        select doc_id, position, sum(a * t) as s from {prefix}_a join (
          select doc_id, term, sum(a * {value}) as t from {prefix}_a join {vector} using (doc_id, position) group by all)
        using (doc_id, term) group by all"""

    _relation(f"{prefix}_p0", f"select doc_id, position, 1.0::double / n as p, n, 1.0::double as one from {prefix}_sentences")
    _relation(f"{prefix}_degree", step(f"{prefix}_p0", "one"))
    previous = f"{prefix}_p0"
    for i in range(1, iterations + 1):
        _relation(f"{prefix}_q{i}", f"select doc_id, position, p / s as q from {previous} join {prefix}_degree using (doc_id, position)")
        _relation(f"{prefix}_s{i}", step(f"{prefix}_q{i}", "q"))
        _relation(
            f"{prefix}_p{i}",
            f"""
            select v.doc_id, v.position, n, (1 - 0.85::double) / n + 0.85::double * coalesce(s, 0) as p
            from {previous} v left join {prefix}_s{i} s on v.doc_id = s.doc_id and v.position = s.position""",
        )
        previous = f"{prefix}_p{i}"
    _relation(
        f"{prefix}_top",
        f"""
        select doc_id, position, sentence from {prefix}_sentences join {previous} using (doc_id, position)
        qualify row_number() over (partition by doc_id order by round(p, 10) desc, position) <= {n_sentences}""",
    )
    _relation(
        f"{prefix}_summary",
        f"select doc_id, string_agg(sentence, ' ' order by position) as summary from {prefix}_top group by doc_id",
    )


LEXRANK_ITERATIONS = 60
_lexrank("prose", "documents", LEXRANK_ITERATIONS, 2)
_lexrank("ruling", "decision_texts", LEXRANK_ITERATIONS, 2)


def _keyword_filter(summary: str) -> str:
    kept = (
        f"list_filter(string_split({summary}, '. '), "
        "lambda s: regexp_matches(lower(s), 'putusan|terdakwa|hukuman|pidana|perdata|amar'))"
    )
    return f"case when len({kept}) > 0 then array_to_string({kept}, chr(10)) else {summary} end"


# ---- queries ---------------------------------------------------------------------------------------

_RAW_COLUMNS = (
    "vendorid, pickup_datetime, dropoff_datetime, pulocationid, dolocationid, payment_type, passenger_count, trip_distance, "
    "fare_amount, tip_amount, total_amount"
)
_ALERT = "event_type = 'error' or coalesce(buffer_duration_ms, 0) > 4000"
_LINE = (
    "'- User ' || user_id || ' Movie ' || movie_id || ' Event ' || event_type || ' Buffer ' || buffer_duration_ms || 'ms' || chr(10)"
)
_CUT = "timestamp '1999-07-01'"
_OVERLAP = "timestamp '1999-04-01'"


def _payment_row(amount: str = "cast(amount as double)") -> str:
    return f"select * replace ({amount} as amount)"


def statements() -> dict[str, str]:
    """One statement per registered query that SQL can express."""
    money = "* replace (cast(amount as double) as amount)"
    plain = {
        # sources
        "trip_source_lower": "select vendorid, pickup_datetime as tpep_pickup_datetime, dropoff_datetime as tpep_dropoff_datetime, "
        "pulocationid, dolocationid, payment_type, passenger_count, trip_distance, fare_amount, tip_amount, total_amount "
        "from trips where taxi_type = 'yellow'",
        "trip_months_pruned": "select vendorid, pickup_datetime as tpep_pickup_datetime, dropoff_datetime as tpep_dropoff_datetime, "
        "pulocationid, dolocationid, payment_type, passenger_count, trip_distance, fare_amount, tip_amount, total_amount "
        "from trips where taxi_type = 'yellow' and pickup_datetime >= timestamp '1998-01-01' and pickup_datetime < timestamp '1998-04-01'",
        "month_slice": "select year(o_orderdate) as order_year, month(o_orderdate) as order_month, o_orderkey, o_totalprice "
        "from orders where year(o_orderdate) = 1998 and month(o_orderdate) = 3",
        "extract_day": f"select {money} from payments where cast(created_at as date) = date '1998-03-14'",
        "extract_before": f"select {money} from payments where cast(created_at as date) < date '1998-03-14'",
        "month_window_scan": f"select {money} from payments where created_at >= timestamp '1998-03-01' and created_at < timestamp '1998-04-01'",
        "events_parse_json": "select event_id, session_id, user_id, movie_id, event_type, date_trunc('second', event_timestamp) "
        "as event_timestamp, buffer_duration_ms, cast(null as bigint) as bitrate_kbps, cast(null as varchar) as city, "
        "cast(null as varchar) as isp, cast(null as varchar) as country from playback",
        "events_to_json": """select '{"event_id":' || event_id || ',"session_id":' || session_id || ',"user_id":' || user_id
          || ',"movie_id":' || movie_id || ',"event_type":"' || event_type || '","event_timestamp":"'
          || strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') || '","buffer_duration_ms":' || buffer_duration_ms || '}' as value
          from playback""",
        "delete_where": f"select {money} from payments where not coalesce(status = 'failed' and amount > 100000, false)",
        "merge_upsert": f"""select * replace (cast(amount as double) as amount) from (
          select * from payments where created_at < {_OVERLAP}
          union all select * replace (amount + 1 as amount) from payments where created_at >= {_OVERLAP})""",
        "insert_ignore": f"""select * replace (cast(amount as double) as amount) from (
          select * from payments where created_at < {_CUT}
          union all select * replace (amount + 1 as amount) from payments where created_at >= {_CUT})""",
        "file_upsert_keep_last": f"""select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate from lineitem
          qualify row_number() over (partition by l_orderkey, l_linenumber
            order by l_shipdate >= {_CUT} desc, l_shipdate desc, l_partkey asc, l_quantity asc) = 1""",
        "last_id": "select max(o_orderkey) as last_id from orders",
        # projection, typing, keys, predicates
        "normalize_columns": "select c_custkey as customer_key, c_name as full_name, c_acctbal as balance from customer",
        "rename_columns": f"select {_RAW_COLUMNS} from trips",
        "select_required": "select c_custkey, c_mktsegment from customer",
        "datetime_expand": "select o_orderkey, o_orderdate, cast(year(o_orderdate) as int) as o_orderdate_year, "
        "cast(month(o_orderdate) as int) as o_orderdate_month, cast(day(o_orderdate) as int) as o_orderdate_day, "
        "cast(hour(o_orderdate) as int) as o_orderdate_hour, cast(isodow(o_orderdate) - 1 as int) as o_orderdate_day_of_week from orders",
        "run_date_stamp": "select o_orderkey, date '2025-10-28' as run_date from orders",
        "sha256_key": "select sha256(concat_ws('-', o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'))) as row_id, "
        "o_orderkey, o_custkey, o_orderdate from orders",
        "md5_key": f"select {_TRIP_COLUMNS.replace('md5_key, ', '')}, md5({_TRIP_KEY_TEXT}) as md5_key from trips",
        "align_schema": "select o_orderkey, cast(round(o_totalprice, 2) as double) as o_totalprice, o_orderdate, "
        "cast(null as bigint) as o_orderpriority, o_orderstatus from orders",
        "cast_date_int": "select o_orderkey, cast(o_orderdate as date) as o_orderdate, cast(null as bigint) as o_orderstatus, "
        "o_totalprice from orders",
        "weekend_night_trips": f"select distinct {_RAW_COLUMNS.replace('pickup_datetime, dropoff_datetime', 'pickup_datetime as tpep_pickup_datetime, dropoff_datetime as tpep_dropoff_datetime')} "
        f"from trips where taxi_type = 'yellow' and {_NIGHT}",
        "trip_ingest": "select distinct " + _RAW_COLUMNS.replace("payment_type", "cast(payment_type as bigint) as payment_type")
        + f", taxi_type from trips where {_NIGHT}",
        "doc_path": "select number as no_putusan, 'files/pdf/' || year(decided) || '/' || replace(replace(number, '/', '_'), ' ', '_') "
        "|| '.pdf' as path from decisions",
        "playback_alerts": f"select *, date '{RUN_DATE}' as run_date from playback where {_ALERT}",
        # joins
        "semi_holiday": "select f.* from fact_taxi_trip f where exists (select 1 from dim_holiday h "
        "where h.date = cast(f.pickup_datetime as date) and h.hour = hour(f.pickup_datetime))",
        "cascade_prune": f"select {money} from payments where user_id in (select user_id from users where subscription_status = 'active')",
        # trips
        "trip_union": "select * from trip_union",
        "trip_clean": "select * from trip_clean",
        "trip_dedup": "select * from trip_dedup",
        "prep_taxi_trip": "select * from prep_taxi_trip",
        "fact_taxi_trip": "select * from fact_taxi_trip",
        "zone_flow": f"select {_DOUBLE_REVENUE} from zone_flow",
        "holiday_daily": f"select {_DOUBLE_REVENUE} from holiday_daily",
        "holiday_summary": f"select {_DOUBLE_REVENUE} from holiday_summary",
        "holiday_summary_fixed": f"select {_DOUBLE_REVENUE} from ({_summary('select distinct date, holiday_type from dim_holiday')})",
        "dim_holiday": "select * from dim_holiday",
        "dim_location": "select * from zones",
        "trips_by_payment_type": f"select payment_type, {_pick('payment_type', 'Flex Fare trip', 'Credit card', 'Cash', 'No charge', 'Dispute', 'Unknown', 'Voided trip')} "
        f"as payment_desc, count(*) as total_trip, cast({_sum('total_amount')} as double) as total_revenue from fact_taxi_trip group by payment_type",
        "merge_upsert_composite": f"select {_DOUBLE_REVENUE} from zone_flow",
        "zone_flow_merge_fixed": f"select {_DOUBLE_REVENUE} from zone_flow",
        # subscription video
        **{name: f"select * from {name}" for name in ("prep_users", "prep_movies", "prep_ratings", "prep_subscriptions", "prep_watch_sessions")},
        "prep_payments": f"select {money} from prep_payments",
        "dedup_latest": "select * from (select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from lineitem) "
        + _first("l_orderkey, l_linenumber", "l_shipdate", "desc", "l_partkey l_suppkey"),
        **{name: f"select * from {name}" for name in ("dim_users", "dim_movies", "dim_subscriptions", "dim_date")},
        **{name: f"select * from {name}" for name in ("fact_user_activity", "fact_ratings", "fact_movie_popularity")},
        "fact_payments": f"select {money} from fact_payments",
        "mart_movie_popularity": "select * from mart_movie_popularity",
        "mart_movie_popularity_fixed": "select * from mart_movie_popularity_exact",
        "mart_movie_popularity_states": "select * from mart_movie_popularity_exact",
        "mart_user_activity_deltas": "select * from mart_user_activity",
        "mart_movie_rating": "select * from mart_movie_rating",
        "mart_user_activity": "select * from mart_user_activity",
        "mart_subscription_revenue": "select * from mart_subscription_revenue",
        "subscription_cohorts": "select * from cohorts",
        "subscription_cohorts_incremental_fixed": "select * from cohorts",
        "trailing_window_fixed": "select * from fact_movie_popularity where date_key >= date '1999-05-01'",
        "subscription_churn_fixed": "select cast(last_month + interval 1 month as date) as month_key, count(*) as churned_users "
        "from (select subscription_id, max(month_key) as last_month from revenue group by 1) "
        "where last_month < (select max(month_key) from revenue) group by 1",
        # incremental rules
        "incremental_since_max": f"select {money} from payments where run_date_bq > "
        f"(select max(run_date_bq) from payments where created_at < {_CUT})",
        "incremental_event_date": "select * from watch_sessions where cast(start_time as date) > "
        f"(select max(cast(start_time as date)) from watch_sessions where created_at < {_CUT})",
        "incremental_lookback_months": f"select * from trips where date_trunc('month', pickup_datetime) >= "
        f"(select date_trunc('month', max(pickup_datetime)) - interval 2 month from trips where pickup_datetime < {_CUT})",
        "incremental_trailing_window": "select * from fact_movie_popularity where date_trunc('month', date_key) >= "
        "date '1999-07-15' - interval 2 month",
        # quality
        "dq_not_null": _not_null_suite(),
        "dq_unique": _unique_suite(),
        "dq_relationships": _relationship_suite(),
        "dq_accepted_values": _accepted_suite(),
        "dq_range": _range_suite(),
        "dq_count_reconcile": "select year(decided) as year, month(decided) as month, count(*) as collected_total, "
        "cast(sum(doc_id % 3) as bigint) as declared_total, cast(sum(doc_id % 3) as bigint) - count(*) as difference from decisions group by 1, 2",
        # streaming twins
        "alert_windows": "select time_bucket(interval 2 minute, event_timestamp) as window_start, "
        "time_bucket(interval 2 minute, event_timestamp) + interval 2 minute as window_end, count(*) as n_alerts "
        f"from playback where {_ALERT} group by 1, 2",
        "alert_digest": "select w as window_start, part, '⚠️ ' || strftime(w + interval 2 minute + interval 7 hour, "
        "'%Y-%m-%d %H:%M:%S') || ' - ' || count(*) || ' alerts' || chr(10) || string_agg(line, '' order by event_timestamp, event_id) as message "
        f"from (select *, time_bucket(interval 2 minute, event_timestamp) as w, cast(event_id % 8 + 1 as bigint) as part, {_LINE} as line "
        f"from playback where {_ALERT}) group by w, part",
        # text and pages
        "page_links": "select page_id, url, cast(position - 1 as int) as position, href from (select page_id, url, unnest(links) as href, "
        "generate_subscripts(links, 1) as position from (select page_id, url, regexp_extract_all(html, '<a\\s[^>]*href=\"([^\"]*)\"', 1) "
        "as links from pages))",
        "listing_records": "select doc_id as page_id, 0 as position, number as no_putusan, decided as tgl_putusan, "
        "link as link_page_putusan from decisions",
        "listing_totals": "select doc_id as page_id, cast(month(decided) as int) as month, doc_id % 3 as declared_total from decisions",
        "detail_fields": f"""select doc_id as page_id, link as link_page_putusan, person as nama_terdakwa,
          case when doc_id % 3 <> 0 then '/pdf/' || doc_id else 'no_pdf_file' end as link_pdf_putusan, number as no_putusan,
          'Pertama' as tingkat_proses, evidence as kata_kunci, 'PN ' || place as lembaga_pengadilan,
          cast(null as varchar) as jenis_lembaga_peradilan, 'A & B' as hakim_ketua, 'C;' || chr(10) || 'D' as hakim_anggota,
          cast(null as varchar) as panitera, 'Lain-lain' as amar, cast(null as varchar) as amar_lainnya,
          cast(null as varchar) as catatan_amar, 'Pidana - Umum' as klasifikasi, year(decided) as tahun, decided as tgl_register,
          cast(null as date) as tgl_musyawarah, decided as tgl_dibacakan from decisions""",
        "decision_details": """select number as no_putusan, decided as tgl_putusan, link as link_page_putusan, person as nama_terdakwa,
          case when doc_id % 3 <> 0 then '/pdf/' || doc_id else 'no_pdf_file' end as link_pdf_putusan,
          case when doc_id % 3 <> 0 then 'files/pdf/' || year(decided) || '/' || replace(replace(number, '/', '_'), ' ', '_') || '.pdf' end
            as gcs_pdf_path, year(decided) as tahun, decided as tgl_register from decisions""",
        "indonesian_date": "select doc_id, born, birth as birth_date from decisions",
        "doc_clean": "select doc_id, trim(regexp_replace(text, '\\n{2,}', chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)) "
        "as clean_text from documents",
        "decision_clean": "select doc_id, text as clean_text from decision_texts",
        "doc_number": "select doc_id, no_putusan from decision_fields",
        "biodata": "select doc_id, nama_terdakwa, tempat_lahir_terdakwa, tanggal_lahir_terdakwa, jenis_kelamin_terdakwa, kebangsaan_terdakwa, "
        "tempat_tinggal_terdakwa, agama_terdakwa, pekerjaan_terdakwa from decision_fields",
        "legal_references": "select doc_id, rujukan_hukum from decision_fields",
        "ruling_text": "select doc_id, amar_putusan from decision_fields",
        "evidence_text": "select doc_id, barang_bukti from decision_fields",
        "summary_topn": "select doc_id, cast(position as int) as position, sentence from prose_top",
        "keyword_sentences": f"select doc_id, {_keyword_filter('summary')} as summary_extractive_short from prose_summary",
        "decision_extracts": f"""select number as no_putusan, decided as tgl_putusan, {_keyword_filter("summary")} as summary_extractive_short,
          f.* exclude (doc_id, no_putusan), 'files/extract/' || year(decided) || '/' || replace(replace(number, '/', '_'), ' ', '_') || '.txt'
          as gcs_extract_pdf_path, date '{RUN_DATE}' as run_date
          from decisions join decision_fields f using (doc_id) join ruling_summary using (doc_id)""",
        # loans
        "normalize_amount_text": "select snapshot_id, position, amount_text, amount from amounts",
        "loan_stats": "select * from loan_stats",
        "daily_report": f"""select snapshot_id, 'date {RUN_DATE}' || chr(10) || '**Penerima Dana** - Posisi Akhir: '
          || format('{{:,}}', penerima_dana_posisi_akhir) || chr(10) || '**Pemberi Dana** - Posisi Akhir: '
          || format('{{:,}}', pemberi_dana_posisi_akhir) || chr(10) || '**Dana Tersalurkan** - Posisi Akhir: '
          || format('{{:,}}', dana_tersalurkan_posisi_akhir) as message from loan_stats""",
    }
    return {name: _with(statement) for name, statement in plain.items()}
