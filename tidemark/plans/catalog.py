"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` and the
matching DuckDB SQL used as an independent oracle.

Every query reads the given tables (or data Spark derives from them), in
full. Floating columns are rounded to 6 decimals on both sides; counts are
BIGINT on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import activity
from tidemark.schemas import EVENTS_TABLE_COLS as EV
from tidemark.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _events(spark, d):
    return table(spark, d, "events")


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- activity

DAU_START = dt.datetime(2024, 1, 5, 13, 0, 0)


@register("dau_exact", """
select cast(ts as date) as date, count(distinct user_id) as daily_active_users
from events group by 1
""")
def q_dau_exact(spark, d):
    return activity.daily_active(_events(spark, d), cols=EV)


@register("dau_since", """
select cast(ts as date) as date, count(distinct user_id) as daily_active_users
from events where cast(ts as date) >= date '2024-01-05' group by 1
""")
def q_dau_since(spark, d):
    return activity.daily_active(_events(spark, d), start=DAU_START, cols=EV)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (both engines sum floats in other orders)."""
    return df.select([F.round(F.col(f.name), digits).alias(f.name)
                      if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                      for f in df.schema.fields])


def rsql(sql: str, *double_cols: str) -> str:
    """Wrap an oracle query so the listed double columns are rounded."""
    if not double_cols:
        return sql
    rep = ", ".join(f"round({c}, 6) as {c}" for c in double_cols)
    return f"select * replace ({rep}) from ({sql.strip()}) as q"


@register("rolling_dau_sum_31", """
with d as (select cast(ts as date) as date, count(distinct user_id) as daily_active_users
           from events group by 1)
select date, daily_active_users,
       cast(sum(daily_active_users) over (order by date rows between 30 preceding and current row)
            as bigint) as monthly_active_users
from d
""")
def q_rolling_dau_sum(spark, d):
    return activity.rolling_dau_sum(activity.daily_active(_events(spark, d), cols=EV), rows=31)


def _rolling_sql(days: int) -> str:
    return f"""
with ud as (select distinct user_id, cast(ts as date) as date from events where user_id is not null),
dates as (select distinct date from ud)
select d.date, count(distinct ud.user_id) as active_users_{days}d
from dates d join ud on ud.date <= d.date and ud.date > d.date - {days}
group by d.date
"""


@register("mau_rolling_exact", _rolling_sql(30))
def q_mau_rolling_exact(spark, d):
    return activity.rolling_active_users(_events(spark, d), 30, cols=EV)


@register("wau_rolling_exact", _rolling_sql(7))
def q_wau_rolling_exact(spark, d):
    return activity.rolling_active_users(_events(spark, d), 7, cols=EV)


@register("dau_approx")
def q_dau_approx(spark, d):
    return activity.daily_active(_events(spark, d), cols=EV, approx=True)


@register("mau_rolling_hll")
def q_mau_rolling_hll(spark, d):
    return activity.rolling_active_users_approx(_events(spark, d), 30, cols=EV)


@register("mau_calendar", """
select cast(date_trunc('month', ts) as date) as month, count(distinct user_id) as monthly_active_users
from events group by 1
""")
def q_mau_calendar(spark, d):
    return activity.monthly_active(_events(spark, d), cols=EV)


@register("user_day", rsql("""
select cast(ts as date) as date, user_id, count(*) as actions, min(ts) as first_ts,
       max(ts) as last_ts, sum(value) as total_measure
from events where user_id is not null group by 1, 2
""", "total_measure"))
def q_user_day(spark, d):
    return rounded(activity.user_day_summary(_events(spark, d), cols=EV))


@register("dau_from_user_day", """
select date, count(*) as daily_active_users
from (select distinct cast(ts as date) as date, user_id from events where user_id is not null) as t
group by 1
""")
def q_dau_from_user_day(spark, d):
    return activity.dau_from_user_days(activity.user_day_summary(_events(spark, d), cols=EV))


@register("action_mix", """
select cast(ts as date) as date, event_type as action_type, count(*) as events,
       count(distinct user_id) as users
from events group by 1, 2
""")
def q_action_mix(spark, d):
    return activity.action_mix(_events(spark, d), cols=EV)


@register("dau_purchasers", """
select cast(ts as date) as date, count(distinct user_id) as daily_active_users
from events where event_type in ('purchase', 'click') group by 1
""")
def q_dau_purchasers(spark, d):
    return activity.daily_active(_events(spark, d), cols=EV, actions=("purchase", "click"))


# ---------------------------------------------------------------- sessions

from tidemark.operators import sessions as sess  # noqa: E402


def _session_cte(midnight: bool, timeout: int = 30) -> str:
    day_rule = "or cast(ts as date) <> cast(prev_timestamp as date)" if midnight else ""
    return f"""
a as (select *, lag(ts) over (partition by user_id order by ts, event_id) as prev_timestamp
      from events where user_id is not null and ts is not null),
b as (select *, case when prev_timestamp is null then 0.0
                     else (floor(epoch(ts)) - floor(epoch(prev_timestamp))) / 60 end
                as time_diff_minutes from a),
c as (select *, case when prev_timestamp is null or time_diff_minutes > {timeout} {day_rule}
                     then 1 else 0 end as new_session from b),
e as (select *, cast(sum(new_session) over (partition by user_id order by ts, event_id
                     rows between unbounded preceding and current row) as bigint) as session_num
      from c),
s as (select *, concat(cast(user_id as varchar), '_', cast(session_num as varchar)) as session_id
      from e)"""


def _session_events_sql(midnight: bool) -> str:
    return rsql(f"with {_session_cte(midnight)} select * from s", "time_diff_minutes")


def _sessions_sql(midnight: bool, timeout: int = 30) -> str:
    return rsql(f"""with {_session_cte(midnight, timeout)}
select user_id, session_id, count(*) as actions_per_session, min(ts) as session_start,
       max(ts) as session_end, avg(time_diff_minutes) as avg_time_between_actions,
       avg(case when new_session = 0 then time_diff_minutes end) as avg_gap_in_session,
       (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 3600 as session_duration_hours
from s group by user_id, session_id""", "avg_time_between_actions", "avg_gap_in_session",
                "session_duration_hours")


@register("session_events_midnight", _session_events_sql(True))
def q_session_events_midnight(spark, d):
    return rounded(sess.session_events(_events(spark, d), 30, True, cols=EV))


@register("session_events_plain", _session_events_sql(False))
def q_session_events_plain(spark, d):
    return rounded(sess.session_events(_events(spark, d), 30, False, cols=EV))


@register("sessions_midnight", _sessions_sql(True))
def q_sessions_midnight(spark, d):
    return rounded(sess.sessions(_events(spark, d), 30, True, cols=EV))


@register("sessions_plain", _sessions_sql(False))
def q_sessions_plain(spark, d):
    return rounded(sess.sessions(_events(spark, d), 30, False, cols=EV))


@register("sessions_timeout_15", _sessions_sql(True, 15))
def q_sessions_timeout_15(spark, d):
    return rounded(sess.sessions(_events(spark, d), 15, True, cols=EV))


@register("sessions_timeout_60", _sessions_sql(True, 60))
def q_sessions_timeout_60(spark, d):
    return rounded(sess.sessions(_events(spark, d), 60, True, cols=EV))


# ---------------------------------------------------------------- cleaning, summaries

from tidemark.operators import outliers, summary  # noqa: E402

_SESSION_COLS = ("user_id, session_id, actions_per_session, session_start, session_end, "
                 "avg_time_between_actions, avg_gap_in_session, session_duration_hours")


def _clean_cte() -> str:
    return f"""{_session_cte(True)},
ss as (select user_id, session_id, count(*) as actions_per_session, min(ts) as session_start,
              max(ts) as session_end, avg(time_diff_minutes) as avg_time_between_actions,
              avg(case when new_session = 0 then time_diff_minutes end) as avg_gap_in_session,
              (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 3600 as session_duration_hours
       from s group by user_id, session_id),
v as (select * from ss where session_duration_hours <= 24 and actions_per_session >= 2),
q as (select quantile_disc(session_duration_hours, 0.25) as q1_duration,
             quantile_disc(session_duration_hours, 0.75) as q3_duration,
             quantile_disc(actions_per_session, 0.25) as q1_actions,
             quantile_disc(actions_per_session, 0.75) as q3_actions from v),
bnd as (select *, q3_duration - q1_duration as iqr_duration, q3_actions - q1_actions as iqr_actions,
               q3_duration + 1.5::double * (q3_duration - q1_duration) as duration_upper_bound,
               q3_actions + 1.5::double * (q3_actions - q1_actions) as actions_upper_bound from q),
cl as (select v.* from v, bnd where v.session_duration_hours <= bnd.duration_upper_bound
                              and v.actions_per_session <= bnd.actions_upper_bound)"""


def _valid(spark, d):
    return sess.valid_sessions(sess.sessions(_events(spark, d), 30, True, cols=EV))


def _clean(spark, d):
    v = _valid(spark, d)
    return outliers.clean_sessions(v, outliers.iqr_bounds(v))


_SESS_DOUBLES = ("avg_time_between_actions", "avg_gap_in_session", "session_duration_hours")


@register("sessions_valid", rsql(f"with {_clean_cte()} select * from v", *_SESS_DOUBLES))
def q_sessions_valid(spark, d):
    return rounded(_valid(spark, d))


@register("iqr_bounds", rsql(f"with {_clean_cte()} select * from bnd",
                             "q1_duration", "q3_duration", "iqr_duration",
                             "duration_upper_bound", "actions_upper_bound"))
def q_iqr_bounds(spark, d):
    return rounded(outliers.iqr_bounds(_valid(spark, d)))


@register("sessions_clean", rsql(f"with {_clean_cte()} select * from cl", *_SESS_DOUBLES))
def q_sessions_clean(spark, d):
    return rounded(_clean(spark, d))


@register("sessions_removed", rsql(f"""with {_clean_cte()}
select (select count(*) from ss) as n_sessions, (select count(*) from v) as n_valid,
       (select count(*) from cl) as n_clean, (select count(*) from ss) - (select count(*) from cl)
       as n_removed, duration_upper_bound, actions_upper_bound from bnd""",
                                   "duration_upper_bound", "actions_upper_bound"))
def q_sessions_removed(spark, d):
    return rounded(summary.cleaning_funnel(sess.sessions(_events(spark, d), 30, True, cols=EV)))


@register("session_summary", rsql(f"""with {_clean_cte()}
select count(session_id) as total_valid_sessions, count(distinct user_id) as unique_users,
       avg(session_duration_hours) as avg_session_duration_hours,
       stddev_samp(session_duration_hours) as stddev_session_duration,
       avg(actions_per_session) as avg_actions_per_session,
       stddev_samp(actions_per_session) as stddev_actions_per_session,
       quantile_disc(session_duration_hours, 0.25) as duration_q1,
       quantile_disc(session_duration_hours, 0.5) as duration_median,
       quantile_disc(session_duration_hours, 0.75) as duration_q3,
       quantile_disc(actions_per_session, 0.25) as actions_q1,
       quantile_disc(actions_per_session, 0.5) as actions_median,
       quantile_disc(actions_per_session, 0.75) as actions_q3
from cl""", "avg_session_duration_hours", "stddev_session_duration", "avg_actions_per_session",
                                  "stddev_actions_per_session", "duration_q1", "duration_median",
                                  "duration_q3"))
def q_session_summary(spark, d):
    return rounded(summary.session_summary(_clean(spark, d), compat_strings=False))


@register("session_time_of_week", rsql(f"""with {_clean_cte()}
select cast(hour(session_start) as integer) as hour_of_day,
       cast(dayofweek(session_start) + 1 as integer) as day_of_week,
       count(session_id) as session_count, avg(session_duration_hours) as avg_duration,
       avg(actions_per_session) as avg_actions
from cl group by 1, 2""", "avg_duration", "avg_actions"))
def q_session_time_of_week(spark, d):
    return rounded(summary.time_of_week(_clean(spark, d)))


@register("session_ratio", rsql(f"""with {_clean_cte()}
select count(*) as sessions, sum(session_duration_hours) as total_session_hours,
       cast(sum(actions_per_session) as bigint) as total_actions,
       sum(session_duration_hours) / count(*) as hours_per_session,
       sum(actions_per_session) / count(*) as actions_per_session
from cl""", "total_session_hours", "hours_per_session", "actions_per_session"))
def q_session_ratio(spark, d):
    return rounded(summary.session_ratios(_clean(spark, d)))


@register("event_value_capped", rsql("""
with q as (select quantile_disc(value, 0.25) as q1, quantile_disc(value, 0.75) as q3 from events),
b as (select q1 - 1.5::double * (q3 - q1) as lo, q3 + 1.5::double * (q3 - q1) as hi from q)
select event_id, user_id, ts, value, coalesce(value < lo or value > hi, false) as is_outlier,
       least(greatest(value, lo), hi) as value_capped
from events, b""", "value", "value_capped"))
def q_event_value_capped(spark, d):
    ev = _events(spark, d).select("event_id", "user_id", "ts", "value")
    return rounded(outliers.handle_outliers(ev, "value", mode="flag"))


@register("event_value_dropped", rsql("""
with q as (select quantile_disc(value, 0.25) as q1, quantile_disc(value, 0.75) as q3 from events),
b as (select q1 - 1.5::double * (q3 - q1) as lo, q3 + 1.5::double * (q3 - q1) as hi from q)
select event_id, user_id, value from events, b where value >= lo and value <= hi""", "value"))
def q_event_value_dropped(spark, d):
    ev = _events(spark, d).select("event_id", "user_id", "value")
    return rounded(outliers.handle_outliers(ev, "value", mode="drop"))


# ---------------------------------------------------------------- enrichment and skew

from tidemark.operators import enrich as en  # noqa: E402


def user_dimension(spark, d) -> DataFrame:
    """User attributes: latest customer row per key, with its nation name."""
    cust = table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey",
        F.col("c_mktsegment").alias("segment"), "c_name")
    cust = en.latest_per_key(cust, "user_id", order=["c_name"])
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                              F.col("n_name").alias("country"))
    return (en.enrich(cust, nation, "c_nationkey", "left", "broadcast")
            .select("user_id", "country", "segment"))


_ENRICH_SQL = """
select e.event_id, e.user_id, e.ts, e.event_type, e.value, n.n_name as country,
       c.c_mktsegment as segment
from events e left join customer c on e.user_id = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey
"""


def _enriched(spark, d, strategy, **kw):
    ev = _events(spark, d).select("event_id", "user_id", "ts", "event_type", "value")
    return en.enrich(ev, user_dimension(spark, d), "user_id", "left", strategy=strategy, **kw)


@register("enrich_broadcast", _ENRICH_SQL)
def q_enrich_broadcast(spark, d):
    return _enriched(spark, d, "broadcast")


@register("enrich_shuffle_hash", _ENRICH_SQL)
def q_enrich_shuffle_hash(spark, d):
    return _enriched(spark, d, "shuffle_hash")


@register("enrich_merge", _ENRICH_SQL)
def q_enrich_merge(spark, d):
    return _enriched(spark, d, "merge")


@register("enrich_salted", _ENRICH_SQL)
def q_enrich_salted(spark, d):
    return _enriched(spark, d, "salted", salt_col="event_id")


@register("hot_users", rsql("""
select user_id, count(*) as events, count(*) / (select count(*) from events) as share
from events where user_id is not null group by 1 order by events desc, user_id limit 10
""", "share"))
def q_hot_users(spark, d):
    return rounded(en.hot_keys(_events(spark, d), "user_id", k=10))


@register("metadata_latest", """
select o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from (select *, row_number() over (partition by o_custkey
                                   order by o_orderdate desc, o_orderkey desc) as rn
      from orders) as t where rn = 1
""")
def q_metadata_latest(spark, d):
    return en.latest_per_key(table(spark, d, "orders"), "o_custkey",
                             order=["o_orderdate", "o_orderkey"])


@register("segment_activity", rsql("""
select n.n_name as country, c.c_mktsegment as segment, count(*) as events,
       count(distinct e.user_id) as users, avg(e.value) as avg_measure
from events e left join customer c on e.user_id = c.c_custkey
left join nation n on c.c_nationkey = n.n_nationkey group by 1, 2
""", "avg_measure"))
def q_segment_activity(spark, d):
    return rounded(en.segment_activity(_events(spark, d), user_dimension(spark, d), "user_id",
                                       ["country", "segment"], "value"))


# ---------------------------------------------------------------- quality, diff

from tidemark.operators import diff as dff  # noqa: E402
from tidemark.operators import quality as dq  # noqa: E402

AS_OF = dt.datetime(2024, 1, 20, 0, 0, 0)
_AS_OF_SQL = "timestamp '2024-01-20 00:00:00'"
_EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
_DUP_KEYS = ["user_id", "ts", "event_type", "value", "props"]
_TYPES_SQL = ", ".join(f"'{t}'" for t in dq.EVENT_TYPES)
_RULES_SQL = {
    "null_user": "user_id is null",
    "null_timestamp": "ts is null",
    "null_action": "event_type is null",
    "unknown_action": f"event_type is not null and event_type not in ({_TYPES_SQL})",
    "negative_measure": "value < 0",
    "future_timestamp": f"ts > {_AS_OF_SQL}",
}


def _event_rules():
    return dq.event_rules("user_id", "ts", "event_type", "value", dq.EVENT_TYPES, AS_OF)


@register("quality_nulls", " union all ".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count from events"
    for c in _EVENT_COLUMNS))
def q_quality_nulls(spark, d):
    return dq.null_counts(_events(spark, d))


@register("quality_future", f"""
select count(*) filter (where ts > {_AS_OF_SQL}) as future_records from events
""")
def q_quality_future(spark, d):
    return dq.future_records(_events(spark, d), "ts", AS_OF)


@register("quality_rules", " union all ".join(
    [f"select '{n}' as check_name, count(*) filter (where {c}) as n_bad from events"
     for n, c in _RULES_SQL.items()]
    + [f"""select 'duplicate_rows' as check_name, coalesce(cast(sum(c - 1) as bigint), 0) as n_bad
          from (select count(*) as c from events group by {', '.join(_DUP_KEYS)}
                having count(*) > 1) as t""",
       """select 'orphan_rows' as check_name, count(*) as n_bad from events e
          where not exists (select 1 from customer c where c.c_custkey = e.user_id)"""]))
def q_quality_rules(spark, d):
    return dq.quality_rules(_events(spark, d), _event_rules(), _DUP_KEYS,
                            table(spark, d, "customer"), "user_id", "c_custkey")


@register("orphan_users", """
select user_id, count(*) as events from events e
where not exists (select 1 from customer c where c.c_custkey = e.user_id) group by 1
""")
def q_orphan_users(spark, d):
    return dq.orphans_per_key(_events(spark, d), table(spark, d, "customer"), "user_id", "c_custkey")


@register("duplicate_events", f"""
select {', '.join(_DUP_KEYS)}, count(*) as copies from events
group by {', '.join(_DUP_KEYS)} having count(*) > 1
""")
def q_duplicate_events(spark, d):
    return dq.duplicates(_events(spark, d), _DUP_KEYS)


@register("quarantine_events", f"""
select event_id, user_id, ts,
       concat_ws(',', {', '.join(f"case when {c} then '{n}' end" for n, c in _RULES_SQL.items())})
       as dq_failures
from events where {' or '.join(f'coalesce({c}, false)' for c in _RULES_SQL.values())}
""")
def q_quarantine_events(spark, d):
    _, bad = dq.split_quarantine(_events(spark, d).select("event_id", "user_id", "ts",
                                                          "event_type", "value"), _event_rules())
    return bad.select("event_id", "user_id", "ts",
                      F.array_join("dq_failures", ",").alias("dq_failures"))


_DIFF_LEFT = "select user_id, event_type from events where event_type <> 'error'"
_DIFF_RIGHT = "select user_id, event_type from events where value < 50"


def _diff_sides(spark, d):
    ev = _events(spark, d)
    return (ev.where(F.col("event_type") != "error").select("user_id", "event_type"),
            ev.where(F.col("value") < 50).select("user_id", "event_type"))


@register("dataset_diff_all", f"""
select user_id, event_type, 'left_only' as side, count(*) as copies
from ({_DIFF_LEFT} except all {_DIFF_RIGHT}) as a group by 1, 2
union all
select user_id, event_type, 'right_only' as side, count(*) as copies
from ({_DIFF_RIGHT} except all {_DIFF_LEFT}) as b group by 1, 2
""")
def q_dataset_diff_all(spark, d):
    return dff.diff_rows(*_diff_sides(spark, d), bag=True)


@register("dataset_diff_distinct", f"""
select *, 'left_only' as side from ({_DIFF_LEFT} except {_DIFF_RIGHT}) as a
union all
select *, 'right_only' as side from ({_DIFF_RIGHT} except {_DIFF_LEFT}) as b
""")
def q_dataset_diff_distinct(spark, d):
    return dff.diff_rows(*_diff_sides(spark, d), bag=False)


# ---------------------------------------------------------------- sources, sinks, layouts

from tidemark.operators import partitioning as part  # noqa: E402
from tidemark.schemas import EVENTS as EVENTS_SCHEMA  # noqa: E402
from tidemark.session import scratch_path, table_path  # noqa: E402
from tidemark.sources import datagen, readers, sinks  # noqa: E402


@register("csv_roundtrip", "select * from events")
def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "events-csv")
    sinks.write_csv(_events(spark, d), path)
    return readers.read_csv(spark, path, EVENTS_SCHEMA)


def _layout(spark, d, layout):
    path = scratch_path(spark, f"events-{layout}")
    sinks.write_layout(_events(spark, d), path, layout, "ts", "user_id", n_buckets=16)
    return path


@register("parquet_by_date", "select *, cast(ts as date) as date from events")
def q_parquet_by_date(spark, d):
    return spark.read.parquet(_layout(spark, d, "date"))


@register("parquet_date_hour",
          "select *, cast(ts as date) as date, cast(hour(ts) as integer) as hour from events")
def q_parquet_date_hour(spark, d):
    return spark.read.parquet(_layout(spark, d, "date_hour"))


@register("parquet_user_bucket", "select * from events")
def q_parquet_user_bucket(spark, d):
    return spark.read.parquet(_layout(spark, d, "user_id_partition")).drop("user_id_partition")


@register("parquet_date_bucket", "select *, cast(ts as date) as date from events")
def q_parquet_date_bucket(spark, d):
    return spark.read.parquet(_layout(spark, d, "date_bucket")).drop("user_id_partition")


@register("pruned_range", """
select *, cast(ts as date) as date from events
where cast(ts as date) between date '2024-01-05' and date '2024-01-11'
""")
def q_pruned_range(spark, d):
    return sinks.read_date_range(spark, _layout(spark, d, "date"),
                                 dt.date(2024, 1, 5), dt.date(2024, 1, 11))


@register("repartitioned_hash", """
select cast(ts as date) as date, count(distinct user_id) as daily_active_users
from events group by 1
""")
def q_repartitioned_hash(spark, d):
    ev = part.partition_by_user(_events(spark, d), "user_id", method="hash", salt_col="event_id")
    return activity.daily_active(ev, cols=EV)


@register("repartitioned_range", ORACLE["repartitioned_hash"])
def q_repartitioned_range(spark, d):
    ev = part.partition_by_user(_events(spark, d), "user_id", method="range", salt_col="event_id")
    return activity.daily_active(ev, cols=EV)


def _hex_sql(name: str) -> str:
    return (f"('0x' || substr(md5(concat_ws(':', cast(id as varchar), '42', '{name}')), 1, 8))"
            "::bigint")


def _list_sql(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_TS_SPAN = int((datagen.TS_END - datagen.TS_START).total_seconds())
_JOIN_DAYS = (datagen.JOIN_END - datagen.JOIN_START).days


@register("synthetic_interactions", f"""
with ids as (select event_id as id from events)
select id,
       printf('u%06d', 1 + {_hex_sql('user_id')} % {datagen.USER_IDS}) as user_id,
       timestamp '{datagen.TS_START:%Y-%m-%d %H:%M:%S}'
         + to_seconds({_hex_sql('timestamp')} % {_TS_SPAN + 1}) as "timestamp",
       list_extract({_list_sql(datagen.ACTION_TYPES)},
                    cast({_hex_sql('action_type')} % {len(datagen.ACTION_TYPES)} + 1 as integer))
         as action_type,
       printf('p%06d', 1 + {_hex_sql('page_id')} % {datagen.PAGE_IDS}) as page_id,
       {datagen.DURATION_MS[0]} + {_hex_sql('duration_ms')}
         % {datagen.DURATION_MS[1] - datagen.DURATION_MS[0] + 1} as duration_ms,
       concat_ws('.', cast({datagen.APP_MAJOR[0]} + {_hex_sql('app_major')}
                           % {datagen.APP_MAJOR[1] - datagen.APP_MAJOR[0] + 1} as varchar),
                 cast({_hex_sql('app_minor')} % 10 as varchar),
                 cast({_hex_sql('app_patch')} % 10 as varchar)) as app_version
from ids
""")
def q_synthetic_interactions(spark, d):
    return datagen.interactions(_events(spark, d).select(F.col("event_id").alias("id")))


@register("synthetic_metadata", f"""
with ids as (select c_custkey as id from customer)
select id,
       printf('u%06d', 1 + {_hex_sql('user_id')} % {datagen.USER_IDS}) as user_id,
       date '{datagen.JOIN_START:%Y-%m-%d}' + cast({_hex_sql('join_date')} % {_JOIN_DAYS + 1}
                                                    as integer) as join_date,
       list_extract({_list_sql(datagen.COUNTRIES)},
                    cast({_hex_sql('country')} % {len(datagen.COUNTRIES)} + 1 as integer)) as country,
       list_extract({_list_sql(datagen.DEVICE_TYPES)},
                    cast({_hex_sql('device_type')} % {len(datagen.DEVICE_TYPES)} + 1 as integer))
         as device_type,
       list_extract({_list_sql(datagen.SUBSCRIPTION_TYPES)},
                    cast({_hex_sql('subscription_type')} % {len(datagen.SUBSCRIPTION_TYPES)} + 1
                         as integer)) as subscription_type
from ids
""")
def q_synthetic_metadata(spark, d):
    return datagen.metadata(table(spark, d, "customer").select(F.col("c_custkey").alias("id")))


# ---------------------------------------------------------------- streaming

from tidemark.streaming import incremental as inc  # noqa: E402


@register("stream_user_day", """
select cast(ts as date) as date, user_id, count(*) as actions, min(ts) as first_ts,
       max(ts) as last_ts
from events where user_id is not null group by 1, 2
""")
def q_stream_user_day(spark, d):
    return inc.user_day_snapshot(spark, table_path(d, "events"), EVENTS_SCHEMA, EV)


@register("stream_dau", ORACLE["dau_from_user_day"])
def q_stream_dau(spark, d):
    return inc.dau_from_snapshot(
        inc.user_day_snapshot(spark, table_path(d, "events"), EVENTS_SCHEMA, EV))


# ---------------------------------------------------------------- counts, full report

@register("dataset_counts", """
select (select count(*) from events) as events_rows, (select count(*) from customer)
       as customer_rows
""")
def q_dataset_counts(spark, d):
    cust = table(spark, d, "customer").agg(F.count(F.lit(1)).alias("n")).scalar()
    return (_events(spark, d).agg(F.count(F.lit(1)).alias("events_rows"))
            .withColumn("customer_rows", cust))


@register("quality_report", "with r as (select * from (" + " union all ".join(
    [f"select 'nulls' as check_name, '{c}' as column_name, "
     f"count(*) filter (where {c} is null) as n_bad from events" for c in _EVENT_COLUMNS]
    + [f"select '{n}' as check_name, cast(null as varchar) as column_name, "
       f"count(*) filter (where {c}) as n_bad from events" for n, c in _RULES_SQL.items()])
    + """) as t)
select *, case when check_name = 'nulls'
                 then printf('Found %d null values in column %s', n_bad, column_name)
               when check_name = 'future_timestamp'
                 then printf('Found %d records with future timestamps', n_bad)
               else printf('Found %d rows failing %s', n_bad, check_name) end as message
from r where n_bad > 0""")
def q_quality_report(spark, d):
    from tidemark.plans.reports import validate_data_quality
    return validate_data_quality(spark, _events(spark, d), EVENTS_SCHEMA, EV, dq.EVENT_TYPES,
                                 AS_OF, "events").drop("table_name")


@register("mau_from_user_day", _rolling_sql(30))
def q_mau_from_user_day(spark, d):
    ud = activity.user_day_summary(_events(spark, d), cols=EV)
    return activity.rolling_from_user_days(ud, 30, "user_id")


@register("user_day_table", ORACLE["user_day"])
def q_user_day_table(spark, d):
    """User-day rollup written partitioned by date, run twice (a re-run
    replaces its days), read back whole."""
    path = scratch_path(spark, "user-day-table")
    ud = activity.user_day_summary(_events(spark, d), cols=EV)
    sinks.write_partitions(ud, path, ["date"])
    sinks.write_partitions(ud, path, ["date"])
    back = spark.read.parquet(path)
    return rounded(back.select(*ud.columns))


# ---------------------------------------------------------------- whole entry points

from tidemark.plans import reports  # noqa: E402
from tidemark.schemas import METADATA as METADATA_SCHEMA  # noqa: E402


@register("valid_sessions_plain", rsql(f"""with {_session_cte(False)},
ss as (select user_id, session_id, count(*) as actions_per_session, min(ts) as session_start,
              max(ts) as session_end,
              (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 3600 as session_duration_hours
       from s group by user_id, session_id)
select * from ss where session_duration_hours <= 24 and actions_per_session >= 2""",
                                       "session_duration_hours"))
def q_valid_sessions_plain(spark, d):
    return rounded(reports.valid_session_table(_events(spark, d), cols=EV))


@register("session_report_strings", f"""with {_clean_cte()}, qs as (
select quantile_disc(session_duration_hours, [0.25, 0.5, 0.75]) as d,
       quantile_disc(actions_per_session, [0.25, 0.5, 0.75]) as a from cl)
select '[' || array_to_string([printf('%.4f', x) for x in d], ', ') || ']' as session_duration_quartiles,
       '[' || array_to_string(a, ', ') || ']' as actions_quartiles from qs""")
def q_session_report_strings(spark, d):
    """The quartile strings of the report; durations are read back from the
    string and formatted, as engines print doubles differently."""
    out = reports.session_metrics(_events(spark, d), cols=EV)["session_metrics"]
    hours = F.from_json("session_duration_quartiles", "array<double>")
    return out.select(
        F.concat(F.lit("["), F.array_join(F.transform(hours, lambda x: F.format_string("%.4f", x)), ", "), F.lit("]"))
        .alias("session_duration_quartiles"), "actions_quartiles")


@register("event_value_cap", rsql("""
with q as (select quantile_disc(value, 0.25) as q1, quantile_disc(value, 0.75) as q3 from events),
b as (select q1 - 1.5::double * (q3 - q1) as lo, q3 + 1.5::double * (q3 - q1) as hi from q)
select event_id, user_id, case when value is null then null else least(greatest(value, lo), hi) end as value
from events, b""", "value"))
def q_event_value_cap(spark, d):
    ev = _events(spark, d).select("event_id", "user_id", "value")
    return rounded(outliers.handle_outliers(ev, "value", mode="cap"))


@register("dau_approx_error", """
select cast(ts as date) as date, count(distinct user_id) as exact, true as within_tolerance
from events group by 1
""")
def q_dau_approx_error(spark, d):
    """Approximate DAU beside the exact one: within three standard errors of
    the sketch, or one user."""
    ev = _events(spark, d)
    approx = activity.daily_active(ev, cols=EV, approx=True).withColumnRenamed("daily_active_users", "approx")
    exact = activity.daily_active(ev, cols=EV).withColumnRenamed("daily_active_users", "exact")
    near = F.abs(F.col("approx") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.15)
    return (exact.join(approx, exact["date"].eqNullSafe(approx["date"]))
            .select(exact["date"], "exact", near.alias("within_tolerance")))


@register("mau_rolling_hll_error", f"""
select date, active_users_30d as exact, true as within_tolerance from ({_rolling_sql(30)}) as r
""")
def q_mau_rolling_hll_error(spark, d):
    ev = _events(spark, d)
    approx = activity.rolling_active_users_approx(ev, 30, cols=EV, out_col="approx")
    exact = activity.rolling_active_users(ev, 30, cols=EV, out_col="exact")
    near = F.abs(F.col("approx") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.05)
    return exact.join(approx, "date").select("date", "exact", near.alias("within_tolerance"))


def _metadata(spark, d) -> DataFrame:
    """The customer table under the names of user metadata; two rows per user
    with different join dates."""
    c = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int")).alias("join_date"),
        F.col("c_nationkey").cast("string").alias("country"), F.col("c_mktsegment").alias("device_type"),
        F.lit("free").alias("subscription_type"))
    later = c.withColumn("join_date", F.date_add("join_date", 7)).withColumn("subscription_type", F.lit("pro"))
    return c.unionByName(later)


@register("metadata_csv_roundtrip", """
select cast(c_custkey as varchar) as user_id,
       date '2020-01-01' + cast(c_custkey % 1000 as integer) + 7 as join_date,
       cast(c_nationkey as varchar) as country, c_mktsegment as device_type, 'pro' as subscription_type
from customer
""")
def q_metadata_csv_roundtrip(spark, d):
    """Metadata written as CSV with its columns in another order, read back by
    name and reduced to the latest row per user."""
    path = scratch_path(spark, "metadata-csv")
    sinks.write_csv(_metadata(spark, d).select(*reversed(METADATA_SCHEMA.fieldNames())), path)
    return en.latest_per_key(readers.read_metadata(spark, path), "user_id", order=["join_date"])


@register("quality_report_customer", """
with r as (
select 'schema_extra' as check_name, c as column_name, cast(1 as bigint) as n_bad from (values
  ('c_name'), ('c_nationkey'), ('c_acctbal'), ('c_mktsegment')) as t(c)
union all select 'schema_missing', 'user_id', 1
union all select 'nulls', 'c_custkey', (select count(*) from customer where c_custkey is null)
union all select 'nulls', 'c_acctbal', (select count(*) from customer where c_acctbal is null))
select *, case check_name when 'schema_missing' then printf('Missing required column: %s', column_name)
          when 'schema_extra' then printf('Column %s: extra', column_name)
          else printf('Found %d null values in column %s', n_bad, column_name) end as message
from r where n_bad > 0
""")
def q_quality_report_customer(spark, d):
    from pyspark.sql import types as T
    cust = table(spark, d, "customer")
    declared = T.StructType([cust.schema["c_custkey"], T.StructField("user_id", T.StringType())])
    return reports.validate_data_quality(spark, cust, declared, as_of=AS_OF, table_name="customer") \
        .drop("table_name")


@register("first_events", """
select event_id, user_id, ts from events order by ts, event_id limit 20
""")
def q_first_events(spark, d):
    return sinks.preview(_events(spark, d).select("event_id", "user_id", "ts"), ["ts", "event_id"], 20)


# more queries register themselves here
from tidemark.plans import extended  # noqa: E402, F401
