"""More registered queries: as-of joins, interval overlap, grouping sets, user
sets, retention, stored quantile and session state, properties, and the
library's entry points. Imported by ``catalog``, which owns the registry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import (
    asof, grouping, heavy, intervals, props, quantile_state, retention, session_store, sessions, user_sets,
)
from tidemark.operators.activity import user_days
from tidemark.plans.catalog import (
    EV, ORACLE, _clean_cte, _events, _rolling_sql, _session_cte, _sessions_sql, register, rounded, rsql,
    user_dimension,
)
from tidemark.session import scratch_path
from tidemark.sources.tables import table

# ---------------------------------------------------------------- as-of joins

# order dates, 1995 to 2001, mapped onto the month of the events
_ORDERS_START, _EVENTS_START, _SQUEEZE = 788_918_400, 1_704_067_200, 80


def order_versions(spark, d) -> DataFrame:
    """A changing attribute of users: status and priority of their latest order."""
    sec = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    at = F.lit(_EVENTS_START) + F.floor((sec - _ORDERS_START) / _SQUEEZE)
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("user_id"), F.timestamp_seconds(at).cast("timestamp_ntz").alias("valid_from"),
        F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"))


_VERSIONS_SQL = f"""
v as (select * exclude (rn) from (
        select o_custkey as user_id, o_orderkey as order_id, o_orderstatus as status, o_orderpriority as priority,
               make_timestamp(({_EVENTS_START} + (cast(epoch(o_orderdate) as bigint) - {_ORDERS_START}) // {_SQUEEZE})
                              * 1000000) as valid_from,
               row_number() over (partition by o_custkey, valid_from
                                  order by o_orderkey desc, o_orderstatus desc, o_orderpriority desc) as rn
        from orders) as o where rn = 1)"""


@register("asof_orders", f"""with {_VERSIONS_SQL}
select e.event_id, e.user_id, e.ts, e.event_type, v.valid_from, v.order_id, v.status, v.priority
from events e asof left join v on e.user_id = v.user_id and e.ts >= v.valid_from
""")
def q_asof_orders(spark, d):
    """Each event with the order that was its user's latest at the time."""
    ev = _events(spark, d).select("event_id", "user_id", "ts", "event_type")
    return asof.asof_join(ev, order_versions(spark, d), "user_id", "ts", ["order_id", "status", "priority"])


@register("asof_last_purchase", rsql("""
select e.event_id, e.user_id, e.ts, p.purchased_at, p.purchase_id, p.purchase_value
from events e asof left join
     (select user_id, ts as purchased_at, max(event_id) as purchase_id, arg_max(value, event_id) as purchase_value
      from events where event_type = 'purchase' group by 1, 2) as p
  on e.user_id = p.user_id and e.ts >= p.purchased_at
""", "purchase_value"))
def q_asof_last_purchase(spark, d):
    """Each event with its user's last purchase, itself if it is one."""
    ev = _events(spark, d)
    bought = ev.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("purchased_at"), F.col("event_id").alias("purchase_id"),
        F.col("value").alias("purchase_value"))
    return rounded(asof.asof_join(ev.select("event_id", "user_id", "ts"), bought, "user_id", "ts",
                                  ["purchase_id", "purchase_value"], valid_from="purchased_at"))


@register("activity_by_status_at_time", f"""with {_VERSIONS_SQL}
select v.status, cast(e.ts as date) as date, count(*) as events, count(distinct e.user_id) as users
from events e asof left join v on e.user_id = v.user_id and e.ts >= v.valid_from group by 1, 2
""")
def q_activity_by_status(spark, d):
    """Daily activity by the status a user had at the time, not the latest one."""
    ev = _events(spark, d).select("event_id", "user_id", "ts")
    out = asof.asof_join(ev, order_versions(spark, d), "user_id", "ts", ["order_id", "status"])
    per_user = out.groupBy("status", F.to_date("ts").alias("date"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("status", "date").agg(F.sum("n").alias("events"), F.count("user_id").alias("users"))


# ---------------------------------------------------------------- interval overlap

def _overlap_sql(rows: str, width: int) -> str:
    return f"""
iv as (select cast(floor(epoch(a)) as bigint) as s, cast(floor(epoch(b)) as bigint) as e from ({rows}) as r
       where a <= b),
bounds as (select min(s) // {width} as lo, max(e) // {width} as hi from iv),
blocks as (select unnest(range(lo, hi + 1)) as block from bounds),
mean as (select block, cast(sum(least(e + 1, (block + 1) * {width}) - greatest(s, block * {width})) as bigint)
                as open_seconds
         from blocks join iv on s < (block + 1) * {width} and e >= block * {width} group by 1),
points as (select s as p from iv union select block * {width} from blocks),
open_at as (select p, count(*) as n from points join iv on s <= p and e >= p group by 1),
top as (select p // {width} as block, max(n) as peak from open_at group by 1)
select make_timestamp(block * {width} * 1000000) as block_start, peak, open_seconds / {width} as mean_open,
       open_seconds
from mean join top using (block)"""


_SESSION_SPANS = "select min(ts) as a, max(ts) as b from s group by user_id, session_id"


@register("concurrent_sessions_hour", rsql(f"""with {_session_cte(False)},
{_overlap_sql(_SESSION_SPANS, 3600)}""", "mean_open"))
def q_concurrent_sessions(spark, d):
    """Open sessions per hour: peak and time-weighted mean."""
    sess = sessions.sessions(_events(spark, d), 30, False, EV, with_avg_gap=False)
    out = intervals.overlap_by_block(sess, "session_start", "session_end", 3600)
    return rounded(out.withColumn("block_start", F.col("block_start").cast("timestamp_ntz")))


@register("users_online_minute", rsql(f"""with {_overlap_sql(
    "select min(ts) as a, max(ts) as b from events where user_id is not null group by user_id, cast(ts as date)",
    60)}""", "mean_open"))
def q_users_online(spark, d):
    """Users between their first and last event of the day, per minute."""
    days = (_events(spark, d).where("user_id is not null").groupBy("user_id", F.to_date("ts").alias("date"))
            .agg(F.min("ts").alias("a"), F.max("ts").alias("b")))
    out = intervals.overlap_by_block(days, "a", "b", 60)
    return rounded(out.withColumn("block_start", F.col("block_start").cast("timestamp_ntz")))


# ---------------------------------------------------------------- grouping sets

_CUBE_SQL = """
select cast(e.ts as date) as date, n.n_name as country, c.c_mktsegment as segment,
       cast(grouping(cast(e.ts as date), n.n_name, c.c_mktsegment) as bigint) as grouping_id,
       count(*) as events, count(distinct e.user_id) as users, sum(e.value) as total_measure
from events e left join customer c on e.user_id = c.c_custkey left join nation n on c.c_nationkey = n.n_nationkey
group by {}(cast(e.ts as date), n.n_name, c.c_mktsegment)"""


@register("activity_cube", rsql(_CUBE_SQL.format("cube"), "total_measure"))
def q_activity_cube(spark, d):
    return rounded(grouping.activity_cube(_events(spark, d), user_dimension(spark, d), ["country", "segment"], EV))


@register("activity_rollup", rsql(_CUBE_SQL.format("rollup"), "total_measure"))
def q_activity_rollup(spark, d):
    return rounded(grouping.activity_cube(_events(spark, d), user_dimension(spark, d), ["country", "segment"], EV,
                                          kind="rollup"))


# ---------------------------------------------------------------- bitmap user sets

def stored_user_sets(spark, d) -> DataFrame:
    """User sets per day, country and segment, written in two runs (the
    second adds the users first seen then), read back."""
    path = scratch_path(spark, "user-sets")
    ev = _events(spark, d).withColumn("date", F.to_date("ts"))
    dim = user_dimension(spark, d)
    for name, part in (("first", ev.where("day(date) <= 15")), ("second", ev.where("day(date) > 15"))):
        days = user_days(part, EV)
        numbers = user_sets.extend_user_numbers(spark, f"{path}/numbers", days, "user_id", name)
        sets = user_sets.user_set_table(days.join(dim, "user_id", "left"), numbers, ["date", "country", "segment"])
        user_sets.write_user_sets(sets, f"{path}/sets")
    return spark.read.parquet(f"{path}/sets")


_SEGMENTED = """(select cast(e.ts as date) as date, e.user_id, n.n_name as country, c.c_mktsegment as segment
from events e left join customer c on e.user_id = c.c_custkey left join nation n on c.c_nationkey = n.n_nationkey
where e.user_id is not null)"""


@register("bitmap_week_segment", f"""
select cast(date_trunc('week', date) as date) as week, segment, count(distinct user_id) as users
from {_SEGMENTED} as x group by 1, 2
""")
def q_bitmap_week_segment(spark, d):
    """Distinct users per week and segment, from the stored sets alone."""
    sets = stored_user_sets(spark, d).withColumn("week", F.trunc("date", "week"))
    return user_sets.count_users(user_sets.united(sets, ["week", "segment"]), ["week", "segment"])


@register("bitmap_rolling_users", _rolling_sql(7))
def q_bitmap_rolling(spark, d):
    """Rolling distinct users of seven days, from the stored sets alone."""
    return user_sets.rolling_users(stored_user_sets(spark, d), 7)


@register("bitmap_every_week", f"""
select country, count(*) as users from (
  select country, user_id from {_SEGMENTED} as x where date < date '2024-01-29'
  group by 1, 2 having count(distinct date_trunc('week', date)) = 4) as y group by 1
""")
def q_bitmap_every_week(spark, d):
    """Users active in each of the four whole weeks, per country: stored sets intersected."""
    sets = stored_user_sets(spark, d).where("date < date'2024-01-29'").withColumn("week", F.trunc("date", "week"))
    return user_sets.count_users(user_sets.common(sets, ["country"], "week", 4), ["country"]).where("users > 0")


# ---------------------------------------------------------------- retention

_RETENTION_SQL = """
with w as (select distinct user_id, cast(date_trunc('week', ts) as date) as period from events
           where user_id is not null),
p as (select period, lag(period) over (order by period) as before from (select distinct period from w) as x)
select period,
       (select count(*) from w a join w b on a.user_id = b.user_id
        where a.period = p.period and b.period = p.before) as kept,
       (select count(*) from w a where a.period = p.period and not exists (
          select 1 from w b where b.user_id = a.user_id and b.period = p.before)) as new,
       (select count(*) from w b where b.period = p.before and not exists (
          select 1 from w a where b.user_id = a.user_id and a.period = p.period)) as lost
from p"""


def _week():
    return F.trunc("ts", "week")


@register("retention_weekly", _RETENTION_SQL)
def q_retention_weekly(spark, d):
    return retention.retention_exact(_events(spark, d), _week())


@register("retention_weekly_sketch")
def q_retention_sketch(spark, d):
    return retention.retention_sketch(retention.period_sketches(_events(spark, d), _week()))


@register("retention_weekly_error", f"""
select period, kept, new, lost, true as within_tolerance from ({_RETENTION_SQL}) as r
""")
def q_retention_error(spark, d):
    """Sketched retention beside the exact one: within three standard errors
    of the union's estimate, or one user."""
    ev = _events(spark, d)
    exact = retention.retention_exact(ev, _week())
    near = retention.retention_sketch(retention.period_sketches(ev, _week())).select(
        "period", *[F.col(c).alias(f"e_{c}") for c in ("kept", "new", "lost", "either")])
    allowed = F.greatest(F.lit(1.0), F.col("e_either") * 3 / (2 ** (retention.LG_NOMINAL / 2)))
    ok = F.lit(True)
    for c in ("kept", "new", "lost"):
        ok = ok & (F.abs(F.col(c) - F.col(f"e_{c}")) <= allowed)
    return exact.join(near, "period").select("period", "kept", "new", "lost", ok.alias("within_tolerance"))


# ---------------------------------------------------------------- quantile state

def _stored_quantiles(spark, d) -> str:
    path = scratch_path(spark, "quantile-state")
    sess = sessions.sessions(_events(spark, d), 30, True, EV, with_avg_gap=False)
    measures = (sess.select(F.col("session_start").alias("ts"), "session_duration_hours",
                            F.col("actions_per_session").cast("double").alias("actions_per_session"))
                .unionByName(_events(spark, d).select("ts", "value"), allowMissingColumns=True))
    quantile_state.write_days(measures, path, "ts", ["session_duration_hours", "actions_per_session", "value"])
    return path


def _quantile_rows_sql(date_rule: str) -> str:
    parts = []
    for name, source in (("session_duration_hours", "ss"), ("actions_per_session", "ss"), ("value", "events")):
        day = "session_start" if source == "ss" else "ts"
        for p in (0.25, 0.5, 0.75):
            parts.append(f"select '{name}' as measure, {p}::double as p, "
                         f"quantile_disc({name}, {p})::double as value from {source} "
                         f"where cast({day} as date) {date_rule}")
    return rsql(f"with {_clean_cte()} " + " union all ".join(parts), "value")


@register("quantiles_of_days", _quantile_rows_sql("between date '2024-01-08' and date '2024-01-21'"))
def q_quantiles_of_days(spark, d):
    """Quartiles of a range of days from the stored daily state alone."""
    return rounded(quantile_state.quantiles(spark, _stored_quantiles(spark, d), [0.25, 0.5, 0.75],
                                            dt.date(2024, 1, 8), dt.date(2024, 1, 21)))


@register("quantiles_of_month", _quantile_rows_sql("is not null"))
def q_quantiles_of_month(spark, d):
    return rounded(quantile_state.quantiles(spark, _stored_quantiles(spark, d), [0.25, 0.5, 0.75]))


# ---------------------------------------------------------------- heavy hitters

@register("heavy_users", ORACLE["hot_users"])
def q_heavy_users(spark, d):
    return rounded(heavy.top_keys(_events(spark, d), "user_id", 10))


@register("heavy_orders_customers", rsql("""
select o_custkey, count(*) as events, count(*) / (select count(*) from orders) as share
from orders group by 1 order by events desc, o_custkey limit 25
""", "share"))
def q_heavy_customers(spark, d):
    """More keys than counters: proven by the summary or counted whole."""
    return rounded(heavy.top_keys(table(spark, d, "orders"), "o_custkey", 25, counters=1024))


# ---------------------------------------------------------------- incremental sessions

def _sessions_by_day(spark, d) -> str:
    """Days stored out of order in four runs, one of them twice."""
    path = scratch_path(spark, "session-pieces")
    ev = _events(spark, d)
    for k in (2, 0, 3, 1, 0):
        session_store.write_days(ev.where(F.day("ts") % 4 == k), path, 30, EV)
    return path


@register("sessions_incremental", _sessions_sql(False))
def q_sessions_incremental(spark, d):
    return rounded(session_store.read_sessions(spark, _sessions_by_day(spark, d), 30, False, EV))


@register("sessions_incremental_midnight", _sessions_sql(True))
def q_sessions_incremental_midnight(spark, d):
    return rounded(session_store.read_sessions(spark, _sessions_by_day(spark, d), 30, True, EV))


# ---------------------------------------------------------------- semi-structured properties

def _mixed_props():
    """The events' properties with other types, arrays and broken text in some."""
    k = F.col("event_id") % 10
    return (F.when(k == 3, F.substring("props", 1, 4)).when(k == 4, F.concat(F.lit('{"k": "'), "event_type", F.lit('"}')))
            .when(k == 5, F.concat(F.lit('{"k": '), F.col("event_id").cast("string"), F.lit('.5, "tags": ["a", "b"]}')))
            .when(k == 6, F.lit("[1, 2]")).when(k == 8, F.lit('{"ok": true, "none": null}'))
            .when(k != 7, F.col("props")))


_MIXED_SQL = """
m as (select event_id, event_type, case event_id % 10 when 3 then substr(props, 1, 4)
        when 4 then '{"k": "' || event_type || '"}'
        when 5 then '{"k": ' || event_id || '.5, "tags": ["a", "b"]}' when 6 then '[1, 2]' when 7 then null
        when 8 then '{"ok": true, "none": null}' else props end as text from events)"""


@register("props_profile", f"""with {_MIXED_SQL},
j as (select event_type, text, try_cast(text as json) as v from m),
k as (select event_type, unnest(json_keys(v)) as property, v from j where json_type(v) = 'OBJECT'),
t as (select event_type, property, json_extract(v, '$.' || property) as x from k)
select event_type, property, case json_type(x) when 'UBIGINT' then 'BIGINT' when 'VARCHAR' then 'STRING'
         when 'NULL' then 'VOID' else json_type(x) end as type, count(*) as rows,
       min(case when json_type(x) in ('UBIGINT', 'BIGINT', 'DOUBLE') then cast(x as double) end) as lowest,
       max(case when json_type(x) in ('UBIGINT', 'BIGINT', 'DOUBLE') then cast(x as double) end) as highest
from t group by 1, 2, 3
union all
select event_type, null, case when text is null then 'NULL' when v is null then 'MALFORMED' else json_type(v) end,
       count(*), null, null
from j where text is null or v is null or json_type(v) <> 'OBJECT' group by 1, 3
""")
def q_props_profile(spark, d):
    ev = _events(spark, d).withColumn("text", _mixed_props())
    return props.property_profile(ev, "text", ["event_type"])


@register("props_quarantine", f"""with {_MIXED_SQL}
select event_id, text from m where text is not null and try_cast(text as json) is null
""")
def q_props_quarantine(spark, d):
    ev = _events(spark, d).select("event_id", _mixed_props().alias("text"))
    return props.split_malformed(ev, "text")[1]


@register("props_measure", rsql("""
select event_type, count(json_extract(props, '$.k')) as rows, avg(cast(json_extract(props, '$.k') as double)) as mean_k
from events group by 1
""", "mean_k"))
def q_props_measure(spark, d):
    """A typed field of the properties as a measure."""
    good, _ = props.split_malformed(_events(spark, d).select("event_type", "props"), "props")
    k = F.try_variant_get("variant", "$.k", "double")
    return rounded(good.groupBy("event_type").agg(F.count(k).alias("rows"), F.avg(k).alias("mean_k")))


# ---------------------------------------------------------------- layouts by user and along a curve

from tidemark.operators import activity, enrich  # noqa: E402
from tidemark.operators.partitioning import partition_by_user, persisted  # noqa: E402
from tidemark.plans import reports  # noqa: E402
from tidemark.sources import bucketed, clustered, sinks  # noqa: E402

BUCKETS = 16


@register("bucketed_sessions", _sessions_sql(True))
def q_bucketed_sessions(spark, d):
    """Sessions from a table bucketed by user: no exchange; hot users by the usual plan."""
    t = bucketed.write_user_table(_events(spark, d), "user_id", BUCKETS, ["ts"])
    return rounded(t.per_user(lambda ev: sessions.sessions(ev, 30, True, EV)))


@register("bucketed_enrich", ORACLE["enrich_merge"])
def q_bucketed_enrich(spark, d):
    """Events and users bucketed alike join without exchange; hot users are few, so theirs is broadcast."""
    ev = _events(spark, d).select("event_id", "user_id", "ts", "event_type", "value")
    t = bucketed.write_user_table(ev, "user_id", BUCKETS, ["ts"])
    path = scratch_path(spark, "users-bucketed")
    dim = bucketed.save_bucketed(user_dimension(spark, d), "user_id", BUCKETS, [], path,
                                 "users_" + path.rsplit("-", 1)[-1])
    usual = t.usual.join(dim.hint("merge"), "user_id", "left")
    hot_dim = dim.join(F.broadcast(t.hot_users), "user_id", "left_semi")  # at most one row per bucket
    return usual.unionByName(t.hot.join(F.broadcast(hot_dim), "user_id", "left"))


@register("bucketed_user_days", ORACLE["user_day"])
def q_bucketed_user_days(spark, d):
    t = bucketed.write_user_table(_events(spark, d), "user_id", BUCKETS, ["ts"])
    return rounded(t.per_user(lambda ev: activity.user_day_summary(ev, cols=EV)))


def _clustered(spark, d) -> DataFrame:
    path = scratch_path(spark, "events-clustered")
    clustered.write_clustered(_events(spark, d).withColumn("date", F.to_date("ts")), path, ["date", "user_id"], 64,
                              bloom=["user_id"])
    return spark.read.parquet(path)


@register("clustered_one_user", "select *, cast(ts as date) as date from events where user_id = 7")
def q_clustered_one_user(spark, d):
    return _clustered(spark, d).where("user_id = 7")


@register("clustered_days", """
select *, cast(ts as date) as date from events where cast(ts as date) between date '2024-01-10' and date '2024-01-11'
""")
def q_clustered_days(spark, d):
    return _clustered(spark, d).where("date between date'2024-01-10' and date'2024-01-11'")


@register("clustered_files_touched", """
select (select count(*) from events) as rows, true as days_skip_most, true as user_skips_most
""")
def q_clustered_files_touched(spark, d):
    """Filters on two days or on one user touch less than a third of the rows' files."""
    r = clustered.file_ranges(_clustered(spark, d), ["date", "user_id"])
    days = F.expr("lo_date <= date'2024-01-11' and hi_date >= date'2024-01-10'")
    user = F.expr("lo_user_id <= 7 and hi_user_id >= 7")
    total = F.sum("rows")
    return r.agg(total.alias("rows"), (F.sum(F.when(days, F.col("rows")).otherwise(0)) * 3 < total).alias("days_skip_most"),
                 (F.sum(F.when(user, F.col("rows")).otherwise(0)) * 3 < total).alias("user_skips_most"))


@register("persisted_layout", """
select 'daily_active' as metric, cast(ts as date) as date, count(distinct user_id) as n from events group by 2
union all
select 'purchasers', cast(ts as date), count(distinct user_id) from events where event_type = 'purchase' group by 2
""")
def q_persisted_layout(spark, d):
    """One layout by user, persisted for two outputs and released; the outputs are written before."""
    path = scratch_path(spark, "persisted-layout")
    ev = _events(spark, d).select("event_id", "user_id", "ts", "event_type", "value")
    with persisted(partition_by_user(ev, "user_id", salt_col="event_id")) as layout:
        for metric, actions in (("daily_active", None), ("purchasers", ["purchase"])):
            dau = activity.daily_active(layout, cols=EV, actions=actions)
            dau.select(F.lit(metric).alias("metric"), "date", F.col("daily_active_users").alias("n")) \
                .write.parquet(f"{path}/{metric}")
    return spark.read.parquet(f"{path}/daily_active", f"{path}/purchasers")


# ---------------------------------------------------------------- entry points of the reports

_INTERACTIONS_SQL = """
select cast(user_id as varchar) as user_id, ts as "timestamp", event_type as action_type,
       'p' || (event_id % 100) as page_id, cast(floor(value * 100) as bigint) as duration_ms,
       '1.0.' || (event_id % 10) as app_version from events"""


def _prepared(spark, d):
    """Events and customers as the two CSV inputs, taken in by the entry point."""
    ev = _events(spark, d).select(
        F.col("user_id").cast("string").alias("user_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("action_type"), F.concat(F.lit("p"), (F.col("event_id") % 100)).alias("page_id"),
        F.floor(F.col("value") * 100).cast("long").alias("duration_ms"),
        F.concat(F.lit("1.0."), (F.col("event_id") % 10)).alias("app_version"))
    from tidemark.plans.catalog import _metadata
    inter, meta = scratch_path(spark, "interactions-csv"), scratch_path(spark, "metadata-csv")
    sinks.write_csv(ev, inter)
    sinks.write_csv(_metadata(spark, d), meta)
    return reports.prepare_datasets(spark, inter, meta, "csv", partitioning="hash")


@register("entry_interactions", _INTERACTIONS_SQL)
def q_entry_interactions(spark, d):
    out = _prepared(spark, d)[0]
    return out.select("user_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "action_type", "page_id",
                      "duration_ms", "app_version")


@register("entry_metadata", ORACLE["metadata_csv_roundtrip"])
def q_entry_metadata(spark, d):
    return _prepared(spark, d)[1]


@register("entry_daily_active", ORACLE["dau_since"])
def q_entry_daily_active(spark, d):
    return reports.active_users(_events(spark, d), start=dt.datetime(2024, 1, 5, 13), cols=EV)["daily_active"]


@register("entry_monthly_active", ORACLE["rolling_dau_sum_31"])
def q_entry_monthly_active(spark, d):
    return reports.active_users(_events(spark, d), cols=EV)["monthly_active"]


@register("entry_rolling_mau", ORACLE["mau_rolling_exact"])
def q_entry_rolling_mau(spark, d):
    return reports.active_users(_events(spark, d), cols=EV)["rolling_mau"]


@register("entry_active_users_approx", f"""
select date, exact, active_users_30d as rolling, true as dau_near, true as rolling_near
from ({ORACLE["dau_approx_error"]}) as a join ({_rolling_sql(30)}) as r using (date)
""")
def q_entry_active_users_approx(spark, d):
    """The approximate form of the active-user report beside the exact one."""
    ev = _events(spark, d)
    near, exact = reports.active_users(ev, approx=True, cols=EV), reports.active_users(ev, cols=EV)
    rows = (exact["daily_active"].select("date", F.col("daily_active_users").alias("exact"))
            .join(exact["rolling_mau"].select("date", F.col("active_users_30d").alias("rolling")), "date")
            .join(near["daily_active"].select("date", F.col("daily_active_users").alias("d")), "date")
            .join(near["rolling_mau"].select("date", F.col("approx_active_users_30d").alias("r")), "date"))
    return rows.select("date", "exact", "rolling",
                       (F.abs(F.col("d") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.15)).alias("dau_near"),
                       (F.abs(F.col("r") - F.col("rolling")) <= F.greatest(F.lit(1.0), F.col("rolling") * 0.05))
                       .alias("rolling_near"))


def _session_report(name: str, oracle: str, drop: tuple[str, ...] = ()):
    @register(f"entry_{name}", ORACLE[oracle])
    def query(spark, d):
        return rounded(reports.session_metrics(_events(spark, d), cols=EV)[name].drop(*drop))
    return query


_session_report("session_metrics", "session_summary", ("session_duration_quartiles", "actions_quartiles"))
_session_report("detailed_sessions", "sessions_clean")
_session_report("time_metrics", "session_time_of_week")
_session_report("outlier_thresholds", "iqr_bounds")
_session_report("funnel", "sessions_removed")


# ---------------------------------------------------------------- stateful streams

from tidemark.schemas import EVENTS as EVENTS_SCHEMA  # noqa: E402
from tidemark.streaming import stateful  # noqa: E402

DELAY_SECONDS = 2 * 86_400

# ten days arrive together; every 50th event comes one arrival late, every tenth a second time one arrival later
_ARRIVALS_SQL = """
p as (select *, (day(ts) - 1) // 10 as k from events),
a as (select * exclude (k), case when event_id % 50 = 0 then least(k + 1, 2) else k end as k from p
      union all select * exclude (k), k + 1 from p where event_id % 10 = 1 and k < 2),
seen as (select k, max(max(ts)) over (order by k rows between unbounded preceding and 1 preceding) as latest
         from a group by k),
s as (select a.*, coalesce(a.ts <= seen.latest - interval 2 days, false) as late from a join seen using (k))"""


def _arrivals(spark, d) -> DataFrame:
    k = F.floor((F.day("ts") - 1) / 10)
    ev = _events(spark, d)
    first = ev.withColumn("k", F.when(F.col("event_id") % 50 == 0, F.least(k + 1, F.lit(2))).otherwise(k))
    again = ev.where(F.col("event_id") % 10 == 1).withColumn("k", k + 1).where("k <= 2")
    return first.unionByName(again)


def _deduplicated(spark, d) -> dict[str, DataFrame]:
    path = scratch_path(spark, "arrivals")
    rows = _arrivals(spark, d)
    for k in range(3):
        rows.where(F.col("k") == k).drop("k").write.parquet(f"{path}/files/k{k}")
        out = stateful.take_in(spark, f"{path}/files", EVENTS_SCHEMA, f"{path}/sink", "event_id", "ts", DELAY_SECONDS)
    return out


@register("stream_unique_events", f"with {_ARRIVALS_SQL} select distinct * exclude (k, late) from s where not late")
def q_stream_unique(spark, d):
    """Events of three arrivals, each once, but for those that came too late."""
    return _deduplicated(spark, d)["unique"]


@register("stream_late_events", f"""with {_ARRIVALS_SQL}
select event_id, ts, count(*) as copies from s where late group by 1, 2""")
def q_stream_late(spark, d):
    """The side table of late rows, copies included."""
    return _deduplicated(spark, d)["late"].groupBy("event_id", "ts").agg(F.count(F.lit(1)).alias("copies"))


@register("stream_view_to_purchase", """
select v.user_id, v.event_id as view_id, v.ts as viewed_at, p.event_id as purchase_id, p.ts as purchased_at
from events v join events p on v.user_id = p.user_id and p.ts >= v.ts and p.ts <= v.ts + interval 1 hour
where v.event_type = 'view' and p.event_type = 'purchase'
""")
def q_stream_view_to_purchase(spark, d):
    """Views followed by a purchase of the same user within an hour, from a stream of three arrivals."""
    path = scratch_path(spark, "interval-join")

    def views(ev):
        return ev.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"),
                                                      F.col("ts").alias("viewed_at"))

    def purchases(ev):
        return ev.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"),
                                                          F.col("ts").alias("purchased_at"))
    for k in range(3):
        _events(spark, d).where(F.floor((F.day("ts") - 1) / 10) == k).write.parquet(f"{path}/files/k{k}")
        out = stateful.interval_join_table(spark, f"{path}/files", EVENTS_SCHEMA, f"{path}/sink", views, purchases,
                                           "user_id", "viewed_at", "purchased_at", 3600, DELAY_SECONDS)
    return out
