"""Straight per-user definition of event-level sessions, in plain SQL.

Independent of the library's expressions on purpose; it keeps a user's whole
history in one task, which is why the library does not use it.
"""

from pyspark.sql import DataFrame

from tidemark.schemas import EventCols, INTERACTION_COLS


def session_events_by_user_window(df: DataFrame, timeout_minutes: float = 30,
                                  split_at_midnight: bool = True,
                                  cols: EventCols = INTERACTION_COLS) -> DataFrame:
    """Per-user window form of ``session_events`` (same output columns)."""
    u, ts, order = cols.user, cols.ts, ", ".join(cols.order_cols())
    midnight = f"or to_date({ts}) <> to_date(prev_timestamp)" if split_at_midnight else ""
    if df.schema[ts].dataType.simpleString() == "timestamp_ntz":  # the wall clock itself, no zone
        seconds = lambda x: (f"(unix_date(to_date({x})) * 86400L + hour({x}) * 3600 + minute({x}) * 60"  # noqa: E731
                             f" + second({x}))")
    else:
        seconds = lambda x: f"unix_seconds({x})"
    return df.sparkSession.sql(f"""
        with e as (
          select *, lag({ts}) over (partition by {u} order by {order}) as prev_timestamp
          from {{events}} where {u} is not null and {ts} is not null),
        g as (
          select *, case when prev_timestamp is null then 0.0d
                    else ({seconds(ts)} - {seconds("prev_timestamp")}) / 60.0d end as time_diff_minutes
          from e),
        f as (
          select *, case when prev_timestamp is null or time_diff_minutes > {float(timeout_minutes)}d {midnight}
                    then 1 else 0 end as new_session from g),
        n as (
          select *, sum(new_session) over (partition by {u} order by {order}
                                           rows between unbounded preceding and current row) as session_num from f)
        select *, concat(cast({u} as string), '_', cast(session_num as string)) as session_id from n
        """, events=df)
