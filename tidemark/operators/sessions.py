"""Sessionization by inactivity gap, with an optional midnight split.

Semantics (kept from the task's pipeline):

* events of a user are ordered by time (plus a tiebreak column, T10);
* a new session starts at a user's first event, when the whole-second gap
  to the previous event exceeds ``timeout_minutes`` (strictly, T6/T7), or,
  with ``split_at_midnight``, when the calendar day changes (T3);
* ``session_id`` is ``<user>_<n>``, ``n`` the running count of starts.

Plan. A per-user window over raw events puts all of one user's history
into one task, and AQE cannot split a window partition; a user holding a
third of all rows would stall the job. Instead events are cut into
fixed-width time buckets per user whose width ``W`` is at most the
timeout (and that never cross midnight). Two events of one bucket are at
most ``W - 1`` whole seconds apart, so no session can start *inside* a
bucket: a session is a run of consecutive buckets. Hence

1. ``groupBy(user, bucket)`` -> count, first/last time (hash aggregate
   with map-side partial aggregation: skew-proof, shuffles one row per
   user-bucket per map task);
2. a per-user window over *buckets* decides which bucket opens a session
   and numbers them (at most span / W rows per user, independent of how
   many events the user has);
3. session metrics are an aggregate over buckets, already partitioned by
   user, so no further shuffle.

Event-level output (``session_events``) orders events only within one
user's whole second; the predecessor of a second's first event comes from
a per-second table (window over at most W seconds of one bucket) and the
bucket table, joined back on (user, second).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timefns import (
    DAY_SECONDS, activity_date, duration_hours, epoch_seconds, gap_minutes, time_bucket,
)
from tidemark.schemas import EventCols, INTERACTION_COLS


def bucket_width_seconds(timeout_minutes: float) -> int:
    """Largest whole-second width that cannot hold a session break."""
    if timeout_minutes < 0:
        raise ValueError("timeout_minutes must be >= 0")
    return max(1, min(DAY_SECONDS, int(math.floor(timeout_minutes * 60))))


def _is_break(ts, prev, timeout_minutes: float, split_at_midnight: bool):
    cond = prev.isNull() | (gap_minutes(ts, prev) > F.lit(float(timeout_minutes)))
    if split_at_midnight:
        cond = cond | (activity_date(ts) != activity_date(prev))
    return cond


def _clean(df: DataFrame, cols: EventCols) -> DataFrame:
    # NULL users or times cannot be ordered into a session (T11); the
    # quality report counts and quarantines them.
    return df.where(F.col(cols.user).isNotNull() & F.col(cols.ts).isNotNull())


def _number_buckets(per_bucket: DataFrame, timeout_minutes: float, split_at_midnight: bool,
                    user: str) -> DataFrame:
    """Add ``prev_last_ts``, ``opens`` and ``session_num`` to a per-(user,
    bucket) table of ``first_ts, last_ts``: a per-user window over
    buckets (at most span / W rows per user)."""
    w = Window.partitionBy(user).orderBy("_bucket")
    opens = F.when(_is_break(F.col("first_ts"), F.col("prev_last_ts"),
                             timeout_minutes, split_at_midnight), 1).otherwise(0)
    return (per_bucket
            .withColumn("prev_last_ts", F.lag("last_ts").over(w))
            .withColumn("opens", opens)
            .withColumn("session_num",
                        F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding,
                                                          Window.currentRow))))


def session_buckets(df: DataFrame, timeout_minutes: float = 30,
                    split_at_midnight: bool = True,
                    cols: EventCols = INTERACTION_COLS) -> DataFrame:
    """One row per (user, bucket) with its session number.

    Columns: user, ``_bucket``, ``n``, ``first_ts``, ``last_ts``,
    ``prev_last_ts`` (last event time before the bucket), ``opens``
    (1 if the bucket starts a session) and ``session_num``.
    """
    width = bucket_width_seconds(timeout_minutes)
    u, ts = cols.user, cols.ts
    per_bucket = (_clean(df, cols)
                  .groupBy(u, time_bucket(ts, width).alias("_bucket"))
                  .agg(F.count(F.lit(1)).alias("n"),
                       F.min(ts).alias("first_ts"),
                       F.max(ts).alias("last_ts")))
    return _number_buckets(per_bucket, timeout_minutes, split_at_midnight, u)


def _session_id(user: str, num: str = "session_num"):
    return F.concat(F.col(user).cast("string"), F.lit("_"), F.col(num).cast("string"))


def sessions(df: DataFrame, timeout_minutes: float = 30, split_at_midnight: bool = True,
             cols: EventCols = INTERACTION_COLS, with_avg_gap: bool = True) -> DataFrame:
    """One row per session.

    ``user, session_id, actions_per_session, session_start, session_end,
    avg_time_between_actions, avg_gap_in_session, session_duration_hours``.

    ``avg_time_between_actions`` is the compat measure (T5): the mean of
    each event's gap to its predecessor, so the first event contributes the
    idle time *before* the session (0 for a user's first event). Inside a
    session the whole-second gaps telescope to ``end - start``, so the mean
    is ``(lead_gap + (end - start) / 60) / actions`` without touching
    events. ``avg_gap_in_session`` is the corrected mean gap between the
    session's own actions (NULL for one action).
    """
    u = cols.user
    b = session_buckets(df, timeout_minutes, split_at_midnight, cols)
    lead_gap = F.when(F.col("opens") == 1, gap_minutes("first_ts", "prev_last_ts"))
    agg = (b.groupBy(u, "session_num")
           .agg(F.sum("n").alias("actions_per_session"),
                F.min("first_ts").alias("session_start"),
                F.max("last_ts").alias("session_end"),
                F.max(lead_gap).alias("_lead_gap")))
    return session_measures(agg, u, with_avg_gap)


def session_measures(agg: DataFrame, u: str, with_avg_gap: bool = True) -> DataFrame:
    """Output columns of ``sessions`` from one row per session with ``_lead_gap``,
    the minutes from the user's event before it (0 for the first)."""
    span_min = (epoch_seconds("session_end") - epoch_seconds("session_start")) / 60.0
    out = agg.select(
        u,
        _session_id(u).alias("session_id"),
        "actions_per_session", "session_start", "session_end",
        ((F.col("_lead_gap") + span_min) / F.col("actions_per_session"))
        .alias("avg_time_between_actions"),
        F.when(F.col("actions_per_session") > 1,
               span_min / (F.col("actions_per_session") - 1)).alias("avg_gap_in_session"),
        duration_hours("session_start", "session_end").alias("session_duration_hours"))
    if not with_avg_gap:
        out = out.drop("avg_time_between_actions", "avg_gap_in_session")
    return out


def session_events(df: DataFrame, timeout_minutes: float = 30, split_at_midnight: bool = True,
                   cols: EventCols = INTERACTION_COLS) -> DataFrame:
    """Every event with ``prev_timestamp, time_diff_minutes, new_session,
    session_num, session_id`` (the per-event columns of the task's
    pipeline).

    One lazy plan whatever the data: events are only ordered within one
    user's *second* (window keyed by user and whole second). The first event
    of a second takes its predecessor from a per-second table: the last time
    of the previous non-empty second in the same bucket (a window over at
    most W seconds), or, for the bucket's first second, the last time before
    the bucket from the bucket table. Only a bucket's first event can open a
    session. So no task orders more than one user-second, even if one bucket
    holds a third of all rows.
    """
    u, ts = cols.user, cols.ts
    width = bucket_width_seconds(timeout_minutes)
    ev = (_clean(df, cols)
          .withColumn("_sec", epoch_seconds(ts))
          .withColumn("_bucket", time_bucket(ts, width)))
    # Two readers share the exchange of the per-second table, so the events
    # are read twice and not three times: for that both use the same columns,
    # and the filters that the join below implies stand here for both.
    per_sec = (ev.where(F.col("_sec").isNotNull() & F.col("_bucket").isNotNull())
               .groupBy(u, "_bucket", "_sec")
               .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")))
    per_bucket = (per_sec.groupBy(u, "_bucket")
                  .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")))
    buckets = (_number_buckets(per_bucket, timeout_minutes, split_at_midnight, u)
               .select(u, "_bucket", "prev_last_ts", "opens", "session_num"))
    in_bucket = Window.partitionBy(u, "_bucket").orderBy("_sec")
    seconds = (per_sec
               .withColumn("_prev_sec_last", F.lag(F.struct("first_ts", "last_ts")).over(in_bucket)["last_ts"])
               .select(u, "_bucket", "_sec", "_prev_sec_last")
               .join(buckets, [u, "_bucket"], "inner")
               .drop("_bucket"))
    in_second = Window.partitionBy(u, "_sec").orderBy(*cols.order_cols())
    joined = (ev.withColumn("_prev_in", F.lag(ts).over(in_second))
              .join(seconds, [u, "_sec"], "inner"))
    return (_finish_events(joined, u, ts)
            .drop("_bucket", "_sec", "_prev_in", "_prev_sec_last", "prev_last_ts", "opens"))


def _finish_events(joined: DataFrame, u: str, ts: str) -> DataFrame:
    """Per-event columns from ``_prev_in`` (predecessor in the ordered
    group), ``_prev_sec_last`` (last time of the previous second in the
    bucket, if ordered per second) and the bucket's ``prev_last_ts``,
    ``opens`` and ``session_num``."""
    first_of_bucket = F.col("_prev_in").isNull() & F.col("_prev_sec_last").isNull()
    prev = F.coalesce(F.col("_prev_in"), F.col("_prev_sec_last"), F.col("prev_last_ts"))
    return (joined
            .withColumn("prev_timestamp", prev)
            .withColumn("time_diff_minutes", gap_minutes(ts, "prev_timestamp"))
            .withColumn("new_session", F.when(first_of_bucket, F.col("opens")).otherwise(F.lit(0)))
            .withColumn("session_id", _session_id(u)))


def valid_sessions(sess: DataFrame, max_hours: float = 24.0, min_actions: int = 2) -> DataFrame:
    """Duration at most ``max_hours`` and at least ``min_actions`` actions."""
    from tidemark.functions.predicates import valid_session
    return sess.where(valid_session(max_hours, min_actions))
