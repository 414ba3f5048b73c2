"""Active-user metrics: DAU, rolling sums, true rolling distinct users.

Plans (checked with ``explain``):

* ``daily_active`` - Catalyst rewrites the distinct count into a two-phase
  aggregate: partial (date, user) -> shuffle -> count per date. A user with
  a third of all rows is collapsed map-side before any shuffle.
* ``rolling_active_users`` - exact distinct users over a calendar window
  without joining every day to its 30 predecessors: each active user-day
  opens an interval that ends at the window length or at the user's next
  active day, whichever comes first; +1/-1 deltas per date and a running
  sum give the count. The per-user window sees at most one row per active
  day (bounded by the calendar span, not by data volume), and the final
  running sum sees one row per date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.predicates import on_or_after_day
from tidemark.functions.timefns import activity_date
from tidemark.schemas import EventCols, INTERACTION_COLS


def _dated(df: DataFrame, cols: EventCols, start=None, actions=None) -> DataFrame:
    out = df.withColumn("date", activity_date(cols.ts))
    if start is not None:
        out = out.where(on_or_after_day("date", start))
    if actions is not None:
        out = out.where(F.col(cols.action).isin(list(actions)))
    return out


def daily_active(df: DataFrame, start=None, cols: EventCols = INTERACTION_COLS,
                 approx: bool = False, rsd: float = 0.05, actions=None) -> DataFrame:
    """One row per active date: ``date, daily_active_users``.

    NULL users are not counted. ``start`` keeps its whole first day (T4).
    ``actions`` restricts which action types make a user active.
    ``approx`` uses HyperLogLog++ (``approx_count_distinct``).
    """
    dated = _dated(df, cols, start, actions)
    agg = (F.approx_count_distinct(cols.user, rsd) if approx
           else F.countDistinct(cols.user))
    return dated.groupBy("date").agg(agg.alias("daily_active_users"))


def rolling_dau_sum(dau: DataFrame, rows: int = 31) -> DataFrame:
    """Compat "MAU": sum of DAU over the last ``rows`` rows ordered by date.

    This is what the task's pipeline labels monthly active users: a user
    active on k days counts k times (T1), and the frame counts rows, not
    calendar days (T2). The window has no partition key on purpose: its
    input has one row per date, so the single partition stays small.
    """
    if rows < 1:
        raise ValueError("rows must be >= 1")
    w = Window.orderBy("date").rowsBetween(-(rows - 1), Window.currentRow)
    return dau.withColumn("monthly_active_users",
                          F.sum("daily_active_users").over(w))


def user_days(df: DataFrame, cols: EventCols = INTERACTION_COLS, start=None) -> DataFrame:
    """Distinct (user, date) pairs; NULL users and times dropped."""
    return (_dated(df, cols, start)
            .where(F.col(cols.user).isNotNull() & F.col("date").isNotNull())
            .select(cols.user, "date").distinct())


def rolling_active_users(df: DataFrame, window_days: int = 30,
                         cols: EventCols = INTERACTION_COLS, start=None,
                         out_col: str | None = None) -> DataFrame:
    """Exact distinct users active in ``[date - window_days + 1, date]``.

    One row per date that has activity. ``window_days=1`` equals DAU.
    """
    return rolling_from_user_days(user_days(df, cols, start), window_days, cols.user, out_col)


def rolling_from_user_days(user_day: DataFrame, window_days: int = 30, user: str = "user_id",
                           out_col: str | None = None) -> DataFrame:
    """Rolling distinct users from distinct (user, ``date``) rows, e.g. a
    stored user-day rollup, without rescanning raw events."""
    if window_days < 1:
        raise ValueError("window_days must be >= 1")
    out_col = out_col or f"active_users_{window_days}d"
    # a row without a date would open a span that ends at the user's next day
    ud = user_day.where(F.col(user).isNotNull() & F.col("date").isNotNull()).select(user, "date")
    nxt = F.lead("date").over(Window.partitionBy(user).orderBy("date"))
    horizon = F.date_add(F.col("date"), window_days)
    spans = ud.select("date", F.least(horizon, F.coalesce(nxt, horizon)).alias("close_on"))
    # one pass over the windowed rows: each span emits its +1 and its -1
    deltas = spans.select(F.explode(F.array(
        F.struct(F.col("date").alias("date"), F.lit(1).alias("delta"), F.lit(1).alias("opens")),
        F.struct(F.col("close_on").alias("date"), F.lit(-1).alias("delta"),
                 F.lit(0).alias("opens"))
    )).alias("d")).select("d.*")
    per_date = deltas.groupBy("date").agg(F.sum("delta").alias("delta"),
                                          F.max("opens").alias("active_day"))
    running = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (per_date
            .withColumn(out_col, F.sum("delta").over(running))
            .where(F.col("active_day") == 1)
            .select("date", out_col))


def rolling_active_users_approx(df: DataFrame, window_days: int = 30,
                                cols: EventCols = INTERACTION_COLS, start=None,
                                lg_k: int = 12, out_col: str | None = None) -> DataFrame:
    """Approximate rolling distinct users from daily HLL sketches.

    One sketch per date (a few KB each), unioned over a RANGE frame of
    calendar days; the data itself is aggregated once, map-side.
    """
    if window_days < 1:
        raise ValueError("window_days must be >= 1")
    out_col = out_col or f"approx_active_users_{window_days}d"
    daily = (_dated(df, cols, start)
             .groupBy("date")
             .agg(F.hll_sketch_agg(cols.user, lg_k).alias("sketch")))
    w = (Window.orderBy(F.unix_date("date"))
         .rangeBetween(-(window_days - 1), Window.currentRow))
    return daily.select(
        "date",
        F.hll_sketch_estimate(F.hll_union_agg("sketch").over(w)).alias(out_col))


def monthly_active(df: DataFrame, cols: EventCols = INTERACTION_COLS, start=None) -> DataFrame:
    """Distinct users per calendar month: ``month, monthly_active_users``."""
    return (_dated(df, cols, start)
            .groupBy(F.trunc("date", "month").alias("month"))
            .agg(F.countDistinct(cols.user).alias("monthly_active_users")))


def user_day_summary(df: DataFrame, cols: EventCols = INTERACTION_COLS, start=None) -> DataFrame:
    """User-day pre-aggregate feeding DAU/MAU and later rollups.

    ``date, user, actions, first_ts, last_ts, total_measure``; rows without a
    user or a time belong to no user-day.
    """
    return (_dated(df, cols, start)
            .where(F.col(cols.user).isNotNull() & F.col("date").isNotNull())
            .groupBy("date", cols.user)
            .agg(F.count(F.lit(1)).alias("actions"),
                 F.min(cols.ts).alias("first_ts"),
                 F.max(cols.ts).alias("last_ts"),
                 F.sum(cols.measure).alias("total_measure")))


def dau_from_user_days(user_day: DataFrame, cols: EventCols = INTERACTION_COLS) -> DataFrame:
    """DAU from the user-day pre-aggregate: a plain count, no distinct."""
    return user_day.groupBy("date").agg(F.count(F.lit(1)).alias("daily_active_users"))


def action_mix(df: DataFrame, cols: EventCols = INTERACTION_COLS, start=None) -> DataFrame:
    """Events and distinct users per (date, action type)."""
    return (_dated(df, cols, start)
            .groupBy("date", F.col(cols.action).alias("action_type"))
            .agg(F.count(F.lit(1)).alias("events"),
                 F.countDistinct(cols.user).alias("users")))
