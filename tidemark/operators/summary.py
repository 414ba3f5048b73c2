"""Session summaries: one-row report, time-of-week profile, ratios and
the cleaning funnel. All are single aggregates over the session table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import valid_session, within_bounds
from tidemark.functions.timefns import day_of_week, hour_of_day
from tidemark.operators.outliers import bound_values, iqr_bounds
from tidemark.operators.quantiles import discrete_quantiles

# fixed values: the output names below are those of the report's contract
DUR = "session_duration_hours"
ACT = "actions_per_session"


def session_summary(clean: DataFrame, user: str = "user_id", compat_strings: bool = True) -> DataFrame:
    """One row: counts, mean and sample stddev (T12) of duration and
    actions, and their quartiles as columns (plus, for compatibility, the
    quartile arrays cast to strings)."""
    quart = discrete_quantiles(clean, [DUR, ACT], [0.25, 0.5, 0.75])
    qd, qa = bound_values(quart, f"q_{DUR}", f"q_{ACT}")
    out = clean.agg(
        F.count("session_id").alias("total_valid_sessions"),
        F.countDistinct(user).alias("unique_users"),
        F.avg(DUR).alias("avg_session_duration_hours"),
        F.stddev_samp(DUR).alias("stddev_session_duration"),
        F.avg(ACT).alias("avg_actions_per_session"),
        F.stddev_samp(ACT).alias("stddev_actions_per_session"))
    out = out.select(
        "*",
        qd[0].alias("duration_q1"), qd[1].alias("duration_median"), qd[2].alias("duration_q3"),
        qa[0].alias("actions_q1"), qa[1].alias("actions_median"), qa[2].alias("actions_q3"),
        *([qd.cast("string").alias("session_duration_quartiles"),
           qa.cast("string").alias("actions_quartiles")] if compat_strings else []))
    return out


def time_of_week(clean: DataFrame) -> DataFrame:
    """Sessions per (hour of day, day of week; 1 = Sunday) of their start."""
    return (clean
            .groupBy(hour_of_day("session_start").alias("hour_of_day"),
                     day_of_week("session_start").alias("day_of_week"))
            .agg(F.count("session_id").alias("session_count"),
                 F.avg(DUR).alias("avg_duration"),
                 F.avg(ACT).alias("avg_actions")))


def session_ratios(sess: DataFrame) -> DataFrame:
    """Total session time and total actions over the number of sessions."""
    return (sess.agg(F.count(F.lit(1)).alias("sessions"),
                     F.sum(DUR).alias("total_session_hours"),
                     F.sum(ACT).alias("total_actions"))
            .withColumn("hours_per_session", F.col("total_session_hours") / F.col("sessions"))
            .withColumn("actions_per_session", F.col("total_actions") / F.col("sessions")))


def cleaning_funnel(sess: DataFrame, max_hours: float = 24.0, min_actions: int = 2) -> DataFrame:
    """One pass over all sessions: how many are valid, clean and removed.

    ``sessions_removed = all - clean``, as the task's pipeline logs it,
    with the bounds it used.
    """
    valid = valid_session(max_hours, min_actions)
    bounds = iqr_bounds(sess.where(valid))
    d_ub, a_ub = bound_values(bounds, "duration_upper_bound", "actions_upper_bound")
    clean = valid & within_bounds(d_ub, a_ub)
    return (sess.agg(F.count(F.lit(1)).alias("n_sessions"),
                     F.count_if(valid).alias("n_valid"),
                     F.count_if(F.coalesce(clean, F.lit(False))).alias("n_clean"))
            .withColumn("n_removed", F.col("n_sessions") - F.col("n_clean"))
            .withColumn("duration_upper_bound", d_ub)
            .withColumn("actions_upper_bound", a_ub))
