"""The task's entry points as functions returning DataFrames.

``prepare_datasets`` (C1/C2), ``active_users`` (C3/C4),
``session_metrics`` (C5), ``valid_session_table`` (C6) and
``validate_data_quality`` (C7). Nothing is pulled to the driver: the
outlier thresholds are a one-row DataFrame and the quality report a long
DataFrame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators import activity, enrich, outliers, quality, sessions, summary
from tidemark.operators.partitioning import partition_by_user
from tidemark.schemas import EventCols, INTERACTION_COLS
from tidemark.session import materialize
from tidemark.sources import readers


def prepare_datasets(spark: SparkSession, interactions_path: str, metadata_path: str,
                     fmt: str = "csv", partitioning: str | None = None,
                     n_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(interactions, deduplicated metadata).

    ``partitioning`` ("hash"/"range") repartitions interactions by user;
    only useful when the caller persists them for several user-keyed
    outputs. Metadata keeps the latest ``join_date`` per user.
    """
    inter = readers.read_interactions(spark, interactions_path, fmt)
    if partitioning:
        inter = partition_by_user(inter, "user_id", n_partitions, partitioning)
    meta = readers.read_metadata(spark, metadata_path, fmt)
    meta = enrich.latest_per_key(meta, "user_id", order=["join_date"])
    return inter, meta


def active_users(interactions: DataFrame, start=None, approx: bool = False,
                 cols: EventCols = INTERACTION_COLS) -> dict[str, DataFrame]:
    """DAU, the compat rolling DAU sum, and true 30-day distinct users."""
    dau = activity.daily_active(interactions, start, cols, approx=approx)
    out = {"daily_active": dau, "monthly_active": activity.rolling_dau_sum(dau, 31)}
    if approx:
        out["rolling_mau"] = activity.rolling_active_users_approx(interactions, 30, cols, start)
    else:
        out["rolling_mau"] = activity.rolling_active_users(interactions, 30, cols, start)
    return out


def session_metrics(interactions: DataFrame, timeout_minutes: float = 30,
                    max_hours: float = 24.0, min_actions: int = 2,
                    split_at_midnight: bool = True, cols: EventCols = INTERACTION_COLS,
                    checkpoint_sessions: bool = True) -> dict[str, DataFrame]:
    """Summary, clean sessions, time-of-week profile, thresholds, funnel.

    The session table is derived once, by this call, and written as a
    reliable checkpoint in the shared folder (survives executor loss); all
    outputs read it. Without ``checkpoint_sessions`` nothing is written and
    every output derives the sessions when it runs.
    """
    sess = sessions.sessions(interactions, timeout_minutes, split_at_midnight, cols)
    if checkpoint_sessions:
        sess = materialize(sess)
    valid = sessions.valid_sessions(sess, max_hours, min_actions)
    bounds = outliers.iqr_bounds(valid)
    clean = outliers.clean_sessions(valid, bounds)
    return {
        "session_metrics": summary.session_summary(clean, cols.user),
        "detailed_sessions": clean,
        "time_metrics": summary.time_of_week(clean),
        "outlier_thresholds": bounds,
        "funnel": summary.cleaning_funnel(sess, max_hours, min_actions),
    }


def valid_session_table(interactions: DataFrame, timeout_minutes: float = 30,
                        max_hours: float = 24.0, min_actions: int = 2,
                        cols: EventCols = INTERACTION_COLS) -> DataFrame:
    """Sessions without the midnight split, validity filter only."""
    sess = sessions.sessions(interactions, timeout_minutes, False, cols, with_avg_gap=False)
    return sessions.valid_sessions(sess, max_hours, min_actions)


def validate_data_quality(spark: SparkSession, df: DataFrame, declared: T.StructType | None,
                          cols: EventCols = INTERACTION_COLS,
                          domain=quality.INTERACTION_ACTIONS,
                          as_of: dt.datetime | None = None,
                          table_name: str = "interactions") -> DataFrame:
    """Failing checks of any table: columns against ``declared``, NULLs, and
    the row rules whose columns the table has (a table without any of them,
    such as user metadata, gets the first two)."""
    rules = quality.event_rules(cols.user, cols.ts, cols.action, cols.measure, domain, as_of,
                                columns=df.columns)
    return quality.quality_report(spark, df, declared, rules, table_name)
