"""Declared schemas and the logical-to-physical column mapping."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The action types of the task's interactions table.
INTERACTION_ACTIONS = ("page_view", "edit", "create", "delete", "share")
# The event types of the driver's events table.
EVENT_TYPES = ("view", "signup", "error", "click", "purchase")

# Interactions as the task statement declares them (CSV at rest).
INTERACTIONS = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("action_type", T.StringType(), True),
    T.StructField("page_id", T.StringType(), True),
    T.StructField("duration_ms", T.LongType(), True),
    T.StructField("app_version", T.StringType(), True),
])

# User metadata as declared; user_id may repeat (see metadata dedup).
METADATA = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("join_date", T.DateType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("subscription_type", T.StringType(), True),
])

# The driver's ``events`` table, read from Parquet.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])


@dataclass(frozen=True)
class EventCols:
    """Names of the logical columns in a physical event table.

    ``order`` is a unique tiebreak used after the timestamp wherever rows
    are ordered per user (trap T10); ``None`` means no tiebreak column.
    ``measure`` is the per-event numeric value (``duration_ms`` in the
    task statement, ``value`` in the events table).
    """

    user: str = "user_id"
    ts: str = "timestamp"
    action: str = "action_type"
    measure: str = "duration_ms"
    order: str | None = None

    def order_cols(self) -> list[str]:
        return [self.ts] + ([self.order] if self.order else [])


INTERACTION_COLS = EventCols()
EVENTS_TABLE_COLS = EventCols(user="user_id", ts="ts", action="event_type",
                              measure="value", order="event_id")
