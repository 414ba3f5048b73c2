"""Structured Streaming pipelines (incremental user-days and sessions)."""

from tidemark.streaming.incremental import (
    merge_partials, read_event_stream, run_available_now, session_stream, user_day_partials, user_day_snapshot,
)

__all__ = ["merge_partials", "read_event_stream", "run_available_now", "session_stream",
           "user_day_partials", "user_day_snapshot"]
