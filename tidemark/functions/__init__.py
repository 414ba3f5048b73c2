"""Column-level building blocks (all JVM-side built-ins, codegen friendly)."""

from tidemark.functions.timefns import (
    activity_date, day_start, epoch_seconds, gap_minutes, hour_of_day,
    day_of_week, duration_hours, time_bucket,
)
from tidemark.functions.predicates import (
    on_or_after_day, is_future, valid_session, within_bounds,
)

__all__ = [
    "activity_date", "day_start", "epoch_seconds", "gap_minutes", "hour_of_day",
    "day_of_week", "duration_hours", "time_bucket", "on_or_after_day", "is_future",
    "valid_session", "within_bounds",
]
