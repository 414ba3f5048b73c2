"""Time expressions.

Whole-second arithmetic is kept on purpose (trap T7): gaps and durations
are differences of ``unix_timestamp`` values, which drop the fraction of
each timestamp before subtracting.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A wall-clock timestamp literal (``timestamp_ntz``).

    Built from text on purpose: a Python ``datetime`` literal is turned
    into an instant through the *driver process's* local time zone, so it
    would shift with the machine. Compared with zoned columns it is read
    in the session time zone (UTC).
    """
    if isinstance(value, str):
        text = value
    elif isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        raise TypeError(f"not a timestamp: {value!r}")
    return F.lit(text).cast("timestamp_ntz")


def date_literal(value) -> Column:
    """A calendar-date literal built from text (no time-zone conversion)."""
    return F.lit(day_start(value).isoformat()).cast("date")


def activity_date(ts) -> Column:
    """Calendar day of an event in the session time zone (UTC, T13)."""
    return F.to_date(_c(ts))


def day_start(start) -> _dt.date:
    """Truncate a start bound to its day, so the first day is kept (T4)."""
    if isinstance(start, _dt.datetime):
        return start.date()
    if isinstance(start, _dt.date):
        return start
    return _dt.date.fromisoformat(str(start)[:10])


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch; the fraction is dropped (T7)."""
    return F.unix_timestamp(_c(ts))


def gap_minutes(ts, prev_ts) -> Column:
    """Minutes from ``prev_ts`` to ``ts`` on whole seconds, 0 without prev."""
    return (F.when(_c(prev_ts).isNotNull(),
                   (epoch_seconds(ts) - epoch_seconds(prev_ts)) / 60.0)
            .otherwise(F.lit(0.0)))


def duration_hours(start, end) -> Column:
    return (epoch_seconds(end) - epoch_seconds(start)) / 3600.0


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts))


def day_of_week(ts) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(_c(ts))


DAY_SECONDS = 86_400


def time_bucket(ts, bucket_seconds: int) -> Column:
    """Index of the ``bucket_seconds``-wide slot holding ``ts``.

    Slots restart at every midnight of the session time zone, the one in
    which ``activity_date`` cuts days (the last slot of a day may be
    shorter), so a slot never spans two calendar days, and the index orders
    like time. Two events in one slot are at most ``bucket_seconds - 1``
    whole seconds apart. Days with a clock change have 23 or 25 hours.
    """
    width = int(bucket_seconds)
    day = activity_date(ts)
    into_day = epoch_seconds(ts) - epoch_seconds(day.cast("timestamp"))
    per_day = -(-(DAY_SECONDS + 7200) // width)
    return (F.unix_date(day) * F.lit(per_day) + F.floor(into_day / F.lit(width))).cast("long")
