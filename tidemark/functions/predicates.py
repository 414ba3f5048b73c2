"""Row predicates."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.timefns import date_literal, ts_literal


def on_or_after_day(date_col, start) -> Column:
    """``date >= start`` with ``start`` truncated to its day (trap T4)."""
    col = F.col(date_col) if isinstance(date_col, str) else date_col
    return col >= date_literal(start)


def is_future(ts, as_of: _dt.datetime | Column) -> Column:
    """Event time after ``as_of``: a fixed instant (repeatable) or a column
    such as ``current_timestamp()``."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return col > (as_of if isinstance(as_of, Column) else ts_literal(as_of))


def valid_session(max_hours: float = 24.0, min_actions: int = 2,
                  duration: str = "session_duration_hours",
                  actions: str = "actions_per_session") -> Column:
    return ((F.col(duration) <= F.lit(float(max_hours)))
            & (F.col(actions) >= F.lit(int(min_actions))))


def within_bounds(duration_bound: Column, actions_bound: Column,
                  duration: str = "session_duration_hours",
                  actions: str = "actions_per_session") -> Column:
    """Upper-side IQR filter only (trap T9); NULL bounds keep no row (T8)."""
    return (F.col(duration) <= duration_bound) & (F.col(actions) <= actions_bound)
