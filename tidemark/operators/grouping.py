"""Grouping sets with exact distinct users.

A distinct count under ``CUBE`` would expand every event once per grouping set
and then group by user in each. Here the expansion happens on users:

1. events are reduced to one row per user and day (map-side partials);
2. a first pair of grouping sets adds one row per user over all days;
3. attributes are joined to these rows. Each user has one set of attributes,
   so within a day (or all days) a user is one row, and the sets over the
   attributes need plain counts only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import activity_date
from tidemark.operators.enrich import enrich
from tidemark.schemas import EventCols, INTERACTION_COLS


def activity_cube(events: DataFrame, users: DataFrame, segments: list[str],
                  cols: EventCols = INTERACTION_COLS, kind: str = "cube") -> DataFrame:
    """``date, <segments>, grouping_id, events, users, total_measure`` for the
    day and the user attributes ``segments`` with all subtotals.

    ``users`` has one row per user. ``kind`` is ``cube`` (all sets) or
    ``rollup`` (date, then the segments in order). ``grouping_id`` has one bit
    per column, the date's highest; a set bit marks a subtotal over that
    column, so a NULL that is a value stays apart. Events without a user count
    as events but not as users.
    """
    if kind not in ("cube", "rollup"):
        raise ValueError(f"unknown kind {kind!r}")
    u = cols.user
    user_day = (events.withColumn("date", activity_date(cols.ts)).groupBy("date", u)
                .agg(F.count(F.lit(1)).alias("_n"), F.sum(cols.measure).alias("_sum")))
    spans = (user_day.groupingSets([["date", u], [u]], "date", u)
             .agg(F.grouping("date").alias("_all_days"), F.sum("_n").alias("_n"), F.sum("_sum").alias("_sum")))
    rows = enrich(spans, users.select(u, *segments), u, "left")

    fixed = ["date", "_all_days"]
    if kind == "cube":
        sets = [list(c) for k in range(len(segments) + 1) for c in combinations(segments, k)]
    else:
        sets = [segments[:k] for k in range(len(segments) + 1)]
    bits = F.col("_all_days").cast("long") * (1 << len(segments))
    for i, s in enumerate(reversed(segments)):
        bits = bits + F.grouping(s).cast("long") * (1 << i)
    out = (rows.groupingSets([[*fixed, *s] for s in sets], *fixed, *segments)
           .agg(bits.alias("grouping_id"), F.sum("_n").alias("events"), F.count(u).alias("users"),
                F.sum("_sum").alias("total_measure")))
    if kind == "rollup":  # subtotals over the date keep no segment
        out = out.where((F.col("_all_days") == 0) | (F.col("grouping_id") == (2 << len(segments)) - 1))
    return out.select("date", *segments, "grouping_id", "events", "users", "total_measure")
