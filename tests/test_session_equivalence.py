"""The bucket plan equals the straight per-user window definition."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import diff, sessions
from tidemark.schemas import EVENTS_TABLE_COLS as EV
from tests.reference_forms import session_events_by_user_window
from tests.conftest import SF001

COLS = ["event_id", "user_id", "ts", "prev_timestamp", "time_diff_minutes", "new_session",
        "session_num", "session_id"]


@pytest.mark.parametrize("timeout,midnight", [
    (30, True), (30, False), (7.5, False), (90, True), (0, False)])
def test_bucket_plan_matches_user_window(spark, timeout, midnight):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    a = sessions.session_events(ev, timeout, midnight, cols=EV).select(*COLS)
    b = session_events_by_user_window(ev, timeout, midnight, cols=EV).select(*COLS)
    assert diff.same_rows(a, b)


@pytest.mark.parametrize("zone", ["Asia/Kathmandu", "America/New_York", "Europe/Berlin"])
def test_midnight_is_that_of_the_session_zone(spark, zone):
    """23:50 to 00:10 of the wall clock is two sessions in any zone, and days
    with a clock change keep the order of slots."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = [(1, 1, "2024-06-01 23:50:00"), (2, 1, "2024-06-02 00:10:00"), (3, 2, "2024-06-01 23:59:59"),
                (4, 2, "2024-06-02 00:00:00")]
        text += [(10 + h, 3, f"2024-{d} {h % 24:02d}:45:00") for d in ("03-31", "11-03") for h in range(24)]
        rows = spark.createDataFrame(text, "event_id long, user_id long, t string")
        for kind in ("timestamp", "timestamp_ntz"):
            ev = rows.select("event_id", "user_id", F.col("t").cast(kind).alias("ts"))
            n = {r.user_id: r.n for r in sessions.sessions(ev, 60, True, EV).groupBy("user_id")
                 .agg(F.count("*").alias("n")).collect()}
            assert n[1] == n[2] == 2
            for timeout in (30, 59, 90):
                a = sessions.session_events(ev, timeout, True, cols=EV).select(*COLS)
                b = session_events_by_user_window(ev, timeout, True, cols=EV).select(*COLS)
                assert diff.same_rows(a, b)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_session_table_consistent_with_events(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    s = sessions.sessions(ev, 30, True, cols=EV)
    assert s.agg(F.sum("actions_per_session")).collect()[0][0] == ev.count()
    per_event = (session_events_by_user_window(ev, 30, True, cols=EV)
                 .groupBy("user_id", "session_id")
                 .agg(F.count(F.lit(1)).alias("actions_per_session"),
                      F.avg("time_diff_minutes").alias("avg_time_between_actions")))
    joined = s.join(per_event, ["user_id", "session_id"], "full")
    bad = joined.where(
        (s.actions_per_session != per_event.actions_per_session)
        | (F.abs(s.avg_time_between_actions - per_event.avg_time_between_actions) > 1e-9)
        | s.actions_per_session.isNull() | per_event.actions_per_session.isNull())
    assert bad.count() == 0


def test_midnight_rule_never_merges(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    with_rule = sessions.sessions(ev, 30, True, cols=EV).count()
    without = sessions.sessions(ev, 30, False, cols=EV).count()
    assert without <= with_rule


_base = dt.datetime(2024, 1, 1, 22, 0, 0)
_event = st.tuples(st.integers(0, 2), st.integers(0, 6 * 3600), st.integers(0, 999_999))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_event, min_size=1, max_size=40),
       st.sampled_from([0.5, 1, 5, 30]), st.booleans())
def test_property_bucket_plan(spark, events, timeout, midnight):
    rows = [(i, u, _base + dt.timedelta(seconds=s, microseconds=us))
            for i, (u, s, us) in enumerate(events)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    a = sessions.session_events(df, timeout, midnight, cols=EV).select(*COLS)
    b = session_events_by_user_window(df, timeout, midnight, cols=EV).select(*COLS)
    assert diff.same_rows(a, b)


def test_events_within_one_second(spark):
    base = dt.datetime(2024, 1, 1, 23, 59, 58)
    offs = [0.1, 0.5, 0.5, 0.9, 1.2, 1.2, 3.0, 2000.0, 2000.4, 2001.0]
    rows = [(i, 7, base + dt.timedelta(seconds=o)) for i, o in enumerate(offs)]
    rows += [(100 + i, 8, base + dt.timedelta(seconds=o)) for i, o in enumerate(offs[:4])]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    for midnight in (True, False):
        a = sessions.session_events(df, 30, midnight, cols=EV).select(*COLS)
        b = session_events_by_user_window(df, 30, midnight, cols=EV).select(*COLS)
        assert diff.same_rows(a, b)
