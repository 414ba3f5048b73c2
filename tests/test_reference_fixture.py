"""The task's own five-row fixture, through a CSV round trip."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from tidemark.operators import activity, sessions
from tidemark.plans import reports
from tidemark.session import scratch_path
from tidemark.sources import sinks

# The task's fixture rows.
ROWS = [
    ("user1", "2024-01-01 10:00:00", "view", "page1", 120, "1.0.0"),
    ("user1", "2024-01-01 10:05:00", "edit", "page1", 300, "1.0.0"),
    ("user1", "2024-01-01 11:00:00", "view", "page2", 180, "1.0.0"),
    ("user2", "2024-01-01 09:00:00", "view", "page3", 240, "1.0.0"),
    ("user2", "2024-01-01 09:03:00", "edit", "page3", 420, "1.0.0"),
]
META = [
    ("user1", "2023-01-01", "US", "desktop", "premium"),
    ("user2", "2023-06-01", "UK", "mobile", "free"),
]


@pytest.fixture(scope="module")
def loaded(spark):
    s = T.StructType([T.StructField(n, T.StringType(), False) for n in
                      ("user_id", "timestamp", "action_type", "page_id")]
                     + [T.StructField("duration_ms", T.IntegerType(), False),
                        T.StructField("app_version", T.StringType(), False)])
    m = T.StructType([T.StructField(n, T.StringType(), False) for n in
                      ("user_id", "join_date", "country", "device_type", "subscription_type")])
    ip, mp = scratch_path(spark, "fx-inter"), scratch_path(spark, "fx-meta")
    sinks.write_csv(spark.createDataFrame(ROWS, s), ip)
    sinks.write_csv(spark.createDataFrame(META, m), mp)
    return reports.prepare_datasets(spark, ip, mp, partitioning="range", n_partitions=2)


def test_csv_gives_declared_types_and_unique_users(loaded):
    inter, meta = loaded
    assert inter.count() == 5
    assert meta.count() == 2
    assert dict(inter.dtypes)["timestamp"] == "timestamp"
    assert dict(meta.dtypes)["join_date"] == "date"


def test_dau_and_rolling_counts_of_the_fixture(loaded):
    inter, _ = loaded
    res = reports.active_users(inter, dt.datetime(2024, 1, 1))
    rows = res["daily_active"].collect()
    assert [(r.date, r.daily_active_users) for r in rows] == [(dt.date(2024, 1, 1), 2)]
    assert res["monthly_active"].collect()[0]["monthly_active_users"] == 2
    assert res["rolling_mau"].collect()[0]["active_users_30d"] == 2


def test_single_action_session_is_not_valid(loaded):
    inter, _ = loaded
    all_sessions = sessions.sessions(inter, 30, False)
    assert all_sessions.count() == 3
    valid = reports.valid_session_table(inter, 30)
    # user1's 11:00 action is a session of its own, which the validity
    # filter (>= 2 actions) removes: 2, not 3.
    assert valid.count() == 2
    assert sorted(r.session_id for r in valid.collect()) == ["user1_1", "user2_1"]
    got = {r.session_id: (r.actions_per_session, r.session_duration_hours) for r in valid.collect()}
    assert got == {"user1_1": (2, 300 / 3600), "user2_1": (2, 180 / 3600)}


def test_longer_timeouts_never_add_sessions(loaded):
    inter, _ = loaded
    assert reports.valid_session_table(inter, 15).count() == 2
    assert reports.valid_session_table(inter, 60).count() == 2
    raw = [sessions.sessions(inter, t, False).count() for t in (15, 30, 60)]
    assert raw == sorted(raw, reverse=True)


def test_full_session_metrics(loaded):
    inter, _ = loaded
    out = reports.session_metrics(inter)
    s = out["session_metrics"].collect()[0]
    assert s.total_valid_sessions == 2 and s.unique_users == 2
    assert out["funnel"].collect()[0].n_sessions == 3
    assert out["time_metrics"].count() == 2


def test_quality_report(spark, loaded):
    from tidemark.schemas import INTERACTIONS
    inter, _ = loaded
    rep = reports.validate_data_quality(spark, inter, INTERACTIONS,
                                        as_of=dt.datetime(2030, 1, 1))
    checks = {(r.check_name, r.column_name): r.n_bad for r in rep.collect()}
    # 'view' is not one of the generator's action types.
    assert checks == {("unknown_action", None): 3}


def test_dau_of_activity_subset(loaded):
    inter, _ = loaded
    r = activity.daily_active(inter, actions=["edit"]).collect()
    assert r[0].daily_active_users == 2


def test_session_metrics_checkpointed(loaded):
    inter, _ = loaded
    out = reports.session_metrics(inter, checkpoint_sessions=True)
    assert out["session_metrics"].collect()[0].total_valid_sessions == 2
    assert out["funnel"].collect()[0].n_sessions == 3
