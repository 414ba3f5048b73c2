"""One edge fixture per semantic trap."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from tidemark.operators import activity, diff, enrich, outliers, quality, quantiles, sessions, summary


def _col(df, name, order="date"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_t1_rolling_sum_vs_true_mau(make_events):
    ev = make_events([("a", "2024-01-01 10:00:00"), ("a", "2024-01-02 10:00:00"),
                      ("a", "2024-01-03 10:00:00")])
    dau = activity.daily_active(ev)
    assert _col(activity.rolling_dau_sum(dau), "monthly_active_users") == [1, 2, 3]
    assert _col(activity.rolling_active_users(ev, 30), "active_users_30d") == [1, 1, 1]


def test_t2_rows_frame_vs_calendar_window(make_events):
    ev = make_events([("a", "2024-01-01 10:00:00"), ("a", "2024-02-09 10:00:00")])
    dau = activity.daily_active(ev)
    assert _col(activity.rolling_dau_sum(dau), "monthly_active_users") == [1, 2]
    assert _col(activity.rolling_active_users(ev, 30), "active_users_30d") == [1, 1]
    ev2 = make_events([("a", "2024-01-01 10:00:00"), ("b", "2024-02-09 10:00:00")])
    assert _col(activity.rolling_active_users(ev2, 30), "active_users_30d") == [1, 1]
    # the 30-day window includes day 30 but not day 31
    ev3 = make_events([("a", "2024-01-01 10:00:00"), ("b", "2024-01-30 10:00:00"),
                       ("c", "2024-01-31 10:00:00")])
    assert _col(activity.rolling_active_users(ev3, 30), "active_users_30d") == [1, 2, 2]


def test_rolling_window_one_equals_dau(make_events):
    ev = make_events([("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 11:00:00"),
                      ("a", "2024-01-03 10:00:00")])
    got = _col(activity.rolling_active_users(ev, 1), "active_users_1d")
    assert got == _col(activity.daily_active(ev), "daily_active_users") == [2, 1]


def test_t3_midnight_split(make_events):
    ev = make_events([("a", "2024-01-01 23:50:00"), ("a", "2024-01-02 00:10:00")])
    assert sessions.sessions(ev, 30, True).count() == 2
    assert sessions.sessions(ev, 30, False).count() == 1


def test_t4_start_day_kept(make_events):
    ev = make_events([("a", "2024-01-05 08:00:00"), ("a", "2024-01-04 08:00:00")])
    got = activity.daily_active(ev, start=dt.datetime(2024, 1, 5, 12, 0)).collect()
    assert [r.date for r in got] == [dt.date(2024, 1, 5)]


def test_t5_compat_and_corrected_gap(make_events):
    ev = make_events([("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:10:00"),
                      ("a", "2024-01-01 12:00:00"), ("a", "2024-01-01 12:20:00")])
    s = {r.session_id: r for r in sessions.sessions(ev, 30).collect()}
    assert s["a_1"].avg_time_between_actions == 5.0     # (0 + 10) / 2
    assert s["a_2"].avg_time_between_actions == 65.0    # (110 + 20) / 2
    assert s["a_2"].avg_gap_in_session == 20.0


def test_t6_exact_timeout_stays(make_events):
    ev = make_events([("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:30:00"),
                      ("a", "2024-01-01 11:00:01")])
    assert sorted(r.actions_per_session for r in sessions.sessions(ev, 30).collect()) == [1, 2]


def test_t7_whole_seconds(make_events):
    ev = make_events([("a", "2024-01-01 10:00:00.100000"), ("a", "2024-01-01 10:30:00.900000")])
    assert sessions.sessions(ev, 30).count() == 1


def test_t8_no_valid_session(make_events):
    ev = make_events([("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 11:00:00")])
    valid = sessions.valid_sessions(sessions.sessions(ev))
    b = outliers.iqr_bounds(valid).collect()[0]
    assert b.duration_upper_bound is None and b.actions_upper_bound is None
    assert outliers.clean_sessions(valid, outliers.iqr_bounds(valid)).count() == 0
    f = summary.cleaning_funnel(sessions.sessions(ev)).collect()[0]
    assert (f.n_sessions, f.n_valid, f.n_clean, f.n_removed) == (2, 0, 0, 2)


def test_t8b_quantiles_are_exact(spark):
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    many = spark.range(300_000).select((F.col("id") * 7919 % 300_007 / 3.0 - 20_000).alias("v"), F.lit(1).alias("w"))
    odd = spark.createDataFrame([(x, 1) for x in [
        0.0, -0.0, 1e-320, -1e-320, 5e-324, 1.0, 1.0 + 2**-52, -1.0, 2.0, 1.999999, 1e308, -1e308, float("inf"),
        float("-inf"), float("nan"), None, 3.0, 3.0, 3.0]], "v double, w int")
    for df in (many, odd, odd.limit(1), spark.createDataFrame([], "v double, w int")):
        want = df.selectExpr(*[f"percentile_disc({p}) within group (order by v) as p{i}"
                               for i, p in enumerate(probs)]).collect()[0]
        for f in (quantiles.exact_quantiles, quantiles.discrete_quantiles):
            got = f(df, ["v", "w"], probs).collect()[0]
            plain = lambda xs: [x if x is None else str(x + 0.0) for x in xs]  # noqa: E731  (-0.0 is 0.0)
            assert plain(got.q_v) == plain(want), f
            assert set(got.q_w) <= {1, None}


def test_quantiles_of_whole_numbers_keep_their_type(spark):
    df = spark.range(1, 1001).select("id")
    assert quantiles.exact_quantiles(df, ["id"], [0.25, 0.5]).collect()[0].q_id == [250, 500]


def test_t9_low_outlier_kept(make_events):
    rows = []
    for i, u in enumerate("bcdefgh"):
        rows += [(u, f"2024-01-0{1 + i % 7} 10:00:00"), (u, f"2024-01-0{1 + i % 7} 10:20:00")]
    rows += [("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:01")]
    ev = make_events(rows)
    valid = sessions.valid_sessions(sessions.sessions(ev))
    clean = outliers.clean_sessions(valid, outliers.iqr_bounds(valid))
    assert "a_1" in {r.session_id for r in clean.collect()}


def test_t10_same_instant(make_events):
    ev = make_events([("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:00")])
    s = sessions.sessions(ev).collect()
    assert len(s) == 1 and s[0].actions_per_session == 2


def test_t11_null_user(make_events):
    ev = make_events([(None, "2024-01-01 10:00:00"), ("a", "2024-01-01 10:00:00")])
    assert activity.daily_active(ev).collect()[0].daily_active_users == 1
    s = sessions.sessions(ev).collect()
    assert [r.session_id for r in s] == ["a_1"]
    rules = quality.event_rules("user_id", "timestamp", "action_type", "duration_ms",
                                ["view"], dt.datetime(2030, 1, 1))
    clean, bad = quality.split_quarantine(ev, rules)
    assert clean.count() == 1
    assert bad.collect()[0].dq_failures == ["null_user"]


def test_t12_single_session_stddev_null(make_events):
    ev = make_events([("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:05:00")])
    valid = sessions.valid_sessions(sessions.sessions(ev))
    s = summary.session_summary(outliers.clean_sessions(valid, outliers.iqr_bounds(valid)))
    r = s.collect()[0]
    assert r.total_valid_sessions == 1 and r.stddev_session_duration is None


def test_t13_utc_day(spark, make_events):
    ev = make_events([("a", dt.datetime(2024, 1, 1, 23, 30))])
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert activity.daily_active(ev).collect()[0].date == dt.date(2024, 1, 1)


def test_d8_latest_metadata(spark):
    meta = spark.createDataFrame(
        [("u1", dt.date(2023, 1, 1), "US"), ("u1", dt.date(2024, 1, 1), "UK"),
         ("u2", dt.date(2022, 1, 1), "FR")], "user_id string, join_date date, country string")
    latest = {r.user_id: r.country for r in
              enrich.latest_per_key(meta, "user_id", ["join_date"]).collect()}
    assert latest == {"u1": "UK", "u2": "FR"}
    facts = spark.createDataFrame([(1, "u1"), (2, "u1"), (3, "u3")], "id long, user_id string")
    joined = enrich.enrich(facts, enrich.latest_per_key(meta, "user_id", ["join_date"]),
                           "user_id", "left", strategy="broadcast")
    assert joined.count() == 3


def test_d7_salted_equals_plain(spark):
    facts = spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("user_id"))
    facts = facts.withColumn("user_id", F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("user_id")))
    dim = spark.range(45).select(F.col("id").alias("user_id"), (F.col("id") * 10).alias("attr"))
    assert enrich.hot_keys(facts, "user_id", k=2).collect()[0].user_id == 7
    salts = {r.user_id: r.salts for r in enrich.hot_key_salts(facts, "user_id", 12).collect()}
    assert salts == {7: 4}  # a bit less than a third of the rows over twelve tasks
    for how in ("left", "inner", "left_semi", "left_anti"):
        salted = enrich.enrich_salted(facts, dim, "user_id", "event_id", how, partitions=12)
        plain = facts.join(dim, "user_id", how)
        assert diff.same_rows(salted, plain.select(*salted.columns))
    for how in ("right", "full", "cross"):
        with pytest.raises(ValueError):
            enrich.enrich_salted(facts, dim, "user_id", "event_id", how)


def test_x1_bag_vs_set_diff(spark):
    a = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    b = spark.createDataFrame([("a",), ("b",)], "x string")
    assert diff.diff_rows(a, b, bag=False).count() == 0
    d = diff.diff_rows(a, b, bag=True).collect()
    assert [(r.x, r.side, r.copies) for r in d] == [("a", "left_only", 1)]
    many = spark.range(3_000_000).select(F.lit("a").alias("x"))
    assert [tuple(r) for r in diff.diff_rows(many, b).collect()
            if r.x == "a"] == [("a", "left_only", 2_999_999)]
    assert diff.same_rows(a, a) and not diff.same_rows(a, b)


def test_schema_issues(spark):
    from tidemark.schemas import INTERACTIONS
    df = spark.createDataFrame([("u", 1)], "user_id string, duration_ms int")
    issues = {(r.column_name, r.issue) for r in
              quality.schema_issues(spark, df, INTERACTIONS).collect()}
    assert ("timestamp", "missing") in issues
    assert ("duration_ms", "wrong_type") in issues


def test_value_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "v double")
    flagged = outliers.handle_outliers(df, "v", mode="flag")
    assert [r.v for r in flagged.where("is_outlier").collect()] == [100.0]
    assert outliers.handle_outliers(df, "v", mode="drop").count() == 8
    capped = outliers.handle_outliers(df, "v", mode="cap").agg(F.max("v")).collect()[0][0]
    assert capped < 100.0


def test_literals_do_not_depend_on_driver_time_zone(spark):
    import os
    import time

    from tidemark.plans.catalog import QUERIES
    from tests.conftest import SF001
    old = os.environ.get("TZ")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        n = QUERIES["quality_future"](spark, SF001).collect()[0].future_records
        first = QUERIES["synthetic_interactions"](spark, SF001).agg(F.min("timestamp")).collect()
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        time.tzset()
    assert n == QUERIES["quality_future"](spark, SF001).collect()[0].future_records == 3672
    assert first == QUERIES["synthetic_interactions"](spark, SF001).agg(
        F.min("timestamp")).collect()


def test_quality_report_messages(spark, make_events):
    from tidemark.plans import reports
    from tidemark.schemas import INTERACTIONS
    ev = make_events([(None, "2024-01-01 10:00:00"), ("a", "2031-01-01 10:00:00")],
                     action="edit").drop("app_version")
    rep = reports.validate_data_quality(spark, ev, INTERACTIONS, as_of=dt.datetime(2030, 1, 1))
    msgs = sorted(r.message for r in rep.collect())
    assert msgs == ["Found 1 null values in column user_id",
                    "Found 1 records with future timestamps",
                    "Found 1 rows failing null_user",
                    "Missing required column: app_version"]


def test_null_times_do_not_leak_into_rolling_users(make_events):
    ev = make_events([("A", "2024-01-10 10:00:00"), ("B", "2024-01-05 10:00:00")])
    null = ev.where("user_id = 'A'").withColumn("timestamp", F.lit(None).cast("timestamp"))
    got = {str(r.date): r.active_users_30d for r in activity.rolling_active_users(ev.union(null), 30).collect()}
    assert got == {"2024-01-05": 1, "2024-01-10": 2}
    days = activity.user_day_summary(ev.union(null))
    assert days.where("date is null").count() == 0
    got = {str(r.date): r.active_users_30d for r in activity.rolling_from_user_days(
        days.unionByName(days.withColumn("date", F.lit(None).cast("date"))), 30).collect()}
    assert got == {"2024-01-05": 1, "2024-01-10": 2}


def test_quality_of_other_tables(spark):
    from tidemark.plans import reports
    from tidemark.schemas import METADATA
    meta = spark.createDataFrame([("u", None, "US")], "user_id string, join_date date, country string")
    got = {(r.check_name, r.column_name) for r in
           reports.validate_data_quality(spark, meta, METADATA, table_name="metadata").collect()}
    assert got == {("nulls", "join_date"), ("schema_missing", "device_type"), ("schema_missing", "subscription_type")}
    two = spark.createDataFrame([("u", dt.datetime(2031, 1, 1)), (None, None)], "user_id string, timestamp timestamp")
    got = {r.check_name for r in reports.validate_data_quality(spark, two, None, as_of=dt.datetime(2030, 1, 1)).collect()}
    assert got == {"nulls", "null_user", "null_timestamp", "future_timestamp"}
    none = spark.createDataFrame([(1,)], "x int")
    assert reports.validate_data_quality(spark, none, None).count() == 0


def test_persisted_and_preview(spark):
    from tidemark.operators.partitioning import partition_by_user, persisted
    from tidemark.sources.sinks import preview
    df = spark.range(100).select((F.col("id") % 7).alias("user_id"), "id")
    with persisted(partition_by_user(df)) as d:
        assert d.is_cached and d.count() == 100
    assert not df.is_cached
    assert [r.id for r in preview(df, ["user_id", "id"], 3).collect()] == [0, 7, 14]
