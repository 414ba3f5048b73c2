"""Readers, sinks, layouts and the generator."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.schemas import INTERACTIONS
from tidemark.session import remove_scratch, scratch_path, scratch_scope
from tidemark.sources import datagen, readers, sinks
from tests.conftest import SF001


def test_csv_permissive_nulls_are_counted(spark):
    path = scratch_path(spark, "t-csv-bad")
    lines = ["user_id,timestamp,action_type,page_id,duration_ms,app_version",
             "u1,2024-01-01 10:00:00,edit,p1,100,5.0.0",
             "u2,not-a-time,edit,p1,abc,5.0.0",
             "u3,2024-01-01 10:00:00.123456,share,p2,7,6.1.0"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    df = readers.read_interactions(spark, path)
    assert df.count() == 3
    nulls = {r.column_name: r.null_count for r in quality.null_counts(df).collect()}
    assert nulls["timestamp"] == 1 and nulls["duration_ms"] == 1
    got = df.where("user_id = 'u3'").collect()[0].timestamp
    assert got == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)


def test_user_bucket_layout_is_consistent(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    path = scratch_path(spark, "t-bucket")
    sinks.write_layout(ev, path, "date_bucket", "ts", "user_id", n_buckets=8)
    back = spark.read.parquet(path)
    assert back.count() == ev.count()
    per_user = back.groupBy("user_id").agg(F.countDistinct("user_id_partition").alias("b"))
    assert per_user.where("b > 1").count() == 0
    assert back.select("user_id_partition").distinct().count() <= 8


def test_pruned_read_lists_partition_filter(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    path = scratch_path(spark, "t-date")
    sinks.write_layout(ev, path, "date", "ts", "user_id", max_records_per_file=500)
    df = sinks.read_date_range(spark, path, dt.date(2024, 1, 10), dt.date(2024, 1, 10))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p
    assert df.count() == ev.where(F.to_date("ts") == dt.date(2024, 1, 10)).count()


def test_generator_domains_and_determinism(spark):
    ids = spark.range(20_000)
    a = datagen.interactions(ids)
    b = datagen.interactions(ids.repartition(7))
    assert a.exceptAll(b).count() == 0
    r = a.agg(F.min("timestamp").alias("t0"), F.max("timestamp").alias("t1"),
              F.min("duration_ms").alias("d0"), F.max("duration_ms").alias("d1"),
              F.countDistinct("action_type").alias("na")).collect()[0]
    assert r.t0 >= datagen.TS_START and r.t1 <= datagen.TS_END
    assert datagen.DURATION_MS[0] <= r.d0 and r.d1 <= datagen.DURATION_MS[1] and r.na == 5
    assert a.where(~F.col("user_id").rlike(r"^u\d{6,7}$")).count() == 0
    hot = datagen.interactions(ids, hot_share=1 / 3)
    share = hot.where("user_id = 'u000001'").count() / 20_000
    assert 0.30 < share < 0.37
    m = datagen.metadata(ids)
    assert m.where(~F.col("country").isin(list(datagen.COUNTRIES))).count() == 0


def test_generated_rows_fit_declared_schema(spark):
    df = datagen.interactions(spark.range(10))
    issues = quality.schema_issues(spark, df.drop("id"), INTERACTIONS).collect()
    # only the timestamp flavour differs: generated wall clock is timestamp_ntz
    assert [(r.column_name, r.issue) for r in issues] == [("timestamp", "wrong_type")]


def test_corrupt_lines_are_kept_and_quarantined(spark):
    path = scratch_path(spark, "t-csv-corrupt")
    lines = ["user_id,timestamp,action_type,page_id,duration_ms,app_version",
             "u1,2024-01-01 10:00:00,edit,p1,100,5.0.0",
             "u2,2024-01-01 10:00:00,edit,p1,not-a-number,5.0.0"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
    df = readers.read_csv(spark, path, INTERACTIONS, keep_corrupt=True)
    clean, bad = quality.split_quarantine(df, readers.unparsable_rule())
    assert [r.user_id for r in clean.collect()] == ["u1"]
    got = bad.collect()
    assert len(got) == 1 and got[0].dq_failures == ["unparsable_row"]
    assert "not-a-number" in got[0][readers.CORRUPT_COL]


def test_partition_rerun_is_idempotent(spark):
    from tidemark.operators import activity
    from tidemark.schemas import EVENTS_TABLE_COLS as EV
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ud = activity.user_day_summary(ev, cols=EV)
    path = scratch_path(spark, "t-user-day")
    first = ud.where(F.col("date") <= dt.date(2024, 1, 15))
    sinks.write_partitions(first, path, ["date"])
    sinks.write_partitions(ud.where(F.col("date") >= dt.date(2024, 1, 10)), path, ["date"])
    back = spark.read.parquet(path).select(*ud.columns)
    assert back.count() == ud.count()
    assert back.exceptAll(ud).count() == 0


def _csv(spark, *lines):
    path = scratch_path(spark, "t-csv")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_csv_columns_go_by_name(spark):
    path = _csv(spark, "user_id,action_type,timestamp,extra,duration_ms",
                "u1,edit,2024-01-01 10:00:00,x,120", "u2,share,,y,")
    df = readers.read_interactions(spark, path)
    assert df.columns == ["user_id", "timestamp", "action_type", "duration_ms", "extra"]
    r = df.where("user_id = 'u1'").collect()[0]
    assert (r.timestamp, r.action_type, r.duration_ms, r.extra) == (dt.datetime(2024, 1, 1, 10), "edit", 120, "x")
    issues = {(i.column_name, i.issue) for i in quality.schema_issues(spark, df, INTERACTIONS).collect()}
    assert issues == {("page_id", "missing"), ("app_version", "missing"), ("extra", "extra")}


def test_csv_files_with_another_header_fail_instead_of_shifting(spark):
    path = _csv(spark, "user_id,action_type", "u1,edit")
    spark.createDataFrame([("action_type,user_id",), ("edit,u2",)], "value string").coalesce(1) \
        .write.mode("append").text(path)
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_interactions(spark, path).collect()


def test_partitioned_writes_do_not_multiply_files(spark):
    """Files follow the data, not tasks x partition values."""
    ev = spark.read.parquet(f"{SF001}/events.parquet").repartition(32)
    days = ev.select(F.to_date("ts")).distinct().count()
    path = scratch_path(spark, "t-files")
    sinks.write_layout(ev, path, "date", "ts", "user_id")
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert days <= files <= 2 * days  # 32 tasks x 30 days before
    sinks.write_partitions(ev.withColumn("date", F.to_date("ts")), path, ["date"])
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() <= 2 * days


def test_readers_leave_the_session_zone_alone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
    try:
        readers.read_interactions(spark, _csv(spark, "user_id", "u"))
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Kathmandu"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def there(path):
    return os.path.exists(path.removeprefix("file:"))


def test_scratch_scope_removes_what_was_made_inside(spark):
    outer = scratch_path(spark, "kept")
    with scratch_scope(spark):
        with scratch_scope(spark):
            inner = scratch_path(spark, "inner")
            spark.range(5).write.parquet(inner)
        first = scratch_path(spark, "first")
        spark.range(7).write.parquet(first)
        assert not there(inner) and spark.read.parquet(first).count() == 7
        spark.read.parquet(first).write.parquet(outer)
        scratch_path(spark, "never_written")
    assert not there(first) and spark.read.parquet(outer).count() == 7
    with pytest.raises(RuntimeError), scratch_scope(spark):
        spark.range(1).write.parquet(inner)
        bad = scratch_path(spark, "bad")
        spark.range(1).write.parquet(bad)
        raise RuntimeError
    assert not there(bad) and there(inner)  # only folders named inside
    remove_scratch(spark, outer)
    remove_scratch(spark, inner)
    assert not there(outer)
    for path in ("/tmp/other", outer.replace("/tidemark/", "/")):
        with pytest.raises(ValueError):
            remove_scratch(spark, path)
