"""Plan properties: pushdown, pruning, join strategies, no Python in the
hot path, and no per-user window over raw events in the session plan."""

import pytest

from tidemark.plans.catalog import QUERIES
from tests.conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf(spark, name):
    p = plan(QUERIES[name](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas", "PythonUDF"):
        assert node not in p, f"{name} runs Python: {node}"


def test_start_filter_pushed(spark):
    p = plan(QUERIES["dau_since"](spark, SF001))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


def test_partition_pruning(spark):
    p = plan(QUERIES["pruned_range"](spark, SF001))
    assert "PartitionFilters: [isnotnull(date" in p
    assert "date#" in p and ">= 2024-01-05" in p


def test_sessions_scan_pruned_and_bucketed(spark):
    p = plan(QUERIES["sessions_midnight"](spark, SF001))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p
    # the only window runs over the bucket table; events are aggregated first
    assert "partial_count(1)" in p and "partial_min(ts" in p


def test_join_strategies(spark):
    assert "BroadcastHashJoin" in plan(QUERIES["enrich_broadcast"](spark, SF001))
    assert "ShuffledHashJoin" in plan(QUERIES["enrich_shuffle_hash"](spark, SF001))
    assert "SortMergeJoin" in plan(QUERIES["enrich_merge"](spark, SF001))


def test_iqr_bounds_are_a_subquery(spark):
    p = plan(QUERIES["sessions_clean"](spark, SF001))
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_salted_join_shuffles_on_salt(spark):
    from tidemark.plans.catalog import QUERIES as Q
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = Q["enrich_salted"](spark, SF001)
        df.write.format("noop").mode("overwrite").save()
        p = plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        if old_aqe is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old_aqe)
    assert "SortMergeJoin [user_id#" in p and "_salt#" in p.split("SortMergeJoin")[1][:200]
    # the hot-key list is broadcast: no more keys than tasks
    assert "BroadcastHashJoin" in p


def test_broadcast_goes_by_bytes_in_memory(spark):
    from tidemark.operators import enrich
    facts = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(50).withColumnRenamed("id", "k")
    size = enrich.memory_bytes(dim)
    ok = enrich.enrich(facts, dim, "k", strategy="broadcast", max_broadcast_bytes=size)
    too_big = enrich.enrich(facts, dim, "k", strategy="broadcast", max_broadcast_bytes=size - 1)
    assert "broadcast" in ok._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in too_big._jdf.queryExecution().logical().toString().lower()


def test_event_level_sessions_order_one_second_at_a_time(spark):
    p = plan(QUERIES["session_events_midnight"](spark, SF001))
    windows = [x for x in p.splitlines() if "Window [lag(ts" in x]
    assert windows and all("_sec#" in x for x in windows)  # never a whole user or bucket of raw events


def test_no_percentile_sketch(spark):
    for name in ("iqr_bounds", "session_summary", "event_value_capped", "sessions_removed"):
        p = plan(QUERIES[name](spark, SF001))
        assert "percentile" not in p and "CartesianProduct" not in p
