"""As-of joins, overlap, grouping sets, user sets, retention, stored state and
properties against plain versions, with odd rows; plan properties."""

import bisect
import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from tests.test_plans import plan
from tidemark.operators import (
    asof, grouping, heavy, intervals, props, quantile_state, retention, session_store, sessions, user_sets,
)
from tidemark.operators import partitioning as part
from tidemark.plans.catalog import EV, QUERIES
from tidemark.schemas import EVENTS
from tidemark.session import scratch_path
from tidemark.sources import bucketed, clustered
from tidemark.streaming import stateful

T0 = dt.datetime(2024, 3, 1)


def at(seconds):
    return T0 + dt.timedelta(microseconds=round(seconds * 1e6))


def collected(df, key=repr):
    return sorted(map(tuple, df.collect()), key=key)


# ---------------------------------------------------------------- as-of join

EVENT_SCHEMA = "id long, k string, ts timestamp_ntz"
VERSION_SCHEMA = "k string, valid_from timestamp_ntz, grade int, name string"


def asof_brute(events, versions):
    per = defaultdict(dict)
    for k, t, *attributes in versions:
        if k is not None and t is not None:
            old = per[k].get(t)
            rank = [(a is not None, a) for a in attributes]
            if old is None or rank > [(a is not None, a) for a in old]:
                per[k][t] = attributes
    out = []
    for i, k, t in events:
        times = sorted(per.get(k, ())) if k is not None and t is not None else []
        n = bisect.bisect_right(times, t) if times else 0
        out.append((i, k, t, *((times[n - 1], *per[k][times[n - 1]]) if n else (None, None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slot", [1, 60, 3600, 86400])
def test_asof_matches_brute_force(spark, slot):
    rnd = random.Random(slot)

    def when():
        return rnd.choice([at(rnd.randint(-5, 40)), at(rnd.random() * 200_000), at(rnd.randint(0, 50) * 3600)])
    events = [(i, rnd.choice(["hot", "hot", "a", "b", "c", None]), rnd.choice([None, *[when() for _ in range(9)]]))
              for i in range(600)]
    versions = [(rnd.choice(["hot", "a", "b", None]), rnd.choice([None, *[when() for _ in range(9)]]),
                 rnd.choice([None, 1, 2, 3]), rnd.choice("xyz")) for _ in range(150)]
    versions += versions[:40] + [("a", t, 9, "tie") for _, _, t in events[:20] if t]
    got = asof.asof_join(spark.createDataFrame(events, EVENT_SCHEMA), spark.createDataFrame(versions, VERSION_SCHEMA),
                         "k", "ts", ["grade", "name"], slot_seconds=slot)
    assert collected(got) == asof_brute(events, versions)


def test_asof_odd_tables(spark):
    ev = spark.createDataFrame([(1, "a", at(0)), (1, "a", at(0)), (2, None, at(1))], EVENT_SCHEMA)
    none = spark.createDataFrame([], VERSION_SCHEMA)
    assert [r.grade for r in asof.asof_join(ev, none, "k", "ts", ["grade"]).collect()] == [None] * 3
    assert asof.asof_join(ev.limit(0), none, "k", "ts", ["grade"]).collect() == []
    with pytest.raises(ValueError):
        asof.asof_join(ev.withColumn("grade", F.lit(1)), none, "k", "ts", ["grade"])


def test_asof_plan_orders_events_within_slots_only(spark):
    p = plan(QUERIES["asof_orders"](spark, SF001))
    windows = [line for line in p.splitlines() if " Window [" in line]
    assert len(windows) == 2 and any("_key" in w and "_slot" in w and "_event" in w for w in windows)
    # the narrow pass reads two columns, the wide one is dealt by key and slot
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p
    assert "SortMergeJoin" not in p and "CartesianProduct" not in p


# ---------------------------------------------------------------- interval overlap

def overlap_brute(rows, width):
    """Second by second."""
    open_at = Counter()
    for a, b in rows:
        if a is not None and b is not None and a <= b:
            for s in range(int((a - T0).total_seconds() // 1), int((b - T0).total_seconds() // 1) + 1):
                open_at[s] += 1
    blocks = defaultdict(list)
    for s, n in open_at.items():
        blocks[s // width].append(n)
    return sorted((T0 + dt.timedelta(seconds=k * width), max(v), sum(v) / width, sum(v)) for k, v in blocks.items())


@pytest.mark.parametrize("width", [60, 600])
def test_overlap_matches_brute_force(spark, width):
    rnd = random.Random(width)
    rows = [(at(0), at(0)), (at(59.5), at(60)), (at(60), at(59)), (None, at(3)), (at(3), None), (at(10_000), at(25_000)),
            (at(600), at(1199)), (at(600), at(1200))] + [(at(0), at(119))] * 30
    for _ in range(150):
        a = rnd.random() * 5000
        rows.append((at(a), at(a + rnd.choice([0, 0.4, 30, 600, 1700]) * rnd.random())))
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = intervals.overlap_by_block(df, "a", "b", width).withColumn("block_start", F.col("block_start").cast("timestamp_ntz"))
    assert collected(got, lambda r: r[0]) == overlap_brute(rows, width)
    assert intervals.overlap_by_block(df.limit(0), "a", "b", width).collect() == []


def test_overlap_window_over_seconds_is_partitioned(spark):
    p = plan(QUERIES["concurrent_sessions_hour"](spark, SF001))
    for line in p.splitlines():
        if " Window [" in line and "sec#" in line:
            assert "block#" in line  # never one window over all seconds
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


# ---------------------------------------------------------------- grouping sets

def test_cube_equals_the_plain_cube_with_nulls(spark):
    rnd = random.Random(3)
    rows = [(i, at(rnd.randint(0, 5) * 86400 + 5) if rnd.random() < 0.95 else None, rnd.choice([None, *range(12)]), "v",
             rnd.choice([None, 1.0, 2.0]), None) for i in range(400)]
    ev = spark.createDataFrame(rows, EVENTS)
    users = spark.createDataFrame([(u, rnd.choice([None, "x", "y"]), rnd.choice([None, "p", "q"])) for u in range(9)],
                                  "user_id long, country string, segment string")
    plain = ev.join(users, "user_id", "left").withColumn("date", F.to_date("ts"))
    for kind, sets in (("cube", plain.cube("date", "country", "segment")),
                       ("rollup", plain.rollup("date", "country", "segment"))):
        want = sets.agg(F.grouping_id().alias("grouping_id"), F.count(F.lit(1)).alias("events"),
                        F.countDistinct("user_id").alias("users"), F.sum("value").alias("total_measure"))
        got = grouping.activity_cube(ev, users, ["country", "segment"], EV, kind)
        assert collected(got) == collected(want.select(got.columns))


def test_cube_plan_has_no_distinct_over_events(spark):
    p = plan(QUERIES["activity_cube"](spark, SF001))
    assert "distinct" not in p.lower()
    assert p.count("FileScan parquet [ts#") == 1  # the events, reduced before both expansions


# ---------------------------------------------------------------- user sets

def test_user_numbers_are_dense_and_stay(spark):
    path = scratch_path(spark, "numbers")
    first = spark.createDataFrame([("u%d" % (i % 700),) for i in range(2000)] + [(None,)], "u string")
    one = dict(user_sets.extend_user_numbers(spark, path, first, "u", "d1", blocks=16).collect())
    assert sorted(one.values()) == list(range(1, 701)) and None not in one
    second = first.union(spark.createDataFrame([("n%d" % i,) for i in range(50)], "u string"))
    for _ in range(2):  # running a batch again replaces it
        two = dict(user_sets.extend_user_numbers(spark, path, second, "u", "d2", blocks=16).collect())
        assert sorted(two.values()) == list(range(1, 751)) and all(two[u] == n for u, n in one.items())
    assert user_sets.extend_user_numbers(spark, scratch_path(spark, "none"), first.limit(0), "u").collect() == []


def test_sets_count_unite_and_intersect(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 90_000), dt.date(2024, 3, rnd.randint(1, 9)), rnd.choice(["a", "b", None]))
            for _ in range(4000)]
    days = spark.createDataFrame(rows, "u long, date date, seg string")
    sets = user_sets.user_set_table(days, user_sets.number_users(days, "u", blocks=8), ["date", "seg"], "u")
    path = scratch_path(spark, "sets")
    user_sets.write_user_sets(sets, path)
    user_sets.write_user_sets(sets.where("date = date'2024-03-02'"), path)  # again: no second copy
    stored = spark.read.parquet(path)

    def brute(group, keep=lambda r: True):
        out = defaultdict(set)
        for r in rows:
            if keep(r):
                out[group(r)].add(r[0])
        return out
    got = user_sets.count_users(user_sets.united(stored, ["seg"]), ["seg"])
    assert dict(got.collect()) == {k: len(v) for k, v in brute(lambda r: r[2]).items()}
    both = user_sets.common(stored.where("seg in ('a', 'b')"), [], "seg", 2)
    b = brute(lambda r: r[2])
    assert user_sets.count_users(both, []).first()[0] == len(b["a"] & b["b"])
    rolled = dict(user_sets.rolling_users(stored, 3).collect())
    for day, n in rolled.items():
        assert n == len(set().union(*brute(lambda r: 0, lambda r: 0 <= (day - r[1]).days < 3).values()))
    assert stored.agg(F.max(F.length("users"))).first()[0] == 4096


def test_bitmap_plan_reads_the_sets_alone(spark):
    p = plan(QUERIES["bitmap_week_segment"](spark, SF001))
    assert p.count("FileScan") == 1 and "sets" in p and "events.parquet" not in p


# ---------------------------------------------------------------- retention

def retention_brute(rows):
    per = defaultdict(set)
    for u, p in rows:
        if u is not None and p is not None:
            per[p].add(u)
    order, out = sorted(per), []
    for i, p in enumerate(order):
        before = per[order[i - 1]] if i else set()
        out.append((p, len(per[p] & before), len(per[p] - before), len(before - per[p])))
    return out


def test_retention_with_gaps_and_nulls(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, 1, 2, 5, 6, 9])) for _ in range(300)] + [(99, 9), (99, 1)]
    df = spark.createDataFrame(rows, "user_id int, p int")
    assert collected(retention.retention_exact(df, F.col("p"))) == retention_brute(rows)
    near = retention.retention_sketch(retention.period_sketches(df, F.col("p"))).drop("either")
    assert collected(near) == retention_brute(rows)  # fewer users than the sketch holds: exact


def test_retention_sketch_within_its_error(spark):
    df = spark.range(120_000).select(F.explode(F.array(
        F.struct(F.lit(1).alias("p"), F.col("id").alias("u")),
        F.struct(F.lit(2).alias("p"), (F.col("id") + 40_000).alias("u")))).alias("x")).select("x.*")
    r = retention.retention_sketch(retention.period_sketches(df, F.col("p"), "u")).where("period = 2").first()
    allowed = 3 * 160_000 / 2 ** (retention.LG_NOMINAL / 2)
    assert abs(r.kept - 80_000) < allowed and abs(r.new - 40_000) < allowed and abs(r.lost - 40_000) < allowed
    assert r.kept != 80_000  # sketched, not exact


# ---------------------------------------------------------------- quantile state

@pytest.mark.parametrize("margin", [0.01, 0.0])
def test_quantiles_of_any_days(spark, margin, monkeypatch):
    monkeypatch.setattr(quantile_state, "MARGIN", margin)  # without margin the sketch misses the rank at times
    rnd = random.Random(7)
    rows = []
    for i in range(6000):
        x = rnd.choice([rnd.gauss(0, 1), rnd.expovariate(1e-3), 5.0, float(rnd.randint(-3, 3)), None, float("nan")])
        rows.append((at(rnd.randint(0, 6) * 86400), x, rnd.choice([float("inf"), float("-inf"), 1.0]) if i % 9 == 0 else 2.0))
    rows.append((None, 1.0, 1.0))
    df = spark.createDataFrame(rows, "ts timestamp_ntz, x double, y double")
    path = scratch_path(spark, "qstate")
    quantile_state.write_days(df.where("day(ts) <= 3"), path, "ts", ["x", "y"])
    quantile_state.write_days(df.where("day(ts) >= 3"), path, "ts", ["x", "y"])  # the third again
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for lo, hi in ((1, 7), (2, 4), (5, 5)):
        got = {(r.measure, r.p): r.value for r in quantile_state.quantiles(
            spark, path, probs, dt.date(2024, 3, lo), dt.date(2024, 3, hi)).collect()}
        for j, name in ((1, "x"), (2, "y")):
            v = sorted(r[j] for r in rows if r[0] and lo <= r[0].day <= hi and r[j] is not None and r[j] == r[j])
            for p in probs:
                k = max(1, -int(-(p * len(v)) // 1))
                assert got[name, p] == v[k - 1], (name, p)
    assert quantile_state.quantiles(spark, path, [0.5], dt.date(2025, 1, 1)).collect() == []


def test_outlier_bounds_read_the_input_once(spark):
    p = plan(QUERIES["event_value_capped"](spark, SF001))
    assert p.count("FileScan parquet") == 1  # the counted values are stored, one read is left for the output


# ---------------------------------------------------------------- heavy hitters

@pytest.mark.parametrize("counters,listed", [(65536, None), (64, 20), (16, 16)])
def test_top_keys_are_exact(spark, counters, listed):
    rnd = random.Random(counters)
    keys = [None] * 40 + [f"h{i}" for i in range(6) for _ in range(300 - 20 * (i // 2))]
    keys += [f"k{rnd.randint(0, 900)}" for _ in range(3000)]
    rnd.shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(6)
    for k in (3, 6, 10):  # the last one lies in the flat part: every key is counted
        want = sorted(((x, n, n / len(keys)) for x, n in Counter(x for x in keys if x).items()), key=lambda r: (-r[1], r[0]))
        got = list(map(tuple, heavy.top_keys(df, "k", k, counters, listed).collect()))
        assert got == want[:k]
    few = df.where("k in ('h0', 'h1')")
    assert [r.k for r in heavy.top_keys(few, "k", 5, counters, listed).collect()] == ["h0", "h1"]
    assert heavy.top_keys(df.limit(0), "k", 5, counters, listed).collect() == []


# ---------------------------------------------------------------- incremental sessions

def test_stored_days_equal_the_batch_in_any_order(spark):
    rnd = random.Random(9)
    rows, n = [], 0
    for u in (1, 2, 3, None):
        t = 0.0
        for _ in range(250):
            t += rnd.choice([1, 60, 1790, 1800, 1801, 4000, 90_000]) + rnd.random()
            rows.append((n, at(t), u, "v", 1.0, None))
            n += 1
    rows.append((n, None, 1, "v", 1.0, None))
    ev = spark.createDataFrame(rows, EVENTS)
    days = sorted({r[1].date() for r in rows if r[1]})
    parts = [days[i::5] for i in range(5)]
    rnd.shuffle(parts)
    path = scratch_path(spark, "pieces")
    for part in [*parts, parts[1]]:
        session_store.write_days(ev.where(F.to_date("ts").isin(part)), path, 30, EV)
    for midnight in (False, True):
        want = sessions.sessions(ev, 30, midnight, EV)
        assert collected(session_store.read_sessions(spark, path, 30, midnight, EV)) == collected(want)
    longest = sessions.sessions(ev, 30, False, EV).agg(F.max(F.datediff("session_end", "session_start"))).first()[0]
    assert longest >= 1


def test_a_day_run_again_with_other_events_replaces_it(spark):
    ev = spark.createDataFrame([(i, at(86400 * 0.99 + 100 * i), 1, "v", 1.0, None) for i in range(20)], EVENTS)
    path = scratch_path(spark, "pieces")
    session_store.write_days(ev, path, 30, EV)
    assert session_store.read_sessions(spark, path, 30, False, EV).count() == 1
    session_store.write_days(ev.where("event_id = 19"), path, 30, EV)  # the second day shrinks to its last event
    got = collected(session_store.read_sessions(spark, path, 30, False, EV))
    left = ev.where((F.to_date("ts") == F.lit(dt.date(2024, 3, 1))) | (F.col("event_id") == 19))
    assert got == collected(sessions.sessions(left, 30, False, EV))


# ---------------------------------------------------------------- properties

def test_property_profile_of_odd_json(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": 2.5}', '{"a": -3}', '{"a": null}', '{"a": [1]}', '{"a": {"c": 1}}', "[1]", "7",
             '"s"', "null", "{", "", None, "{}", '{"a": true}', '{"a": 1e300}']
    df = spark.createDataFrame([("g", t) for t in texts], "g string, text string")
    got = {(r.property, r.type): (r.rows, r.lowest, r.highest) for r in props.property_profile(df, "text", ["g"]).collect()}
    assert got["a", "BIGINT"] == (2, -3.0, 1.0) and got["b", "STRING"] == (1, None, None)
    assert got["a", "DOUBLE"] == (2, 2.5, 1e300)
    assert got["a", "VOID"][0] == got["a", "ARRAY"][0] == got["a", "OBJECT"][0] == got["a", "BOOLEAN"][0] == 1
    assert got[None, "MALFORMED"][0] == 2 and got[None, "NULL"][0] == 1 and got[None, "ARRAY"][0] == 1
    good, bad = props.split_malformed(df, "text")
    assert sorted(r.text for r in bad.collect()) == ["", "{"] and good.count() == len(texts) - 2
    assert "a" in props.merged_schema(df.limit(2), "text").first()[0]


# ---------------------------------------------------------------- layouts

def test_bucketed_plans_have_no_exchange(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        ev = spark.read.parquet(f"{SF001}/events.parquet")
        t = bucketed.write_user_table(ev, "user_id", 8, ["ts"])
        assert "Exchange" not in plan(sessions.sessions(t.usual, 30, True, EV))
        dim = bucketed.save_bucketed(ev.groupBy("user_id").agg(F.max("value").alias("top")), "user_id", 8, [],
                                     scratch_path(spark, "dim"), "dim_" + scratch_path(spark, "x").rsplit("-", 1)[-1])
        p = plan(t.usual.join(dim.hint("merge"), "user_id"))
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert t.usual.count() + t.hot.count() == ev.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_users_leave_the_bucketed_table(spark):
    rows = [(i, at(i), 7 if i % 3 else i, "v", 1.0, None) for i in range(3000)] + [(9000, at(1), None, "v", 1.0, None)]
    ev = spark.createDataFrame(rows, EVENTS)
    t = bucketed.write_user_table(ev, "user_id", 8, ["ts"])
    assert [r.user_id for r in t.hot_users.collect()] == [7]
    assert {r.user_id for r in t.hot.select("user_id").distinct().collect()} == {7, None}
    assert t.usual.where("user_id = 7 or user_id is null").count() == 0
    want = sessions.sessions(ev, 30, True, EV)
    assert collected(t.per_user(lambda x: sessions.sessions(x, 30, True, EV))) == collected(want)


def test_salted_repartition_cuts_hot_users(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("u"))
    df = df.unionByName(spark.range(3000).select("id", F.lit(None).cast("long").alias("u")))
    for method in ("hash", "range"):
        out = part.partition_by_user(df, "u", 16, method, salt_col="id")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 12_000 and max(sizes) < 4000  # whole, user 7 alone would be 6,000 rows in one task
        assert collected(out.groupBy("u").count()) == collected(df.groupBy("u").count())


def test_clustered_layout_skips_row_groups_for_either_column(spark):
    import glob

    import pyarrow.parquet as pq
    ev = spark.range(40_000).select(
        F.col("id"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 64).cast("int")).alias("day"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("user"))
    ev = ev.unionByName(spark.createDataFrame([(-1, None, None)], ev.schema))
    path = scratch_path(spark, "curve")
    clustered.write_clustered(ev, path, ["day", "user"], 64, bloom=["user"])
    groups = []
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            s = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(3)}
            groups.append((meta.row_group(g).num_rows, s["day"].min, s["day"].max, s["user"].min, s["user"].max))
    rows = sum(g[0] for g in groups)
    day, user = dt.date(2024, 1, 20), 500
    by_day = sum(n for n, lo, hi, _, _ in groups if lo is not None and lo <= day <= hi)
    by_user = sum(n for n, _, _, lo, hi in groups if lo is not None and lo <= user <= hi)
    assert rows == 40_001 and by_day < rows / 3 and by_user < rows / 3
    back = spark.read.parquet(path)
    assert collected(back) == collected(ev)
    assert "PushedFilters: [IsNotNull(user), EqualTo(user,500)]" in plan(back.where("user = 500"))


def test_clustered_layout_of_strings(spark):
    ev = spark.range(500).select(F.concat(F.lit("u"), "id").alias("u"), (F.col("id") / 7).alias("x"))
    path = scratch_path(spark, "curve")
    clustered.write_clustered(ev, path, ["u", "x"], 4, bits=3)
    assert collected(spark.read.parquet(path)) == collected(ev)


# ---------------------------------------------------------------- reads, defaults

def test_event_sessions_read_the_events_twice(spark):
    df = QUERIES["session_events_midnight"](spark, SF001)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2 and "ReusedExchange" in final


def test_all_session_outputs_read_one_stored_table(spark):
    from tidemark.plans import reports
    out = reports.session_metrics(spark.read.parquet(f"{SF001}/events.parquet"), cols=EV)
    assert len(out) == 5
    for df in out.values():
        assert "FileScan" not in plan(df)  # the checkpoint, not the events


def test_future_records_against_the_current_time(spark):
    from tidemark.operators import quality
    now = spark.sql("select current_timestamp() as t")
    df = now.select(F.explode(F.array(
        F.col("t") - F.expr("interval 1 day"), F.col("t") + F.expr("interval 1 day"),
        F.col("t") + F.expr("interval 1 hour"), F.lit(None).cast("timestamp"))).alias("ts"))
    assert quality.future_records(df, "ts").first()[0] == 2
    assert quality.future_records(df.select(F.col("ts").cast("timestamp_ntz").alias("ts")), "ts").first()[0] == 2


def test_memory_bytes_count_strings_as_they_are(spark):
    from tidemark.operators import enrich
    df = spark.range(1000).select("id", F.lit("x" * 1000).alias("s"))
    path = scratch_path(spark, "wide")
    df.write.parquet(path)  # a few KB on disk
    assert enrich.memory_bytes(spark.read.parquet(path)) >= 1_000_000
    assert enrich.memory_bytes(df.limit(0)) == 0


# ---------------------------------------------------------------- stateful streams

def test_arrivals_are_unique_late_or_unplaced(spark):
    path = scratch_path(spark, "stream")
    batches = [
        [(1, at(0)), (1, at(0)), (2, at(100)), (None, at(5)), (3, None)],
        [(2, at(100)), (4, at(300)), (5, at(40)), (5, at(39)), (6, at(40.5))],  # up to 100 - 60 is late
        [(6, at(40.5)), (4, at(300)), (7, at(240.5)), (8, at(240))],
    ]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{path}/files/k{k}")
        schema = spark.createDataFrame([], "id long, ts timestamp_ntz").schema
        for _ in range(2):  # nothing new the second time
            out = stateful.take_in(spark, f"{path}/files", schema, f"{path}/sink", "id", "ts", 60)
    ids = {k: sorted((r.id for r in v.collect()), key=repr) for k, v in out.items()}
    assert ids == {"unique": [1, 2, 4, 6, 7], "late": [5, 5, 6, 8], "unplaced": sorted([None, 3], key=repr)}
