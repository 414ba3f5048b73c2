"""Property tests against brute-force Python definitions."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import activity, diff
from tidemark.schemas import EVENTS_TABLE_COLS as EV

_day0 = dt.date(2024, 1, 1)
_settings = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@_settings
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 70)), min_size=1, max_size=60),
       st.sampled_from([1, 3, 7, 30]))
def test_rolling_distinct_matches_brute_force(spark, visits, window):
    rows = [(i, u, dt.datetime.combine(_day0 + dt.timedelta(days=d), dt.time(12)))
            for i, (u, d) in enumerate(visits)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    got = {r.date: r[1] for r in activity.rolling_active_users(df, window, EV).collect()}
    days = {_day0 + dt.timedelta(days=d) for _, d in visits}
    want = {day: len({u for u, d in visits
                      if 0 <= (day - (_day0 + dt.timedelta(days=d))).days < window})
            for day in days}
    assert got == want


@_settings
@given(st.lists(st.sampled_from(["a", "b", "c", None]), max_size=12),
       st.lists(st.sampled_from(["a", "b", "c", None]), max_size=12))
def test_diff_matches_counter(spark, left, right):
    lf = spark.createDataFrame([(x,) for x in left], "x string")
    rf = spark.createDataFrame([(x,) for x in right], "x string")
    got = Counter({(r.x, r.side): r.copies for r in diff.diff_rows(lf, rf, bag=True).collect()})
    cl, cr = Counter(left), Counter(right)
    want = Counter({(k, "left_only"): n for k, n in (cl - cr).items()})
    want.update({(k, "right_only"): n for k, n in (cr - cl).items()})
    assert got == want
    got_set = {(r.x, r.side) for r in diff.diff_rows(lf, rf, bag=False).collect()}
    want_set = ({(k, "left_only") for k in set(left) - set(right)}
                | {(k, "right_only") for k in set(right) - set(left)})
    assert got_set == want_set
