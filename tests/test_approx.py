"""Approximate operators against their exact twins (tolerance tests)."""

from pyspark.sql import functions as F

from tidemark.operators import activity
from tidemark.schemas import EVENTS_TABLE_COLS as EV
from tests.conftest import SF001


def _rel_err(spark, approx, exact, a_col, e_col):
    j = approx.join(exact, "date")
    assert j.count() == exact.count() == approx.count()
    return j.agg(F.max(F.abs(F.col(a_col) - F.col(e_col)) / F.col(e_col))).collect()[0][0]


def test_approx_dau_within_tolerance(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    approx = activity.daily_active(ev, cols=EV, approx=True).withColumnRenamed(
        "daily_active_users", "a")
    exact = activity.daily_active(ev, cols=EV)
    # rsd 0.05; the worst of 30 days stays well inside 3 standard errors
    assert _rel_err(spark, approx, exact, "a", "daily_active_users") <= 0.15


def test_hll_rolling_within_tolerance(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    approx = activity.rolling_active_users_approx(ev, 30, EV)
    exact = activity.rolling_active_users(ev, 30, EV)
    # lg_k 12: relative standard error about 1.6 %
    assert _rel_err(spark, approx, exact, "approx_active_users_30d", "active_users_30d") <= 0.06
