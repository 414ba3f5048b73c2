"""Synthetic interactions and metadata as a Spark job.

Every value is a function of the row id, a seed and the column name
(``md5`` -> first 8 hex digits -> integer -> modulo the domain), so the
result does not depend on partitioning or task retries, scales with the
id frame it is given (``spark.range(n)`` or ids of a real table), and an
SQL engine can recompute it exactly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import date_literal, ts_literal
from tidemark.schemas import INTERACTION_ACTIONS as ACTION_TYPES

# Generator domains of the task statement.
COUNTRIES = ("US", "UK", "CA", "AU", "DE", "FR", "JP", "IN", "BR", "MX")
DEVICE_TYPES = ("iPhone", "iPad", "Android Phone", "Android Tablet", "Windows", "Mac")
SUBSCRIPTION_TYPES = ("free", "basic", "premium", "enterprise")
USER_IDS = 1_000_000          # u000001 .. u1000000
PAGE_IDS = 1_000_000          # p000001 .. p1000000
TS_START = dt.datetime(2023, 1, 1)
TS_END = dt.datetime(2025, 1, 13)
DURATION_MS = (100, 300_000)
APP_MAJOR = (5, 7)
JOIN_START = dt.date(2020, 1, 1)
JOIN_END = dt.date(2025, 1, 10)


def hash_int(id_col: str, seed: int, name: str) -> Column:
    """Uniform integer in [0, 2^32) from (id, seed, column name)."""
    key = F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed)), F.lit(name))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def _pick(values, h: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]),
                        (h % F.lit(len(values)) + 1).cast("int"))


def _between(h: Column, lo: int, hi: int) -> Column:
    return F.lit(lo) + h % F.lit(hi - lo + 1)


def interactions(ids: DataFrame, id_col: str = "id", seed: int = 42,
                 hot_share: float = 0.0) -> DataFrame:
    """One interaction per id: the task's interaction columns (timestamp as
    ``timestamp_ntz``, UTC wall clock).

    ``hot_share`` gives that fraction of rows to the single user
    ``u000001`` (skewed-key scenario); 0 keeps the uniform draw.
    """
    span = int((TS_END - TS_START).total_seconds())
    h = lambda n: hash_int(id_col, seed, n)
    ts = (ts_literal(TS_START)
          + F.make_dt_interval(secs=_between(h("timestamp"), 0, span).cast("decimal(18,6)")))
    user = F.format_string("u%06d", _between(h("user_id"), 1, USER_IDS))
    if hot_share > 0:
        cut = int(hot_share * 1_000_000)
        user = F.when(h("hot") % 1_000_000 < cut, F.lit("u000001")).otherwise(user)
    return ids.select(
        F.col(id_col).alias("id"),
        user.alias("user_id"),
        ts.alias("timestamp"),
        _pick(ACTION_TYPES, h("action_type")).alias("action_type"),
        F.format_string("p%06d", _between(h("page_id"), 1, PAGE_IDS)).alias("page_id"),
        _between(h("duration_ms"), *DURATION_MS).alias("duration_ms"),
        F.concat_ws(".", _between(h("app_major"), *APP_MAJOR).cast("string"),
                    (h("app_minor") % 10).cast("string"),
                    (h("app_patch") % 10).cast("string")).alias("app_version"))


def metadata(ids: DataFrame, id_col: str = "id", seed: int = 42) -> DataFrame:
    """One metadata row per id; user ids are drawn, so duplicates occur."""
    days = (JOIN_END - JOIN_START).days
    h = lambda n: hash_int(id_col, seed, n)
    return ids.select(
        F.col(id_col).alias("id"),
        F.format_string("u%06d", _between(h("user_id"), 1, USER_IDS)).alias("user_id"),
        F.date_add(date_literal(JOIN_START), _between(h("join_date"), 0, days).cast("int"))
        .alias("join_date"),
        _pick(COUNTRIES, h("country")).alias("country"),
        _pick(DEVICE_TYPES, h("device_type")).alias("device_type"),
        _pick(SUBSCRIPTION_TYPES, h("subscription_type")).alias("subscription_type"))
