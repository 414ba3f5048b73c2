"""Explicit partitioning and caching.

Only worth it when several user-keyed outputs reuse one layout: once a
persisted frame is hash- or range-partitioned by user, later windows and
group-bys on the user need no further exchange. Persisted blocks lost
with an executor are recomputed from lineage; use
``tidemark.session.materialize`` to cut the lineage instead.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.enrich import hot_key_salts


def partition_by_user(df: DataFrame, user: str = "user_id", n: int | None = None,
                      method: str = "hash", salt_col: str | None = None) -> DataFrame:
    """Rows repartitioned by user, by hash or by range.

    With ``salt_col`` (a column that tells a user's rows apart, as an event
    id) users with more than an even task's share of the rows, and rows
    without user, are cut into slices by its hash, so no task gets a hot
    user's rows whole. One narrow pass measures the shares. Without it all
    rows of a user are in one task, whatever their number.
    """
    if method not in ("hash", "range"):
        raise ValueError(f"unknown method {method!r}")
    keys = [user]
    if salt_col is not None:
        tasks = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = F.broadcast(hot_key_salts(df, user, tasks))  # at most one row per task
        slices = F.when(F.col(user).isNull(), F.lit(tasks)).otherwise(F.coalesce("salts", F.lit(1)))
        df = df.join(salts, user, "left").withColumn("_slice", F.pmod(F.xxhash64(salt_col), slices)).drop("salts")
        keys.append("_slice")
    deal = df.repartition if method == "hash" else df.repartitionByRange
    return (deal(n, *keys) if n else deal(*keys)).drop("_slice")


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """``with persisted(df) as d: ...`` - always paired with unpersist."""
    d = df.persist(level)
    try:
        yield d
    finally:
        d.unpersist()
