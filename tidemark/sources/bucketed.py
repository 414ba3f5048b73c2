"""Tables bucketed and sorted by user, so that work per user needs no shuffle.

Rows are dealt to ``buckets`` files by the hash of the user, sorted by user and
time. Group-bys, windows and joins on the user then run on the files as they
lie: Spark sees the bucketing in the catalog and plans no exchange.

A bucket holds its users whole, so a user with a third of all rows would make
one bucket, and one task, of a third of the table. Such users (more than an
even bucket's share, found by one narrow pass) go to a second, unbucketed
table whose files follow the data's size; work on it is planned with an
exchange by user *and* time slot, which spreads them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import hot_key_salts
from tidemark.session import scratch_path


def save_bucketed(df: DataFrame, user: str, buckets: int, sort: list[str], path: str, name: str) -> DataFrame:
    """One file per bucket: rows are dealt with the bucketing's own hash first."""
    (df.repartition(buckets, user).write.mode("overwrite").bucketBy(buckets, user).sortBy(user, *sort)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


@dataclass(frozen=True)
class UserTable:
    """``usual``: bucketed rows; ``hot``: rows of users with more than an even
    bucket's share, and rows without user; ``hot_users``: these users."""
    usual: DataFrame
    hot: DataFrame
    hot_users: DataFrame

    def per_user(self, fn) -> DataFrame:
        """``fn`` on both parts; right for results that depend on one user's
        rows alone."""
        return fn(self.usual).unionByName(fn(self.hot))


def write_user_table(df: DataFrame, user: str, buckets: int, sort: list[str], path: str | None = None) -> UserTable:
    """Store ``df`` under ``path`` (default: the shared scratch folder) and
    register its tables with the session under names of their own."""
    spark: SparkSession = df.sparkSession
    path = path or scratch_path(spark, "user-table")
    hot_path, users_path = f"{path}/hot", f"{path}/hot_users"
    hot_key_salts(df, user, buckets).select(user).write.mode("overwrite").parquet(users_path)
    hot_users = spark.read.schema(df.select(user).schema).parquet(users_path)
    known = F.broadcast(hot_users.withColumn("_hot", F.lit(True)))  # at most one row per bucket
    flagged = df.join(known, user, "left").withColumn("_hot", F.coalesce("_hot", F.col(user).isNull()))
    usual = save_bucketed(flagged.where(~F.col("_hot")).drop("_hot"), user, buckets, sort, f"{path}/usual",
                          f"user_table_{uuid.uuid4().hex[:12]}")
    flagged.where("_hot").drop("_hot").hint("rebalance").write.mode("overwrite").parquet(hot_path)
    return UserTable(usual, spark.read.schema(usual.schema).parquet(hot_path), hot_users)
