"""Exact sets of users as bitmaps, stored per day and segment.

Counting the distinct users of arbitrary days and segments needs the users
again each time, unless the sets themselves are stored. Here every user gets a
dense number, and a set is a bitmap of numbers in buckets of 32,768 (4 KB).
Union and intersection of stored sets are bitwise aggregates, combined
map-side; no event is read again.

Numbers are dealt in two levels: users fall into hash blocks, a running sum
over the blocks' sizes (one row per block) gives each block its offset, and
within a block the user's rank is added. So no task numbers all users. Numbers
are stored and never change: users seen later are appended behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.sinks import write_partitions

BLOCKS = 4096


def number_users(users: DataFrame, user: str = "user_id", first: int = 1, blocks: int = BLOCKS) -> DataFrame:
    """``user, number`` for the distinct users, dense from ``first``; NULL
    users get none. ``blocks`` bounds what one task ranks: users / blocks."""
    known = (users.select(user).where(F.col(user).isNotNull()).distinct()
             .withColumn("_block", F.pmod(F.xxhash64(user), F.lit(int(blocks)))))
    sizes = known.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_block", (F.sum("_n").over(Window.orderBy("_block")) - F.col("_n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_block").orderBy(user))
    return (known.withColumn("_rank", rank).join(F.broadcast(offsets), "_block")  # one row per block
            .select(user, (F.col("_before") + F.col("_rank") + F.lit(int(first) - 1)).alias("number")))


def extend_user_numbers(spark: SparkSession, path: str, users: DataFrame, user: str = "user_id",
                        batch: str = "0", blocks: int = BLOCKS) -> DataFrame:
    """Add the users that the table at ``path`` doesn't know and return the
    whole table. ``batch`` names the folder of this run (a day, say): running
    it again replaces the folder, so numbers of later batches must not exist
    then. Users of earlier batches keep their numbers."""
    schema = f"`{user}` {users.schema[user].dataType.simpleString()}, number bigint"
    # a first, empty folder: the table can be read before any batch has run
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/batch=none")
    table = spark.read.schema(f"{schema}, batch string").parquet(path)
    known = table.where(F.col("batch") != batch)
    first = 1 + known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("m")).first()["m"]
    new = users.select(user).where(F.col(user).isNotNull()).join(known.select(user), user, "left_anti")
    write_partitions(number_users(new, user, first, blocks).withColumn("batch", F.lit(batch)), path, ["batch"])
    return spark.read.schema(f"{schema}, batch string").parquet(path).select(user, "number")


def user_set_table(user_days: DataFrame, numbers: DataFrame, by: list[str], user: str = "user_id") -> DataFrame:
    """``<by>, bucket, users``: one bitmap per value of ``by`` and bucket of
    numbers. ``user_days`` may repeat users; users without number are left out."""
    numbered = user_days.select(user, *by).join(numbers, user)
    return (numbered.groupBy(*by, F.bitmap_bucket_number("number").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users")))


def write_user_sets(sets: DataFrame, path: str, date: str = "date") -> None:
    """Store sets by day; a day written again replaces its old sets."""
    write_partitions(sets, path, [date])


def united(sets: DataFrame, by: list[str]) -> DataFrame:
    """Sets united per value of ``by``."""
    return sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def common(sets: DataFrame, by: list[str], over: str, n: int) -> DataFrame:
    """Users in the sets of all ``n`` values of ``over``, per value of ``by``.
    A bucket that one of them lacks holds no common user."""
    per = united(sets, [*by, over])
    return (per.groupBy(*by, "bucket").agg(F.bitmap_and_agg("users").alias("users"), F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") == n).drop("_n"))


def count_users(sets: DataFrame, by: list[str], name: str = "users") -> DataFrame:
    """``<by>, name``: size of sets that are united already (one bitmap per
    value of ``by`` and bucket)."""
    return sets.groupBy(*by).agg(F.sum(F.bitmap_count("users")).alias(name))


def rolling_users(sets: DataFrame, window_days: int, date: str = "date") -> DataFrame:
    """Exact distinct users of the last ``window_days`` calendar days, for
    each day that has a set: days are united first, then each is lent to the
    windows it belongs to."""
    daily = united(sets, [date])
    days = daily.select(F.col(date).alias("_day")).distinct()
    lent = daily.withColumn("_day", F.explode(F.sequence(F.col(date), F.date_add(date, window_days - 1))))
    kept = lent.join(F.broadcast(days), "_day", "left_semi")  # one row per day
    windows = kept.groupBy(F.col("_day").alias(date), "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return count_users(windows, [date], f"active_users_{window_days}d")
