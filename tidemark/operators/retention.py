"""Users kept, new and lost from one period to the next.

``retention_exact`` counts on distinct (user, period) rows. ``retention_sketch``
stores one theta sketch per period (a few KB to tens of KB, whatever the number
of users) and gets the three numbers by intersection and difference of
neighbouring sketches; HyperLogLog sketches could only be united.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LG_NOMINAL = 12


def retention_exact(events: DataFrame, period: Column, user: str = "user_id") -> DataFrame:
    """``period, kept, new, lost``: users of the period that the one before
    had or had not, and users that it had and this one has not.

    Periods without any user have no row; the one before a period is the
    latest that has users. Rows without user or period are left out.
    """
    active = (events.select(F.col(user).alias("u"), period.alias("period"))
              .where("u is not null and period is not null").distinct())
    order = Window.orderBy("period")  # one row per period
    neighbours = active.select("period").distinct().select(
        "period", F.lag("period").over(order).alias("_before"), F.lead("period").over(order).alias("_next"))
    own = Window.partitionBy("u").orderBy("period")  # one row per period of a user
    rows = (active.withColumn("_last", F.lag("period").over(own)).withColumn("_then", F.lead("period").over(own))
            .join(F.broadcast(neighbours), "period"))
    kept = F.col("_last").eqNullSafe(F.col("_before")) & F.col("_before").isNotNull()
    left = F.col("_next").isNotNull() & ~F.col("_then").eqNullSafe(F.col("_next"))
    counted = rows.select(F.explode(F.array(
        F.struct("period", kept.cast("long").alias("kept"), (~kept).cast("long").alias("new"),
                 F.lit(0).cast("long").alias("lost")),
        F.struct(F.when(left, F.col("_next")).alias("period"), F.lit(0).cast("long").alias("kept"),
                 F.lit(0).cast("long").alias("new"), F.lit(1).cast("long").alias("lost")))).alias("x"))
    return (counted.select("x.*").where("period is not null").groupBy("period")
            .agg(F.sum("kept").alias("kept"), F.sum("new").alias("new"), F.sum("lost").alias("lost")))


def period_sketches(events: DataFrame, period: Column, user: str = "user_id",
                    lg_nominal: int = LG_NOMINAL) -> DataFrame:
    """``period, sketch``: mergeable by ``theta_union_agg``, so days can be
    stored and united to any period."""
    return (events.where(F.col(user).isNotNull()).groupBy(period.alias("period"))
            .agg(F.theta_sketch_agg(user, lg_nominal).alias("sketch")).where("period is not null"))


def retention_sketch(sketches: DataFrame) -> DataFrame:
    """``period, kept, new, lost, either``: estimates from one sketch per
    period; ``either`` is the size of the union with the period before. The
    standard error of each is about ``either / sqrt(2 ** lg_nominal)``."""
    pairs = sketches.withColumn("before", F.lag("sketch").over(Window.orderBy("period")))  # one row per period

    def size(c):
        return F.theta_sketch_estimate(c)
    first = F.col("before").isNull()
    return pairs.select(
        "period", F.when(first, 0).otherwise(size(F.theta_intersection("before", "sketch"))).alias("kept"),
        F.when(first, size("sketch")).otherwise(size(F.theta_difference("sketch", "before"))).alias("new"),
        F.when(first, 0).otherwise(size(F.theta_difference("before", "sketch"))).alias("lost"),
        F.when(first, size("sketch")).otherwise(size(F.theta_union("before", "sketch"))).alias("either"))
