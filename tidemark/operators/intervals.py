"""Overlap of intervals in time: how many are open, by a distributed sweep.

Each interval adds +1 where it starts and -1 after it ends. The running sum of
these steps is the number open. One window over all seconds would be a single
task, so the prefix sum has two levels: within each block of time (one window
partition per block, at most ``block_seconds`` rows), and over the totals of
the blocks (one row per block, a few thousand a year). As the level before a
block only shifts everything in it, peak and mean follow from the block's own
sums and that level, and the steps are read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timefns import epoch_seconds


def steps(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """``sec, step``: change of the number of open intervals per second,
    combined map-side. An interval covers its first and last second."""
    whole = intervals.where(F.col(start) <= F.col(end))
    pair = F.array(F.struct(epoch_seconds(start).alias("sec"), F.lit(1).alias("step")),
                   F.struct((epoch_seconds(end) + 1).alias("sec"), F.lit(-1).alias("step")))
    return (whole.select(F.explode(pair).alias("s")).groupBy("s.sec").agg(F.sum("s.step").alias("step"))
            .where("step <> 0"))


def overlap_by_block(intervals: DataFrame, start: str, end: str, block_seconds: int = 3600) -> DataFrame:
    """``block_start, peak, mean_open, open_seconds`` per block of time in
    which an interval is open.

    ``peak`` is the largest number of intervals open at one second, both ends
    included; ``open_seconds`` sums the seconds of all of them within the
    block and ``mean_open`` is that over the block's length. Blocks that
    intervals span without starting or ending there are included. Intervals
    with a NULL end or that end before they start are left out.
    """
    width = int(block_seconds)
    block = F.floor(F.col("sec") / width)
    inside = Window.partitionBy("block").orderBy("sec")
    swept = (steps(intervals, start, end).withColumn("block", block)
             .withColumn("rise", F.sum("step").over(inside))
             .withColumn("until", F.coalesce(F.lead("sec").over(inside), (F.col("block") + 1) * width)))
    blocks = swept.groupBy("block").agg(
        F.sum("step").alias("total"), F.max("rise").alias("rise"), F.min("sec").alias("first"),
        F.sum(F.col("rise") * (F.col("until") - F.col("sec"))).alias("area"))

    order = Window.orderBy("block")  # one row per block
    blocks = (blocks.withColumn("after", F.sum("total").over(order))
              .withColumn("before", F.col("after") - F.col("total"))
              .withColumn("next", F.lead("block").over(order)))
    quiet_start = F.when(F.col("first") > F.col("block") * width, 0)
    own = blocks.select("block", (F.col("before") + F.greatest("rise", quiet_start)).alias("peak"),
                        (F.col("before") * width + F.col("area")).alias("open_seconds"))
    between = blocks.where((F.col("after") > 0) & (F.col("next") > F.col("block") + 1)).select(
        F.explode(F.sequence(F.col("block") + 1, F.col("next") - 1)).alias("block"),
        F.col("after").alias("peak"), (F.col("after") * width).alias("open_seconds"))
    return own.unionByName(between).where("peak > 0").select(
        F.timestamp_seconds(F.col("block") * width).alias("block_start"), "peak",
        (F.col("open_seconds") / width).alias("mean_open"), "open_seconds")
