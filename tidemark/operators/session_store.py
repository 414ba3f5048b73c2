"""Sessions kept up to date day by day.

A day's events are reduced to pieces, the sessions that the day's events alone
form, and stored in the day's folder of a table. A run reads only that day's
events and writes only that folder, so days may come in any order and be run
again. Pieces within a day are final but for the first and the last of each
user; these are merged over the day borders when the table is read:

1. one row per user and day (first and last time, number of pieces) tells
   whether the day's first piece goes on from the day before (a window over at
   most one row per day of a user) and how many sessions came earlier;
2. joined back to the pieces on (user, day), this gives each piece its
   session number, and a session is the sum of its pieces.

The result equals ``sessions`` over all events at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.timefns import activity_date, gap_minutes
from tidemark.operators.sessions import session_buckets, session_measures
from tidemark.schemas import EventCols, INTERACTION_COLS
from tidemark.sources.sinks import write_partitions


def day_pieces(events: DataFrame, timeout_minutes: float = 30, cols: EventCols = INTERACTION_COLS) -> DataFrame:
    """``date, user, piece, pieces, n, first_ts, last_ts, prev_ts``: the
    sessions of each day on its own, numbered per user and day; ``prev_ts`` is
    the end of the piece before in the same day."""
    u = cols.user
    buckets = session_buckets(events, timeout_minutes, True, cols)
    runs = (buckets.groupBy(u, "session_num")
            .agg(F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
            .withColumn("date", activity_date("first_ts")))
    day = Window.partitionBy(u, "date")
    return runs.select(
        "date", u, F.row_number().over(day.orderBy("session_num")).alias("piece"),
        F.count(F.lit(1)).over(day).cast("int").alias("pieces"), "n", "first_ts", "last_ts",
        F.lag("last_ts").over(day.orderBy("session_num")).alias("prev_ts"))


def write_days(events: DataFrame, path: str, timeout_minutes: float = 30,
               cols: EventCols = INTERACTION_COLS) -> None:
    """Store the pieces of whole days; a day stored before is replaced."""
    write_partitions(day_pieces(events, timeout_minutes, cols), path, ["date"])


def read_sessions(spark: SparkSession, path: str, timeout_minutes: float = 30, split_at_midnight: bool = False,
                  cols: EventCols = INTERACTION_COLS, with_avg_gap: bool = True) -> DataFrame:
    """Sessions of all stored days, as ``sessions`` gives them.

    ``timeout_minutes`` must be the one that the pieces were cut with.
    """
    u = cols.user
    pieces = spark.read.parquet(path)
    own = Window.partitionBy(u).orderBy("date")
    days = (pieces.groupBy(u, "date").agg(F.min("first_ts").alias("_first"), F.max("last_ts").alias("_last"),
                                          F.max("pieces").alias("_k"))
            .withColumn("_before_ts", F.lag("_last").over(own)))
    goes_on = F.lit(not split_at_midnight) & F.col("_before_ts").isNotNull() & (
        gap_minutes("_first", "_before_ts") <= F.lit(float(timeout_minutes)))
    days = days.withColumn("_joined", goes_on.cast("int"))
    started = F.sum(F.col("_k") - F.col("_joined")).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    days = days.select(u, "date", "_before_ts", "_joined",
                       (started - F.col("_k") + F.col("_joined")).alias("_started"))

    rows = pieces.join(days, [u, "date"])
    before = F.when(F.col("piece") == 1, F.col("_before_ts")).otherwise(F.col("prev_ts"))
    opens = ~((F.col("piece") == 1) & (F.col("_joined") == 1))
    agg = (rows.withColumn("session_num", F.col("_started") + F.col("piece") - F.col("_joined"))
           .groupBy(u, "session_num")
           .agg(F.sum("n").alias("actions_per_session"), F.min("first_ts").alias("session_start"),
                F.max("last_ts").alias("session_end"),
                F.max(F.when(opens, gap_minutes("first_ts", before))).alias("_lead_gap")))
    return session_measures(agg, u, with_avg_gap)
