"""Structured Streaming versions of the user-day rollup and sessions.

* ``user_day_snapshot`` - new event files arrive in a folder; each micro-batch
  is reduced to partial (day, user) counts and first/last times, written to
  its own ``batch_id`` folder of a table in the shared scratch area. The
  snapshot adds the partials up. Nothing is held in state and there is no
  watermark, so rows count however late they come, the result is complete
  after every batch, and a batch replayed after a failure overwrites its own
  folder with the same values.
* ``session_stream`` - ``session_window`` sessions (append mode only, as
  Spark requires): a session is emitted once the watermark passes its
  end, and rows later than the watermark are dropped. Gaps are compared in
  microseconds and there is no midnight rule, so it matches the batch
  ``sessions(split_at_midnight=False)`` except for gaps within one second of
  the timeout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefns import activity_date
from tidemark.schemas import EventCols, INTERACTION_COLS
from tidemark.session import scratch_path


def read_event_stream(spark: SparkSession, path: str, schema: T.StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files at ``path``: a folder that files arrive in, or one file
    (streams take a plain path for a folder; a pattern may match either)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    path = path.rstrip("/")
    return r.parquet(f"{path[:-1]}[{path[-1]}]")


def user_day_partials(events: DataFrame, cols: EventCols = INTERACTION_COLS) -> DataFrame:
    """``date, user, actions, first_ts, last_ts`` of a batch; rows without a
    user or a time belong to no user-day."""
    return (events.where(F.col(cols.user).isNotNull() & F.col(cols.ts).isNotNull())
            .groupBy(activity_date(cols.ts).alias("date"), cols.user)
            .agg(F.count(F.lit(1)).alias("actions"), F.min(cols.ts).alias("first_ts"),
                 F.max(cols.ts).alias("last_ts")))


def merge_partials(partials: DataFrame, cols: EventCols = INTERACTION_COLS) -> DataFrame:
    return (partials.groupBy("date", cols.user)
            .agg(F.sum("actions").alias("actions"), F.min("first_ts").alias("first_ts"),
                 F.max("last_ts").alias("last_ts")))


def session_stream(events: DataFrame, timeout_minutes: int = 30,
                   cols: EventCols = INTERACTION_COLS, watermark: str = "1 hour") -> DataFrame:
    events = events.withColumn(cols.ts, F.col(cols.ts).cast("timestamp"))  # watermarks need the zoned type
    return (events.withWatermark(cols.ts, watermark)
            .groupBy(cols.user, F.session_window(cols.ts, f"{int(timeout_minutes)} minutes")
                     .alias("session"))
            .agg(F.count(F.lit(1)).alias("actions_per_session"),
                 F.min(cols.ts).alias("session_start"),
                 F.max(cols.ts).alias("session_end")))


def run_available_now(stream: DataFrame, write_batch, checkpoint: str) -> None:
    """Process everything available, then stop."""
    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def user_day_snapshot(spark: SparkSession, path: str, schema: T.StructType,
                      cols: EventCols = INTERACTION_COLS, sink: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Take in the files that are new at ``path`` and return the user-days so
    far: ``date, user, actions, first_ts, last_ts``.

    ``sink`` keeps the partials and the stream's checkpoint; pass the same one
    again to go on from there (default: a fresh one). Without any file the
    result is empty.
    """
    sink = sink or scratch_path(spark, "user-day-stream")
    empty = user_day_partials(spark.createDataFrame([], schema), cols)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        user_day_partials(batch, cols).write.mode("overwrite").parquet(f"{sink}/data/batch_id={batch_id}")

    # a first, empty folder: the table can be read before any batch has run
    empty.write.mode("overwrite").parquet(f"{sink}/data/batch_id=-1")
    run_available_now(read_event_stream(spark, path, schema, max_files_per_trigger), write_batch,
                      f"{sink}/checkpoint")
    return merge_partials(spark.read.schema(empty.schema).parquet(f"{sink}/data"), cols)


def dau_from_snapshot(user_day: DataFrame) -> DataFrame:
    return user_day.groupBy("date").agg(F.count(F.lit(1)).alias("daily_active_users"))
