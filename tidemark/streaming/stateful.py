"""Stateful streams: deduplication and an interval join under a watermark.

A watermark bounds the state: what is older than the latest time seen so far
by more than the delay is given up. Spark drops such rows in its stateful
operators without a trace, so here they are split off first:

* ``split_arrivals`` marks each row of a batch as ``on_time``, ``late`` (not
  after the latest time of all batches before it less the delay, where Spark's
  operators give rows up) or ``unplaced`` (no id or time), and stores the batch in folders of its own. No
  row is lost, and a batch that is run again overwrites its folders.
* ``deduplicate`` streams the on-time rows through
  ``dropDuplicatesWithinWatermark``. A copy that comes in time is dropped
  against the state; one that comes later stands among the late rows.
* ``interval_join`` joins two streams on a key and a range of times. Both sides
  have watermarks, so rows that can't match any more leave the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.streaming.incremental import run_available_now

KINDS = ("on_time", "late", "unplaced")


def read_folder_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def split_arrivals(spark: SparkSession, path: str, schema: T.StructType, sink: str, key: str, ts: str,
                   delay_seconds: int) -> None:
    """Take in the files that are new at ``path`` as one batch and store its
    rows under ``sink/kind=.../batch_id=n``."""
    seen_schema = f"latest {schema[ts].dataType.simpleString()}, batch_id int"
    # first, empty folders: the tables can be read before any batch has run
    spark.createDataFrame([], seen_schema).drop("batch_id").write.mode("overwrite").parquet(f"{sink}/seen/batch_id=-1")
    for kind in KINDS:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{sink}/rows/kind={kind}/batch_id=-1")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        seen = (spark.read.schema(seen_schema).parquet(f"{sink}/seen").where(F.col("batch_id") < batch_id)
                .agg(F.max("latest").alias("t")).scalar())  # one row per batch
        placed = F.col(key).isNotNull() & F.col(ts).isNotNull()
        late = placed & F.coalesce(F.col(ts) <= seen - F.make_dt_interval(secs=F.lit(int(delay_seconds))), F.lit(False))
        rows = batch.withColumn("kind", F.when(~placed, "unplaced").when(late, "late").otherwise("on_time"))
        (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("kind", "batch_id").parquet(f"{sink}/rows"))
        stored = spark.read.schema(_stored(schema)).parquet(f"{sink}/rows").where(F.col("batch_id") == batch_id)
        stored.agg(F.max(ts).alias("latest")).write.mode("overwrite").parquet(f"{sink}/seen/batch_id={batch_id}")

    run_available_now(read_folder_stream(spark, path, schema), write_batch, f"{sink}/split-checkpoint")


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("kind", T.StringType()),
                         T.StructField("batch_id", T.IntegerType())])


def deduplicate(spark: SparkSession, schema: T.StructType, sink: str, key: str, ts: str, delay_seconds: int) -> None:
    """Bring ``sink/unique`` up to the on-time rows split so far: one row per ``key``."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{sink}/unique/batch_id=-1")
    stream = read_folder_stream(spark, f"{sink}/rows/kind=on_time", schema)
    # watermarks need the zoned type; the column itself stays as it is
    unique = (stream.withColumn("_at", F.col(ts).cast("timestamp")).withWatermark("_at", f"{int(delay_seconds)} seconds")
              .dropDuplicatesWithinWatermark([key]).drop("_at"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/unique/batch_id={batch_id}")

    run_available_now(unique, write_batch, f"{sink}/unique-checkpoint")


def take_in(spark: SparkSession, path: str, schema: T.StructType, sink: str, key: str, ts: str,
            delay_seconds: int) -> dict[str, DataFrame]:
    """One run over the files that are new at ``path``: the tables ``unique``
    (one row per ``key`` of the rows in time), ``late`` and ``unplaced`` so far."""
    split_arrivals(spark, path, schema, sink, key, ts, delay_seconds)
    deduplicate(spark, schema, sink, key, ts, delay_seconds)
    rows = spark.read.schema(_stored(schema)).parquet(f"{sink}/rows")
    out = {k: rows.where(F.col("kind") == k).drop("kind", "batch_id") for k in ("late", "unplaced")}
    return {"unique": spark.read.schema(schema).parquet(f"{sink}/unique").drop("batch_id"), **out}


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within_seconds: int,
                  delay_seconds: int) -> DataFrame:
    """Streaming pairs of equal ``key`` with ``right_ts`` from ``left_ts`` to
    ``within_seconds`` later, both included. Column names must differ but for
    ``key``; rows later than ``delay_seconds`` are not matched."""
    a = left.withColumn("_left_at", F.col(left_ts).cast("timestamp")).withWatermark("_left_at", f"{int(delay_seconds)} seconds")
    b = (right.withColumnRenamed(key, "_key").withColumn("_right_at", F.col(right_ts).cast("timestamp"))
         .withWatermark("_right_at", f"{int(delay_seconds)} seconds"))
    span = F.make_dt_interval(secs=F.lit(int(within_seconds)))
    near = (F.col("_right_at") >= F.col("_left_at")) & (F.col("_right_at") <= F.col("_left_at") + span)
    return a.join(b, (F.col(key) == F.col("_key")) & near).drop("_key", "_left_at", "_right_at")


def interval_join_table(spark: SparkSession, path: str, schema: T.StructType, sink: str, left_of, right_of, key: str,
                        left_ts: str, right_ts: str, within_seconds: int, delay_seconds: int) -> DataFrame:
    """One run over the files that are new at ``path``: all pairs found so far
    between ``left_of`` and ``right_of`` the arriving rows."""
    def joined(rows):
        return interval_join(left_of(rows), right_of(rows), key, left_ts, right_ts, within_seconds, delay_seconds)

    out = joined(spark.createDataFrame([], schema)).schema
    spark.createDataFrame([], out).write.mode("overwrite").parquet(f"{sink}/pairs/batch_id=-1")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/pairs/batch_id={batch_id}")

    # one read per side: a stream may not be joined with itself
    pairs = interval_join(left_of(read_folder_stream(spark, path, schema)),
                          right_of(read_folder_stream(spark, path, schema)),
                          key, left_ts, right_ts, within_seconds, delay_seconds)
    run_available_now(pairs, write_batch, f"{sink}/pairs-checkpoint")
    return spark.read.schema(out).parquet(f"{sink}/pairs").drop("batch_id")
