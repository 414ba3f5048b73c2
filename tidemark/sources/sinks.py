"""Sinks and partitioned layouts.

Partitioned writes first *rebalance* by the partition columns: AQE gathers
the rows of a partition value in tasks of the advisory size, merging small
values and splitting hot ones, so the number of files follows the data (about
size / target), not tasks x values, and no task receives a whole hot date.
Bucket columns come from a hash of the user (deterministic across retries),
modulo a fixed count, so a layout has a bounded number of folders per date
however many users exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timefns import activity_date, date_literal
from tidemark.sources.readers import TS_WRITE_FORMAT

LAYOUTS = ("date", "date_hour", "user_id_partition", "date_bucket")


def preview(df: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a stated order (what ``show()`` prints, but
    deterministic and still a DataFrame). Top-k: at most ``n`` rows per
    partition reach the final merge."""
    return df.orderBy(*order).limit(n)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    (df.write.mode(mode)
     .option("header", True)
     .option("timestampFormat", TS_WRITE_FORMAT)
     .option("timestampNTZFormat", TS_WRITE_FORMAT)
     .csv(path))


def user_bucket(user, n_buckets: int) -> Column:
    col = F.col(user) if isinstance(user, str) else user
    return F.pmod(F.xxhash64(col), F.lit(int(n_buckets))).cast("int")


def with_layout_columns(df: DataFrame, layout: str, ts: str, user: str,
                        n_buckets: int = 64) -> tuple[DataFrame, list[str]]:
    """Adds the partition columns of a layout; returns (frame, columns)."""
    if layout == "date":
        return df.withColumn("date", activity_date(ts)), ["date"]
    if layout == "date_hour":
        return (df.withColumn("date", activity_date(ts))
                .withColumn("hour", F.hour(ts)), ["date", "hour"])
    if layout == "user_id_partition":
        return (df.withColumn("user_id_partition", user_bucket(user, n_buckets)),
                ["user_id_partition"])
    if layout == "date_bucket":
        return (df.withColumn("date", activity_date(ts))
                .withColumn("user_id_partition", user_bucket(user, n_buckets)),
                ["date", "user_id_partition"])
    raise ValueError(f"unknown layout {layout!r}; one of {LAYOUTS}")


def _gathered(df: DataFrame, partition_by: list[str]) -> DataFrame:
    return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", compression: str = "snappy",
                  max_records_per_file: int | None = None) -> None:
    if partition_by:
        df = _gathered(df, partition_by)
    w = df.write.mode(mode).option("compression", compression)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: list[str],
                     compression: str = "snappy") -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite).

    The incremental form of a partitioned table: each run writes the days
    it computed, and re-running a day after a failure replaces that day
    instead of adding a second copy. Other partitions are untouched.
    """
    (_gathered(df, partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("compression", compression)
     .partitionBy(*partition_by)
     .parquet(path))


def write_layout(df: DataFrame, path: str, layout: str, ts: str, user: str,
                 n_buckets: int = 64, **kw) -> list[str]:
    framed, cols = with_layout_columns(df, layout, ts, user, n_buckets)
    write_parquet(framed, path, cols, **kw)
    return cols


def read_date_range(spark: SparkSession, path: str, start=None, end=None,
                    date_col: str = "date") -> DataFrame:
    """Read a date-partitioned layout; the date filter prunes folders
    (``PartitionFilters`` in the scan), so other days are never listed
    into tasks."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col(date_col) >= date_literal(start))
    if end is not None:
        df = df.where(F.col(date_col) <= date_literal(end))
    return df
