"""Driver test tables (one Parquet file each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import table_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
