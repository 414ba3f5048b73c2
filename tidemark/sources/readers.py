"""Readers with declared schemas (no inference pass over the data)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import INTERACTIONS, METADATA

TS_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CORRUPT_COL = "_corrupt_record"


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder (reads one line)."""
    return spark.read.option("header", True).csv(path).columns


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             mode: str = "PERMISSIVE", keep_corrupt: bool = False) -> DataFrame:
    """CSV with header, matched to the declared schema *by name*.

    Columns may stand in any order. A declared column that the file lacks is
    missing from the result and an undeclared one is kept as text, so
    ``schema_issues`` can report both. All files of a folder must agree on
    the header: one that does not fails the read instead of shifting columns.

    Fields are cast to the declared types; ``PERMISSIVE`` turns those that do
    not parse into NULLs, which the quality checks then count. With
    ``keep_corrupt`` the text of every line that is malformed or has such a
    field is kept in ``_corrupt_record`` (NULL for good lines), so
    ``unparsable_rule`` can quarantine it. ``DROPMALFORMED`` drops such lines
    and ``FAILFAST`` fails on them.
    """
    header = csv_header(spark, path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.read.option("header", True).option("enforceSchema", False)
    declared = {f.name: f.dataType for f in schema.fields}
    strict = mode == "FAILFAST"
    if mode == "PERMISSIVE":
        text = text.add(CORRUPT_COL, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    raw = reader.option("mode", mode).schema(text).csv(path)

    def parsed(c: str):
        if c not in declared:
            return F.col(c)
        return F.col(c).cast(declared[c]) if strict else F.col(c).try_cast(declared[c])

    order = [f.name for f in schema.fields if f.name in header] + [c for c in header if c not in declared]
    bad = reduce(lambda a, b: a | b, [F.col(c).isNotNull() & parsed(c).isNull() for c in order if c in declared],
                 F.lit(False))
    if mode == "DROPMALFORMED":
        return raw.where(~bad).select(*[parsed(c).alias(c) for c in order])
    out = [parsed(c).alias(c) for c in order]
    if keep_corrupt and mode == "PERMISSIVE":
        line = F.to_csv(F.struct(*[F.col(c) for c in header]))
        out.append(F.coalesce(CORRUPT_COL, F.when(bad, line)).alias(CORRUPT_COL))
    return raw.select(*out)


def unparsable_rule() -> dict:
    """Quality rule for rows read with ``keep_corrupt=True``."""
    return {"unparsable_row": F.col(CORRUPT_COL).isNotNull()}


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    raise ValueError(f"unknown format {fmt!r}")


def read_interactions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, INTERACTIONS, fmt)


def read_metadata(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, METADATA, fmt)
