"""Semi-structured event properties: JSON text read as VARIANT.

The text is parsed once per row into the binary variant form; its fields are
then addressed without parsing again. Text that is no JSON is never lost: it
is split off as malformed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_variant(df: DataFrame, col: str, name: str = "variant") -> DataFrame:
    """Add the parsed column; NULL for NULL text and for text that is no JSON."""
    return df.withColumn(name, F.try_parse_json(col))


def split_malformed(df: DataFrame, col: str, name: str = "variant") -> tuple[DataFrame, DataFrame]:
    """(rows with the parsed column, rows whose text is no JSON)."""
    parsed = with_variant(df, col, name)
    bad = F.col(col).isNotNull() & F.col(name).isNull()
    return parsed.where(~bad), parsed.where(bad).drop(name)


def property_profile(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    """``<by>, property, type, rows, lowest, highest``: how often each property
    of the top-level objects in JSON column ``col`` has each type, and the
    range of its numbers. Rows that are no object count under property NULL,
    with type ``MALFORMED``, ``NULL`` (no text) or that of the whole value."""
    rows = with_variant(df.select(*by, F.col(col).alias("_text")), "_text", "_v")
    kind = F.schema_of_variant("_v")
    is_object = kind.startswith("OBJECT")
    entries = F.map_entries(F.try_variant_get("_v", "$", "map<string,variant>"))
    none = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col("_v").alias("value")))
    rows = rows.select(*by, "_text", "_v", F.explode(F.when(is_object, entries).otherwise(none)).alias("_e"))
    whole = F.when(F.col("_text").isNull(), "NULL").when(F.col("_v").isNull(), "MALFORMED")
    number = F.try_variant_get("_e.value", "$", "double")
    numeric = F.schema_of_variant("_e.value").rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    named = F.regexp_replace(F.regexp_extract(F.schema_of_variant("_e.value"), "^[A-Z]+", 0), "^(DECIMAL|FLOAT)$",
                             "DOUBLE")
    return (rows.groupBy(*by, F.col("_e.key").alias("property"), F.coalesce(whole, named).alias("type"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(F.when(numeric, number)).alias("lowest"),
                 F.max(F.when(numeric, number)).alias("highest")))


def merged_schema(df: DataFrame, col: str) -> DataFrame:
    """One row ``schema``: the type that all values of JSON column ``col`` share."""
    return with_variant(df.select(F.col(col)), col, "_v").agg(F.schema_of_variant_agg("_v").alias("schema"))
