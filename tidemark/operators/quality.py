"""Data-quality checks and quarantine.

Every check is a column predicate; all of them are counted in one
aggregate pass (``count_if``) and unpivoted to a long report. Duplicate
rows are a group-by with map-side partial counts, orphans a left-anti
join. The report is a DataFrame, never a driver-side list.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.predicates import is_future
from tidemark.functions.timefns import ts_literal
from tidemark.schemas import EVENT_TYPES, INTERACTION_ACTIONS  # noqa: F401  (re-exported)


def _long(agg_row: DataFrame, names: list[str], label: str, value: str) -> DataFrame:
    """Unpivot a one-row frame of counts into ``label, value`` rows."""
    return agg_row.unpivot([], names, label, value)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column_name, null_count`` for every column, in one pass."""
    columns = columns or df.columns
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _long(row, columns, "column_name", "null_count")


def future_records(df: DataFrame, ts: str, as_of: dt.datetime | None = None) -> DataFrame:
    """One row: events later than ``as_of`` (default: query start time)."""
    limit = ts_literal(as_of) if as_of is not None else F.current_timestamp()
    return df.agg(F.count_if(is_future(ts, limit)).alias("future_records"))


def schema_issues(spark: SparkSession, df: DataFrame, declared: T.StructType) -> DataFrame:
    """Declared schema against the frame's own: missing, extra, wrong type.

    Metadata only (no data is read): ``column_name, issue, expected_type,
    actual_type``.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    expected = {f.name: f.dataType.simpleString() for f in declared.fields}
    rows = []
    for name, typ in expected.items():
        if name not in actual:
            rows.append((name, "missing", typ, None))
        elif actual[name] != typ:
            rows.append((name, "wrong_type", typ, actual[name]))
    for name, typ in actual.items():
        if name not in expected:
            rows.append((name, "extra", None, typ))
    schema = "column_name string, issue string, expected_type string, actual_type string"
    return spark.createDataFrame(rows, schema)


def event_rules(user: str, ts: str, action: str, measure: str, domain,
                as_of: dt.datetime | None = None,
                columns: list[str] | None = None) -> dict[str, Column]:
    """Row rules for an event table; each value is the *failing* predicate.

    ``columns`` keeps the rules whose column is among them.
    """
    limit = ts_literal(as_of) if as_of is not None else F.current_timestamp()
    rules = {
        "null_user": (user, F.col(user).isNull()),
        "null_timestamp": (ts, F.col(ts).isNull()),
        "null_action": (action, F.col(action).isNull()),
        "unknown_action": (action, F.col(action).isNotNull() & ~F.col(action).isin(list(domain))),
        "negative_measure": (measure, F.col(measure) < 0),
        "future_timestamp": (ts, is_future(ts, limit)),
    }
    return {n: c for n, (needs, c) in rules.items() if columns is None or needs in columns}


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``check_name, n_bad`` for every rule, in one pass."""
    if not rules:
        return df.sparkSession.createDataFrame([], "check_name string, n_bad long")
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return _long(row, list(rules), "check_name", "n_bad")


def duplicates(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Groups of identical ``keys`` occurring more than once: keys + ``copies``."""
    keys = keys or df.columns
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
            .where(F.col("copies") > 1))


def orphans(facts: DataFrame, dim: DataFrame, fkey: str, dkey: str | None = None) -> DataFrame:
    """Fact rows whose key has no dimension row (NULL keys included)."""
    dkey = dkey or fkey
    d = dim.select(F.col(dkey).alias("_k")).distinct()
    return facts.join(d, facts[fkey] == d["_k"], "left_anti")


def orphans_per_key(facts: DataFrame, dim: DataFrame, fkey: str, dkey: str | None = None) -> DataFrame:
    """``fkey, events``: keys without a dimension row (NULL included) and how
    many fact rows they have. Facts are counted per key before the join, so it
    moves keys, not rows, and a hot key is one row."""
    counts = facts.groupBy(fkey).agg(F.count(F.lit(1)).alias("events"))
    return orphans(counts, dim, fkey, dkey)


def quality_rules(df: DataFrame, rules: dict[str, Column], dup_keys: list[str],
                  dim: DataFrame | None = None, fkey: str | None = None,
                  dkey: str | None = None) -> DataFrame:
    """Long report ``check_name, n_bad``: row rules, extra duplicate copies
    and orphan rows."""
    parts = [rule_counts(df, rules)]
    dup = (duplicates(df, dup_keys)
           .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("n_bad"))
           .select(F.lit("duplicate_rows").alias("check_name"), "n_bad"))
    parts.append(dup)
    if dim is not None and fkey is not None:
        orph = (orphans_per_key(df, dim, fkey, dkey)
                .agg(F.coalesce(F.sum("events"), F.lit(0)).cast("long").alias("n_bad"))
                .select(F.lit("orphan_rows").alias("check_name"), "n_bad"))
        parts.append(orph)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quarantine(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``dq_failures``: names of the rules a row fails (empty = clean)."""
    fails = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n))
                                      for n, c in rules.items()]))
    return df.withColumn("dq_failures", fails)


def split_quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with ``dq_failures``)."""
    tagged = quarantine(df, rules)
    clean = tagged.where(F.size("dq_failures") == 0).drop("dq_failures")
    bad = tagged.where(F.size("dq_failures") > 0)
    return clean, bad


def quality_report(spark: SparkSession, df: DataFrame, declared: T.StructType | None,
                   rules: dict[str, Column], table_name: str) -> DataFrame:
    """The task's ``validate_data_quality`` as one long DataFrame:
    ``table_name, check_name, column_name, n_bad, message``; only failing
    checks."""
    parts = []
    if declared is not None:
        parts.append(schema_issues(spark, df, declared)
                     .select(F.concat(F.lit("schema_"), "issue").alias("check_name"),
                             "column_name", F.lit(1).cast("long").alias("n_bad")))
    parts.append(null_counts(df).select(F.lit("nulls").alias("check_name"), "column_name",
                                        F.col("null_count").alias("n_bad")))
    parts.append(rule_counts(df, rules).select("check_name",
                                               F.lit(None).cast("string").alias("column_name"),
                                               "n_bad"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return (out.where(F.col("n_bad") > 0)
            .withColumn("message", issue_message())
            .withColumn("table_name", F.lit(table_name)))


# Wording of the issues reported by the task's quality check.
MSG_MISSING_COLUMN = "Missing required column: %s"
MSG_NULLS = "Found %d null values in column %s"
MSG_FUTURE = "Found %d records with future timestamps"
# Wording for the other checks of this report.
MSG_SCHEMA = "Column %s: %s"
MSG_RULE = "Found %d rows failing %s"


def issue_message() -> Column:
    """Human-readable line per report row (built in Spark, not on the driver)."""
    c, col, n = F.col("check_name"), F.col("column_name"), F.col("n_bad")
    return (F.when(c == "schema_missing", F.format_string(MSG_MISSING_COLUMN, col))
            .when(c.startswith("schema_"),
                  F.format_string(MSG_SCHEMA, col, F.substring(c, 8, 100)))
            .when(c == "nulls", F.format_string(MSG_NULLS, n, col))
            .when(c == "future_timestamp", F.format_string(MSG_FUTURE, n))
            .otherwise(F.format_string(MSG_RULE, n, c)))
