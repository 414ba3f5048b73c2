"""Quantiles of any range of days from a stored daily state.

The state of a day is, per measure, the counts of its values and a KLL sketch
with the number of rows. Days are stored in folders of their own, so a day can
be written again. A quantile of a range of days reads the state alone:

1. the days' sketches are merged (a few KB each) and bracket the wanted rank;
2. a pass over the value counts adds up ``CELLS`` cells of equal width within
   the bracket, and what lies below and above it. The cumulative counts tell
   for certain which cell holds the rank, even if the sketch was off;
3. a second pass reads that cell only (the value range is pushed to the
   stored table) and ranks its values.

So the result is exact, the sketch only makes the cells narrow, and a task
ranks the distinct values of one cell.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.timefns import activity_date, date_literal
from tidemark.sources.sinks import write_partitions

KLL_K = 800
MARGIN = 0.01  # of the ranks to each side; the sketch's error at this k is about half a per cent
CELLS = 4096


def _measured(df: DataFrame, date, measures: list[str]) -> DataFrame:
    return df.select(date.alias("date"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures
    ])).alias("x")).select("date", "x.*").where("date is not null and value is not null and not isnan(value)")


def write_days(df: DataFrame, path: str, ts: str, measures: list[str], k: int = KLL_K) -> None:
    """Store the state of whole days (``path/values`` and ``path/sketches``);
    days stored before are replaced. NULL and NaN measures are left out."""
    rows = _measured(df, activity_date(ts), measures)
    counts = rows.groupBy("date", "measure", "value").agg(F.count(F.lit(1)).alias("n"))
    sketches = rows.groupBy("date", "measure").agg(F.kll_sketch_agg_double("value", k).alias("sketch"),
                                                   F.count(F.lit(1)).alias("n"))
    (counts.hint("rebalance", "date").sortWithinPartitions("date", "measure", "value")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date")
     .parquet(f"{path}/values"))
    write_partitions(sketches, f"{path}/sketches", ["date"])


def quantiles(spark: SparkSession, path: str, probs: list[float], start: dt.date | None = None,
              end: dt.date | None = None) -> DataFrame:
    """``measure, p, value``: the smallest value whose cumulative count reaches
    ``p`` times the rows of the days from ``start`` to ``end``, both included.
    Measures without rows there have none."""
    def days(name):
        df = spark.read.parquet(f"{path}/{name}")
        if start is not None:
            df = df.where(F.col("date") >= date_literal(start))
        if end is not None:
            df = df.where(F.col("date") <= date_literal(end))
        return df

    def at(p):
        return F.kll_sketch_get_quantile_double("s", F.lit(min(1.0, max(0.0, p))))
    wanted = F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(float(p)) * F.col("rows")))
                 .alias("rank"), at(p - MARGIN).alias("lo"), at(p + MARGIN).alias("hi")) for p in probs])).alias("b")
    brackets = (days("sketches").groupBy("measure").agg(F.kll_merge_agg_double("sketch").alias("s"),
                                                        F.sum("n").alias("rows")).select("measure", wanted)
                .select("measure", "b.*"))
    brackets = F.broadcast(brackets)  # measures x probabilities

    share = (F.col("value") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    cell = (F.when(F.col("value") < F.col("lo"), -1).when(F.col("value") > F.col("hi"), CELLS)
            .otherwise(F.least(F.floor(F.coalesce(share, F.lit(0.0)) * CELLS), F.lit(CELLS - 1))).cast("int"))
    values = days("values").join(brackets, "measure").withColumn("cell", cell)
    key = Window.partitionBy("measure", "p")
    cells = values.groupBy("measure", "p", "rank", "lo", "hi", "cell").agg(
        F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    cells = cells.withColumn("upto", F.sum("n").over(key.orderBy("cell")))
    chosen = cells.where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
    chosen = chosen.select("measure", "p", "low", "high", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"))

    inside = days("values").join(F.broadcast(chosen), "measure").where("value between low and high")
    ranked = (inside.groupBy("measure", "p", "rank", "value").agg(F.sum("n").alias("n"))
              .withColumn("upto", F.sum("n").over(key.orderBy("value"))))
    return ranked.where("upto >= rank").groupBy("measure", "p").agg(F.min("value").alias("value"))
