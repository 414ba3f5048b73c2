"""Exact quantiles of numeric columns, without a sketch.

``discrete_quantiles`` is for measures with few distinct values, such as
session lengths in whole seconds and action counts: values are counted
(map-side first) and one window runs over the distinct ones.

``exact_quantiles`` is for any numbers, by radix selection. The discrete
quantile (``percentile_disc``: the smallest value whose cumulative count
reaches ``p`` times the rows) is found digit by digit:

1. the input is read once: equal values of a column are counted (map-side
   first) and the counts written to the shared folder;
2. every value counted is written as three order-preserving digits: class and
   exponent with the leading bits of the mantissa, then the rest of the
   mantissa 20 bits at a time;
3. a histogram of the first digit, combined map-side, tells which digit holds
   each wanted rank and the rank within it;
4. a second pass over the counts takes the next digit among the values with
   that digit, a third the last.

So the input's other columns are never read and its rows are read once, what
is shuffled is at most one (value, count) pair per distinct value, and after
that only histograms whose size is bounded by the digits. The result is exact.
NULLs are left out; NaN sorts last, as in Spark. Whole numbers are exact up to
2**53.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

HEAD_BITS = 12
DIGIT_BITS = (20, 20)  # with HEAD_BITS the 52 bits of a double's mantissa


def _digits(v: Column) -> list[Column]:
    """Order-preserving digits of a double, most significant first."""
    size = F.abs(v)
    guess = F.floor(F.log2(size)).cast("int")
    first = size / F.pow(F.lit(2.0), guess)
    exponent = guess + F.when(first >= 2, 1).when(first < 1, -1).otherwise(0)
    plain = (size > 0) & (size < float("inf"))
    frac = F.when(plain, size / F.pow(F.lit(2.0), exponent) - 1).otherwise(F.lit(0.0))
    out, scale = [], F.lit(float(1 << HEAD_BITS))
    head = F.floor(frac * scale)
    out.append(F.when(plain, (exponent + 1100) * (1 << HEAD_BITS) + head)
               .when(size == 0, 0).otherwise(1 << 30))
    rest = frac * scale - head
    for bits in DIGIT_BITS:
        scaled = rest * float(1 << bits)
        out.append(F.floor(scaled))
        rest = scaled - F.floor(scaled)
    sign = F.when(v < 0, -1).otherwise(1)
    return [F.when(F.isnan(v), F.lit(1 << 31) if i == 0 else F.lit(0)).otherwise(d * sign).cast("long")
            for i, d in enumerate(out)]


def _values(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)
    ])).alias("x")).select("x.c", "x.v").where(F.col("v").isNotNull())


def discrete_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """``exact_quantiles`` for columns with few distinct values: what one task
    sees is the distinct values of a column."""
    counted = _values(df, cols).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("c")
    ranked = counted.select("c", "v", F.sum("n").over(whole.orderBy("v")).alias("upto"),
                            F.sum("n").over(whole).alias("total"))

    def least(i, p):
        reached = F.col("upto") >= F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(float(p)) * F.col("total")))
        return F.min(F.when((F.col("c") == i) & reached, F.col("v")))
    return ranked.agg(*[F.array(*[least(i, p) for p in probs])
                        .cast(f"array<{df.schema[c].dataType.simpleString()}>").alias(f"q_{c}")
                        for i, c in enumerate(cols)])


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """One row with an array column ``q_<col>`` per column (values in the
    order of ``probs``, in the column's own type; NULLs without rows). Counting
    the values is a job of its own, run by this call."""
    return weighted_quantiles(materialize(value_counts(df, cols)), [df.schema[c] for c in cols], probs)


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``c, v, n``: number of the column in ``cols``, value, rows."""
    return _values(df, cols).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))


def weighted_quantiles(counts: DataFrame, fields: list[T.StructField], probs: list[float]) -> DataFrame:
    """``exact_quantiles`` from counted values ``c, v, n`` of the columns
    ``fields``; a value may stand in several rows. ``counts`` is read once per
    digit, so it should be stored."""
    digits = _digits(F.col("v"))
    names = [f"d{i}" for i in range(len(digits))]
    values = counts.select("c", "v", "n", *[d.alias(x) for d, x in zip(digits, names, strict=True)])
    count, low = F.sum("n").alias("n"), F.min("v").alias("v")

    # one row per column and probability: the digits found, the rank left
    hist = values.groupBy("c", names[0]).agg(count, low)
    whole = Window.partitionBy("c")
    hist = hist.withColumn("upto", F.sum("n").over(whole.orderBy(names[0]))) \
        .withColumn("total", F.sum("n").over(whole))
    hist = hist.select("*", F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("k", "p")) \
        .withColumn("rank", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("p") * F.col("total"))))
    for i in range(len(names)):
        if i:
            left = values.join(F.broadcast(found), ["c", *names[:i]])  # columns x probabilities
            hist = left.groupBy("c", "k", "rank", *names[:i + 1]).agg(count, low)
            hist = hist.withColumn("upto", F.sum("n").over(Window.partitionBy("c", "k").orderBy(names[i])))
        here = hist.where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
        found = here.select("c", "k", *names[:i + 1], (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"),
                            *(["v"] if i == len(names) - 1 else []))
    return found.agg(*[
        F.array(*[F.max(F.when((F.col("c") == i) & (F.col("k") == k), F.col("v"))) for k in range(len(probs))])
        .cast(f"array<{f.dataType.simpleString()}>").alias(f"q_{f.name}") for i, f in enumerate(fields)])
