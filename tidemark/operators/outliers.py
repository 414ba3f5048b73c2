"""IQR bounds and outlier filtering / capping.

Bounds stay a one-row DataFrame (never pulled to the driver). Rows are
compared with them through a scalar subquery (``DataFrame.scalar()``):
Spark runs the bound aggregate once, and the resulting literal reaches
the filter, even the Parquet scan's pushed filters. No cross join.

Quartiles are exact and need no sketch of the data (see ``quantiles``): what
one task sees does not grow with the rows or the number of input tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import within_bounds
from tidemark.operators.quantiles import discrete_quantiles, exact_quantiles

IQR_FACTOR = 1.5


def iqr_bounds(valid: DataFrame, duration: str = "session_duration_hours",
               actions: str = "actions_per_session") -> DataFrame:
    """One row: quartiles, IQRs and upper bounds ``q3 + 1.5 * IQR``.

    An empty input gives NULL bounds (trap T8), which keep no row later.
    """
    q = discrete_quantiles(valid, [duration, actions], [0.25, 0.75])
    qd, qa = F.col(f"q_{duration}"), F.col(f"q_{actions}")
    q = q.select(qd[0].alias("q1_duration"), qd[1].alias("q3_duration"),
                 qa[0].alias("q1_actions"), qa[1].alias("q3_actions"))
    return (q
            .withColumn("iqr_duration", F.col("q3_duration") - F.col("q1_duration"))
            .withColumn("iqr_actions", F.col("q3_actions") - F.col("q1_actions"))
            .withColumn("duration_upper_bound",
                        F.col("q3_duration") + F.lit(IQR_FACTOR) * F.col("iqr_duration"))
            .withColumn("actions_upper_bound",
                        F.col("q3_actions") + F.lit(IQR_FACTOR) * F.col("iqr_actions")))


def bound_values(bounds: DataFrame, *names: str) -> list[Column]:
    """Scalar-subquery columns for the named fields of a one-row frame.

    All names share one subquery (a struct), so the bound aggregate runs
    once however many fields are used.
    """
    packed = bounds.select(F.struct(*names).alias("b")).scalar()
    return [packed.getField(n) for n in names]


def clean_sessions(valid: DataFrame, bounds: DataFrame,
                   duration: str = "session_duration_hours",
                   actions: str = "actions_per_session") -> DataFrame:
    """Drop sessions above either upper bound (upper side only, T9)."""
    d_ub, a_ub = bound_values(bounds, "duration_upper_bound", "actions_upper_bound")
    return valid.where(within_bounds(d_ub, a_ub, duration, actions))


def measure_bounds(df: DataFrame, col: str, factor: float = IQR_FACTOR) -> DataFrame:
    """One row: ``q1, q3, iqr, lower_bound, upper_bound`` of a column."""
    q = F.col(f"q_{col}")
    return (exact_quantiles(df, [col], [0.25, 0.75]).select(q[0].alias("q1"), q[1].alias("q3"))
            .withColumn("iqr", F.col("q3") - F.col("q1"))
            .withColumn("lower_bound", F.col("q1") - F.lit(factor) * F.col("iqr"))
            .withColumn("upper_bound", F.col("q3") + F.lit(factor) * F.col("iqr")))


def handle_outliers(df: DataFrame, col: str, factor: float = IQR_FACTOR, mode: str = "flag") -> DataFrame:
    """IQR outliers of a per-row measure (e.g. ``duration_ms``).

    ``mode``: ``flag`` adds ``is_outlier`` and ``<col>_capped`` (value
    clamped into the bounds); ``drop`` keeps rows inside the bounds;
    ``cap`` replaces the column by its clamped value. NULL measures are
    neither outliers nor dropped by ``flag``/``cap``.
    """
    lo, hi = bound_values(measure_bounds(df, col, factor), "lower_bound", "upper_bound")
    c = F.col(col)
    outside = (c < lo) | (c > hi)
    capped = F.least(F.greatest(c, lo), hi)
    if mode == "drop":
        return df.where(~outside)
    if mode == "cap":
        return df.withColumn(col, capped)
    if mode == "flag":
        return (df.withColumn("is_outlier", F.coalesce(outside, F.lit(False)))
                .withColumn(f"{col}_capped", capped))
    raise ValueError(f"unknown mode {mode!r}")
