"""Dataset comparison (unordered equality and its witnesses).

Both directions come from one aggregate: the two inputs are tagged,
unioned and grouped by all columns, counting copies per side (map-side
partial counts, so a row repeated a third of the time collapses before
the shuffle). NULLs compare equal, as in SQL EXCEPT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _side_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    cols = left.columns
    tagged = (left.select(*cols, F.lit(1).alias("_nl"), F.lit(0).alias("_nr"))
              .unionByName(right.select(*cols, F.lit(0).alias("_nl"), F.lit(1).alias("_nr"))))
    return tagged.groupBy(*cols).agg(F.sum("_nl").alias("_nl"), F.sum("_nr").alias("_nr"))


def diff_rows(left: DataFrame, right: DataFrame, bag: bool = True) -> DataFrame:
    """Rows found on one side only, tagged ``side`` = left_only/right_only.

    ``bag=True`` compares multisets (EXCEPT ALL both ways) and says in
    ``copies`` how often the row is in excess: a row present twice on the
    left and once on the right has one copy. A row repeated any number of
    times stays one row. ``bag=False`` compares sets (EXCEPT DISTINCT,
    duplicates ignored).
    """
    cols = left.columns
    counts = _side_counts(left, right.select(*cols))
    side = F.when(F.col("_nl") > F.col("_nr"), F.lit("left_only")).otherwise(F.lit("right_only"))
    if bag:
        return (counts.where(F.col("_nl") != F.col("_nr"))
                .select(*cols, side.alias("side"), F.abs(F.col("_nl") - F.col("_nr")).alias("copies")))
    return (counts.where((F.col("_nl") == 0) | (F.col("_nr") == 0))
            .select(*cols, side.alias("side")))


def same_rows(left: DataFrame, right: DataFrame, bag: bool = True) -> bool:
    """Unordered equality; runs one job that stops at the first witness."""
    return diff_rows(left, right, bag).isEmpty()
