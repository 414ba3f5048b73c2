"""Clustered layout: rows near each other in several columns share a file.

Folders by date help filters on the date only. Here each column's values are
ranked by its quantiles (2 ** ``bits`` ranges of about equal size; columns that
aren't numbers, dates or times by the leading bits of their hash), the bits of
the ranks are interleaved (Z-order), and rows are range-partitioned and sorted
by that key. Every file then covers a small range of *each* column, so the
minima and maxima in Parquet's footers and page indexes rule out most files and
row groups for a filter on any of them; a bloom filter per file does the same
for single keys that the ranges don't exclude.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANK_BITS = 5
ACCURACY = 10_000
NUMBERS = ("byte", "short", "integer", "long", "float", "double", "decimal")


def _number(df: DataFrame, c: str) -> Column | None:
    kind = df.schema[c].dataType.typeName()
    if kind in NUMBERS:
        return F.col(c).cast("double")
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_timestamp(c).cast("double")
    return None


def curve_key(df: DataFrame, columns: list[str], bits: int = RANK_BITS) -> Column:
    """The Z-order key. The bounds of the ranges (2 ** ``bits`` - 1 numbers per
    column) come from one narrow pass over ``df``. NULLs rank lowest."""
    steps = [i / (1 << bits) for i in range(1, 1 << bits)]
    numbers = {c: _number(df, c) for c in columns}
    known = [c for c in columns if numbers[c] is not None]
    bounds = df.agg(*[F.percentile_approx(numbers[c], steps, ACCURACY).alias(c) for c in known]).first() if known else {}
    key = F.lit(0).cast("long")
    for j, c in enumerate(columns):
        if numbers[c] is None:
            rank = F.shiftrightunsigned(F.xxhash64(c), 64 - bits)
        else:
            v = numbers[c]
            rank = sum((F.coalesce(v > b, F.lit(False)).cast("long") for b in bounds[c] or []), F.lit(0).cast("long"))
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, i * len(columns) + j))
    return key


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int, bits: int = RANK_BITS,
                    bloom: list[str] | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` in about ``files`` files along the curve over ``columns``,
    with bloom filters for the columns ``bloom``. A value that a third of the
    rows share is cut along the other columns."""
    keyed = df.withColumn("_curve", curve_key(df, columns, bits))
    w = keyed.repartitionByRange(files, "_curve", *columns).sortWithinPartitions("_curve", *columns).drop("_curve") \
        .write.mode(mode)
    for c in bloom or []:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def file_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """``file, rows`` and ``lo_<c>``, ``hi_<c>`` of a stored layout: what a
    filter has to touch."""
    return df.groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
