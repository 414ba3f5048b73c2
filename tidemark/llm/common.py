"""Helpers that several operators of this package share.

Words, here and in every operator: maximal runs of characters other than
space and U+0009 to U+000D, which is what ``bytes.split()`` returns.
"""

from __future__ import annotations

import ctypes
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"

# A slot filter has 2**26 one-bit slots in at most 2048 rows of 4 KB: 8 MB
# whatever the number of keys, so broadcasting it is safe at any size.
SLOTS = 1 << 26
ROW_SLOTS = 1 << 15

BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2_000


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python tasks in batches of ``BATCH_ROWS`` rows at most, in
    this session from now on: both sides of the pipe hold whole batches."""
    if not 0 < int(spark.conf.get(BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage,
    computes the frame once, and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def told_apart(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``df`` with a long ``_row`` that, beside the id, names each row.

    It is the hash of id and text; only if rows agree in id and hash, they are
    numbered in a written copy, so that the numbers are the same in every
    later read.
    """
    named = df.withColumn("_row", F.xxhash64(id_col, text_col))
    if named.groupBy(id_col, "_row").count().filter("count > 1").limit(1).isEmpty():
        return named
    return staged(df.withColumn("_row", F.monotonically_increasing_id()), "numbered_rows")


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(SLOTS))


def slot_filter(keys: DataFrame, key: Column) -> DataFrame:
    """One bit per slot that some (64-bit integer) key falls in."""
    slot = _slot(key)
    return (keys.select(F.shiftright(slot, 15).alias("_bucket"),
                        (slot % ROW_SLOTS).alias("_pos"))
            .repartition("_bucket").groupBy("_bucket")
            .agg(F.bitmap_construct_agg("_pos").alias("_bits")))


def with_slot_flag(df: DataFrame, bits: DataFrame, key: Column, name: str) -> DataFrame:
    """Add a boolean: the key's slot is set. False is certain; true may be
    another key in the same slot, so an exact step has to follow."""
    out = (df.withColumn("_slot", _slot(key))
           .withColumn("_bucket", F.shiftright("_slot", 15))
           .join(F.broadcast(bits), "_bucket", "left"))
    byte = F.expr(f"cast(conv(hex(substring(_bits, cast(_slot % {ROW_SLOTS} div 8 as int) + 1, 1)), 16, 10) as int)")
    bit = F.expr("cast(_slot % 8 as int)")
    flag = F.coalesce((byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), bit))) != 0, F.lit(False))
    return out.withColumn(name, flag).drop("_slot", "_bucket", "_bits")


class Memo(dict):
    """Remembers ``fn(key)`` for recent keys inside one Python worker.

    Two generations of at most ``limit`` keys each, so memory is bounded on
    any vocabulary; call ``trim`` between documents.
    """

    def __init__(self, fn, limit: int = 400_000):
        super().__init__()
        self.fn, self.limit, self.old = fn, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.fn(key)
        self[key] = value
        return value

    def trim(self):
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


    def forget(self):
        self.clear()
        self.old = {}


def release_memory() -> None:
    """Give memory that is free inside this process back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def forgetting(forget, run):
    """``run`` over a task's batches, then ``forget()``: Python workers are used
    again by other tasks, which should not start with its memory."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            forget()
            release_memory()
    return task


def slot_bytes(bits: DataFrame):
    """A slot filter as one byte array for use in Python tasks: 8 MB always."""
    import numpy as np

    out = np.zeros((SLOTS // ROW_SLOTS, ROW_SLOTS // 8), np.uint8)
    for row in bits.collect():  # at most SLOTS / ROW_SLOTS rows
        out[row["_bucket"]] = np.frombuffer(row["_bits"], np.uint8)
    return out.ravel()


def in_slots(table, keys):
    """Which of the int64 ``keys`` fall in a set slot."""
    import numpy as np

    slot = keys.astype(np.int64) % SLOTS
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
