"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

1. One scan keeps (length in bytes, hash of the first characters) per row.
   Lengths that occur once are settled.
2. Of the rest, (length, prefix hash) pairs that occur once are settled.
3. The surviving pairs become a slot filter of fixed size. A second scan
   reads full content only for rows whose slot is set, and groups those by
   SHA-256. Rows that the filter lets through without need end up in groups
   of one, so it only saves work.

No text is ever shuffled, only lengths and digests; counts and the largest
id are combined before each shuffle, so a group with a third of all rows is
no hot spot, and the join that hands each row its group's verdict carries
(id, digest) alone and can be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, slot_filter, staged, with_slot_flag

PREFIX_CHARS = 64


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, digest``.

    Texts are equal when identical after lower-casing A-Z. The row with the
    largest id stays. ``digest`` is the SHA-256 of the normalised text as
    binary; for rows settled before the last step it is null unless
    ``digest_all``.

    NULL text counts as the empty text; empty texts are equal to each other.
    Ids are taken as keys: rows that share the id which stays are all kept.
    A NULL id never beats another id; a group of NULL ids only keeps them.
    Other columns are not looked at. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("_id"), text.alias("_text"))
    shape = (F.octet_length("_text").alias("_len"),
             F.xxhash64(lower_ascii(F.substring("_text", 1, prefix_chars))).alias("_prefix"))

    shapes = staged(rows.select(*shape), "exact_dedup_shapes")
    lengths = shapes.groupBy("_len").count().filter("count > 1").select("_len")
    pairs = (shapes.join(lengths, "_len", "left_semi").groupBy("_len", "_prefix").count()
             .filter("count > 1"))
    pair_key = F.xxhash64("_len", "_prefix")
    bits = slot_filter(pairs, pair_key)

    flagged = with_slot_flag(rows.select("*", *shape), bits, pair_key, "_open")
    full = F.unhex(F.sha2(lower_ascii(F.col("_text")), 256))
    settled = staged(flagged.select(
        "_id", "_open",
        (full if digest_all else F.when(F.col("_open"), full)).alias("digest")), "exact_dedup_digests")

    survivors = settled.filter("_open")
    groups = survivors.groupBy("digest").agg(F.max("_id").alias("keep_id"),
                                             F.count(F.lit(1)).alias("group_size"))
    judged = survivors.join(groups, "digest").select("_id", "keep_id", "group_size", "digest")
    single = settled.filter("not _open").select(
        "_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")
    return judged.unionByName(single).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
