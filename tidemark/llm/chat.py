"""Chat formatting with cumulative-snapshot collapse.

Loggers often store a conversation again after each turn. A snapshot is
redundant if its turns are a prefix of a longer logged conversation.

1. Turns get their rank within the conversation in two levels (chunks of
   turn numbers, then within the chunk), so a conversation of any length is
   ranked by many tasks.
2. The hash of a prefix is the XOR over its turns of a hash of (rank, role,
   text), twice with different seeds: 128 bits. XOR combines in any order, so
   prefix hashes are running XORs within a chunk joined to the XOR of the
   chunks before.
3. Conversations are grouped by (turns, full hash); of equal ones the smallest
   id stays. An anti-join with the distinct proper prefixes (turns, hash) of
   all conversations leaves the maximal ones: both sides are distinct in the
   join key, so an opening that a third of all conversations share is one row.
4. Only maximal conversations are rendered.

Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

CHUNK_TURNS = 256

# fixed values: the chat template that training code expects
TURN_START, TURN_MID, TURN_END = "<|im_start|>", "\n", "<|im_end|>\n"


def ranked_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
                 chunk_turns: int) -> DataFrame:
    """conv, rank (from 1), chunk, role, text, h1, h2 per turn."""
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter(F.col("conv").isNotNull())
    rows = rows.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / chunk_turns), F.lit(-(1 << 62))))
    sizes = rows.groupBy("conv", "chunk").count()
    before = sizes.select("conv", "chunk", (F.sum("count").over(
        Window.partitionBy("conv").orderBy("chunk")) - F.col("count")).alias("before"))
    local = F.row_number().over(Window.partitionBy("conv", "chunk")
                                .orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    ranked = (rows.withColumn("local", local).join(before, ["conv", "chunk"])
              .withColumn("rank", F.col("before") + F.col("local")))
    return ranked.select("conv", "chunk", "rank", "role", "text",
                         F.xxhash64("rank", "role", "text").alias("h1"),
                         F.xxhash64(F.lit(7), "rank", "role", "text").alias("h2"))


def maximal_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                          role_col: str = "role", text_col: str = "text",
                          chunk_turns: int = CHUNK_TURNS) -> tuple[DataFrame, DataFrame]:
    """``(turns, conversations)``: ranked turns, and the ids that stay with
    their number of turns and of equal copies."""
    ranked = staged(ranked_turns(turns, conv_col, turn_col, role_col, text_col, chunk_turns), "chat_turns")
    hashed = ranked.select("conv", "chunk", "rank", "h1", "h2")
    chunks = hashed.groupBy("conv", "chunk").agg(F.bit_xor("h1").alias("c1"), F.bit_xor("h2").alias("c2"))
    upto = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chunks = chunks.select("conv", "chunk", F.bit_xor("c1").over(upto).bitwiseXOR(F.col("c1")).alias("b1"),
                           F.bit_xor("c2").over(upto).bitwiseXOR(F.col("c2")).alias("b2"))
    inside = Window.partitionBy("conv", "chunk").orderBy("rank") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prefixes = (hashed.withColumn("p1", F.bit_xor("h1").over(inside)).withColumn("p2", F.bit_xor("h2").over(inside))
                .join(chunks, ["conv", "chunk"])
                .select("conv", "rank", F.col("p1").bitwiseXOR(F.col("b1")).alias("p1"),
                        F.col("p2").bitwiseXOR(F.col("b2")).alias("p2")))
    whole = hashed.groupBy("conv").agg(F.count(F.lit(1)).alias("n_turns"), F.bit_xor("h1").alias("p1"),
                                       F.bit_xor("h2").alias("p2"))
    proper = (prefixes.join(whole.select("conv", "n_turns"), "conv").filter("rank < n_turns")
              .select(F.col("rank").alias("n_turns"), "p1", "p2").distinct())
    classes = whole.groupBy("n_turns", "p1", "p2").agg(F.min("conv").alias("conv"),
                                                       F.count(F.lit(1)).alias("n_copies"))
    return ranked, classes.join(proper, ["n_turns", "p1", "p2"], "left_anti").select("conv", "n_turns", "n_copies")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text",
                 chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """``conv_col, n_turns, n_copies, chat``: one row per maximal conversation.

    A turn renders as start mark, role, line end, text, end mark. Turns are
    ordered by number (NULL first), ties by role and text, so repeated rows
    are repeated turns. NULL roles and texts count as empty. Turns without a
    conversation id are left out: they belong to no conversation. Other
    columns are not looked at; an empty table gives an empty result. A
    conversation's rendering is one value, so it has to fit one row.
    """
    ranked, kept = maximal_conversations(turns, conv_col, turn_col, role_col, text_col, chunk_turns)
    kept = staged(kept, "chat_kept")
    piece = F.concat(F.lit(TURN_START), "role", F.lit(TURN_MID), "text", F.lit(TURN_END))
    pieces = ranked.join(kept.select("conv"), "conv", "left_semi").select("conv", "rank", piece.alias("piece"))
    chats = pieces.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("rank", "piece"))), lambda x: x["piece"]), "").alias("chat"))
    return kept.join(chats, "conv").select(F.col("conv").alias(conv_col), "n_turns", "n_copies", "chat")
