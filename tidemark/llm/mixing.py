"""Mix sources to target weights in fixed-length blocks.

1. Each source's documents, laid end to end, form one stream of words that
   is cut into blocks of ``block`` words. A document's place is a prefix sum
   in two levels (hash bucket within the source, then document within the
   bucket), so no source is summed by one task.
2. Targets: the weights share the budget; a source stops at ``cap`` times its
   size and the excess is shared anew by weight (water filling in closed form
   over the table of sources).
3. Each output shard draws its sources: the whole part of the expected count
   is fixed and the remainder is drawn from a multinomial (residual
   resampling), seeded by the shard, so sums stay near their targets even in
   small mixes.
4. The k-th slot of a source takes block ``perm(k mod n)`` of epoch
   ``k div n``, where perm is a keyed Feistel permutation of the n blocks
   (own key per source and epoch): within an epoch no block comes twice.
   Numbers of slots are prefix sums in two levels too (groups of shards, then
   shards), and a source's slots are made by shard, at most ``TASK_SLOTS`` or
   a few shards in one task.
5. Slots and blocks meet in a join on (source, block); each key has at most
   ``cap`` slots and one block's documents, so no key of this join is hot.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, forgetting, staged

BUCKET_ROWS = 2_000
GROUP_SHARDS = 1_024
TASK_SLOTS = 1 << 22
_WORD = re.compile(WORD)


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5,
                   cap: int = 2) -> DataFrame:
    """(source, size) rows -> one row per source with its target.

    Sources in code point order, NULL last, take the weights in turn. The
    windows run over the table of sources, not over documents.
    """
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    src = src.withColumn("rank", F.row_number().over(order) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("rank") % len(weights) + 1).cast("int"))
    src = (src.withColumn("weight", w).withColumn("limit", F.col("source_size") * float(cap))
           .withColumn("fill", F.col("limit") / F.col("weight")))
    before = Window.orderBy("fill", "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # level: what a unit of weight gets if exactly the sources before are full
    src = src.withColumn("level", (
        F.sum("source_size").over(every) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    stop = F.min(F.when(F.col("fill") > F.col("level"),
                        F.struct("fill", "rank", "level"))).over(every)["level"]
    return src.withColumn("target", F.least("limit", F.coalesce(stop * F.col("weight"), F.col("limit")))) \
        .select("source", "rank", "weight", "source_size", "target")


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each index in a keyed pseudorandom permutation of range(n).

    Four Feistel rounds on the smallest even number of bits that holds n;
    values outside the range walk on through the cycle.
    """
    n = n.astype(np.uint64)
    half = np.ones(len(n), np.uint64)
    for bits in range(1, 32):
        half[n > (np.uint64(1) << np.uint64(2 * bits))] = np.uint64(bits + 1)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.ones(len(n), bool)
    with np.errstate(over="ignore"):
        while todo.any():
            h, m, k = half[todo], mask[todo], key.astype(np.uint64)[todo]
            left, right = out[todo] >> h, out[todo] & m
            for r in range(4):
                f = _mix64(right + k + np.uint64(r + 1) * np.uint64(0x9E3779B97F4A7C15)) & m
                left, right = right, left ^ f
            out[todo] = (left << h) | right
            todo = out >= n
    return out.astype(np.int64)


def _draw(seed: int):
    def draw(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", kind="stable")
        shard, shards = int(pdf["shard"].iloc[0]), int(pdf["shards"].iloc[0])
        expected = pdf["slots"].to_numpy(float) / shards
        whole = np.floor(expected)
        rest = expected - whole
        total = rest.sum()
        draws = int(np.floor((shard + 1) * total + 0.5) - np.floor(shard * total + 0.5))
        extra = np.zeros(len(rest), np.int64)
        if draws > 0:
            rng = np.random.Generator(np.random.Philox(key=[seed, shard]))
            extra = rng.multinomial(draws, rest / total)
        return pd.DataFrame({"shard": shard, "source_key": pdf["source_key"].to_numpy(),
                             "n": (whole + extra).astype(np.int64)})
    return draw


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights=(3, 1, 2), share: float = 1.5, cap: int = 2,
                block: int = 64, shard_slots: int = 65_536, seed: int = 17,
                row_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Returns ``(documents, mix)``.

    ``documents``: row, id, source, size, source_size, target.
    ``mix``: one row per piece of a document in a slot of the output: shard,
    epoch, source, block, row, from_word, n_words. The mix takes a document's
    words ``from_word .. from_word + n_words - 1``.

    ``row`` names an input row (``row_col``, or numbered here and written
    once), so repeated ids stay apart. NULL text has no words and, like an
    empty one, takes no part. NULL is a source of its own. Other columns are
    not looked at; an empty table gives empty results. A source of fewer
    words than a block is one short block, so its share is only as near to
    its target as whole copies allow; every other source is within about a
    block per shard. The same input gives the same mix on each run.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    row = F.monotonically_increasing_id() if row_col is None else F.col(row_col)
    sizes = staged(docs.select(row.alias("row"), F.col(id_col).alias("id"),
                               F.col(source_col).alias("source"), size.alias("size")), "mix_sizes")
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))
    src = staged(source_targets(sizes, weights, share, cap)
                 .withColumn("source_key", key)
                 .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long"))
                 .withColumn("slots", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks")
                                             / F.col("source_size")).otherwise(0.0)), "mix_sources")

    rows = sizes.count()
    buckets = max(1, -(-rows // BUCKET_ROWS))
    sized = (sizes.withColumn("source_key", key)
             .withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets))))
    filled = sized.filter("size > 0")
    base = filled.groupBy("source_key", "bucket").agg(F.sum("size").alias("bucket_size"))
    running = Window.partitionBy("source_key").orderBy("bucket")
    base = base.select("source_key", "bucket",
                       (F.sum("bucket_size").over(running) - F.col("bucket_size")).alias("base"))
    within = Window.partitionBy("source_key", "bucket").orderBy("id", "size", "row") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (filled.withColumn("local", F.sum("size").over(within) - F.col("size"))
              .join(base, ["source_key", "bucket"])
              .withColumn("at", F.col("base") + F.col("local")))
    pieces = (placed.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block))))
        .withColumn("lo", F.greatest(F.col("at"), F.col("block") * block))
        .withColumn("hi", F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * block))
        .select("source_key", "block", "row", (F.col("lo") - F.col("at")).alias("from_word"),
                (F.col("hi") - F.col("lo")).alias("n_words")))

    shards = F.greatest(F.lit(1), F.ceil(F.sum("slots").over(Window.partitionBy()) / shard_slots))
    wanted = (src.withColumn("shards", shards.cast("long"))
              .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
              .select("shard", "shards", "rank", "source_key", "slots"))
    drawn = staged(wanted.groupBy("shard").applyInPandas(_draw(seed), "shard long, source_key string, n long")
                   .withColumn("part", F.floor(F.col("shard") / GROUP_SHARDS)), "mix_drawn")
    parts = drawn.groupBy("source_key", "part").agg(F.sum("n").alias("part_n"))
    over_parts = Window.partitionBy("source_key").orderBy("part")
    parts = parts.select("source_key", "part", (F.sum("part_n").over(over_parts) - F.col("part_n")).alias("before"))
    upto = Window.partitionBy("source_key", "part").orderBy("shard")
    drawn = (drawn.withColumn("local", F.sum("n").over(upto) - F.col("n"))
             .join(parts, ["source_key", "part"])
             .join(src.select("source_key", "source", "rank", "blocks"), "source_key")
             .withColumn("first", F.col("before") + F.col("local"))
             .withColumn("n", F.least("n", F.col("blocks") * cap - F.col("first"))).filter("n > 0"))
    # the windows leave a source's rows together: deal them out before they grow
    total = src.agg(F.sum("slots")).first()[0] or 0.0
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-int(total) // TASK_SLOTS))
    slots = (drawn.repartition(tasks, "source_key", "shard")
             .withColumn("k", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1))))

    @F.pandas_udf("long")
    def place(index: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
        return pd.Series(permuted(index.to_numpy(), n.to_numpy(), key.to_numpy().astype(np.int64)))

    epoch = F.floor(F.col("k") / F.col("blocks"))
    slots = slots.withColumn("epoch", epoch).select(
        "shard", "epoch", "source", "source_key",
        place(F.col("k") % F.col("blocks"), "blocks",
              F.xxhash64(F.lit(seed), "source_key", "epoch")).alias("block"))
    # Spark takes slots for as small as the rows they are exploded from, and would broadcast them
    mix = slots.hint("merge").join(pieces, ["source_key", "block"]).drop("source_key")
    documents = sized.join(src.select("source_key", "source_size", "target"), "source_key") \
        .select("row", "id", "source", "size", "source_size", "target")
    return documents, mix


def taken_words(documents: DataFrame, mix: DataFrame) -> DataFrame:
    """``documents`` with ``taken``: words the mix takes, repeats counted."""
    taken = mix.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return documents.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **mix_args) -> DataFrame:
    """The mix as rows of ``docs``: per document and epoch one row whose text
    is the words taken in that epoch, in order, with the white space that
    follows each piece. Documents of which nothing is taken have no row.

    Rows are numbered in a written copy first, so the numbers are the same in
    every later read; column names that begin with ``_mix_`` are reserved.
    """
    copy = staged(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix_docs")
    _, mix = mix_sources(copy, id_col, text_col, source_col, row_col="_mix_row", **mix_args)
    taken = mix.groupBy(F.col("row").alias("_mix_row"), F.col("epoch").alias("_mix_epoch")).agg(
        F.array_sort(F.collect_list(F.struct("from_word", "n_words"))).alias("_mix_pieces"))

    @F.pandas_udf("string")
    def cut(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def taken(parts):
            for texts, pieces in parts:
                yield pd.Series([take_words(t, [(p["from_word"], p["n_words"]) for p in k])
                                 for t, k in zip(texts, pieces, strict=True)], dtype=object)
        return forgetting(lambda: None, taken)(parts)

    return (copy.join(taken, "_mix_row").withColumn(text_col, cut(text_col, "_mix_pieces"))
            .drop("_mix_row", "_mix_epoch", "_mix_pieces"))


def take_words(text: str, pieces: list[tuple[int, int]]) -> str:
    """The text's words in the (first, number) pieces, which are in order."""
    runs: list[list[int]] = []
    for first, n in pieces:
        if runs and runs[-1][1] == first:
            runs[-1][1] += n
        else:
            runs.append([first, first + n])
    starts = [m.start() for m in _WORD.finditer(text)]
    if runs == [[0, len(starts)]]:
        return text
    starts.append(len(text))
    return "".join(text[starts[a]:starts[b]] for a, b in runs)
