"""Enriching events with user attributes, with skew in mind.

* ``latest_per_key`` deduplicates a dimension with ``max_by`` - an
  aggregate, so a key with a third of all copies is collapsed map-side
  instead of landing whole in one window partition.
* ``enrich`` picks the join strategy: checked broadcast (by the bytes that the
  dimension takes in memory, measured by one pass over it), shuffle hash,
  sort-merge, or salted.
* ``enrich_salted`` spreads the measured hot keys over several shuffle
  partitions in one join: hot facts take a salt from a hash of a row column
  (deterministic, so task retries see the same salt), hot dimension rows are
  replicated once per salt, everything else has salt 0. Which keys are hot
  and how many salts each gets follow from its share of the rows: a key with
  a third of them in a job of 3,000 tasks gets 1,000 salts. Keys with a share
  of at least 1/n are at most n, which bounds the broadcast list.
* ``segment_activity`` aggregates events per user *before* the join, so
  the join and the final group-by see one row per user, not per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 << 20


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per ``key``.

    Ties on ``order`` are broken by the remaining columns, so the choice
    does not depend on partitioning. One aggregate, partial map-side; the
    row travels once, with its order columns in front.
    """
    rest = [c for c in df.columns if c != key]
    ranked = [*order, *[c for c in rest if c not in order]]
    packed = df.groupBy(key).agg(F.max(F.struct(*ranked)).alias("_row"))
    return packed.select(key, *[F.col("_row")[c].alias(c) for c in rest])


ROW_OVERHEAD = 64


def memory_bytes(df: DataFrame) -> int:
    """Bytes that a frame takes as rows in memory: 8 per field and an overhead
    per row, and the bytes of its strings and binaries as they are, not as
    they are compressed in files. One aggregate over the frame; columns of
    nested types count with the length of their JSON text."""
    size = F.lit(ROW_OVERHEAD + 8 * len(df.columns))
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary", "varchar", "char"):
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0))
        elif kind in ("array", "map", "struct"):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0))
    return df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("b")).first()["b"]


def hot_keys(df: DataFrame, key: str, k: int | None = 10, min_share: float = 0.0) -> DataFrame:
    """Top-``k`` keys by row count (all, if ``None``) with their share of all rows.

    ``key, events, share``; the total comes from a scalar subquery. The
    top-k keeps at most ``k`` rows per partition before merging.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = (df.where(F.col(key).isNotNull())
              .groupBy(key).agg(F.count(F.lit(1)).alias("events"))
              .withColumn("share", F.col("events") / total))
    if min_share > 0:
        counts = counts.where(F.col("share") >= F.lit(min_share))
    return counts if k is None else counts.orderBy(F.desc("events"), F.asc(key)).limit(k)


SALTABLE = ("inner", "left", "left_outer", "leftouter", "left_semi", "left_anti")


def hot_key_salts(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """``key, salts``: keys with more than an even task's share of the rows
    (1 / ``partitions``) and the number of slices that brings each back to
    it. At most ``partitions`` rows. The frame is read once: the total is the
    sum of the counts."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("t")).scalar()
    share = F.col("_n") / total
    return (counts.where(F.col(key).isNotNull() & (share >= 1.0 / partitions))
            .select(key, F.ceil(share * partitions).cast("int").alias("salts")))


def enrich(facts: DataFrame, dim: DataFrame, key: str, how: str = "left",
           strategy: str = "auto", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
           salt_col: str | None = None) -> DataFrame:
    """Join facts with a dimension that has one row per ``key``.

    ``strategy``:

    * ``auto`` - a plain join: Catalyst plans it from file statistics and
      AQE re-plans it from the real shuffle sizes (broadcast only below
      ``spark.sql.adaptive.autoBroadcastJoinThreshold``; skewed
      sort-merge partitions are split);
    * ``broadcast`` - broadcast hint if the dimension takes at most
      ``max_broadcast_bytes`` in memory; beyond it the join is ``auto``;
    * ``shuffle_hash`` / ``merge`` - join hints;
    * ``salted`` - see ``enrich_salted``.
    """
    if strategy == "auto":
        return facts.join(dim, key, how)
    if strategy == "broadcast":
        return facts.join(F.broadcast(dim) if memory_bytes(dim) <= max_broadcast_bytes else dim, key, how)
    if strategy in ("shuffle_hash", "merge"):
        return facts.join(dim.hint(strategy), key, how)
    if strategy == "salted":
        if salt_col is None:
            raise ValueError("salted strategy needs a salt column")
        return enrich_salted(facts, dim, key, salt_col, how)
    raise ValueError(f"unknown strategy {strategy!r}")


def enrich_salted(facts: DataFrame, dim: DataFrame, key: str, salt_col: str, how: str = "left",
                  partitions: int | None = None) -> DataFrame:
    """Salted join for the hot keys only; equals the plain join.

    ``partitions`` is the number of tasks whose even share makes a key hot
    (default: the session's shuffle partitions). Facts without a key match
    nothing; they are spread by salt. Joins that keep unmatched dimension
    rows (right, full) would keep each replica, so they are refused.
    """
    if how not in SALTABLE:
        raise ValueError(f"a salted join cannot be {how!r}: one of {SALTABLE}")
    n = partitions or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = F.broadcast(hot_key_salts(facts, key, n))
    slices = F.when(F.col(key).isNull(), F.lit(n)).otherwise(F.coalesce("salts", F.lit(1)))
    f = facts.join(salts, key, "left").withColumn("_salt", F.pmod(F.xxhash64(salt_col), slices)).drop("salts")
    d = (dim.join(salts, key, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                   F.coalesce("salts", F.lit(1)).cast("long") - 1)))
         .drop("salts"))
    return f.join(d, [key, "_salt"], how).drop("_salt")


def segment_activity(facts: DataFrame, dim: DataFrame, key: str, segments: list[str],
                     measure: str, how: str = "left") -> DataFrame:
    """Events, distinct users and mean measure per segment.

    Facts are first reduced to one row per user (map-side partial
    aggregate), so the join moves users, not events.
    """
    per_user = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_events"),
                                      F.count(measure).alias("_n_measure"),
                                      F.sum(measure).alias("_sum_measure"))
    joined = enrich(per_user, dim.select(key, *segments), key, how, "auto")
    return (joined.groupBy(*segments)
            .agg(F.sum("_events").alias("events"),
                 F.count(key).alias("users"),
                 (F.sum("_sum_measure") / F.sum("_n_measure")).alias("avg_measure")))
