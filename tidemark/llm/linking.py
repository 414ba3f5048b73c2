"""Connected components, and links found through shared keys.

Both work on narrow rows of 64-bit ids and never bring a group together in
one task: minima are combined before each shuffle, and the joins that hand
them back can be split by AQE. Lineage is cut by tables written in the shared
scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

MAX_ROUNDS = 60
# pairs are dealt over 16 parts by a hash; these are tested one slice after the other
SLICES = ((0, 1), (1, 4), (4, 16))


def _is_stars(edges: DataFrame) -> bool:
    """Each id has one link down at most, and none of those it leads to has one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    per_id = ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per_id.filter("down + up > 1 and down > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``id, comp``: the smallest id that each id reaches, for all that reach a
    smaller one than themselves.

    Alternating large-star and small-star steps: each hooks the neighbours of
    an id to the smallest among them, until every component is a star. The
    number of rounds is logarithmic in practice.
    """
    cur = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .filter("u != v").distinct(), "cc")
    for _ in range(MAX_ROUNDS):
        if _is_stars(cur):
            break
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # every id but the smallest of a star keeps a link down
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select("u", F.col("m").alias("v"))
                 .unionByName(small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))))
        cur = staged(small.distinct(), "cc")
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("id"), F.col("v").alias("comp"))


def link_groups(members: DataFrame, verify: Callable[[DataFrame], DataFrame],
                refine: Callable[[DataFrame], DataFrame] | None = None,
                fits: Callable[[str, str], Column] | None = None, few_keys: bool = False) -> DataFrame:
    """Components of the links among ids that share a key: ``id, comp``.

    ``members`` has (key, id); two ids may be linked only if they share a key,
    and ``verify`` keeps of (a, b) pairs those that are. Only connectivity is
    asked for, so a pair within one component is never tested:

    1. each id is tested against one hub, the smallest id of its keys;
    2. keys that now hold one component are done. For the ids of the others,
       ``refine`` may give new, more telling (key, id) rows under the same
       promise: ids that may be linked share a key. Its other columns stay;
    3. keys that still hold several components test their members against the
       key's smallest id, then its largest;
    4. for keys that still do, pairs across components are tested in slices,
       a sixteenth of them first. Links of a slice join components, and pairs
       within one are not even formed in the next. ``fits`` names what must
       hold for the rows of a pair in at least one key they share, given the
       prefixes of the two rows' columns. With ``few_keys`` (an id has some
       hundred at most) rows carry their id's smaller keys, and a pair is
       formed under the smallest key it shares alone; ``fits`` must then
       depend on the two ids only, not on the key.

    A family that its hubs link costs about n tests for n ids, and one that is
    linked in other ways grows together over the slices. Every pair is formed
    in one slice unless its ids are in one component by then, so no link
    between two components is lost.
    """
    hubs = members.groupBy("key").agg(F.min("id").alias("hub"))
    pairs = (members.join(hubs, "key").groupBy("id").agg(F.min("hub").alias("hub"))
             .select(F.col("id").alias("a"), F.col("hub").alias("b")))
    tested = labels = None
    for step in ("hub", "min", "max", *SLICES):
        if step != "hub":
            live = _live(members, labels, step)
            if step == "min" and refine is not None:
                members = staged(refine(live.select("id").distinct()), "link_refined")
                live = _live(members, labels, step)
            if step == SLICES[0] and few_keys:
                live = _with_smaller_keys(live)
            live = staged(live, "link_live")
            if live.isEmpty():
                break
            members = live.drop("comp", "hub")
            pairs = _pairs_of_slice(live, step, fits) if step in SLICES else (
                live.filter(F.col("comp") != F.col("hub.comp")).select(F.col("id").alias("a"), F.col("hub.id").alias("b")))
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
            .filter("a != b").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = staged(pairs, "link_pairs")
        if labels is not None and pairs.isEmpty():
            continue
        found = staged(verify(pairs).select("a", "b"), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        if labels is not None:
            if found.isEmpty():
                continue
            # stars stand for the components found so far
            found = found.unionByName(labels.select(F.col("id").alias("a"), F.col("comp").alias("b")))
        labels = components(found)
    return labels


def _live(members: DataFrame, labels: DataFrame, step) -> DataFrame:
    """Members of keys that hold several components, with their component and
    the key's hub: its smallest id, or its largest in step ``max``."""
    placed = members.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    hub = (F.max if step == "max" else F.min)(F.struct("id", "comp"))
    keys = (placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), hub.alias("hub"))
            .filter("lo != hi").drop("lo", "hi"))
    return placed.join(keys, "key")


def _with_smaller_keys(live: DataFrame) -> DataFrame:
    """``live`` with ``before``, the smaller keys of the row's id. It is taken
    once: keys that are done later have all their ids in one component."""
    smaller = Window.partitionBy("id").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    return live.withColumn("before", F.collect_list("key").over(smaller))


def _pairs_of_slice(live: DataFrame, parts: tuple[int, int], fits) -> DataFrame:
    """Pairs across components in the parts of this slice; the rule and the
    slice are conditions of the join, so no other pair is ever a row."""
    a, b = (live.drop("hub").select("key", *[F.col(c).alias(p + c) for c in live.columns if c not in ("key", "hub")])
            for p in ("a_", "b_"))
    across = F.col("a_comp") != F.col("b_comp")
    rule = (F.col("a_id") < F.col("b_id")) if fits is None else fits("a_", "b_")
    part = F.pmod(F.xxhash64(F.least("a_id", "b_id"), F.greatest("a_id", "b_id")), F.lit(16))
    now = (part >= parts[0]) & (part < parts[1])
    if "before" in live.columns:  # under a smaller key the pair is formed already
        now &= ~F.arrays_overlap("a_before", "b_before")
    return (a.join(b, (a["key"] == b["key"]) & across & rule & now)
            .select(F.col("a_id").alias("a"), F.col("b_id").alias("b")))
