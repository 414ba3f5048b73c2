"""Exact Jaccard self-join on word shingles by partitioning the universe.

Two sets of sizes a and b with Jaccard similarity of 80 % or more differ in at
most H = (a + b) div 9 elements. Hash every element into one of m segments:
if m is larger than H, some segments hold the same elements in both sets
(pigeonhole), so sharing a segment's hash is necessary for a link.

* Size bands. Set sizes are cut into bands, each 1.25 times the last, with
  their own m. A set is indexed in its own band and probes the band below if
  that can hold partners; no other band can.
* One-deletion neighbourhoods. A segment can also emit a hash for each of its
  elements left out; it then matches across one difference, and H div 2 + 1
  segments are enough. Fewer, larger segments are more telling, but cost a row
  per element. Each band takes the cheaper way by expected rows plus expected
  segments too small to tell anything (Poisson).
* Cost-based allocation. m is larger than needed by a slack that each set may
  spend on segments it does not index: both sides can leave out half of
  m - 1 - H and still share one. Empty segments go first, then, when list
  lengths are known, the segments that most other sets share, such as those of
  a passage that many documents contain.
* Candidates are verified exactly on the shingles (64-bit hashes).

Equal sets are one class from the start, so copies cost nothing later on;
links and components run over classes (see ``linking``): no pair inside a
component is tested and none is listed. Classes whose segments link them to
several components without a link are narrowed by their rarest shingles. A class is named by a 63-bit hash of
its set.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, forgetting, slot_filter, small_batches, staged, with_slot_flag
from tidemark.llm.linking import link_groups
from tidemark.llm.packed import PACK_ROWS, bin_bits, bins_of, pack, unpack

WORDS = 5
SEEN = 200_000

_M1, _M2, _M3, _M4 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9,
                                             0x94D049BB133111EB, 0xD6E8FEB86659FD93))
_word_hash = Memo(xxhash.xxh64_intdigest, 100_000)


def forget_words() -> None:
    _word_hash.forget()


def mix(x: np.ndarray) -> np.ndarray:
    out = x >> np.uint64(30)
    out ^= x
    out *= _M2
    out ^= out >> np.uint64(27)
    out *= _M3
    out ^= out >> np.uint64(31)
    return out


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Distinct hashes of the runs of ``words`` words (A-Z lower-cased); of a
    shorter text the whole sequence; nothing for a text without words."""
    cut = text.lower().split()
    n = len(cut)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_word_hash.__getitem__, cut), np.uint64, n)
    _word_hash.trim()
    run = min(n, words)
    with np.errstate(over="ignore"):
        out = np.full(n - run + 1, run, np.uint64)
        for j in range(run):
            out = out * _M1 + h[j:n - run + 1 + j]
            out ^= out >> np.uint64(32)
    return np.unique(mix(out))


@lru_cache(maxsize=None)
def band_start(b: int) -> int:
    """Smallest size in band b; band 0 starts at one element."""
    return 1 if b == 0 else max(band_start(b - 1) + 1, math.ceil(1.25 * band_start(b - 1)))


@lru_cache(maxsize=100_000)
def band_of(n: int) -> int:
    b = 0
    while band_start(b + 1) <= n:
        b += 1
    return b


@lru_cache(maxsize=None)
def band_plan(b: int) -> tuple[bool, int]:
    """(one-deletion neighbourhoods?, segments) for sets indexed in band b."""
    top = band_start(b + 1) - 1
    h = (top + (5 * top) // 4) // 9
    slack = max(1, round(0.05 * h))
    plain, pairs = h + 1 + 2 * slack, h // 2 + 1 + 2 * (slack // 2)
    if h == 0:
        return False, 1

    def weak(m):  # expected segments with one element or none
        mean = top / m
        return m * math.exp(-mean) * (1 + mean)

    return (True, pairs) if top + pairs + 10 * weak(pairs) < plain + 10 * weak(plain) else (False, plain)


def segment_hashes(sh: np.ndarray, band: int, h: int) -> tuple[np.ndarray, int]:
    """Hashes that a set shows in a band when it may differ in up to ``h``
    elements, and how many more of them it may leave out."""
    deletions, m = band_plan(band)
    with np.errstate(over="ignore"):
        spread = mix(sh + np.uint64(band) * _M4)
        seg = (spread % np.uint64(m)).astype(np.int64)
        value = mix(spread ^ _M1)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, seg, value)
        empty = np.bincount(seg, minlength=m) == 0
        spare = (m - 1 - (h // 2 if deletions else h)) // 2
        drop = np.flatnonzero(empty)[:spare]
        keep = np.ones(m, bool)
        keep[drop] = False
        name = np.arange(m, dtype=np.uint64) * _M3 + np.uint64(band) * _M2 + np.uint64(1)
        out = mix(sums + mix(name))[keep]
        if deletions:
            left = mix(sums[seg] - value + mix(name[seg]))[keep[seg]]
            return np.unique(np.concatenate([out, left])), 0
        return out, spare - len(drop)


def signature_rows(sh: np.ndarray):
    """(role, hashes, spare) in the set's own band and the one below."""
    n = len(sh)
    b = band_of(n)
    yield 0, *segment_hashes(sh, b, (n + (5 * n) // 4) // 9)
    if b and 5 * (band_start(b) - 1) >= 4 * n:
        yield 1, *segment_hashes(sh, b - 1, (n + band_start(b) - 1) // 9)


def class_name(sh: np.ndarray) -> int:
    """63-bit name of a set, even, so that the last bit can carry the role."""
    with np.errstate(over="ignore"):
        x = mix(np.array([mix(sh ^ _M4).sum(dtype=np.uint64) + np.uint64(len(sh))], np.uint64))
    return int(x.view(np.int64)[0]) & ~1


def _emit(words: int, bits: int):
    """Per document one row (id, cls, n = its size) and, for the first of equal
    sets in a task, its hashes packed with cls + role and spare."""
    def run(batches):
        seen: set[int] = set()
        keys, owners, spares, held = [], [], [], 0
        turn = 0
        for b in batches:
            docs, names, sizes = b.column(0), [], []
            for text in (t for lo in range(0, b.num_rows, 64) for t in b.column(1).slice(lo, 64).to_pylist()):
                sh = shingles(text, words)
                name = class_name(sh) if len(sh) else 0
                names.append(name)
                sizes.append(len(sh))
                if len(sh) and name not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(name)
                    for role, h, spare in signature_rows(sh):
                        keys.append(h)
                        owners.append(np.full(len(h), name | role, np.int64))
                        spares.append(np.full(len(h), spare, np.int32))
                        held += len(h)
                if held > PACK_ROWS:
                    yield _packed(bits, keys, owners, spares)
                    keys, owners, spares, held = [], [], [], 0
            n = b.num_rows
            bins = (turn + np.arange(n)) % (1 << bits)  # documents are dealt in turn
            turn += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(bins, pa.int32()), pa.nulls(n, pa.binary()), docs.cast(pa.int64()),
                 pa.array(names, pa.int64()), pa.array(sizes, pa.int32())], names=PACKED)
        if held:
            yield _packed(bits, keys, owners, spares)
    return run


PACKED = ["bin", "data", "id", "cls", "n"]


def _packed(bits: int, keys, owners, spares) -> pa.RecordBatch:
    bins, data = pack(bits, np.concatenate(keys), np.concatenate(owners), np.concatenate(spares))
    n = len(bins)
    return pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), pa.array(data, pa.binary()), pa.nulls(n, pa.int64()),
                                       pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())], names=PACKED)


def _rows(key, cls, spare) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(cls), pa.array(spare)], names=["key", "cls", "spare"])


def shared_keys(key: np.ndarray, cls: np.ndarray, spare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a bin's rows, once each, the hashes that two sets or more show."""
    for _ in range(2):  # keys of several rows, and then of several sets
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        order = order[np.append(same, False)[:len(key)] | np.append(False, same)[:len(key)]]
        order = order[np.lexsort((cls[order], key[order]))]
        key, cls, spare = key[order], cls[order], spare[order]
        fresh = np.append(True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))[:len(key)]
        key, cls, spare = key[fresh], cls[fresh], spare[fresh]
    return key, cls, spare


def shared_only(bits: int):
    """Of packed rows sorted by bin: documents (spare = -1 - size), and the
    hashes of two sets or more."""
    def rows(which, data):
        key, cls, spare = shared_keys(*unpack(bits, which, data, np.int64, np.int32))
        return _rows(key.view(np.int64), cls, spare)

    def run(batches):
        waiting: list = []
        for b in batches:
            docs = b.column(1).is_null()
            if docs.true_count:
                yield _rows(*(c.filter(docs) for c in (b.column(2), b.column(3), _negated(b.column(4)))))
            hashes = b.filter(b.column(1).is_valid())
            for found in bins_of(hashes.column(0), hashes.column(1), waiting):
                yield rows(*found)
        if waiting:
            yield rows(*waiting)
    return run


def _negated(sizes: pa.Array) -> pa.Array:
    return pc.subtract(pa.scalar(-1, pa.int32()), sizes)


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = WORDS) -> DataFrame:
    """``id_col, n_shingles, component_id, class_id``: one row per input row.

    ``component_id`` is the smallest id reachable over links (Jaccard
    similarity of 80 % or more), the row's own included; rows of one
    ``class_id`` have equal sets. NULL, empty and blank texts have no set and
    are linked with nothing. A NULL id is never a component's name unless all
    its ids are NULL. Repeated ids are separate rows with equal or different
    sets like any others. Ids are whole numbers; other columns are not looked
    at; an empty table gives an empty result.
    """
    small_batches(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("_id"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    bits = bin_bits(df.sparkSession)
    shape = "bin int, data binary, id long, cls long, n int"
    rows = staged(docs.mapInArrow(forgetting(forget_words, _emit(words, bits)), shape)
                  .repartition("bin").sortWithinPartitions("bin")
                  .mapInArrow(forgetting(lambda: None, shared_only(bits)), "key long, cls long, spare int"), "jaccard_rows")
    sized = rows.filter("spare < 0").select(F.col("key").alias("id"), "cls", (-1 - F.col("spare")).alias("n"))

    hashes = rows.filter("spare >= 0")
    counts = hashes.groupBy("key").agg(F.count(F.lit(1)).alias("shared"))
    dearest = Window.partitionBy("cls").orderBy(F.desc("shared"), "key")
    members = (hashes.join(counts, "key").withColumn("r", F.row_number().over(dearest))
               .filter(F.col("r") > F.col("spare"))
               .select("key", F.col("cls").bitwiseAND(F.lit(-2)).alias("id")))
    left = members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key")
    members = staged(members.join(left, "key", "left_semi"), "jaccard_members")

    # the shingles of one document per class that has a candidate
    asked = members.select(F.col("id").alias("cls")).distinct()
    shown = sized.filter("n > 0").groupBy("cls").agg(F.min("id").alias("id")).join(asked, "cls")
    bits = slot_filter(shown.select("id"), F.xxhash64("id"))
    some = with_slot_flag(docs, bits, F.xxhash64("_id"), "_asked").filter("_asked")

    def sets(batches):
        for b in batches:
            sh = [shingles(t, words) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_name(s) for s in sh], pa.int64()),
                 pa.array([s.view(np.int64) for s in sh], pa.list_(pa.int64()))], names=["cls", "set"])

    found = some.select("_text").mapInArrow(forgetting(forget_words, sets), "cls long, set array<long>").join(asked, "cls", "left_semi")
    found = staged(found.groupBy("cls").agg(F.first("set").alias("set")), "jaccard_sets")

    def verify(pairs: DataFrame) -> DataFrame:
        a = found.select(F.col("cls").alias("a"), F.col("set").alias("sa"))
        b = found.select(F.col("cls").alias("b"), F.col("set").alias("sb"))
        sizes = found.select("cls", F.size("set").alias("n"))
        near = (pairs.join(sizes.select(F.col("cls").alias("a"), F.col("n").alias("na")), "a")
                .join(sizes.select(F.col("cls").alias("b"), F.col("n").alias("nb")), "b")
                .filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * 80))
        both = F.size(F.array_intersect("sa", "sb"))
        return (near.join(a, "a").join(b, "b").withColumn("both", both)
                .filter(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * 80))

    def rarest(ids: DataFrame) -> DataFrame:
        """Prefix filter for the ids whose segments left them open, such as
        texts around one common passage: in any one order of all shingles,
        two linked sets share one among their first n - ceil(0.8 n) + 1.
        Ordered by how many open sets hold them, the passage comes last."""
        rows = found.join(ids.withColumnRenamed("id", "cls"), "cls").select(
            F.col("cls").alias("id"), F.size("set").alias("n"), F.explode("set").alias("key"))
        held = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
        first = Window.partitionBy("id").orderBy("c", "key")
        rows = (rows.join(held, "key").withColumn("r", F.row_number().over(first))
                .filter(F.col("r") <= F.col("n") - F.ceil(F.col("n") * 80 / 100) + 1))
        return rows.filter("c > 1").select("key", "id", "n", "r")

    def fits(a: str, b: str) -> Column:
        """Positions: of the shingles that two linked sets share, the first in
        the order of ``rarest`` stands at r in each, and no more than n - r
        can follow it there. Both must reach the overlap that 80 % of their
        sizes asks for. ``a`` is the smaller set."""
        na, nb, ra, rb = (F.col(p + c) for c in ("n", "r") for p in (a, b))
        smaller = (na < nb) | ((na == nb) & (F.col(a + "id") < F.col(b + "id")))
        near = 9 * (1 + F.least(na - ra, nb - rb)) >= 4 * (na + nb)
        return smaller & (na * 100 >= nb * 80) & near

    labels = link_groups(members, verify, rarest, fits).select(F.col("id").alias("cls"), "comp")
    linked = (sized.filter("n > 0").join(labels, "cls", "left")
              .withColumn("comp", F.coalesce("comp", "cls")))
    names = linked.groupBy("comp").agg(F.min("id").alias("component_id"))
    out = linked.join(names, "comp").select("id", "n", "component_id", "cls")
    alone = sized.filter("n = 0").select("id", "n", F.col("id").alias("component_id"),
                                         F.lit(None).cast("long").alias("cls"))
    return out.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
                                         "component_id", F.col("cls").alias("class_id"))
