"""Nearest neighbours by cosine with multi-probe p-stable hashing.

Vectors are scaled to length 1, where the nearest by distance are the nearest
by cosine. A table's hash function is ``floor((a . x + b) / w)`` with Gaussian
``a``; ``n_hashes`` of them side by side name a bucket. Each vector is indexed
in one bucket of every table. A query visits, per table, its own bucket and
then perturbed ones (some coordinates one step up or down), in the order of
the sum of squared distances to the borders crossed, which is the order of
estimated success.

Each bucket reranks its own candidates with exact cosines in double precision
and passes on the best few per query; these are merged over tables and
buckets. So no candidate pair is ever a row. Equal vectors share every
bucket, so the index holds one row per distinct vector with its smallest ids,
and queries with equal vectors are asked once. Buckets of more than
``BUCKET_ROWS`` vectors or ``ASK_ROWS`` queries are split by measured size on
either side, each part of one meeting each part of the other, and scored in
slices of ``SLICE`` queries; nothing is capped. Vectors in buckets that no
query visits go no further. Queries whose buckets hold
fewer than ``k`` candidates are answered by a scan of all vectors of their
dimension, block by block.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

BUCKET_ROWS = 4096
ASK_ROWS = 4096
SLICE = 256


class Hashes:
    """The hash functions of all tables, the same in every task."""

    def __init__(self, dim: int, tables: int, n_hashes: int, width: float, seed: int):
        rng = np.random.Generator(np.random.Philox(key=[seed, dim]))
        self.a = rng.standard_normal((dim, tables * n_hashes))
        self.b = rng.random(tables * n_hashes) * width
        self.tables, self.n, self.width = tables, n_hashes, width

    def project(self, unit: np.ndarray) -> np.ndarray:
        """(rows, tables, hashes) places in units of the width."""
        return ((unit @ self.a + self.b) / self.width).reshape(len(unit), self.tables, self.n)


def bucket_keys(cells: np.ndarray, table: np.ndarray | int) -> np.ndarray:
    """One 64-bit name per row of integer cells."""
    key = np.full(cells.shape[:-1], 0x9E3779B97F4A7C15, np.uint64) + np.asarray(table, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(cells.shape[-1]):
            key = (key ^ cells[..., i].astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            key ^= key >> np.uint64(29)
    return key.view(np.int64)


def perturbations(up: np.ndarray, probes: int) -> list[list[tuple[int, int]]]:
    """The ``probes`` best sets of (hash, step), cheapest first.

    ``up`` is the distance to the next border above, as a share of the width;
    a step down costs (1 - up) squared, a step up costs up squared.
    """
    steps = sorted([((u) ** 2, i, 1) for i, u in enumerate(up)]
                   + [((1 - u) ** 2, i, -1) for i, u in enumerate(up)])
    heap, out = [(steps[0][0], (0,))], []
    while heap and len(out) < probes:
        cost, chosen = heapq.heappop(heap)
        hashes = [steps[j][1] for j in chosen]
        if len(set(hashes)) == len(hashes):
            out.append([(steps[j][1], steps[j][2]) for j in chosen])
        nxt = chosen[-1] + 1
        if nxt < len(steps):
            heapq.heappush(heap, (cost - steps[chosen[-1]][0] + steps[nxt][0], chosen[:-1] + (nxt,)))
            heapq.heappush(heap, (cost + steps[nxt][0], chosen + (nxt,)))
    return out


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact cosine of each query row with each row, in double precision."""
    dots = np.einsum("ij,kj->ik", q, x)
    return dots / (np.sqrt(np.einsum("ij,ij->i", q, q))[:, None] * np.sqrt(np.einsum("ij,ij->i", x, x))[None, :])


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of vectors that take part: not NULL or empty, all components
    finite and not NULL, not all zero. NULL ids take no part."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda c: F.coalesce((c == c) & (F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
            .filter((F.size(vec_col) > 0) & finite & F.exists(v, lambda c: c != 0))
            .select(F.col(id_col).cast("long").alias("id"), v.alias("vec")))


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
            tables: int = 6, n_hashes: int = 6, width: float = 2.0, probes: int = 40, seed: int = 11) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest found.

    ``is_query`` is a condition on the input's columns. Ties go to the smaller
    id; a query is no candidate of its own. Vectors of another dimension than
    the query's are never candidates. Repeated ids count once per distinct
    vector. Other columns are not looked at; an empty table gives none.
    """
    rows = usable(vectors.withColumn("_q", F.coalesce(is_query, F.lit(False))), id_col, vec_col)
    queries = usable(vectors.filter(F.coalesce(is_query, F.lit(False))), id_col, vec_col)
    # per distinct vector its k + 1 smallest ids: enough, as ties go to small ids
    keyed = rows.withColumn("cls", F.xxhash64("vec"))
    ids = keyed.select("cls", "id").distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    for keys in (["cls", "salt"], ["cls"]):
        ids = ids.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy("id"))) \
            .filter(F.col("r") <= k + 1)
    ids = ids.groupBy("cls").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    vecs = keyed.groupBy("cls").agg(F.first("vec").alias("vec"))
    classes = staged(vecs.join(ids, "cls").withColumn("dim", F.size("vec")), "ann_classes")
    asked = staged(queries.withColumn("cls", F.xxhash64("vec")).select("cls", "vec", "id").distinct(), "ann_queries")
    distinct_q = asked.groupBy("cls").agg(F.first("vec").alias("vec")).withColumn("dim", F.size("vec"))

    def hashed(probing: bool):
        def run(batches):
            for pdf in batches:
                for dim, part in pdf.groupby("dim"):
                    h = Hashes(int(dim), tables, n_hashes, width, seed)
                    place = h.project(_unit(_matrix(part["vec"])))
                    cells = np.floor(place)
                    for t in range(tables):
                        own = pd.DataFrame({"dim": dim, "tab": t, "cls": part["cls"].to_numpy()})
                        if not probing:
                            yield own.assign(key=bucket_keys(cells[:, t], t), vec=part["vec"].to_numpy(),
                                             first=[i[0] for i in part["ids"]])
                            continue
                        up = 1 - (place[:, t] - cells[:, t])
                        for i in range(len(part)):
                            sets = perturbations(up[i], probes)
                            move = np.zeros((len(sets) + 1, n_hashes))
                            for j, chosen in enumerate(sets):
                                for at, step in chosen:
                                    move[j + 1, at] = step
                            yield pd.DataFrame({"dim": dim, "tab": t, "cls": own["cls"].iloc[i],
                                                "key": bucket_keys(cells[i, t] + move, t)})
        return run

    spread = max(vectors.sparkSession.sparkContext.defaultParallelism, -(-asked.count() // ASK_ROWS))
    distinct_q = distinct_q.repartition(spread, "cls")  # a query makes rows for all of its probes
    index = staged(classes.mapInPandas(hashed(False), "dim int, tab int, cls long, key long, "
                                                      "vec array<double>, first long"), "ann_index")
    probe = staged(distinct_q.mapInPandas(hashed(True), "dim int, tab int, cls long, key long"), "ann_probes")
    bucket = ["dim", "tab", "key"]

    def counted(rows: DataFrame, keys: list[str], name: str, most: int) -> DataFrame:
        return rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / most).alias(name))

    def dealt(rows: DataFrame, sizes: DataFrame, keys: list[str], own: str, other: str) -> DataFrame:
        """Rows of one side: in one of its own parts, for every part of the other."""
        return (rows.join(sizes, keys).withColumn(own[:-1], F.pmod(F.col("cls"), F.col(own)))
                .withColumn(other[:-1], F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
                .drop("parts", "asks"))

    sizes = staged(counted(index, bucket, "parts", BUCKET_ROWS)
                   .join(counted(probe, bucket, "asks", ASK_ROWS), bucket), "ann_sizes")
    index = dealt(index, sizes, bucket, "parts", "asks")
    probe = dealt(probe, sizes, bucket, "asks", "parts").join(asked.groupBy("cls").agg(F.first("vec").alias("vec")), "cls")

    def rerank(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if held.empty or asking.empty:
            return pd.DataFrame({"qcls": [], "cls": [], "score": []}).astype(
                {"qcls": "int64", "cls": "int64", "score": "float64"})
        score = cosines(_matrix(asking["vec"]), _matrix(held["vec"]))
        first, best = held["first"].to_numpy(), min(k + 1, len(held))
        top = np.stack([np.lexsort((first, -row))[:best] for row in score])
        return pd.DataFrame({"qcls": np.repeat(asking["cls"].to_numpy(), best),
                             "cls": held["cls"].to_numpy()[top].ravel(),
                             "score": np.take_along_axis(score, top, axis=1).ravel()})

    def scan(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([rerank(held, asking.iloc[at:at + SLICE]) for at in range(0, max(len(asking), 1), SLICE)])

    by = [*bucket, "part", "ask"]
    found = (index.groupBy(*by).cogroup(probe.groupBy(*by))
             .applyInPandas(scan, "qcls long, cls long, score double")
             .groupBy("qcls", "cls").agg(F.max("score").alias("score")))
    found = staged(found, "ann_found")
    # a query's own id is among those found
    enough = (found.join(classes.select("cls", F.size("ids").alias("n")), "cls")
              .groupBy("qcls").agg(F.sum("n").alias("n")).filter(F.col("n") > k))
    short = staged(distinct_q.join(enough, distinct_q["cls"] == enough["qcls"], "left_anti"), "ann_short")
    if not short.isEmpty():
        dims = counted(classes, ["dim"], "parts", BUCKET_ROWS).join(counted(short, ["dim"], "asks", ASK_ROWS), "dim")
        held = dealt(classes.select("dim", "cls", "vec", F.col("ids")[0].alias("first")), dims, ["dim"], "parts", "asks")
        asking = dealt(short, dims, ["dim"], "asks", "parts")
        more = held.groupBy("dim", "part", "ask").cogroup(asking.groupBy("dim", "part", "ask")) \
            .applyInPandas(scan, "qcls long, cls long, score double")
        found = found.unionByName(more).groupBy("qcls", "cls").agg(F.max("score").alias("score"))
    near = found.join(classes.select("cls", "ids"), "cls")
    near = near.withColumn("r", F.row_number().over(
        Window.partitionBy("qcls").orderBy(F.desc("score"), F.col("ids")[0]))).filter(F.col("r") <= k + 1)
    out = (asked.select(F.col("cls").alias("qcls"), F.col("id").alias("query_id")).distinct()
           .join(near.select("qcls", "score", F.explode("ids").alias("vec_id")), "qcls")
           .filter("vec_id != query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
