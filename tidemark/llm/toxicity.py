"""Toxicity: FTRL-proximal logistic regression over hashed word features.

Features of a text, hashed into ``2**bits`` coordinates and taken once per
text: words, word beginnings of four characters (so an inflected form that
training never saw is still known by its stem), pairs of neighbours, and
skip-grams of two words with one between. Words are lower-cased (A-Z) and
stripped of punctuation at their ends.

Training follows FTRL-proximal: each coordinate has its own rate from its own
sum of squared gradients, and the L1 term keeps every coordinate at zero until
its evidence passes the threshold. What remains is a table of a few thousand
(coordinate, weight) pairs, never more than ``2**bits``: that bound is what
makes it safe to hand to every task. Training reads at most ``max_rows``
labelled rows; scoring reads every word of every text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, forgetting

BITS = 20
MAX_ROWS = 16_384
STRIP = b".,;:!?\"'()[]{}<>-_*&%$#@/\\|~`^+="
THRESHOLD = 0.7

# odd multipliers that keep the feature families apart
FAMILY = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _hashes(word: bytes) -> int:
    word = word.strip(STRIP) or word
    return zlib.crc32(word) << 32 | zlib.crc32(word.decode(errors="replace")[:4].encode())


_words = Memo(_hashes, 100_000)


def forget_words() -> None:
    _words.forget()


def features(text: bytes, bits: int = BITS) -> np.ndarray:
    """Coordinates of a text, with repeats."""
    words = text.lower().split()
    both = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    _words.trim()
    own, stem = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    shift = np.uint64(64 - bits)
    with np.errstate(over="ignore"):
        parts = [(own + np.uint64(1)) * FAMILY[0], (stem + np.uint64(1)) * FAMILY[1],
                 own[:-1] * FAMILY[2] + own[1:] * FAMILY[3], own[:-2] * FAMILY[4] + own[2:] * FAMILY[5]]
    out = np.concatenate(parts)
    return ((out ^ (out >> np.uint64(29))) * FAMILY[0] >> shift).astype(np.int32)


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(max(x, -35.0), 35.0)))


def screened(rows: list[tuple[np.ndarray, int]], bits: int, least: float) -> list[tuple[np.ndarray, int]]:
    """Keep the coordinates seen in two rows or more whose share of toxic rows
    differs from the sample's by a chi-square of more than ``least``."""
    seen, toxic = np.zeros(1 << bits), np.zeros(1 << bits)
    for idx, y in rows:
        seen[idx] += 1
        toxic[idx] += y
    rate = sum(y for _, y in rows) / max(1, len(rows))
    keep = (seen >= 2) & ((toxic - rate * seen) ** 2 > least * rate * (1 - rate) * seen)
    return [(idx[keep[idx]], y) for idx, y in rows]


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int, thin: tuple[float, ...], alpha: float, beta: float,
         l1: float, l2: float) -> tuple[np.ndarray, float]:
    """Weights and bias from (distinct coordinates, label) rows, in order.

    One epoch per entry of ``thin``, the share of a row's coordinates that the
    epoch shows: thinned rows make each telling word carry the verdict alone,
    the full rows at the end set the scale.
    """
    rng = np.random.default_rng(5)
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bias_z = bias_n = bias = 0.0

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0,
                        (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))

    for share in thin:
        for idx, y in rows:
            if share < 1:
                idx = idx[rng.random(len(idx)) < share]
            zi, ni = z[idx], n[idx]
            w = weights(zi, ni)
            g = _sigmoid(bias + w.sum()) - y
            z[idx] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * w
            n[idx] = ni + g * g
            bias_z += g - (np.sqrt(bias_n + g * g) - np.sqrt(bias_n)) / alpha * bias
            bias_n += g * g
            bias = -bias_z * alpha / (beta + np.sqrt(bias_n))
    return weights(z, n), bias


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_rows: int = MAX_ROWS, bits: int = BITS, least: float = 8.0,
          thin: tuple[float, ...] = (0.5, 0.5, 1, 1, 0.5, 0.5, 1, 1), alpha: float = 5.0, beta: float = 1.0,
          l1: float = 4.0, l2: float = 0.1) -> DataFrame:
    """The model: rows (coordinate, weight); coordinate -1 is the bias.

    Trains on the ``max_rows`` labelled ids with the smallest hashes (all, if
    there are fewer), so the choice depends on nothing but ids, of any type that
    has a text form. Ids and labels
    that are NULL, or labels other than 0 and 1, are left out; an id with two
    labels counts as toxic. Without any labelled row the model is empty.
    """
    chosen = (labels.filter(F.col(label_col).isin(0, 1)).filter(F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    # at most max_rows rows of 12 bytes
    sample = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
              .join(F.broadcast(chosen), "_id")
              .select(F.col("_id").cast("string"), "_y", F.coalesce("_text", F.lit("")).cast("binary").alias("_text")))

    def extract(batches):
        for b in batches:
            idx = [np.unique(features(t, bits)).tobytes() for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(idx, pa.binary())],
                                             names=["_id", "_y", "_idx"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(h=[zlib.crc32(i.encode()) for i in pdf["_id"]]).sort_values(["h", "_id"])
        rows = [(np.frombuffer(x, np.int32), int(y)) for x, y in zip(pdf["_idx"], pdf["_y"], strict=True)]
        w, bias = ftrl(screened(rows, bits, least), bits, thin, alpha, beta, l1, l2)
        at = np.flatnonzero(w)
        return pd.DataFrame({"coordinate": np.append(at, -1).astype(np.int64), "weight": np.append(w[at], bias)})

    found = sample.mapInArrow(forgetting(forget_words, extract), "_id string, _y int, _idx binary")
    return found.groupBy(F.lit(0).alias("_all")).applyInPandas(fit, "coordinate long, weight double")


def score(docs: DataFrame, model: DataFrame, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (score >= 0.7).

    NULL and empty texts get the score of a text without features. Texts of
    any length are scored whole. A column of either name is replaced. The
    model is collected: at most ``2**bits`` + 1 pairs.
    """
    pairs = model.toPandas()
    dense = np.zeros(1 << bits, np.float32)
    at = pairs["coordinate"].to_numpy(np.int64)
    dense[at[at >= 0]] = pairs["weight"].to_numpy()[at >= 0]
    bias = float(pairs["weight"].to_numpy()[at < 0].sum())
    kept = np.flatnonzero(dense)
    model_b = docs.sparkSession.sparkContext.broadcast((kept.astype(np.int32), dense[kept]))

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w = model_b.value
        table = np.zeros(1 << bits, np.float32)
        table[at] = w

        def scored(parts):
            for texts in parts:
                out = np.empty(len(texts))
                for i, t in enumerate(texts):
                    idx = features(t, bits)
                    idx = np.unique(idx[table[idx] != 0])
                    out[i] = _sigmoid(bias + float(table[idx].sum(dtype=np.float64)))
                yield pd.Series(out)
        return forgetting(forget_words, scored)(parts)

    scored = docs.withColumn("score", run(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def held_out(id_col: str = "doc_id"):
    """Rows that labels are never learnt from: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
