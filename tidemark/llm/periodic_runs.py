"""Periodic runs of words, and texts with each run cut to one period.

A run is a stretch of consecutive words with smallest period q, at least
``max(min_words, min_repeats * q)`` words long, that no neighbouring word
extends with period q.

1. Recursive frequency splitting. Every word of a run stands in it at least
   ``min_repeats`` times. A word rarer than that within its segment belongs to
   no run of the segment and splits it; pieces shorter than ``min_words`` go.
   The pieces are counted anew until none splits. Most prose is gone by then.
2. The surviving segments are scanned by lag. Blocks of K words are numbered
   by doubling (equal blocks of 2K words are equal pairs of blocks of K). The
   lag of a place is the distance to the next equal block. Within a run of
   smallest period q <= K that is q: a smaller lag would make the block, and
   with it the run, repeat sooner. And a run is at least 3q > q + K words long
   for K < 2q, so each run shows at the level with K/2 < q <= K as one
   stretch of equal lags, whose ends are the run's ends. Blocks that stand
   once drop out before the next doubling.

A document is worked on whole by one task in memory proportional to its words
and time n log^2 n; no row is shuffled.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 64
MIN_WORDS, MIN_REPEATS = 24, 3


def surviving_segments(ids: np.ndarray, min_words: int = MIN_WORDS,
                       min_repeats: int = MIN_REPEATS) -> list[tuple[int, int]]:
    """(start, end) of the segments that recursive splitting leaves, in order."""
    todo, done = [(0, len(ids))], []
    while todo:
        a, b = todo.pop()
        if b - a < min_words:
            continue
        _, inverse, counts = np.unique(ids[a:b], return_inverse=True, return_counts=True)
        cuts = np.flatnonzero(counts[inverse] < min_repeats)
        if len(cuts) == 0:
            done.append((a, b))
            continue
        starts = np.concatenate([[a], a + cuts + 1])
        ends = np.concatenate([a + cuts, [b]])
        long = ends - starts >= min_words
        todo.extend(zip(starts[long].tolist(), ends[long].tolist(), strict=True))
    return sorted(done)


def lag_runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in whole numbers ``ids >= 0``."""
    n, runs = len(ids), []
    block = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    place, size = np.arange(n), 1
    first = 8  # the first level takes all periods up to 8: 24 words hold a block and a period
    while len(place) and size < max(first, -(-n // min_repeats)):
        place = place[place + 2 * size <= n]
        left, right = block[place], block[place + size]
        place, left, right = (x[right >= 0] for x in (place, left, right))
        _, inverse, counts = np.unique(left * (n + 1) + right, return_inverse=True, return_counts=True)
        again = counts[inverse] > 1
        place, number = place[again], inverse[again]
        block = np.full(n, -1, np.int64)
        block[place] = number
        size *= 2
        if size < first or not len(place):
            continue
        order = np.argsort(number, kind="stable")
        at = place[order]
        lag = np.zeros(n, np.int64)
        same = number[order][1:] == number[order][:-1]
        lag[at[:-1][same]] = np.diff(at)[same]
        lag[(lag > size) | (lag <= (size // 2 if size > first else 0))] = 0
        edge = np.flatnonzero(np.diff(lag)) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [n]])
        period = lag[starts]
        length = ends - starts - 1 + period + size
        keep = (period > 0) & (length >= np.maximum(min_words, min_repeats * period))
        runs += zip(starts[keep].tolist(), length[keep].tolist(), period[keep].tolist(), strict=True)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def runs_of(words: list[bytes], min_words: int = MIN_WORDS,
            min_repeats: int = MIN_REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a document's words."""
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    return [(a + start, length, period) for a, b in surviving_segments(ids, min_words, min_repeats)
            for start, length, period in lag_runs(ids[a:b], min_words, min_repeats)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.cumsum(depth[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                  min_repeats: int = MIN_REPEATS) -> DataFrame:
    """One row per input row: ``id_col, n_words, n_runs, start, length, period,
    exponent_milli, runs, runs_sha256, text, text_sha256``.

    ``runs`` lists start, length and period by start, then period; ``start``,
    ``length`` and ``period`` are those of the run with the greatest exact
    length / period (ties: smallest start, then period), NULL without a run.
    ``runs_sha256`` is the digest of the lines ``start,length,period``. ``text``
    keeps, joined by one space, the words that no run contains after its first
    period. ``min_repeats`` is 3 at least, as the lag scan needs, and
    ``min_words`` 24 at least.

    NULL and empty texts have no words and no runs; their ``text`` is empty.
    Repeated rows and ids each get their own row, NULL ids included. Texts of
    any length are read whole. Other columns are not looked at; an empty table
    gives an empty result.
    """
    if min_repeats < MIN_REPEATS or min_words < MIN_WORDS:
        raise ValueError(f"runs need {MIN_REPEATS} repeats and {MIN_WORDS} words at least")
    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    kind = df.schema[id_col].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    types = [pa.int64()] * 6 + [run_type, pa.string(), pa.string(), pa.string()]
    names = ["n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs", "runs_sha256", "text",
             "text_sha256"]

    def describe(text: bytes):
        words = text.split()  # splits at U+0020 and U+0009 to U+000D
        runs = runs_of(words, min_words, min_repeats)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
        kept = b" ".join(collapsed(words, runs))
        return (len(words), len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                [{"start": a, "length": b, "period": q} for a, b, q in runs],
                hashlib.sha256(lines.encode()).hexdigest(), kept.decode(), hashlib.sha256(kept).hexdigest())

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(lo, SLICE_ROWS)
                cols = zip(*map(describe, part.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                    names=[id_col, *names])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_runs long, start long, length long, period long, "
                                "exponent_milli long, runs array<struct<start:long,length:long,period:long>>, "
                                "runs_sha256 string, text string, text_sha256 string")
