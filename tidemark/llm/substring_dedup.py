"""Substring deduplication by hashing units of text.

1. Each text is cut into units. ``line``: lines. ``sentence`` (default): a
   unit ends at a line end, or at a full stop, question or exclamation mark
   before white space once it has ``unit_words`` words, so a passage that was
   pasted into a line is found too. A unit's normal form is its words,
   lower-cased (A-Z), one space between.
2. (digest, document, unit) rows are grouped by digest over the whole corpus
   with the smallest (document, unit) as the occurrence that stays; minimum
   and maximum are combined before the shuffle, so a unit that a third of all
   documents hold is no hot group. Only digests that occur twice go on.
3. A join on the digest marks the occurrences that do not stay. Rows carry
   digests and places, never text; AQE can split a hot digest.
4. Marked units that follow each other in a document form a run; runs of
   ``min_words`` words or more are removed. Of shorter ones only whole lines of
   ``line_words`` words or more, all of whose units are marked. The spans meet
   the texts in a join on the document; documents with nothing to cut pass a
   slot filter of fixed size without any shuffle.

Offsets are character offsets into the original text.
"""

from __future__ import annotations

import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slot_filter, staged, told_apart, with_slot_flag

MIN_WORDS = 10
UNIT_WORDS = 5
ENDS = {"line": re.compile(r"\n"), "sentence": re.compile(r"\n|[.!?](?=\s)")}


def cut_units(text: str, unit: str = "sentence", unit_words: int = UNIT_WORDS):
    """(start, end, words) of each unit that has a word; ``words`` is its
    normal form. ``end`` is past the line end if the unit began a line."""
    at, line = 0, True
    for m in [*ENDS[unit].finditer(text), None]:
        end = len(text) if m is None else m.end()
        words = text[at:end].encode().lower().split()
        newline = m is not None and m.group() == "\n"
        if m is not None and not newline and len(words) < unit_words:
            continue
        if words:
            yield at, (end - 1 if newline and not line else end), words
        at, line = end, newline


BEGINS, ENDS_LINE = 1, 2
_REST = re.compile(r"[ \t\x0b-\r]*(?:\n|\Z)")


def line_edges(text: str, start: int, end: int) -> int:
    """Whether a unit begins and ends its line."""
    begins = start == 0 or text[start - 1] == "\n"
    return BEGINS * begins + ENDS_LINE * bool(text[end - 1] == "\n" or _REST.match(text, end))


def whole_lines(run: list[dict], line_words: int) -> list[list]:
    """(start, end) of the lines of a run that it covers; neighbours as one."""
    out, line = [], []
    for x in run:
        line = [x] if x["edge"] & BEGINS else line + [x] if line else []
        if line and x["edge"] & ENDS_LINE:
            if sum(y["words"] for y in line) >= line_words:
                if out and out[-1][2] == line[0]["unit"] - 1:
                    out[-1][1:] = [x["end"], x["unit"]]
                else:
                    out.append([line[0]["start"], x["end"], x["unit"]])
            line = []
    return [x[:2] for x in out]


def remove_runs(text: str, marked: list[dict], min_words: int, line_words: int) -> tuple[str, list[dict]]:
    """The text without the long enough runs of marked units and the whole
    lines of the others, and their spans."""
    runs: list[list] = []
    for x in marked:
        if runs and x["unit"] == runs[-1][-1]["unit"] + 1:
            runs[-1].append(x)
        else:
            runs.append([x])
    spans = []
    for run in runs:
        enough = sum(x["words"] for x in run) >= min_words
        spans += [{"start": a, "end": e} for a, e in
                  ([(run[0]["start"], run[-1]["end"])] if enough else whole_lines(run, line_words))]
    out, at = [], 0
    for s in spans:
        out.append(text[at:s["start"]])
        at = s["end"]
    return "".join(out) + text[at:], spans


def unit_digests(rows: DataFrame, unit: str, unit_words: int) -> DataFrame:
    """(_id, _row, unit, start, end, words, edge, h1, h2) of every unit."""
    def run(batches):
        for b in batches:
            out = []
            for doc, row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                      b.column(2).to_pylist(), strict=True):
                for k, (a, e, words) in enumerate(cut_units(text, unit, unit_words)):
                    h = xxhash.xxh3_128_intdigest(b" ".join(words))
                    out.append((doc, row, k, a, e, len(words), line_edges(text, a, e), (h >> 64) - (1 << 63),
                                (h & (1 << 64) - 1) - (1 << 63)))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], b.schema.field(0).type)] + [pa.array(c, pa.int64()) for c in cols[1:]],
                    names=["_id", "_row", "unit", "start", "end", "words", "edge", "h1", "h2"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.select("_id", "_row", F.coalesce("_text", F.lit("")).alias("_text")).mapInArrow(
        run, f"_id {kind}, _row long, unit long, start long, end long, words long, edge long, h1 long, h2 long")


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "sentence",
                    min_words: int = MIN_WORDS, unit_words: int = UNIT_WORDS,
                    line_words: int | None = None) -> DataFrame:
    """``id_col, text, removed, n_removed, n_chars_removed``: one row per input row.

    ``removed`` lists the spans cut (start, end: character offsets into the
    original text) in order. Of equal units, the one in the smallest id stays,
    and within a document the first; NULL ids rank last. ``line_words`` is the
    least length of whole lines that go (``min_words`` if not given). Rows that
    share an id rank by the hash of their text; in a table with rows equal in
    both, rows that share an id rank in the order they are read, and all but
    the first of equal rows lose their units. NULL text stays NULL and, like an empty one, has no units. Other
    columns are not looked at; an empty table gives an empty result.
    """
    line_words = min_words if line_words is None else min(line_words, min_words)
    rows = told_apart(df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_id", "_text")
    units = staged(unit_digests(rows, unit, unit_words), "substring_units")

    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row", "unit")
    first = (units.groupBy("h1", "h2").agg(F.min(place).alias("stays"), F.max(place).alias("last"))
             .filter("stays != last").select("h1", "h2", "stays"))
    marked = (units.join(first, ["h1", "h2"]).filter(place != F.col("stays"))
              .select("_id", "_row", "unit", "start", "end", "words", "edge").distinct())
    marked = staged(marked.groupBy("_id", "_row").agg(F.array_sort(F.collect_list(
        F.struct("unit", "start", "end", "words", "edge"))).alias("marked"),
        F.sum("words").alias("n")).filter(F.col("n") >= line_words).drop("n"), "substring_marked")

    bits = slot_filter(marked, F.col("_row"))
    flagged = with_slot_flag(rows, bits, F.col("_row"), "_cut")
    spans = "array<struct<start:long,end:long>>"
    whole = flagged.filter("not _cut").select(
        "_id", F.col("_text").alias("text"), F.expr(f"cast(array() as {spans})").alias("removed"))
    m = marked.select(F.col("_id").alias("_mid"), F.col("_row").alias("_mrow"), "marked")
    touched = flagged.filter("_cut").join(
        m, (F.col("_row") == F.col("_mrow")) & F.col("_id").eqNullSafe(F.col("_mid")), "left")

    @F.pandas_udf(f"text string, removed {spans}")
    def cut(texts: pd.Series, marks: pd.Series) -> pd.DataFrame:
        out = [(t, []) if t is None or k is None else remove_runs(t, list(k), min_words, line_words)
               for t, k in zip(texts, marks, strict=True)]
        return pd.DataFrame(out, columns=["text", "removed"])

    touched = touched.select("_id", cut("_text", "marked").alias("c")).select("_id", "c.text", "c.removed")
    every = whole.unionByName(touched)
    chars = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return every.select(F.col("_id").alias(id_col), "text", "removed",
                        F.size("removed").cast("long").alias("n_removed"), chars.alias("n_chars_removed"))
