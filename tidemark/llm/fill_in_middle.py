"""Fill-in-middle transformation by secondary-sort assembly.

1. Every document is cut into prefix, middle and suffix at line ends drawn
   from a hash of its id. Its units (lines) are emitted in chunks, one row per
   chunk, keyed by document and position in the *output*: the row knows where
   it goes, nothing is assembled in memory.
2. Rows are repartitioned by document and sorted within partitions by
   (document, position). A stream over the sorted rows feeds each output's
   incremental digest, so a document of any length needs one chunk of memory.
3. For restoration the same stream reads the marks off the output, numbers the
   sections as they stood in the original, and the rows are sorted again
   within the same partitions (no second shuffle); a second stream feeds the
   digest of the restored text.

A document's key is a hash of its id and text and the copy's number within the
task that reads it. So equal rows, however many, are dealt over all
partitions, and a task that is run again gives the same keys in whatever order
its rows arrive.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 64
CHUNK_BYTES = 8192  # times 10,000 rows of an Arrow batch: 80 MB at most
STREAM_ROWS = 256
KEY = ["_h", "_task", "_copy"]

# fixed values: marks of prefix, suffix and middle, and the seed of the draws
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "7"
MARKS = {PREFIX.encode(): 0, MIDDLE.encode(): 1, SUFFIX.encode(): 2}  # place in the original
MARK_BYTES = 3
OUTPUT = 3  # after all sections: the digest of the output
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}


def draws(key: str, seed: str = SEED) -> list[int]:
    """The first four 32-bit groups of the SHA-256 of ``seed:key``."""
    return np.frombuffer(hashlib.sha256(f"{seed}:{key}".encode()).digest()[:16], ">u4").tolist()


def line_ends(text: bytes) -> np.ndarray:
    """End of each unit ``[^\\n]*\\n|[^\\n]+`` in bytes."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.append(ends, len(text)) if len(text) and (not len(ends) or ends[-1] < len(text)) else ends


def characters(text: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


def plan_document(key: str, text: bytes, fim_rate: int, spm_rate: int, seed: str):
    """(form, ends of all units, units in the prefix, units up to the middle's end)."""
    ends = line_ends(text)
    h1, h2, h3, h4 = draws(key, seed)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= fim_rate:
        return "plain", ends, None, None
    a, b = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    return ("spm" if h4 % 100 < spm_rate else "psm"), ends, a, b


def chunks(text: bytes, ends: np.ndarray, lo: int, hi: int, chunk_bytes: int):
    """Units ``lo`` to ``hi`` in pieces of whole units, up to ``chunk_bytes``
    each; a longer unit is cut."""
    at = int(ends[lo - 1]) if lo else 0
    stop = int(ends[hi - 1]) if hi else 0
    while at < stop:
        k = int(np.searchsorted(ends, at + chunk_bytes, "right"))
        to = int(ends[min(k, hi) - 1]) if k else 0
        to = min(to if to > at else at + chunk_bytes, stop)
        yield text[at:to]
        at = to


PIECES = "_h long, _task long, _copy long, _pos long, _form string, _piece binary, _n long, _prefix long, _middle long"


def output_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_rate: int = 100,
                  spm_rate: int = 50, seed: str = SEED, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk, keyed by document (``_h, _task, _copy``) and output
    position; the first chunk of a document carries its id and counts."""
    rows = df.select(F.col(id_col), F.col(id_col).cast("string").alias("_key"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    kind = df.schema[id_col].dataType.simpleString()

    def cut(batches):
        task = TaskContext.get().partitionId()
        copies = defaultdict(int)
        for b in batches:
            for lo in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(lo, SLICE_ROWS)
                source, out = [], []
                for i, (key, text) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist(),
                                                    strict=True)):
                    h = xxhash.xxh3_64_intdigest(text, seed=xxhash.xxh32_intdigest(repr(key))) - (1 << 63)
                    copies[h] += 1
                    form, ends, a, b_ = plan_document("" if key is None else key, text, fim_rate, spm_rate, seed)
                    counts = [len(ends), None, None]
                    if form == "plain":
                        pieces = list(chunks(text, ends, 0, len(ends), chunk_bytes)) or [b""]
                    else:
                        spans = {PREFIX: (0, a), MIDDLE: (a, b_), SUFFIX: (b_, len(ends))}
                        pieces = []
                        for mark in FORMS[form]:
                            section = list(chunks(text, ends, *spans[mark], chunk_bytes)) or [b""]
                            pieces += [mark.encode() + section[0], *section[1:]]
                        cuts = [int(ends[k - 1]) if k else 0 for k in (a, b_)]
                        counts[1:] = characters(text[:cuts[0]]), characters(text[cuts[0]:cuts[1]])
                    for pos, piece in enumerate(pieces):
                        source.append(None if pos else i)
                        out.append((h, task, copies[h], pos, form, piece, *(counts if pos == 0 else (None,) * 3)))
                cols = list(zip(*out, strict=True))
                types = [pa.int64()] * 4 + [pa.string(), pa.binary()] + [pa.int64()] * 3
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(source, pa.int64()))]
                    + [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                    names=[id_col, *(c.split()[0] for c in PIECES.split(", "))])

    return rows.mapInArrow(cut, f"`{id_col}` {kind}, {PIECES}")


def _slices(batches, fields):
    """Slices of sorted rows and, row by row, the values of some fields."""
    for b in batches:
        for lo in range(0, b.num_rows, STREAM_ROWS):
            part = b.slice(lo, STREAM_ROWS)
            yield part, zip(*(part.column(f).to_pylist() for f in fields), strict=True)


def sorted_pieces(df: DataFrame, id_col: str, *args, **kw) -> DataFrame:
    """``output_pieces`` with each document's rows together in output order."""
    return output_pieces(df, id_col, *args, **kw).repartition(*KEY).sortWithinPartitions(*KEY, "_pos")


def transformed_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``id_col, form, text``: the transformed texts, one row per input row
    (parameters and odd rows as in ``fill_in_middle``). A text is one value,
    so it has to fit one row."""
    def join(batches):
        doc, form, ident, parts = None, None, None, []

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([ident], id_type), pa.array([form]), pa.array([b"".join(parts).decode()])],
                names=[id_col, "form", "text"])

        for part, rows in _slices(batches, [id_col, *KEY, "_pos", "_form", "_piece"]):
            id_type = part.schema.field(id_col).type
            for i, h, task, copy, pos, f, piece in rows:
                if (h, task, copy) != doc:
                    if doc:
                        yield row()
                    doc, form, ident, parts = (h, task, copy), f, i, []
                parts.append(piece)
        if doc:
            yield row()

    kind = df.schema[id_col].dataType.simpleString()
    return sorted_pieces(df, id_col, text_col, **kw).mapInArrow(join, f"`{id_col}` {kind}, form string, text string")


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fim_rate: int = 100,
                   spm_rate: int = 50, seed: str = SEED, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Digests of the transformed and of the restored texts, one row per input
    row: ``id_col, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256`` (n: number of lines; lowercase hex digests).

    A document stays plain if its text is empty or holds a mark, or by the
    draw (``fim_rate`` per cent are transformed, ``spm_rate`` per cent of those
    with the suffix first). NULL text counts as empty. Draws come from the
    decimal id (the empty string for NULL), so rows that share an id are cut
    alike; repeated rows and ids each get their own row. Texts of any length
    pass in chunks. Other columns are not looked at; an empty table gives an
    empty result. ``transformed_texts`` gives the texts themselves.
    """
    names = [id_col, *KEY, "_section", "_pos", "_form", "_piece", "_n", "_prefix", "_middle"]
    types = [pa.int64()] * 5 + [pa.string(), pa.binary()] + [pa.int64()] * 3

    def assemble(batches):
        """The pieces without marks, numbered by section of the original, and
        after each document a row with the digest of its output."""
        doc, digest, section, id_type = None, None, 0, None
        for part, rows in _slices(batches, [*KEY, "_pos", "_form", "_piece", "_n", "_prefix", "_middle"]):
            id_type = part.schema.field(id_col).type
            source, out = [], []
            for i, (h, task, copy, pos, form, piece, *counts) in enumerate(rows):
                if (h, task, copy) != doc:
                    if doc:
                        source.append(None)
                        out.append((*doc, OUTPUT, 0, None, digest.digest(), None, None, None))
                    doc, digest, section = (h, task, copy), hashlib.sha256(), 0
                digest.update(piece)
                if form != "plain" and piece[:MARK_BYTES] in MARKS:
                    section, piece = MARKS[piece[:MARK_BYTES]], piece[MARK_BYTES:]
                source.append(i)
                out.append((h, task, copy, section, pos, form, piece, *counts))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(source, pa.int64()))]
                + [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
        if doc:
            last = (*doc, OUTPUT, 0, None, digest.digest(), None, None, None)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type)] + [pa.array([x], t) for x, t in zip(last, types, strict=True)], names=names)

    def restore(batches):
        doc, digest, found = None, None, None
        shown = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for part, rows in _slices(batches, [id_col, *KEY, "_section", "_form", "_piece", "_n", "_prefix", "_middle"]):
            out = []
            for i, h, task, copy, section, form, piece, n, prefix, middle in rows:
                if (h, task, copy) != doc:
                    doc, digest = (h, task, copy), hashlib.sha256()
                if section == OUTPUT:  # sorts last
                    out.append((*found, piece.hex(), digest.hexdigest()))
                    continue
                digest.update(piece)
                if n is not None:
                    found = (i, n, form, prefix, middle)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True),
                                                    [part.schema.field(id_col).type, *shown], strict=True)],
                    names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    output = sorted_pieces(df, id_col, text_col, fim_rate, spm_rate, seed, chunk_bytes).mapInArrow(
        assemble, f"`{id_col}` {kind}, _h long, _task long, _copy long, _section long, _pos long, _form string, "
                  "_piece binary, _n long, _prefix long, _middle long")
    return output.sortWithinPartitions(*KEY, "_section", "_pos").mapInArrow(
        restore, f"`{id_col}` {kind}, n long, form string, prefix_chars long, middle_chars long, "
                 "output_sha256 string, restored_sha256 string")
