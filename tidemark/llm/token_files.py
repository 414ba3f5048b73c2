"""Token ids in files of bit-plane or byte-plane blocks.

The ids of all documents, in ascending order of document id and each ended by
``end_id``, form one stream. Range partitions of the stream are its parts;
within a part, ids are cut into blocks of ``block`` ids, whatever the
document borders. A block is transposed into planes (plane p holds byte or
bit p of every id; the high planes are nearly constant), each plane is
compressed with zstandard, and the block's header lists where each plane
lies. Blocks are written as rows of a Parquet table in the shared store, with
the chunk index beside them: part, chunk, number of ids, and for each
document in the block its id, its place in the part, its length, and the
range of its ids that the block holds. So every store that Spark writes to
will do, a reader can fetch single documents, and a part of any size is
written and read block by block.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import vocabulary_words
from tidemark.llm.vocabulary_words import SLICE_BYTES, SLICE_TEXTS, encode_texts

BLOCK = 65_536
MAGIC = b"TMPL"
HEADER = struct.Struct("<4sBBxxI")  # magic, bits per plane (1 or 8), planes, ids
NO_ID = 0xFFFFFFFF  # between words; ids stay below 2**24, so their highest byte is 0
CUT = b"\xff\xff\xff\xff"
# visible Latin characters are composed already and classed alike by every Unicode version
NOT_PLAIN = re.compile("[^\n!-~\u00a1-\u00ac\u00ae-\u012f\u0131-\u017f]|<\\|")

CHUNKS = ("part long, chunk long, n_ids long, payload binary, doc_id {kind}, start array<long>, "
          "n_tokens array<long>, skip array<long>, n_here array<long>")


def pack(ids: np.ndarray, bits: int = 8, level: int = 3) -> bytes:
    """One block: header, (offset, length) of each plane, the planes."""
    import zstandard

    ids = np.ascontiguousarray(ids, "<u4")
    raw = ids.view(np.uint8).reshape(len(ids), 4)
    if bits == 8:
        planes = [np.ascontiguousarray(raw[:, p]).tobytes() for p in range(4)]
    else:
        each = np.unpackbits(raw, axis=1, bitorder="little")
        planes = [np.packbits(np.ascontiguousarray(each[:, p])).tobytes() for p in range(32)]
    squeeze = zstandard.ZstdCompressor(level=level).compress
    planes = [squeeze(p) for p in planes]
    at, index = HEADER.size + 8 * len(planes), b""
    for p in planes:
        index += struct.pack("<II", at, len(p))
        at += len(p)
    return HEADER.pack(MAGIC, bits, len(planes), len(ids)) + index + b"".join(planes)


def unpack(block: bytes) -> np.ndarray:
    import zstandard

    magic, bits, count, n = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a block of token planes")
    open_ = zstandard.ZstdDecompressor().decompress
    places = [struct.unpack_from("<II", block, HEADER.size + 8 * p) for p in range(count)]
    planes = [np.frombuffer(open_(block[a:a + size]), np.uint8) for a, size in places]
    if bits == 8:
        raw = np.stack(planes, axis=1)
    else:
        each = np.stack([np.unpackbits(p, count=n) for p in planes], axis=1)
        raw = np.packbits(each, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).reshape(-1).view("<u4")


class Recent:
    """What is known of recent keys: two generations of plain dictionaries of
    at most ``limit`` keys each, looked up a whole set at a time."""

    def __init__(self, limit: int):
        self.now, self.old, self.limit = {}, {}, limit

    def get(self, keys: list) -> tuple[list, list[int]]:
        """What is known of distinct keys, None for the others, and the places
        of those; what the older generation knows comes over."""
        values = list(map(self.now.get, keys))
        unknown = [i for i, v in enumerate(values) if v is None]
        if self.old and unknown:
            before = list(map(self.old.get, [keys[i] for i in unknown]))
            for i, v in zip(unknown, before, strict=True):
                if v is not None:
                    values[i] = self.now[keys[i]] = v
            unknown = [i for i, v in zip(unknown, before, strict=True) if v is None]
        return values, unknown

    def trim(self) -> None:
        if len(self.now) > self.limit:
            self.now, self.old = {}, self.now


class LibraryEncoder:
    """The tokenizers library, asked once per recent word.

    Texts in plain Latin letters are lower-cased and cut into words by the
    vocabulary's own pattern with Arrow. Words not seen lately go to the
    library together, as one text, and its ids are dealt back at the tokens
    that end a word; whatever does not come back as one word each goes there
    alone. Other texts are cut at ASCII white space: the vocabulary's splitting
    drops white space, no normalisation step composes across it and no special
    token holds any, so the pieces' ids, one after the other, are the text's.
    Of those pieces, plain ones are cut on by the pattern, all in one text of a
    line each, and every other goes to the library alone.
    """

    def __init__(self, path: str, limit: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import tokenizers

        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        self.find = regex.compile(self.pattern + "|\n").findall
        suffix, vocab = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for s, i in vocab.items() if s.endswith(suffix)]] = True
        # words are normalised and cut when they come to it: split them at spaces alone
        self.by_word = tokenizers.Tokenizer.from_file(path)
        self.by_word.no_padding()
        self.by_word.no_truncation()
        self.by_word.normalizer = None
        self.by_word.pre_tokenizer = tokenizers.pre_tokenizers.Sequence(
            [tokenizers.pre_tokenizers.WhitespaceSplit(), self.library.pre_tokenizer[1]])
        self.chunks, self.words = Recent(limit), Recent(limit)

    def _alone(self, texts: list[str]) -> list[bytes]:
        out = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in out]

    def _together(self, words: list[str]) -> list[bytes]:
        ids = np.array(self.by_word.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1 if ids.max(initial=0) < len(self.ends) else []
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._alone(words)
        return np.insert(ids, ends, NO_ID).tobytes().split(CUT)[:-1]

    def _learn(self, new: list[bytes]) -> None:
        text = b"\n".join(new).decode()
        if NOT_PLAIN.search(text):
            pieces = text.split("\n")
            odd = [i for i, t in enumerate(pieces) if NOT_PLAIN.search(t)]
            self.chunks.now.update(zip([new[i] for i in odd], self._alone([pieces[i] for i in odd]), strict=True))
            keep = sorted(set(range(len(new))).difference(odd))
            new, text = [new[i] for i in keep], "\n".join([pieces[i] for i in keep])
        if not new:
            return
        found = self.find(text.lower())
        distinct = list(set(found).difference("\n"))
        ids = dict(zip(distinct, self._words([w.encode() for w in distinct]), strict=True))
        ids["\n"] = CUT
        ids = b"".join(map(ids.__getitem__, found)).split(CUT)
        self.chunks.now.update(zip(new, ids, strict=True))

    def _words(self, distinct: list[bytes]) -> list[bytes]:
        self.words.now[b""] = b""
        known, unknown = self.words.get(distinct)
        for lo in range(0, len(unknown), 500):
            at = unknown[lo:lo + 500]
            for i, ids in zip(at, self._together([distinct[i].decode() for i in at]), strict=True):
                known[i] = self.words.now[distinct[i]] = ids
        self.words.trim()
        return known

    def _pieces(self, distinct: list[bytes]) -> list[bytes]:
        self.chunks.now[b""] = b""
        known, unknown = self.chunks.get(distinct)
        if unknown:
            self._learn([distinct[i] for i in unknown])
            for i in unknown:
                known[i] = self.chunks.now[distinct[i]]
        self.chunks.trim()
        return known

    def encode(self, texts: list[bytes] | pa.Array) -> list[bytes]:
        """UTF-8 texts -> ids as little-endian unsigned 32-bit integers."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
        return encode_texts(texts, self.pattern, self._words, self._pieces)


def slices(batch: pa.RecordBatch):
    """Runs of rows of ``SLICE_BYTES`` of text, or one text if it has more."""
    return vocabulary_words.slices(batch, SLICE_BYTES, SLICE_TEXTS)


_encoders: dict[str, LibraryEncoder] = {}


def write_tokens(docs: DataFrame, out: str, vocabulary: str, id_col: str = "doc_id",
                 text_col: str = "text", end_id: int = 1, block: int = BLOCK,
                 bits: int = 8) -> None:
    """Encode whole texts with the tokenizers library and write them to ``out``.

    NULL and empty texts are the end id alone. NULL ids come first; repeated
    ids stay apart, in no set order. Other columns are not looked at; an empty
    table writes an empty table. Range partitions split the stream by id, so
    no task holds more than its range, one document and one block.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = CHUNKS.format(kind=f"array<{kind}>")
    rows = (docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
            .repartitionByRange(id_col).sortWithinPartitions(id_col))
    id_type = pa.int64() if kind == "bigint" else None

    def run(batches):
        if vocabulary not in _encoders:
            _encoders[vocabulary] = LibraryEncoder(vocabulary)
        encode, end = _encoders[vocabulary].encode, np.array([end_id], "<u4").tobytes()
        part, chunk, done = TaskContext.get().partitionId(), 0, 0
        held, fill, index = [], 0, []

        def flush():
            nonlocal held, fill, index, chunk
            ids = np.frombuffer(b"".join(held), "<u4")
            cols = list(zip(*index, strict=True))
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([chunk], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([pack(ids, bits)], pa.binary()),
                 pa.array([list(cols[0])], pa.list_(id_type) if id_type else None)]
                + [pa.array([list(c)], pa.list_(pa.int64())) for c in cols[1:]],
                names=["part", "chunk", "n_ids", "payload", "doc_id", "start", "n_tokens", "skip", "n_here"])
            held, fill, index, chunk = [], 0, [], chunk + 1
            return row

        def encoded():
            for b in batches:
                for some in slices(b):
                    yield from zip(some.column(0).to_pylist(), encode(some.column(1)), strict=True)

        for doc, ids in encoded():
            ids += end
            n, skip = len(ids) // 4, 0
            while skip < n:
                take = min(block - fill, n - skip)
                held.append(ids[4 * skip:4 * (skip + take)])
                index.append((doc, done, n, skip, take))
                fill, skip = fill + take, skip + take
                if fill == block:
                    yield flush()
            done += n
        if fill:
            yield flush()

    rows.mapInArrow(run, schema).write.parquet(out)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files.

    ``start`` counts the ids of all documents before it. Documents within one
    block come straight from it; only those that straddle blocks are put
    together after a shuffle.
    """
    chunks = spark.read.parquet(path)
    kind = chunks.schema["doc_id"].dataType.elementType.simpleString()
    schema = f"part long, doc_id {kind}, start long, n_tokens long, skip long, ids binary"

    def pieces(whole: bool):
        def run(batches):
            for b in batches:
                for row in b.to_pylist():
                    ids, at = unpack(row["payload"]).tobytes(), 0
                    out = []
                    for doc, start, n, skip, here in zip(row["doc_id"], row["start"], row["n_tokens"],
                                                         row["skip"], row["n_here"], strict=True):
                        if (here == n) == whole:
                            out.append((row["part"], doc, start, n, skip, ids[4 * at:4 * (at + here)]))
                        at += here
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c) if i != 1 else pa.array(c, b.schema.field("doc_id").type.value_type)
                             for i, c in enumerate(zip(*out, strict=True))],
                            names=["part", "doc_id", "start", "n_tokens", "skip", "ids"])
        return run

    whole = chunks.drop("chunk", "n_ids").mapInArrow(pieces(True), schema)
    cut = chunks.drop("chunk", "n_ids").mapInArrow(pieces(False), schema)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("skip", "ids"))),
                                      lambda x: F.hex(x["ids"])), "")
    cut = cut.groupBy("part", "start", "doc_id", "n_tokens").agg(F.unhex(joined).alias("ids"))
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    cols = ["part", "doc_id", "start", "n_tokens", "ids"]
    # two numbers per part: there are no more of them than range partitions
    return (whole.select(cols).unionByName(cut.select(cols)).join(F.broadcast(before), "part")
            .select("doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids"))
