"""BPE encoding and decoding by dynamic programming over prefixes.

For each prefix of a word exactly one token can be the last one of its
encoding. An automaton over the vocabulary lists, for every position, the
tokens that end there; a token ``t`` is the last one of the prefix if the
last token ``u`` of what precedes it is compatible with it: encoding the two
side by side leaves both whole. Following the stored tokens back from the
end of the word gives the exact ids, in time linear in its length for tokens
of bounded length.

Compatibility: only merges across the border between ``u`` and ``t`` can
break the pair. While ``u`` is built, its right edge is, one after the other,
each token of its right spine; likewise ``t``'s left edge. A merge of two
edge tokens happens if its rank comes before the ranks that replace either of
them, where on equal ranks the merge further left goes first.

Texts in plain Latin letters are cut into lower-cased words with Arrow, a
slice of texts at a time, and each distinct word is encoded once. Others are
cut at ASCII white space before anything else: the vocabulary's own splitting
drops white space, no normalisation step composes across it and no special
token holds any, so the pieces encode independently. Recent words and pieces
are remembered per worker (bounded, and empty when a task ends).
"""

from __future__ import annotations

import gc
import hashlib
import json
import sys
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, forgetting, release_memory
from tidemark.llm.vocabulary_words import encode_texts, slices

END = "\ue000"  # stands for the end-of-word suffix, outside the byte alphabet
SHIFT = 1 << 20  # ids are below this
LATIN_END = "\u0180"


class PrefixBpe:
    """Encoder and decoder for a vocabulary file with word-end suffix."""

    def __init__(self, path: str, memo: int = 200_000):
        import ahocorasick
        import regex
        import tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        if not suffix:
            raise ValueError("a vocabulary with an end-of-word suffix is expected")
        inner = lambda s: s[:-len(suffix)] + END if s.endswith(suffix) else s
        vocab = {inner(s): i for s, i in model["vocab"].items()}
        self.text = {i: s for s, i in model["vocab"].items()}
        self.merge, self.halves, self.rank = {}, {}, {}
        for r, (a, b) in enumerate(model["merges"]):
            a, b = inner(a), inner(b)
            whole = vocab[a + b]
            self.merge[vocab[a] * SHIFT + vocab[b]] = r
            self.halves[whole], self.rank[whole] = (vocab[a], vocab[b]), r
        self.special = {}
        for t in spec["added_tokens"]:
            self.special[t["content"]] = t["id"]
            self.text[t["id"]] = t["content"]
        self.automaton = ahocorasick.Automaton()
        for s, i in vocab.items():
            self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        self.words = regex.compile(self.pattern).findall
        self.specials = regex.compile("|".join(f"({regex.escape(s)})" for s in self.special))
        library = tokenizers.Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.pairs = Memo(self._compatible, memo)
        self.known = Memo(self._known, memo)
        self.chunks = Memo(self._chunk, memo)
        del spec, model, vocab, library
        release_memory()

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens on one edge of ``token`` with the rank that replaces each."""
        out, until = [], float("inf")
        while True:
            out.append((token, until))
            if token not in self.halves:
                return out
            until = self.rank[token]
            token = self.halves[token][side]

    def _compatible(self, pair: int) -> bool:
        u, t = divmod(pair, SHIFT)
        left = self._spine(u, 1)
        for y, y_until in self._spine(t, 0):
            for x, x_until in left:
                r = self.merge.get(x * SHIFT + y)
                if r is not None and r < x_until and r <= y_until:
                    return False
        return True

    def word_ids(self, word: str) -> list[int]:
        """Ids of one word, given in the byte alphabet.

        Position n, between the last character and its suffix, ends no token
        that the way back visits: the two are one symbol, and no token is the
        suffix alone.
        """
        n = len(word) + 1
        last, size_of, pairs = [-1] * (n + 1), [0] * (n + 1), self.pairs
        for end, (size, token) in self.automaton.iter(word + END):
            end += 1
            if last[end] < 0:
                start = end - size
                if not start or pairs[last[start] * SHIFT + token]:
                    last[end], size_of[end] = token, size
        out = []
        while n:
            out.append(last[n])
            n -= size_of[n]
        return out[::-1]

    def _known(self, word: bytes) -> bytes:
        """Ids of a lower-cased word."""
        if not word:
            return b""
        if word.isascii():  # printable ASCII stands for itself
            return _stored(self.word_ids(word.decode()))
        return _stored([i for w, _ in self.split(word.decode()) for i in self.word_ids(w)])

    def _piece(self, text: str) -> bytes:
        if text.isprintable() and max(text) < LATIN_END and "\u0130" not in text:
            # composed already, and classed alike by every Unicode version
            return b"".join([self.known[w.encode()] for w in self.words(text.lower())])
        return _stored([i for w, _ in self.split(self.normalize(text)) for i in self.word_ids(w)])

    def _chunk(self, chunk: bytes) -> bytes:
        text, out = chunk.decode(), []
        for part in self.specials.split(text) if "<|" in text else [text]:
            if part in self.special:
                out.append(_stored([self.special[part]]))
            elif part:
                out.append(self._piece(part))
        return b"".join(out)

    def _look_up(self, memo: Memo, distinct: list[bytes]) -> list[bytes]:
        out = [memo[w] for w in distinct]
        for m in (self.chunks, self.known, self.pairs):
            m.trim()
        return out

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Binary UTF-8 texts -> ids as little-endian unsigned 32-bit integers."""
        return encode_texts(texts, self.pattern, lambda w: self._look_up(self.known, w),
                            lambda w: self._look_up(self.chunks, w))

    def encode(self, text: bytes) -> bytes:
        """UTF-8 text -> ids as little-endian unsigned 32-bit integers."""
        return self.encode_all(pa.array([text], pa.binary()))[0]

    def forget(self) -> None:
        """Drop what was remembered, so that a worker that is used again
        starts its next task without it."""
        for memo in (self.chunks, self.known, self.pairs):
            memo.forget()

    def decode(self, ids: bytes) -> str:
        """Ids -> text; the vocabulary names no decoder, so tokens are joined
        by a space, specials included."""
        text = self.text
        return " ".join([text[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _stored(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


_coders: dict[str, PrefixBpe] = {}


def coder(path: str) -> PrefixBpe:
    """One coder per file and Python worker."""
    if path not in _coders:
        _coders[path] = PrefixBpe(path)
    return _coders[path]


def drop_coder(path: str) -> None:
    """Free the coder when a task ends: one is soon made, and idle workers of
    later stages would hold it."""
    _coders.pop(path, None)
    gc.collect()  # its memories refer back to it


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids`` (binary, little-endian unsigned 32-bit).

    One row per input row, whatever the ids; no shuffle. NULL and empty texts
    have no ids. Whole texts are encoded; other columns are not looked at.
    ``path`` names the vocabulary file, which every worker must see.
    """
    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))

    def run(batches):
        encode_all = coder(path).encode_all
        for b in batches:
            for part in slices(b):
                ids = encode_all(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=[id_col, "n_tokens", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(forgetting(lambda: drop_coder(path), run), f"`{id_col}` {kind}, n_tokens long, ids binary")


def decode_documents(df: DataFrame, path: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and ``text``, decoded from ``ids_col``; NULL ids give
    NULL text."""
    rows = df.select(*keep, ids_col)
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", text string"

    def run(batches):
        decode = coder(path).decode
        for b in batches:
            text = [None if x is None else decode(x) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [pa.array(text, pa.string())],
                                             names=[*keep, "text"])

    return rows.mapInArrow(run, schema)


def encode_decode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_decode_digests`` with the ids themselves in ``ids``. One worker
    per task does both directions, and holds a slice of the texts at a time."""
    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))

    def run(batches):
        c = coder(path)
        for b in batches:
            for part in slices(b, 1 << 20):
                ids = c.encode_all(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                     pa.array([hashlib.sha256(c.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                     pa.array(ids, pa.binary())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(
        forgetting(lambda: drop_coder(path), run),
        f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary")


def encode_decode_digests(df: DataFrame, path: str, id_col: str = "doc_id",
                          text_col: str = "text") -> DataFrame:
    """Encode, decode again, and keep ``id_col, n_tokens, ids_sha256,
    decoded_sha256`` (lowercase hex). Both directions run in one pass, so ids
    and decoded texts never leave the worker."""
    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))

    def run(batches):
        c = coder(path)
        for b in batches:
            for part in slices(b):
                ids = c.encode_all(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                     pa.array([hashlib.sha256(c.decode(x).encode()).hexdigest() for x in ids], pa.string())],
                    names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(forgetting(lambda: drop_coder(path), run),
                           f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
