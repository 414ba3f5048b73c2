"""Texts cut into a vocabulary's words with Arrow, each distinct word looked
up once per slice of texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES, SLICE_TEXTS = 4 << 20, 4096  # texts encoded at a time
# visible Latin characters are composed already and classed alike by every Unicode version
NOT_PLAIN = r"[^\t\n\f\r -~\x{a1}-\x{ac}\x{ae}-\x{12f}\x{131}-\x{17f}]|<\|"
LETTERS = r"|[\p{L}]+|"


def slices(batch: pa.RecordBatch, max_bytes: int = SLICE_BYTES, max_texts: int = SLICE_TEXTS):
    """Runs of rows of ``max_bytes`` of text, or one text if it has more."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(ends):
        full = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + max_bytes, "right"))
        upto = min(max(full, lo + 1), lo + max_texts)
        yield batch.slice(lo, upto - lo)
        lo = upto


def put_for_words(texts: pa.Array, look_up: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
    """Each text with its words, between ASCII white space, replaced.

    ``look_up`` gets the distinct words of all texts at once, the empty one
    among them if a text is empty or white space is at an end of it, and gives
    what stands for each.
    """
    words = pc.ascii_split_whitespace(texts)
    coded = words.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary())
    one = pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct)
    distinct = pc.binary_join(one, b"\n")[0].as_py().split(b"\n") if len(distinct) else []
    flat = pa.array(look_up(distinct), pa.large_binary()).take(coded.indices)
    ends = np.frombuffer(flat.buffers()[1], np.int64) if len(flat) else np.zeros(1, np.int64)
    ends = ends[np.cumsum([0, *pc.list_value_length(words).to_pylist()])].tolist()
    data = memoryview(flat.buffers()[2] or b"")
    return [bytes(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def encode_texts(texts: pa.Array, pattern: str, of_words: Callable[[list[bytes]], list[bytes]],
                 of_pieces: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
    """The ids of binary UTF-8 texts, put together from those of their parts.

    Texts in plain Latin letters are lower-cased and cut by ``pattern``, the
    vocabulary's; ``of_words`` is asked for the words. Letters make words of
    their own in it, so space around everything else cuts alike. Of others,
    and with a pattern of another form, ``of_pieces`` gets what stands between
    ASCII white space, as it is.
    """
    texts = texts.view(pa.large_string() if pa.types.is_large_binary(texts.type) else pa.string())
    if LETTERS not in pattern:
        return put_for_words(texts, of_pieces)
    odd = pc.match_substring_regex(texts, NOT_PLAIN)
    plain = pc.utf8_lower(texts.filter(pc.invert(odd)))
    plain = pc.replace_substring_regex(plain, f"({pattern.replace(LETTERS, '|')})", r" \1 ")
    words = put_for_words(plain, of_words)
    if len(words) == len(texts):
        return words
    words, pieces = iter(words), iter(put_for_words(texts.filter(odd), of_pieces))
    return [next(pieces if x else words) for x in odd.to_pylist()]
