"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity.

1. Each text is cut at line ends. A line's normal form: A-Z lower-cased,
   digits made 0, ASCII punctuation dropped, words joined by one space.
2. Equal normal forms are one class from the start, for lines of
   ``exact_words`` words or more; only those of ``min_words`` words or more
   are compared with other classes. With ``exact_words=1`` every line that is
   not blank has a class. Rows carry hashes and places, never text.
3. Two classes are candidates if they share a key of one of three kinds.
   SimHash: 64 bits over the words, weighted by their length, as long words
   tell lines apart; of five blocks at least two are equal (pigeonhole) if
   three bits differ at most, so the ten pairs of blocks are keys. MinHash: 24
   bands of five minima over the words, with the same preference for long
   ones; SimHashes of lines with one word changed are mostly further apart
   than three bits. Left out: for lines of up to 16 words, the line and the
   line without each of its words. Classes whose keys leave several components
   open get each key with a band of lengths.
   Lengths travel with the keys: where two neighbours in length under a key are
   too far apart for a link, the key is cut, and keys of one class go.
4. Candidates are verified by edit similarity (1 - Levenshtein distance /
   longer length >= ``similarity``) alone, on the normal forms, which are read
   again only for classes that share a key. Links and components run as in
   ``linking``: no pair inside a component is tested.
5. Of each component, copies included, the occurrence in the smallest id
   stays (the first, within a document); the others are removed.

Texts move once, in the join that removes lines, and only for documents that
lose one (a slot filter of fixed size passes the others through).
"""

from __future__ import annotations

import math
import string
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    forgetting, in_slots, slot_bytes, slot_filter, small_batches, staged, told_apart, with_slot_flag,
)
from tidemark.llm.linking import link_groups
from tidemark.llm.packed import PACK_ROWS, bin_bits, bins_of, pack, unpack

MIN_WORDS = 4
SIMILARITY = 0.9
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]  # (lowest bit, bits)
BANDS, BAND_MINIMA = 24, 5
LEFT_OUT_WORDS = 16
BATCH_WORDS = 16_384
# Keys are shuffled with 48 bits, the others zero: random bits don't compress. Two keys
# in 2**48 that agree by chance are a candidate like others.
KEY_BITS = np.int64(-1 << 16)
MOST_CHARS = (1 << 16) - 1  # lengths beside keys end here

_FORM = bytes.maketrans(string.ascii_uppercase.encode() + string.digits.encode(),
                        string.ascii_lowercase.encode() + b"0" * 10)
_DROP = string.punctuation.encode()

_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                  0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x << np.uint64(by) | x >> np.uint64(64 - by)


def word_hashes(words: list[bytes], size: np.ndarray) -> np.ndarray:
    """xxh64 of each word; those of one length up to 31 bytes together, step
    by step as XXH64 defines it for inputs of less than 32 bytes."""
    data = np.frombuffer(b"".join(words), np.uint8)
    at = np.cumsum(size) - size
    out = np.empty(len(words), np.uint64)
    for n in np.flatnonzero(np.bincount(size)).tolist():
        which = np.flatnonzero(size == n)
        if n > 31:
            out[which] = [xxhash.xxh64_intdigest(words[i]) for i in which.tolist()]
            continue
        octets = data[at[which][:, None] + np.arange(n)]
        with np.errstate(over="ignore"):
            h = np.full(len(which), _P5 + np.uint64(n))
            for k in range(0, n - 7, 8):
                h ^= _turned(octets[:, k:k + 8].copy().view("<u8").ravel() * _P2, 31) * _P1
                h = _turned(h, 27) * _P1 + _P4
            k = n & ~7
            if n & 4:
                h ^= octets[:, k:k + 4].copy().view("<u4").ravel() * _P1
                h = _turned(h, 23) * _P2 + _P3
                k += 4
            for i in range(k, n):
                h = _turned(h ^ octets[:, i] * _P5, 11) * _P1
            h = (h ^ h >> np.uint64(33)) * _P2
            h = (h ^ h >> np.uint64(29)) * _P3
            out[which] = h ^ h >> np.uint64(32)
    return out


def line_words(text: bytes) -> list[list[bytes]]:
    """The normal form of each line as a list of words."""
    return [line.split() for line in text.translate(_FORM, _DROP).split(b"\n")]


def _parts(lines: list[list[bytes]]):
    """Slices of (non-empty) lists of words with the hash and the weight of
    each word and the place where each list starts."""
    at = 0
    while at < len(lines):
        upto, held = at, 0
        while upto < len(lines) and (upto == at or held + len(lines[upto]) <= BATCH_WORDS):
            held += len(lines[upto])
            upto += 1
        words = list(chain.from_iterable(lines[at:upto]))
        size = np.fromiter(map(len, words), np.int64, held)
        weight = (np.clip(size - 3, 0, 9) + (size > 1) + 1).astype(np.int32)
        with np.errstate(over="ignore"):
            h = (word_hashes(words, size) >> np.uint64(6)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        yield at, upto, h, weight, np.cumsum([0] + [len(x) for x in lines[at:upto - 1]])
        at = upto


# The eight bits of each byte as 16-bit counters, four to an integer: one sum counts four bits.
_LANES = np.ascontiguousarray(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
                              .astype(np.uint16).view(np.uint64).T)


def hashed_words(lines: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """SimHashes and MinHash keys of (non-empty) lists of words."""
    parts = list(_parts(lines))
    return simhashes(lines, parts), band_keys(lines, parts)


def simhashes(lines: list[list[bytes]], parts=None) -> np.ndarray:
    """64-bit SimHash of each (non-empty) list of words."""
    out = np.empty(len(lines), np.int64)
    for at, upto, h, weight, starts in parts or _parts(lines):
        total = np.add.reduceat(weight, starts)
        if total.max() < 1 << 16:
            octets, wide = h.view(np.uint8).reshape(len(h), 8), weight.astype(np.uint64)
            ones = np.stack([np.add.reduceat(_LANES[half][octets[:, i]] * wide, starts)
                             for i in range(8) for half in (0, 1)], axis=1).view(np.uint16)
        else:
            bits = np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1) * weight[:, None]
            ones = np.add.reduceat(bits, starts, axis=0)
        out[at:upto] = np.packbits(2 * ones.astype(np.int64) > total[:, None], axis=1).view(np.int64).ravel()
    return out


_MULS = np.random.Generator(np.random.Philox(key=[24, 5])).integers(
    1, 1 << 63, (BANDS, BAND_MINIMA), dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_SHIFT = np.array([0, 0, 0, 1, 1, 2, 2, 2, 3, 3, 3, 3], np.uint64)  # by weight


def _mixed(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = (key ^ value) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ key >> np.uint64(31)


def band_keys(lines: list[list[bytes]], parts=None) -> np.ndarray:
    """(lines, BANDS) MinHash keys; a word's hash is halved per weight step."""
    out = np.empty((len(lines), BANDS), np.uint64)
    for at, upto, h, weight, starts in parts or _parts(lines):
        shift = _SHIFT[weight]
        for i in range(BANDS):
            key = np.full(upto - at, i + 1, np.uint64)
            for mul in _MULS[i]:
                with np.errstate(over="ignore"):
                    key = _mixed(key, np.minimum.reduceat((h * mul) >> shift, starts))
            out[at:upto, i] = key
    return out.view(np.int64)


def block_keys(sims: np.ndarray) -> np.ndarray:
    """(lines, 10) keys: a pair of blocks each, masked and named by the pair."""
    masks = [sum(((1 << n) - 1) << lo for lo, n in pair) for pair in combinations(BLOCKS, 2)]
    sims = sims.view(np.uint64)
    return np.stack([_mixed(np.full(len(sims), 1000 + i, np.uint64) << np.uint64(40), sims & np.uint64(m))
                     for i, m in enumerate(masks)], axis=1).view(np.int64)


def left_out_keys(words: list[bytes]) -> set[int]:
    """Names of a short line and of the line without each of its words."""
    if len(words) > LEFT_OUT_WORDS:
        return set()
    return {_name(words), *(_name(words[:i] + words[i + 1:]) for i in range(len(words)))}


def _name(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def hashed_lines(rows: DataFrame, exact_words: int) -> DataFrame:
    """(_id, _row, line, cls, chars) of every line long enough. Lines of
    punctuation only have no normal form; they are named as they stand."""
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                out = []
                part = (b.column(i).slice(lo, 256).to_pylist() for i in range(3))
                for doc, row, text in zip(*part, strict=True):
                    raw = None
                    for k, words in enumerate(line_words(text)):
                        if words and len(words) >= exact_words:
                            form = b" ".join(words)
                            out.append((doc, row, k, _name(words), len(form.decode())))
                        elif not words and exact_words <= 1:
                            raw = raw or text.split(b"\n")
                            if marks := raw[k].split():
                                out.append((doc, row, k, _name([b"\n", *marks]), 0))
                if not out:
                    continue
                c = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[0], b.schema.field(0).type), *[pa.array(x, pa.int64()) for x in c[1:]]],
                    names=["_id", "_row", "line", "cls", "chars"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.select("_id", "_row", F.coalesce("_text", F.lit("")).cast("binary")).mapInArrow(
        run, f"_id {kind}, _row long, line long, cls long, chars long")


def _keys(batches, min_words: int):
    """Per slice of texts: key, class and length of every line long enough."""
    seen: set[int] = set()
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            lines, names, chars = [], [], []
            for text in b.column(0).slice(lo, 256).to_pylist():
                for words in line_words(text):
                    if words and len(words) >= min_words and (name := _name(words)) not in seen:
                        if len(seen) > 200_000:
                            seen.clear()
                        seen.add(name)
                        lines.append(words)
                        names.append(name)
                        chars.append(len(b" ".join(words).decode()))
            if not lines:
                continue
            sims, bands = hashed_words(lines)
            fixed = np.concatenate([block_keys(sims), bands], axis=1)
            out = [left_out_keys(words) for words in lines]
            left = np.fromiter((k for keys in out for k in keys), np.int64)
            times = [len(x) for x in out]
            yield (np.concatenate([fixed.ravel(), left]) & KEY_BITS,
                   *(np.concatenate([np.repeat(x, fixed.shape[1]), np.repeat(x, times)])
                     for x in (np.array(names, np.int64), np.minimum(chars, MOST_CHARS))))


def keyed_lines(texts: DataFrame, min_words: int, bits: int = 0) -> DataFrame:
    """(key, cls) of every line of ``min_words`` words or more; with ``bits``
    packed, the line's length in the key's lower bits."""
    def run(batches):
        for key, cls, _ in _keys(batches, min_words):
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(cls)], names=["key", "cls"])

    def packed(batches):
        held = []
        for key, cls, chars in _keys(batches, min_words):
            held.append((key | chars, cls))
            if sum(len(k) for k, _ in held) > PACK_ROWS:
                yield _packed(bits, held)
                held = []
        if held:
            yield _packed(bits, held)

    if bits:
        return texts.mapInArrow(forgetting(lambda: None, packed), "bin int, data binary")
    return texts.mapInArrow(forgetting(lambda: None, run), "key long, cls long")


def _packed(bits: int, held: list) -> pa.RecordBatch:
    bins, data = pack(bits, *(np.concatenate(x) for x in zip(*held, strict=True)))
    return pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), pa.array(data, pa.binary())], names=["bin", "data"])


def near_lengths(key: np.ndarray, cls: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(key, cls) of classes that share a key with one that may be linked.

    The keys hold lengths in the lower bits. In order of length, a class whose
    length is too far from the one before starts a new key: none before it
    can be linked with it or with those after it.
    """
    order = np.argsort(key)
    key, cls = key[order], cls[order]
    shared = key[1:] >> np.uint64(16) == key[:-1] >> np.uint64(16)
    shared = np.append(shared, False) | np.append(False, shared)
    key, cls = key[shared], cls[shared]
    order = np.lexsort((cls, key))
    key, cls = key[order], cls[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))[:len(key)]
    key, cls = key[fresh], cls[fresh]
    chars, kept = (key & np.uint64(MOST_CHARS)).astype(np.int64), key >> np.uint64(16)
    far = chars[1:] - chars[:-1] > np.floor(chars[1:] * (1 - similarity) + 1e-9)
    start = np.append(True, far | (kept[1:] != kept[:-1]))[:len(key)]
    group = np.cumsum(start) - 1
    several = np.bincount(group)[group] > 1
    return key[start][group][several].view(np.int64), cls[several]


def named_by_members(key: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """For rows ordered by key, a name in place of the key that depends on the
    key's classes alone: keys of equal classes propose the same pairs."""
    if not len(key):
        return key
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    members = np.add.reduceat(_mixed(np.full(len(cls), 77, np.uint64), cls.view(np.uint64)), starts)
    return np.repeat(members, np.diff(np.append(starts, len(key)))).view(np.int64)


def keys_in_reach(keyed: DataFrame, bits: int, similarity: float) -> DataFrame:
    """(key, id) of packed keys that two classes of near lengths share; of keys
    with the same classes, one."""
    def run(batches):
        def rows(which, data):
            key, cls = near_lengths(*unpack(bits, which, data, np.int64), similarity)
            key = named_by_members(key, cls)
            return pa.RecordBatch.from_arrays([pa.array(key), pa.array(cls)], names=["key", "id"])

        waiting: list = []
        for b in batches:
            for found in bins_of(b.column(0), b.column(1), waiting):
                yield rows(*found)
        if waiting:
            yield rows(*waiting)

    return (keyed.repartition("bin").sortWithinPartitions("bin")
            .mapInArrow(forgetting(lambda: None, run), "key long, id long").distinct())


def near_forms(left: list[str], right: list[str], most: np.ndarray) -> np.ndarray:
    """Which pairs are at most ``most`` edits apart (Levenshtein, code points).

    Pairs of like lengths are tested together, one anti-diagonal after the
    other, in the band that the edits leave open.
    """
    size = np.array([(len(a), len(b)) for a, b in zip(left, right, strict=True)], np.int64).reshape(-1, 2)
    near = np.zeros(len(left), bool)
    order = np.argsort(size.max(axis=1), kind="stable")
    at = 0
    while at < len(order):
        upto = at + 1
        while upto < len(order) and upto - at < 512 and (upto - at) * size[order[upto]].max() < 1 << 19 \
                and 7 * size[order[upto]].max() <= 8 * size[order[at]].max() + 56:
            upto += 1
        part = order[at:upto]
        distance = _distances([left[i] for i in part], [right[i] for i in part], size[part], int(most[part].max()))
        near[part] = distance <= most[part]
        at = upto
    return near


def _points(forms: list[str], most: int) -> np.ndarray:
    """(most, forms) code points, zeros below."""
    wide = max(map(max, filter(None, forms)), default="") > "\xff"
    kind, code = (np.uint32, "utf-32-le") if wide else (np.uint8, "latin-1")
    out = np.zeros((most, len(forms)), kind)
    for i, form in enumerate(forms):
        out[:len(form), i] = np.frombuffer(form.encode(code), kind)
    return out


def _distances(left: list[str], right: list[str], size: np.ndarray, band: int) -> np.ndarray:
    """Distances of pairs; those above ``band`` may come out larger. A pair ends
    when all its cells on two diagonals are above it: every path crosses one."""
    la, lb = size.max(axis=0).tolist()
    a, b = _points(left, la), _points(right, lb)[::-1].copy()
    far = la + lb + 2
    kind = np.int16 if far < 32_000 else np.int32
    now, last, before = (np.full((la + 3, len(left)), far, kind) for _ in range(3))  # row i + 1: i of the left
    totals, which = size.sum(axis=1), np.arange(len(left))
    out = np.full(len(left), far, np.int64)
    for total in range(la + lb + 1):
        lo, hi = max(0, total - lb, (total - band + 1) // 2), min(total, la, (total + band) // 2)
        now, last, before = before, now, last
        x, y = max(lo, 1), min(hi, total - 1) + 1
        if x < y:
            cells = now[x + 1:y + 1]
            np.add(before[x:y], a[x - 1:y - 1] != b[lb - total + x:lb - total + y], out=cells)
            step = np.minimum(last[x:y], last[x + 1:y + 1])
            step += 1
            np.minimum(cells, step, out=cells)
        now[lo] = now[hi + 2] = far
        if lo == 0:
            now[1] = total
        if hi == total:
            now[total + 1] = total
        for i in np.flatnonzero(totals == total).tolist():
            if lo <= size[i, 0] <= hi:
                out[which[i]] = now[size[i, 0] + 1, i]
        if total % 32 == 31:
            # last diagonal's rows are within one of this one's
            open_ = now[lo + 1:hi + 2].min(axis=0, initial=far) <= band
            open_ |= last[max(lo, 1):hi + 3].min(axis=0, initial=far) <= band
            open_ &= totals > total
            if 4 * np.count_nonzero(open_) <= 3 * len(open_):
                now, last, before, a, b = (np.compress(open_, x, axis=1) for x in (now, last, before, a, b))
                size, totals, which = size[open_], totals[open_], which[open_]
                if not len(which):
                    break
    return out


def with_length_band(key, chars, similarity: float):
    """The key with a band of lengths; of two classes that may be linked,
    lengths fall in one band or in neighbours, and each class shows its own
    band and the next."""
    band = F.floor(F.log(F.greatest(chars, F.lit(1)).cast("double")) / F.lit(-math.log(similarity) + 1e-9))
    return F.explode(F.array(*[F.xxhash64(key, band + up) for up in (0, 1)]))


def linked_classes(rows: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """``id, comp`` of line classes that are near another."""
    texts = rows.select(F.coalesce("_text", F.lit("")).cast("binary"))
    bits = bin_bits(rows.sparkSession)
    members = staged(keys_in_reach(keyed_lines(texts, min_words, bits), bits, similarity), "line_members")
    asked = staged(members.select(F.col("id").alias("cls")).distinct(), "line_asked")
    slots = rows.sparkSession.sparkContext.broadcast(slot_bytes(slot_filter(asked, F.col("cls"))))

    def forms(batches):
        seen: set[int] = set()
        for b in batches:
            found, text = [], []
            for t in b.column(0).to_pylist():
                lines = [w for w in line_words(t) if w and len(w) >= min_words]
                if not lines:
                    continue
                names = np.array([_name(w) for w in lines], np.int64)
                for i in np.flatnonzero(in_slots(slots.value, names)).tolist():
                    if (name := int(names[i])) not in seen:
                        if len(seen) > 200_000:
                            seen.clear()
                        seen.add(name)
                        found.append(name)
                        text.append(b" ".join(lines[i]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(text, pa.string())],
                                             names=["cls", "form"])

    texts = texts.mapInArrow(forms, "cls long, form string").join(asked, "cls", "left_semi")
    texts = staged(texts.groupBy("cls").agg(F.min("form").alias("form")), "line_forms")
    info = staged(texts.select("cls", F.char_length("form").cast("long").alias("chars")), "line_info")

    def linked(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                near = near_forms(part.column(3).to_pylist(), part.column(4).to_pylist(), part.column(2).to_numpy())
                yield part.select(["a", "b"]).filter(pa.array(near))

    def verify(pairs: DataFrame) -> DataFrame:
        side = lambda t, x, cols: t.select(F.col("cls").alias(x), *[F.col(c).alias(c + x) for c in cols])
        longer = F.greatest("charsa", "charsb")
        most = F.floor(longer * F.lit(1 - similarity) + F.lit(1e-9)).cast("int")
        near = (pairs.join(side(info, "a", ["chars"]), "a").join(side(info, "b", ["chars"]), "b")
                .filter(F.abs(F.col("charsa") - F.col("charsb")) <= most).select("a", "b", most.alias("most")))
        both = near.join(side(texts, "a", ["form"]), "a").join(side(texts, "b", ["form"]), "b")
        return both.select("a", "b", "most", "forma", "formb").mapInArrow(linked, "a long, b long")

    def longer(ids: DataFrame) -> DataFrame:
        nonlocal texts, info  # no other class is asked for from here on
        texts = staged(texts.join(ids.withColumnRenamed("id", "cls"), "cls", "left_semi"), "line_forms")
        info = staged(texts.select("cls", F.char_length("form").cast("long").alias("chars")), "line_info")
        return members.join(ids, "id").join(info.withColumnRenamed("cls", "id"), "id") \
            .select(with_length_band(F.col("key"), F.col("chars"), similarity).alias("key"), "id", "chars")

    def fits(a: str, b: str) -> Column:
        ca, cb = F.col(a + "chars"), F.col(b + "chars")
        most = F.floor(F.greatest(ca, cb) * F.lit(1 - similarity) + F.lit(1e-9))
        return (F.col(a + "id") < F.col(b + "id")) & (F.abs(ca - cb) <= most)

    return link_groups(members, verify, longer, fits, few_keys=True)


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
               similarity: float = SIMILARITY, exact_words: int | None = None) -> DataFrame:
    """``df`` with near-repeated lines removed from the text, and
    ``n_removed``, the number of lines taken from it (a column of that name
    is replaced).

    Every input row comes back, with an empty text if all its lines are
    repeats. NULL text stays NULL; blank lines stay, and so do lines of fewer
    than ``exact_words`` words (``min_words`` if not given). NULL ids rank last.
    Rows that share an id rank by the hash of their text; in a table with rows
    equal in both, rows that share an id rank in the order they are read, and
    all but the first of equal rows lose their lines. Other columns may have
    any name. An empty table gives an empty result.
    """
    small_batches(df.sparkSession)
    df = df.drop("n_removed")
    names = df.columns
    inner = df.toDF(*[f"c{i}" for i in range(len(names))])  # no name of the input meets one used here
    id_col, text_col = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    base = told_apart(inner, id_col, text_col)
    rows = base.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), "_row")
    lines = staged(hashed_lines(rows, min_words if exact_words is None else min(exact_words, min_words)), "line_rows")
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row", "line")
    classes = staged(lines.groupBy("cls").agg(F.min("chars").alias("chars"), F.min(place).alias("first"),
                                              F.max(place).alias("last")), "line_classes")
    labels = linked_classes(rows, min_words, similarity)
    labels = staged(labels.select(F.col("id").alias("cls"), "comp"), "line_labels")
    # only classes that are linked or occur twice go on
    ends = labels.select("cls").unionByName(labels.select(F.col("comp").alias("cls"))).distinct()
    some = with_slot_flag(classes, slot_filter(ends, F.col("cls")), F.col("cls"), "_linked")
    some = some.filter(F.col("_linked") | (F.col("first") != F.col("last"))).select("cls", "first", "last")
    placed = some.join(labels, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    stays = placed.groupBy("comp").agg(F.min("first").alias("stays"), F.max("last").alias("last")) \
        .filter("stays != last").select("comp", "stays")
    repeated = staged(placed.select("cls", "comp").join(stays, "comp").select("cls", "stays"), "line_repeated")
    held = with_slot_flag(lines.select("_id", "_row", "line", "cls"), slot_filter(repeated, F.col("cls")),
                          F.col("cls"), "_held").filter("_held")
    gone = held.join(repeated, "cls").filter(place != F.col("stays")).select("_id", "_row", "line").distinct()
    gone = staged(gone.groupBy("_id", "_row").agg(F.collect_list("line").alias("gone")), "line_gone")

    bits = slot_filter(gone, F.col("_row"))
    flagged = with_slot_flag(base, bits, F.col("_row"), "_cut")
    g = gone.select(F.col("_id").alias("_gid"), F.col("_row").alias("_grow"), "gone")
    touched = flagged.filter("_cut").join(
        g, (F.col("_row") == F.col("_grow")) & F.col(id_col).eqNullSafe(F.col("_gid")), "left")

    @F.pandas_udf("string")
    def without(texts: pd.Series, lines: pd.Series) -> pd.Series:
        def cut(t, k):
            if t is None or k is None:
                return t
            k = set(k.tolist())
            return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in k)
        return pd.Series([cut(t, k) for t, k in zip(texts, lines, strict=True)], dtype=object)

    touched = (touched.withColumn(text_col, without(text_col, "gone"))
               .withColumn("n_removed", F.coalesce(F.array_size("gone"), F.lit(0)).cast("long")))
    whole = flagged.filter("not _cut").withColumn("n_removed", F.lit(0).cast("long"))
    cols = [*inner.columns, "n_removed"]
    return whole.select(cols).unionByName(touched.select(cols)).toDF(*names, "n_removed")
