import hashlib
import os
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import bpe, token_files
from tidemark.session import scratch_path

TEXTS = [None, "", "  \n ", "Hello don't STOP it'll", "a<|endoftext|>b <|startoftext|> <|endof", "é É ß ﬁ İ Σς",
         "日本語 テスト ٣٤ ½ ²", "x" * 5000, "\x00\x1f \x7f\x85a\xa0b　c​d", "á ́ ẹ́",
         "🙂👩‍👩‍👧 ok", "'s't 're've 'm'll'd", "1234 5a6", "</w> w</w>"]


@pytest.fixture(scope="module")
def library(vocabulary):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers
    t = tokenizers.Tokenizer.from_file(vocabulary)
    t.no_padding()
    t.no_truncation()
    return t


def test_prefix_bpe_equals_the_library(vocabulary, library, prose):
    coder = bpe.PrefixBpe(vocabulary, memo=50)  # small memory: forget often
    rnd = random.Random(3)
    alphabet = "abcdeinorst'. <|>éß09\ńИ"
    texts = [t for t in TEXTS if t] + [prose(300, s) for s in range(5)]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        ids = coder.encode(t.encode())
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert coder.decode(ids) == library.decode(want, skip_special_tokens=False), t


def test_every_vocabulary_entry_of_letters(vocabulary, library):
    coder = bpe.PrefixBpe(vocabulary)
    words = [w.removesuffix("</w>") for w in library.get_vocab() if w.removesuffix("</w>").isascii()]
    for w in words[::7]:
        assert np.frombuffer(coder.encode(w.encode()), "<u4").tolist() == \
            library.encode(w, add_special_tokens=False).ids


def test_encode_decode_documents(make_docs, vocabulary, library):
    docs = make_docs(list(enumerate(TEXTS)) + [(None, "null id"), (3, "again")])
    ids = bpe.encode_documents(docs, vocabulary)
    back = bpe.decode_documents(ids, vocabulary, ["doc_id"]).toPandas()
    digests = bpe.encode_decode_digests(docs, vocabulary).toPandas()
    assert len(back) == len(digests) == len(TEXTS) + 2
    for i, t in enumerate(TEXTS):
        if i == 3:
            continue
        want = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(want, skip_special_tokens=False)
        row = digests[digests.doc_id == i].iloc[0]
        assert row.n_tokens == len(want)
        assert row.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert back[back.doc_id == i].iloc[0].text == text
    assert bpe.encode_documents(make_docs([]), vocabulary).count() == 0


def test_library_by_word_equals_whole_texts(vocabulary, library, prose):
    coder = token_files.LibraryEncoder(vocabulary, limit=40)  # small memory: forget often
    rnd = random.Random(5)
    alphabet = "abcdeinorst'!. <|>éß09\ńИ"
    texts = [t or "" for t in TEXTS] + [prose(300, s) for s in range(5)]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    for lo in range(0, len(texts), 7):
        some = texts[lo:lo + 7]
        got = coder.encode([t.encode() for t in some])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == \
            [library.encode(t, add_special_tokens=False).ids for t in some]


def test_plain_texts_share_their_words(vocabulary, library, monkeypatch):
    import pyarrow as pa
    coder, asked = token_files.LibraryEncoder(vocabulary), []
    together = coder._together
    monkeypatch.setattr(coder, "_together", lambda words: asked.extend(words) or together(words))
    texts = ["(Night, NIGHT's night.)", " night!\x0b\t'NIGHT'", "", "ÀÉ\x0cé12 ''s'tis\n", "日本 night", "<|endoftext|>night"] * 3
    for kind in (pa.binary(), pa.large_binary()):
        got = coder.encode(pa.array([t.encode() for t in texts], kind)[1:])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == \
            [library.encode(t, add_special_tokens=False).ids for t in texts[1:]]
    assert "night" in asked and len(asked) == len(set(asked))
    assert b"NIGHT" not in coder.chunks.now  # words are remembered, not what punctuation makes of them


def test_bpe_remembers_words_as_bytes(vocabulary, library):
    import pyarrow as pa
    coder = bpe.PrefixBpe(vocabulary, memo=5)
    texts = ["Night, NIGHT night.", "it's ''s 'tis", "é12 À\t", "", "日本 night"]
    got = coder.encode_all(pa.array([t.encode() for t in texts]))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == \
        [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert coder.known.old[b"night"] == coder.encode(b"NIGHT") and set(map(type, coder.known.old.values())) == {bytes}
    assert b"Night," not in coder.chunks and b"Night," not in coder.chunks.old
    coder.forget()
    assert not (coder.known or coder.known.old or coder.pairs or coder.chunks)


def test_slices_hold_every_row_once(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(token_files, "SLICE_BYTES", 10)
    monkeypatch.setattr(token_files, "SLICE_TEXTS", 3)
    texts = [b"", b"x" * 40, b"abc", b"d" * 7, b"", b"", b"", b"", b"e" * 10, b"f" * 11, b"g"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], names=["i", "t"])
    for some in (batch, batch.slice(2), batch.slice(0, 0)):
        cut = list(token_files.slices(some))
        assert [i for s in cut for i in s.column(0).to_pylist()] == some.column(0).to_pylist()
        assert all(len(s) <= 3 and (len(s) == 1 or sum(map(len, s.column(1).to_pylist())) <= 10) for s in cut)


@pytest.mark.parametrize("bits", [1, 8])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert (token_files.unpack(token_files.pack(ids, bits)) == ids).all()
    with pytest.raises(ValueError):
        token_files.unpack(b"nope" + bytes(60))


@pytest.mark.parametrize("bits,block", [(8, 100), (1, 7), (8, 65_536)])
def test_files_hold_all_ids_in_order(spark, make_docs, vocabulary, library, prose, bits, block):
    texts = TEXTS + [prose(40 * k, k) for k in range(12)]
    rows = [((i * 7) % 101, t) for i, t in enumerate(texts)]
    path = scratch_path(spark, "test_tokens")
    token_files.write_tokens(make_docs(rows), path, vocabulary, bits=bits, block=block)
    got = token_files.read_tokens(spark, path).toPandas().sort_values("doc_id")
    assert got["doc_id"].tolist() == sorted(i for i, _ in rows)
    at = 0
    for (_, t), r in zip(sorted(rows, key=lambda r: r[0]), got.itertuples(), strict=True):
        want = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert (r.start, r.n_tokens) == (at, len(want) // 4)
        assert zlib.crc32(bytes(r.ids)) == zlib.crc32(want)
        at += len(want) // 4


def test_files_of_an_empty_table_and_repeated_ids(spark, make_docs, vocabulary):
    path = scratch_path(spark, "test_tokens")
    token_files.write_tokens(make_docs([]), path, vocabulary)
    assert token_files.read_tokens(spark, path).count() == 0
    path = scratch_path(spark, "test_tokens")
    token_files.write_tokens(make_docs([(5, "a b"), (5, "a b"), (None, "c")]), path, vocabulary)
    got = token_files.read_tokens(spark, path).toPandas()
    assert sorted(got["start"]) == [0, 2, 5] and got["n_tokens"].sum() == 8


def test_a_task_leaves_no_coder_in_its_worker(spark, make_docs, vocabulary):
    docs = make_docs([(i, "one two") for i in range(4)]).coalesce(1)
    bpe.encode_decode_documents(docs, vocabulary).collect()
    left = docs.select("doc_id").mapInArrow(lambda batches: _left(batches), "n long").collect()
    assert {r.n for r in left} == {0}


def _left(batches):
    import pyarrow as pa
    for _ in batches:
        yield pa.RecordBatch.from_arrays([pa.array([len(bpe._coders)], pa.int64())], names=["n"])
