import re

from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.common import WORD, in_slots, slot_bytes, slot_filter, with_slot_flag

from ..conftest import SF001


def test_stages_feed_each_other(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    before, seen = docs.count(), []
    for name, stage in corpus_pipeline.STAGES:
        from tidemark.llm.common import staged
        out = staged(stage(spark, docs, SF001), f"test_{name}")
        seen.append((name, out.count()))
        if name != "bpe":
            assert out.columns == corpus_pipeline.COLUMNS
            assert out.filter("n_chars != char_length(text)").count() == 0
        if name == "toxicity":
            bad = F.lower("text").rlike(r"\b(idiot|moron|scum)\b")
            assert out.filter(bad).count() < 0.2 * docs.filter(bad).count()
        if name == "line_dedup":
            assert out.count() == docs.count()
        if name == "mixing":
            words = lambda d: sum(len(re.findall(WORD, r.text or "")) for r in d.select("text").collect())
            assert abs(words(out) / words(docs) - 1.5) < 0.05
        docs = out
    assert [n for n, _ in seen] == ["toxicity", "line_dedup", "jaccard_join", "mixing", "bpe"]
    assert seen[0][1] < before and seen[2][1] <= seen[1][1] and seen[4][1] == seen[3][1]
    assert docs.filter("n_tokens = 0").count() == 0


def test_stages_take_odd_rows(spark, make_docs, prose):
    from tidemark.llm.common import staged
    rows = [(i, prose(30 + i, i)) for i in range(20)] + [(20, None), (21, ""), (None, prose(9, 3)), (22, prose(30, 0)),
                                                        (23, prose(9000, 1))]
    for data in (make_docs(rows), make_docs([])):
        docs = data.select(corpus_pipeline.COLUMNS)
        for name, stage in corpus_pipeline.STAGES:
            docs = staged(stage(spark, docs, SF001), f"test_{name}")
        assert (docs.count() > 0) == (data.count() > 0)


def test_last_stage_decodes_its_ids(spark, make_docs, prose, vocabulary):
    import hashlib
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers
    library = tokenizers.Tokenizer.from_file(vocabulary)
    library.no_padding()
    library.no_truncation()
    rows = [(i, prose(30 + i, i)) for i in range(9)] + [(20, None), (21, ""), (22, "Don't STOP it'll é 日本 1234"),
                                                       (23, "a  b\n\nc")]
    docs = make_docs(rows).select(corpus_pipeline.COLUMNS)
    got = {r.doc_id: r for r in corpus_pipeline.encode(spark, docs, SF001).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(want, skip_special_tokens=False)
        assert got[i].n_tokens == len(want)
        assert list(memoryview(bytes(got[i].ids)).cast("I")) == want
        assert got[i].ids_sha256 == hashlib.sha256(bytes(got[i].ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_line_and_jaccard_stages_match_brute_force(spark, make_docs, prose):
    from .test_pairs import brute, sets_of
    from .test_text_dedup import distance, reworded
    line = [prose(14, 9100 + k) for k in range(6)]
    rows = [(k, f"{t}\nfooter\n{prose(16, 9200 + k)}") for k, t in enumerate(line)]
    rows += [(10 + k, reworded(t, k, False) + f"\n{prose(18, 9300 + k)}") for k, t in enumerate(line)]
    docs = make_docs(rows).select(corpus_pipeline.COLUMNS)
    seen, want = [], {}
    for i, t in rows:
        keep = []
        for x in t.split("\n"):
            if not any(x == y or distance(x, y) <= int(max(len(x), len(y)) * 0.1 + 1e-9) for y in seen):
                keep.append(x)
            seen.append(x)
        want[i] = "\n".join(keep)
    got = {r.doc_id: r.text for r in corpus_pipeline.dedup_lines(spark, docs, SF001).collect()}
    assert got == want and got[11] == rows[7][1].split("\n")[1]

    rows = list(want.items()) + [(50 + k, want[k] + " tail") for k in range(3)] + [(60, prose(12, 1)), (61, None)]
    sets = sets_of(rows)
    names = brute(rows, lambda i, j: 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) > 0)
    stays = {i: t for (i, t), name in zip(rows, names, strict=True) if name == i}
    out = corpus_pipeline.one_per_group(spark, make_docs(rows).select(corpus_pipeline.COLUMNS), SF001)
    assert {r.doc_id: r.text for r in out.collect()} == stays and 50 not in stays


def test_slot_filter_never_says_no_to_a_key(spark):
    keys = spark.range(0, 5000).select(F.xxhash64("id").alias("k"))
    bits = slot_filter(keys, F.col("k"))
    every = spark.range(0, 200_000).select("id", F.xxhash64("id").alias("k"))
    flagged = with_slot_flag(every, bits, F.col("k"), "hit").cache()
    assert flagged.filter("id < 5000 and not hit").count() == 0
    assert flagged.filter("id >= 5000 and hit").count() < 200
    got = flagged.toPandas()
    assert (in_slots(slot_bytes(bits), got["k"].to_numpy()) == got["hit"].to_numpy()).all()


def test_run_leaves_only_its_result(spark):
    import os

    from tidemark.session import scratch_path
    root = os.path.dirname(scratch_path(spark, "x")).removeprefix("file:")
    held = lambda: set(os.listdir(root)) if os.path.isdir(root) else set()
    before = held()
    out = corpus_pipeline.run(spark, SF001)
    left = held() - before
    assert len(left) == 1 and next(iter(left)).startswith("pipeline_bpe-")
    assert out.count() > 0 and {"doc_id", "n_tokens", "ids_sha256"} <= set(out.columns)
