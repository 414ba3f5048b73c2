import re

import numpy as np
import pytest

from tidemark.llm import mixing
from tidemark.llm.common import WORD
from tidemark.llm.mixing import mix_sources, mixed_documents, permuted, source_targets, take_words, taken_words


def fill(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Water filling by repeated clamping."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    full, target = set(), {}
    while True:
        left = share * sum(sizes.values()) - sum(cap * sizes[s] for s in full)
        rest = sum(w[s] for s in order if s not in full) or 1
        target = {s: cap * sizes[s] if s in full else left * w[s] / rest for s in order}
        over = {s for s in order if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_match_repeated_clamping(spark):
    sizes = {"b": 100, "a": 10, "é": 400, None: 50, "": 30, "zz": 0}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    assert got == pytest.approx(fill(sizes))


def test_permutation_is_one():
    for n in (1, 2, 3, 7, 64, 1000):
        got = permuted(np.arange(n), np.full(n, n), np.full(n, 12345))
        assert sorted(got) == list(range(n))
    far = permuted(np.arange(5), np.full(5, 3 * 10**12), np.full(5, 7))
    assert len(set(far)) == 5 and far.max() < 3 * 10**12


def rows(prose):
    out = [(i, prose(50 + i % 90, i), ("a", "b", None, "c")[i % 7 % 4]) for i in range(400)]
    return out + [(1000, None, "a"), (1001, "", "b"), (1002, " \n\t ", "c"), (1003, prose(20_000, 5), "a"),
                  (1004, "dup words here", "d"), (1004, "dup words here", "d"), (None, prose(40, 8), "a")]


def test_mix_is_whole_near_its_targets_and_repeatable(make_docs, prose):
    data = make_docs(rows(prose))
    first = taken_words(*mix_sources(data)).toPandas()
    assert len(first) == len(rows(prose))
    assert (first["taken"] <= 2 * first["size"]).all()
    by = first.groupby("source", dropna=False).agg(size=("size", "sum"), source_size=("source_size", "first"),
                                                   target=("target", "first"), taken=("taken", "sum"))
    assert (by["size"] == by["source_size"]).all()
    big = by[by["size"] > 1000]
    assert (abs(big["taken"] / big["target"] - 1) < 0.05).all()
    again = taken_words(*mix_sources(data)).toPandas()
    order = ["row"]
    assert first.sort_values(order)["taken"].tolist() == again.sort_values(order)["taken"].tolist()


def test_blocks_come_at_most_once_per_epoch(make_docs, prose):
    _, mix = mix_sources(make_docs(rows(prose)))
    pieces = mix.toPandas()
    assert not pieces.duplicated(["epoch", "row", "from_word"]).any()
    assert pieces["n_words"].between(1, 64).all() and set(pieces["epoch"]) <= {0, 1}


def test_sums_over_groups_of_shards_change_nothing(make_docs, prose, monkeypatch):
    data = make_docs(rows(prose))
    got = []
    for group in (3, 1_024):
        monkeypatch.setattr(mixing, "GROUP_SHARDS", group)
        mix = mix_sources(data, shard_slots=16)[1].toPandas()
        assert mix["shard"].nunique() > 20
        slots = mix[["shard", "source", "epoch", "block"]].drop_duplicates()
        assert not slots.duplicated(["source", "epoch", "block"]).any()
        got.append(sorted(map(tuple, mix.astype(str).to_numpy())))
    assert got[0] == got[1]


def test_mixed_documents_hold_the_words_taken(make_docs, prose):
    data = make_docs(rows(prose))
    taken = taken_words(*mix_sources(data)).toPandas()["taken"].sum()
    got = mixed_documents(data).toPandas()
    assert list(got.columns) == data.columns
    assert sum(len(re.findall(WORD, t)) for t in got["text"]) == taken


def test_take_words():
    assert take_words(" a b  c d", [(0, 4)]) == " a b  c d"
    assert take_words(" a b  c d", [(0, 1), (2, 1)]) == "a c "
    assert take_words("a b c d", [(1, 1), (2, 2)]) == "b c d"


def test_empty_table(make_docs):
    assert taken_words(*mix_sources(make_docs([]))).count() == 0
    assert taken_words(*mix_sources(make_docs([(1, None), (2, "")]))).toPandas()["taken"].tolist() == [0, 0]


def test_slots_are_not_broadcast(make_docs, prose):
    """They grow with the documents, whatever size Spark expects of them."""
    _, mix = mixing.mix_sources(make_docs([(k, prose(50, k), "ab"[k % 2]) for k in range(20)]))
    plan = mix._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[source_key#\d+, block#\d+L\]", plan)
    assert not re.search(r"BroadcastHashJoin \[source_key#\d+, block#\d+L\]", plan)
