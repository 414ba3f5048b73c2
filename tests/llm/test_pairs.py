import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa

from tidemark.llm import jaccard_join as jj
from tidemark.llm import linking
from tidemark.llm.linking import components, link_groups
from tidemark.llm.packed import bins_of, pack, unpack

LOW = {c: c + 32 for c in range(65, 91)}


def sets_of(rows):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        out.append({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    return out


def brute(rows, linked):
    """Component (smallest non-null id) of each row by all pairs."""
    par = list(range(len(rows)))

    def root(x):
        while par[x] != x:
            x = par[x]
        return x
    for i, j in combinations(range(len(rows)), 2):
        if linked(i, j):
            par[root(j)] = root(i)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    name = {}
    for g in groups.values():
        ids = [rows[i][0] for i in g if rows[i][0] is not None]
        for i in g:
            name[i] = min(ids) if ids else None
    return [name[i] for i in range(len(rows))]


def edited(words, k, rnd):
    w = list(words)
    for _ in range(k):
        w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
    return w


def families(prose):
    rnd, rows, doc = random.Random(4), [], 0
    for f, n in enumerate((3, 5, 6, 9, 14, 25, 40, 80, 200, 700)):
        base = prose(n, f).split()
        for c in range(9):
            words = edited(base, c * max(1, n // 60), rnd)
            if c % 3 == 1:
                words = words[:max(1, len(words) - c)]
            rows.append((doc, " ".join(words).upper() if c % 2 else "  ".join(words)))
            doc += 1
    passage = prose(60, 999)
    rows += [(doc + i, prose(20 + 7 * i, 500 + i) + " " + passage) for i in range(25)]
    return rows


def test_components_equal_brute_force(make_docs, prose):
    rows = families(prose)
    rows += [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "a b"), (9004, "A  B"), (9005, "a b c"),
             (None, rows[0][1]), (9006, prose(30_000, 77)), (9007, prose(30_000, 77) + " end"), (5, rows[5][1])]
    sets = sets_of(rows)

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return both > 0 and 100 * both >= 80 * len(sets[i] | sets[j])

    want = sorted(((r[0], len(s), c) for r, s, c in zip(rows, sets, brute(rows, linked), strict=True)), key=repr)
    # rows without a set are their own components
    got = jj.jaccard_components(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want


def test_empty_table(make_docs):
    assert jj.jaccard_components(make_docs([])).count() == 0


def test_sets_within_reach_share_a_hash():
    """The pigeonhole itself, over sizes and both ways, at the exact bound."""
    rng = np.random.default_rng(2)
    for _ in range(400):
        n = int(rng.integers(4, 300))
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        n = len(base)
        inter = int(rng.integers(int(0.8 * n), n + 1))
        extra = int(rng.integers(0, n // 4 + 1))
        other = np.unique(np.concatenate([rng.permutation(base)[:inter],
                                          rng.integers(0, 1 << 63, extra, dtype=np.uint64)]))
        both = len(np.intersect1d(base, other))
        if 100 * both < 80 * (n + len(other) - both):
            continue
        shown = [{(int(h)) for _, hs, spare in jj.signature_rows(s) for h in spend(hs, spare, rng)}
                 for s in (base, other)]
        assert shown[0] & shown[1]


def spend(hashes, spare, rng):
    """Leave out as many hashes as the set may."""
    return rng.permutation(hashes)[spare:]


def test_connected_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 40)]
    edges += [(rnd.randrange(2000, 2100), rnd.randrange(2000, 2100)) for _ in range(60)] + [(7, 7), (3, 2), (3, 2)]
    got = {r.id: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    par = {}

    def root(x):
        while par.setdefault(x, x) != x:
            x = par[x]
        return x
    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            par[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in par if root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_linking_loses_no_link_between_components(spark):
    """Keys whose hub is linked with nobody: the later rounds must find the rest."""
    members = [(1, i) for i in range(12)] + [(2, i) for i in (3, 20, 21)] + [(3, 30)]
    links = {(5, 3), (7, 5), (9, 8), (21, 20), (11, 8)}
    allowed = spark.createDataFrame([(a, b) for a, b in links], "a long, b long")
    got = link_groups(spark.createDataFrame(members, "key long, id long"),
                      lambda pairs: pairs.join(allowed, ["a", "b"], "left_semi"))
    assert {(r.id, r.comp) for r in got.collect()} == {(5, 3), (7, 3), (9, 8), (11, 8), (21, 20)}


def test_packed_keys_come_back_whole():
    rng = np.random.default_rng(3)
    key = rng.integers(0, 1 << 64, 5000, np.uint64)
    cls, spare = rng.integers(-1 << 62, 1 << 62, 5000), rng.integers(0, 9, 5000).astype(np.int32)
    for bits in (8, 11, 15):
        got = []
        halves = [pack(bits, *(c[a:b] for c in (key, cls, spare))) for a, b in ((0, 2000), (2000, 5000))]
        rows = sorted((b, d) for bins, data in halves for b, d in zip(bins, data, strict=True))
        waiting = []
        for lo in range(0, len(rows), 7):  # bins go on in the next batch
            part = [pa.array(x) for x in zip(*rows[lo:lo + 7], strict=True)]
            got += [unpack(bits, *found, np.int64, np.int32) for found in bins_of(*part, waiting)]
        got.append(unpack(bits, *waiting, np.int64, np.int32))
        assert len(got) == len({b for b, _ in rows})
        assert sorted(zip(*(np.concatenate(c).tolist() for c in zip(*got, strict=True)), strict=True)) == sorted(
            zip(key.tolist(), cls.tolist(), spare.tolist(), strict=True))


def test_shared_keys_are_those_of_two_sets():
    rows = [(9, 2, 1), (9, 2, 1), (7, 4, 0), (7, 6, 0), (7, 4, 0), (5, 8, 2), (3, 4, 0), (3, 5, 1), (3, 8, 2), (2**63 - 1, 2, 1)]
    key, cls, spare = (np.array(x, t) for x, t in zip(zip(*rows, strict=True), (np.uint64, np.int64, np.int32), strict=True))
    got = jj.shared_keys(key, cls, spare)
    assert list(zip(*(x.tolist() for x in got), strict=True)) == [(3, 4, 0), (3, 5, 1), (3, 8, 2), (7, 4, 0), (7, 6, 0)]
    assert [len(x) for x in jj.shared_keys(*(x[:0] for x in (key, cls, spare)))] == [0, 0, 0]


def test_pairs_are_formed_under_one_key(spark, monkeypatch):
    """Ids that meet under many keys are one row a pair, and no link is lost as keys end on the way."""
    rnd = random.Random(5)
    members = sorted({(key, i) for key in range(24) for i in range(40) if rnd.random() < 0.6})
    links = {(a, b) for a in range(40) for b in range(a) if rnd.random() < 0.02}
    allowed = spark.createDataFrame(sorted(links), "a long, b long")
    formed, form = [], linking._pairs_of_slice

    def rows(*args):
        out = form(*args)
        formed.extend((r.a, r.b) for r in out.collect())
        return out
    monkeypatch.setattr(linking, "_pairs_of_slice", rows)
    frame = spark.createDataFrame(members, "key long, id long")
    verify = lambda pairs: pairs.join(allowed, ["a", "b"], "left_semi")
    once = {(r.id, r.comp) for r in link_groups(frame, verify, few_keys=True).collect()}
    assert formed and len(formed) == len(set(formed))
    formed.clear()
    assert once == {(r.id, r.comp) for r in link_groups(frame, verify).collect()}
    assert len(formed) > len(set(formed))  # without it they meet again under other keys


def test_components_end_with_stars(spark, monkeypatch):
    """Stars are seen as such: no further round is run on them."""
    written, write = [], linking.staged
    monkeypatch.setattr(linking, "staged", lambda df, name: written.append(name) or write(df, name))
    edges = [(1, 5), (9, 1), (7, 2), (7, 2), (3, 3)]
    got = {(r.id, r.comp) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(5, 1), (9, 1), (7, 2)} and written == ["cc"]
