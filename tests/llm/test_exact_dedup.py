import hashlib

from tidemark.llm.exact_dedup import exact_dedup


def brute(rows):
    norm = {}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in rows:
        norm.setdefault((t or "").translate(low), []).append(i)
    out = []
    for t, ids in norm.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def run(df, **kw):
    got = exact_dedup(df, digest_all=True, **kw).collect()
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in got], key=repr)


def test_matches_brute_force(make_docs, prose):
    long = prose(30_000, 1)
    rows = [(1, "Abc"), (2, "aBC"), (3, "abd"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, long),
            (9, long.upper()), (10, long + "x"), (None, "only null"), (None, "abc"), (11, "x" * 70 + "a"),
            (12, "x" * 70 + "b"), (13, "same"), (13, "same")]
    assert run(make_docs(rows)) == brute(rows)


def test_many_copies_and_empty_table(make_docs):
    rows = [(i, "copy" if i % 3 else f"own {i}") for i in range(300)]
    assert run(make_docs(rows)) == brute(rows)
    assert run(make_docs([])) == []


def test_full_content_is_read_for_survivors_only(make_docs):
    got = exact_dedup(make_docs([(1, "a"), (2, "a"), (3, "bb")])).collect()
    assert {r.doc_id for r in got if r.digest is not None} == {1, 2}


def test_plan_is_native(make_docs):
    plan = exact_dedup(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
