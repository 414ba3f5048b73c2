import random
import re

import numpy as np
import xxhash

from tidemark.llm import line_dedup, substring_dedup
from tidemark.llm.line_dedup import line_words, simhashes


def units_brute(rows, unit, min_words):
    """Per row: text without repeated runs, by one pass in (id, unit) order."""
    every = []
    for n, (i, t) in enumerate(rows):
        for k, (a, e, w) in enumerate(substring_dedup.cut_units(t or "", unit)):
            every.append(((i is None, i or 0), n, k, a, e, tuple(w)))
    seen, marked = set(), {}
    for _, n, k, a, e, w in sorted(every, key=lambda x: (x[0], x[2])):
        if w in seen:
            marked.setdefault(n, []).append((k, a, e, len(w)))
        seen.add(w)
    out = []
    for n, (i, t) in enumerate(rows):
        gone, run = set(), []
        for x in [*sorted(marked.get(n, [])), (None, 0, 0, 0)]:
            if run and x[0] != run[-1][0] + 1:
                if sum(y[3] for y in run) >= min_words:
                    gone |= set(range(run[0][1], run[-1][2]))
                run = []
            run.append(x) if x[0] is not None else None
        out.append((i, t and "".join(c for j, c in enumerate(t) if j not in gone)))
    return sorted(out, key=repr)


def documents(prose):
    passage = ". ".join(prose(12, 900 + k) for k in range(6)) + "."
    rows = [(i, f"{prose(20, i)}.\n{prose(9, i + 50)}. {prose(8, i + 90)}!") for i in range(20)]
    rows += [(30, rows[3][1] + " " + passage), (31, prose(15, 31) + ". " + passage), (32, passage + "\nend of it"),
             (33, passage.upper()), (40, None), (41, ""), (42, "\n\n"), (43, "a. b. c."), (44, "a. b. c."),
             (None, rows[4][1]), (50, prose(15_000, 7)), (51, prose(15_000, 7)), (60, "twice. " * 30)]
    return rows


def test_substring_matches_brute_force(make_docs, prose):
    rows = documents(prose)
    for unit in ("sentence", "line"):
        got = substring_dedup.substring_dedup(make_docs(rows), unit=unit).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=repr) == units_brute(rows, unit, 10)
        source = {i: t for i, t in rows}
        for r in got:  # offsets are those of the original text
            if r.removed:
                t, at, kept = source[r.doc_id], 0, []
                for s in r.removed:
                    kept.append(t[at:s["start"]])
                    at = s["end"]
                assert "".join(kept) + t[at:] == r.text
                assert r.n_chars_removed == len(t) - len(r.text)


def test_passage_of_fifty_words_goes_wherever_it_stands(make_docs, prose):
    rows = documents(prose)
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(make_docs(rows)).collect()}
    assert got[31].n_removed and got[32].n_removed and got[33].n_removed
    assert not got[0].n_removed and not got[60].n_removed == 0


def test_short_whole_lines_go_and_short_pieces_stay(make_docs, prose):
    foot = "Some rights reserved. See licence"
    body = {k: prose(12, 700 + k) for k in range(5)}
    rows = [(k, f"{body[k]}\n{foot}\nend {'abcde'[k]}") for k in range(3)]
    rows += [(3, f"{body[3]}\none two three four five. {body[4]}"), (4, "one two three four five. own words\nEND  A \n"),
             (5, "one two three four five.  \nx"), (6, foot + "\n" + foot), (7, "end a"), (8, None)]
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(make_docs(rows), line_words=1).collect()}
    want = dict(rows) | {1: f"{body[1]}\nend b", 2: f"{body[2]}\nend c", 4: "one two three four five. own words\n",
                         5: "  \nx", 6: "", 7: ""}
    assert {i: r.text for i, r in got.items()} == want
    plain = substring_dedup.substring_dedup(make_docs(rows)).collect()
    assert {r.doc_id: r.text for r in plain} == dict(rows) | {6: ""}  # a run of ten words


def test_substring_empty_table(make_docs):
    assert substring_dedup.substring_dedup(make_docs([])).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def lines_brute(rows):
    """Every pair of lines by edit similarity alone."""
    at, forms = [], []
    for n, (_, t) in enumerate(rows):
        for k, w in enumerate(line_words((t or "").encode())):
            if len(w) >= line_dedup.MIN_WORDS:
                at.append((n, k))
                forms.append(b" ".join(w).decode())
    par = list(range(len(forms)))

    def root(x):
        while par[x] != x:
            x = par[x]
        return x
    for i in range(len(forms)):
        for j in range(i):
            a, b = forms[i], forms[j]
            longer = max(len(a), len(b))
            if a == b or distance(a, b) <= int(longer * 0.1 + 1e-9):
                par[root(i)] = root(j)
    first, gone = {}, set()
    order = lambda x: (rows[x[0]][0] is None, rows[x[0]][0] or 0, x[1])
    for i in sorted(range(len(at)), key=lambda i: order(at[i])):
        if root(i) in first:
            gone.add(at[i])
        first.setdefault(root(i), i)
    return sorted([(i, t and "\n".join(x for k, x in enumerate(t.split("\n")) if (n, k) not in gone))
                   for n, (i, t) in enumerate(rows)], key=repr)


def test_lines_match_brute_force(make_docs, prose):
    line = [prose(25, k) for k in range(8)]
    rows = [(k, f"{line[k]}\n{prose(12, 70 + k)}\n\nshort one") for k in range(8)]
    rows += [(20, line[0].upper() + ".\nshort one"), (21, line[1].replace(" ", "  ") + "\n" + line[2] + " 17"),
             (22, line[2] + " 42\nother words stand in here"), (23, line[3] + "\n" + line[3]),
             (24, " ".join(line[4].split()[:-1] + ["zz"])), (25, None), (26, ""), (27, "\n\n"), (None, line[5]),
             (28, prose(400, 5)), (29, prose(400, 5) + " tail")]
    got = line_dedup.line_dedup(make_docs(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == lines_brute(rows)
    by = {r.doc_id: r for r in got}
    assert by[20].text == "short one" and by[20].n_removed == 1 and by[23].n_removed == 2
    assert by[22].text == "other words stand in here" and by[0].n_removed == 0


def reworded(line, seed, whole_word):
    """``line`` with one letter or one word changed; similarity 0.9 or more."""
    rnd, words = random.Random(seed), line.split()
    fits = [k for k, w in enumerate(words) if 2 <= len(w) <= len(line) // 10] if whole_word else range(len(words))
    k = rnd.choice(list(fits))
    n = len(words[k]) if whole_word else 1
    at = rnd.randrange(len(words[k]) - n + 1)
    words[k] = words[k][:at] + "z" * n + words[k][at + n:]
    return " ".join(words)


def test_reworded_lines_lose_their_copies(make_docs, prose):
    line = {k: prose(5 + k % 46, 2000 + k) for k in range(138)}
    rows = list(line.items()) + [(1000 + k, reworded(t, k, False)) for k, t in line.items()]
    rows += [(2000 + k, reworded(t, k, True)) for k, t in line.items() if len(t.split()) >= 12]
    got = {r.doc_id: r for r in line_dedup.line_dedup(make_docs(rows)).collect()}
    assert [i for i in line if got[i].n_removed] == []
    assert [i for i, _ in rows if i >= 1000 and got[i].text != ""] == []


def test_scattered_changes_are_mostly_found(make_docs, prose):
    line = {k: prose(12 + k % 39, 4000 + k) for k in range(120)}
    rows = list(line.items())
    for k, t in line.items():  # three letters in a hundred, well above the similarity
        for j in range(max(2, len(t) * 3 // 100)):
            t = reworded(t, 100 * k + j, False)
        rows.append((1000 + k, t))
    got = line_dedup.line_dedup(make_docs(rows)).collect()
    assert sum(r.n_removed for r in got if r.doc_id >= 1000) >= 0.95 * len(line)


def test_short_lines_lose_exact_repeats(spark, make_docs, prose):
    import corpus_pipeline
    rows = [(k, f"All rights reserved.\n{prose(20, 6000 + k)}\n\n---\nend {'abc'[k % 3] * 3}") for k in range(6)]
    docs = make_docs([*rows, (9, "ALL  rights reserved\n***\n"), (10, None)])
    body = {k: t.split("\n")[1] for k, t in rows}
    want = {k: f"{body[k]}\n" + (f"\nend {'abc'[k] * 3}" if k < 3 else "") for k in body}
    want |= {0: rows[0][1], 9: "***\n", 10: None}
    for out in (line_dedup.line_dedup(docs, exact_words=1),
                corpus_pipeline.dedup_lines(spark, docs.select(corpus_pipeline.COLUMNS), "")):
        assert {r.doc_id: r.text for r in out.collect()} == want


def test_long_lines_and_edit_similarity_alone(make_docs, prose):
    rows = [(k, prose(5 + k, 8000 + k)) for k in range(0, 46, 5)]
    rows += [(100 + k, reworded(t, k, k % 2 and len(t.split()) >= 12)) for k, t in rows]
    rows += [(200, "something else altogether stands in this line"), (201, rows[3][1] + " " + rows[2][1])]
    plain = line_dedup.line_dedup(make_docs(rows)).collect()
    forms = {i: b" ".join(line_words(t.encode())[0]).decode() for i, t in rows}
    for r in plain:  # no SimHash in what is asked for
        near = [i for i in forms if i < r.doc_id and distance(forms[i], forms[r.doc_id])
                <= int(max(len(forms[i]), len(forms[r.doc_id])) * 0.1 + 1e-9)]
        assert r.n_removed == bool(near), r.doc_id
    assert sum(r.n_removed for r in plain) == 10
    long = [(28, prose(4000, 5)), (29, prose(4000, 5) + " tail"), (30, reworded(prose(4000, 5), 1, True)),
            (31, prose(4000, 6))]
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(make_docs(long)).collect()}
    assert got == {28: long[0][1], 29: "", 30: "", 31: long[3][1]}


def test_line_columns_and_empty_table(make_docs):
    out = line_dedup.line_dedup(make_docs([]))
    assert out.count() == 0 and out.columns.count("n_removed") == 1
    assert set(make_docs([]).columns) <= set(out.columns)


def test_lines_keep_columns_of_any_name(spark, prose):
    names = ["gone", "_gid", "_bucket", "_slot", "_row", "_cut", "_id", "_text", "cls", "a.b", "c0", "_grow"]
    rows = [(k, prose(20, 7000) if k < 2 else prose(20, 7000 + k), *[f"{n} {k}" for n in names]) for k in range(4)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, ["doc_id", "text", *names])).collect()
    want = {r[0]: (r[0], "" if r[0] == 1 else r[1], *r[2:], int(r[0] == 1)) for r in rows}
    assert {r.doc_id: tuple(r) for r in got} == want
    assert got[0].__fields__ == ["doc_id", "text", *names, "n_removed"]


def test_equal_rows_lose_their_copies(make_docs, prose):
    a, b, c = prose(25, 1), prose(25, 2), prose(25, 3)
    rows = [(1, a)] * 3 + [(2, b), (2, b + "\n" + c), (None, c), (None, c), (3, None), (3, None), (4, ""), (4, "")]
    lines = line_dedup.line_dedup(make_docs(rows), exact_words=1).collect()
    spans = substring_dedup.substring_dedup(make_docs(rows), unit="line", line_words=1).collect()
    for got in (lines, spans):
        assert len(got) == len(rows)
        texts = lambda i: sorted((r.text or "" for r in got if r.doc_id == i), key=len)  # noqa: B023, E731
        assert texts(1) == ["", "", a] and texts(None) == ["", ""]
        assert sum(t.count(b) for t in texts(2)) == 1 and sum(t.count(c) for t in texts(2)) == 1
        assert [r.text for r in got if r.doc_id == 3] == [None, None] and texts(4) == ["", ""]


def test_line_keys_are_shuffled_with_48_bits(make_docs, prose):
    rows = [(k, prose(6, k) + "\n" + prose(30, 50 + k)) for k in range(20)]
    keyed = line_dedup.keyed_lines(make_docs(rows).selectExpr("cast(text as binary)"), 4)
    assert keyed.columns == ["key", "cls"]
    got = keyed.collect()
    assert all(r.key % (1 << 16) == 0 for r in got) and any(r.cls % (1 << 16) for r in got)
    assert len({r.key for r in got}) == len(got) > 20 * 2 * 34


def test_simhash_does_not_depend_on_batches(prose):
    lines = [re.findall(rb"\S+", prose(n, n).encode()) for n in (4, 400, 9, 20_000, 30, 5)]
    one = [simhashes([x])[0] for x in lines]
    assert simhashes(lines).tolist() == one


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def test_near_forms_equal_the_full_distance():
    rnd, pairs = random.Random(9), []
    for _ in range(600):
        letters = "ab \u00e9\u6f22"[:rnd.choice((2, 4, 5))]
        a = [rnd.choice(letters) for _ in range(rnd.randrange(70))]
        b = list(a)
        for _ in range(rnd.randrange(9)):
            at = rnd.randrange(len(b) + 1)
            b[at:at + rnd.randrange(2)] = rnd.choice(["", rnd.choice(letters)])
        pairs.append(("".join(a), "".join(b)) if rnd.random() < 0.5 else ("".join(b), "".join(a)))
    pairs += [("", ""), ("", "a"), ("x" * 3000, "x" * 2900 + "y" * 100), ("x" * 3000, "y" * 3000)]
    most = np.array([int(max(map(len, p)) * rnd.choice((0, 0.1, 0.3))) for p in pairs])
    most[-2:] = 100
    got = line_dedup.near_forms([a for a, _ in pairs], [b for _, b in pairs], most)
    want = [distance(a, b) <= k for (a, b), k in zip(pairs[:-2], most, strict=False)] + [True, False]
    assert got.tolist() == want and 100 < sum(want) < 500
    assert line_dedup.near_forms([], [], np.array([], int)).tolist() == []


def test_keys_of_far_lengths_are_cut(spark, make_docs, prose):
    """Lines that share a key but not a length within a tenth are no
    candidates; a chain of near lengths stays under one key."""
    one, two = 5 << 16, 6 << 16
    rows = [(one | 40, 1), (one | 100, 2), (one | 109, 3), (one | 109, 3), (one | 120, 4), (one | 200, 5),
            (two | 65_535, 6), (two | 65_535, 7), (two | 58_982, 8), (two | 58_000, 9), (two | 50_000, 10)]
    key, cls = (np.array(x) for x in zip(*rows, strict=True))
    key, cls = line_dedup.near_lengths(key.astype(np.uint64), cls, 0.9)
    assert list(zip(key.tolist(), cls.tolist(), strict=True)) == [
        (one | 100, 2), (one | 100, 3), (one | 100, 4), (two | 58_000, 9), (two | 58_000, 8), (two | 58_000, 6), (two | 58_000, 7)]
    base = prose(8, 5).split()
    texts = make_docs([(k, " ".join(base * k)) for k in range(1, 9)]).selectExpr("cast(text as binary)")
    assert line_dedup.keys_in_reach(line_dedup.keyed_lines(texts, 4, 8), 8, 0.9).count() == 0
    texts = make_docs([(1, " ".join(base)), (2, " ".join([*base[:7], base[7] + "s"]))]).selectExpr("cast(text as binary)")
    assert {r.id for r in line_dedup.keys_in_reach(line_dedup.keyed_lines(texts, 4, 8), 8, 0.9).collect()} == {
        line_dedup._name(t.encode().split()) for t in (" ".join(base), " ".join([*base[:7], base[7] + "s"]))}


def test_keys_of_equal_classes_are_one(spark, make_docs, prose):
    """Two lines that share many keys are one group under one key; a third
    that joins some of them makes others, and links nothing less."""
    base = prose(40, 5).split()
    near = [" ".join(base), " ".join([*base[:39], base[39] + "s"]), " ".join([base[0] + "s", *base[1:39], base[39] + "s"])]

    def found(lines):
        texts = make_docs([*enumerate(lines)]).selectExpr("cast(text as binary)")
        keys = {}
        for r in line_dedup.keys_in_reach(line_dedup.keyed_lines(texts, 4, 8), 8, 0.9).collect():
            keys.setdefault(r.key, []).append(r.id)
        return [sorted(x) for x in keys.values()]

    names = [line_dedup._name(t.encode().split()) for t in near]
    assert found(near[:2]) == [sorted(names[:2])]
    groups = found(near)
    assert len(groups) == len({*map(tuple, groups)}) and {x for g in groups for x in g} == {*names}
    key, cls = np.array([1, 1, 2, 2, 3, 3, 3], np.int64), np.array([7, 9, 7, 9, 7, 8, 9], np.int64)
    a, b, c, d, e, f, g = line_dedup.named_by_members(key, cls).tolist()
    assert a == b == c == d != e == f == g and not len(line_dedup.named_by_members(key[:0], cls[:0]))


def test_far_pairs_end_early_among_near_ones():
    """Pairs that leave a batch before its end change nothing for the others."""
    rnd, pairs = random.Random(3), []
    for k in range(300):
        a = [rnd.choice("abcdefgh ") for _ in range(120 + k % 9)]
        b = list(a) if k % 3 == 0 else [rnd.choice("abcdefgh ") for _ in range(120 + k % 7)]
        for _ in range(rnd.randrange(20)):
            b[rnd.randrange(len(b))] = "x"
        pairs.append(("".join(a), "".join(b)))
    for share in (0, 0.1, 0.5):
        most = np.array([int(max(map(len, p)) * share) for p in pairs])
        got = line_dedup.near_forms(*map(list, zip(*pairs, strict=True)), most)
        assert got.tolist() == [distance(a, b) <= k for (a, b), k in zip(pairs, most, strict=True)]


def test_word_hashes_are_xxh64():
    rnd = random.Random(4)
    words = [rnd.randbytes(n) for n in range(1, 70) for _ in range(9)]
    rnd.shuffle(words)
    got = line_dedup.word_hashes(words, np.array([len(w) for w in words]))
    assert got.tolist() == [xxhash.xxh64_intdigest(w) for w in words]


def test_text_batches_are_small(spark, make_docs, prose):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, then in (("10000", 2000), ("0", 2000), ("500", 500)):
            spark.conf.set(name, given)
            line_dedup.line_dedup(make_docs([(1, prose(9, 1))]), exact_words=1)
            assert int(spark.conf.get(name)) == then
    finally:
        spark.conf.set(name, before)


def test_settled_classes_are_not_read_again(make_docs, prose, monkeypatch):
    """After the hub's tests only forms of classes whose keys are still open are kept."""
    written, write = [], line_dedup.staged

    def staged(df, name):
        out = write(df, name)
        if name == "line_forms":
            written.append({r.form for r in out.collect()})
        return out
    monkeypatch.setattr(line_dedup, "staged", staged)
    settled = prose(30, 4000).split()
    common = prose(40, 4001).split()
    rows = [(i, " ".join(settled[:i] + ["other"] + settled[i + 1:])) for i in range(3)]
    rows += [(10 + i, " ".join(common + prose(14, 4100 + i).split())) for i in range(4)]
    got = {r.doc_id: r.n_removed for r in line_dedup.line_dedup(make_docs(rows)).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 10: 0, 11: 0, 12: 0, 13: 0}
    before, after = written
    assert after < before and after <= {t for i, t in rows if i >= 10} and len(before - after) >= 3
