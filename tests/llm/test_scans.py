"""License scans, periodic runs and fill-in-middle against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import fill_in_middle as fim
from tidemark.llm import license_scan as lic
from tidemark.llm import periodic_runs as per
from tidemark.llm import queries

# ------------------------------------------------------------------ licences


def plain_words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def edits_by_end(template, words):
    """Plain dynamic program: fewest edits of the template ending at each word."""
    col, out = list(range(len(template) + 1)), []
    for w in words:
        new = [0]
        for i, t in enumerate(template, 1):
            new.append(min(col[i - 1] + (t != w), col[i] + 1, new[i - 1] + 1))
        col = new
        out.append(col[-1])
    return out


def licences_brute(text):
    words, base, labels, score = plain_words(text), set(), set(), 0.0
    for t in lic.BASE:
        p = plain_words(t.text)
        base |= {(i, t.label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p}
    for t in lic.NOTICES:
        p = plain_words(t.text)
        e = int(len(p) * 0.2 + 1e-9)
        for end, d in enumerate(edits_by_end(p, words)):
            window = words[max(0, end - len(p) - e + 1):end + 1]
            joined = " " + " ".join(window) + " "
            if d <= e and all(" " + " ".join(plain_words(k)) + " " in joined for k in t.phrases):
                labels.add(t.label)
                score = max(score, 1 - d / len(p))
    names = {x[1] for x in base}
    return (len(words), len(base), min(base)[0] if base else None, max(base)[0] if base else None,
            ",".join(sorted(names)), ",".join(sorted(names | labels)), 1.0 if base else score)


def license_texts(prose):
    rnd = random.Random(5)
    texts = [None, "", " .-! ", "under the MIT license", "Under-the\nmit; LICENSE under the mit license",
             "cc by nc cc by nc", "apache license version 2.0", "ünder the mit license", "mit license the under",
             "license " * 500, "under the " * 300 + "mit license", "Version 2 version 3 gnu general public license"]
    for t in lic.NOTICES:
        texts += [t.text, prose(40, 1) + "\n# " + t.text.upper() + ". " + prose(30, 2), t.text + " " + t.text]
        for edits in range(1, 7):  # up to and beyond what is allowed, key phrases hit as well
            w = t.text.split()
            for _ in range(edits):
                i = rnd.randrange(len(w))
                w[i:i + rnd.choice([0, 1, 1])] = rnd.choice([["foo"], [], [w[i], "bar"]])
                w = w or ["x"]
            texts.append(prose(rnd.randint(0, 20), edits) + " " + " ".join(w) + " " + prose(5, edits))
    texts.append(prose(30_000, 3) + " " + lic.NOTICES[0].text + " " + prose(5_000, 4))
    return texts


def test_license_scan_matches_brute_force(make_docs, prose):
    texts = license_texts(prose)
    rows = [*enumerate(texts), (None, "under the mit license"), (3, "again"), (3, "again")]
    got = lic.license_scan(make_docs(rows)).drop("hits").collect()
    want = [(i, *licences_brute(t)) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum("isc" in r[6] for r in want) > 2 and sum(0 < r[7] < 1 for r in want) > 20


def test_word_edits_of_random_words():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        t, w = rnd.integers(0, 4, rnd.integers(1, 9)), rnd.integers(0, 4, rnd.integers(1, 30))
        assert lic.word_edits(t, w).tolist() == edits_by_end(t.tolist(), w.tolist())


def test_index_keeps_the_rarest_words_of_all_documents(make_docs):
    docs = make_docs([(i, "software license") for i in range(5)] + [(9, "unencumbered"), (None, None)])
    counts = lic.licence_word_documents(docs, "text", lic.NOTICES)
    assert counts == {b"software": 5, b"license": 5, b"unencumbered": 1}
    index = lic.Index([lic.Template("x", "software license unencumbered released into the", ())], 0.8, counts)
    words = {w: i for w, i in index.ids.items()}
    assert {w for w, i in words.items() if i in index.postings} == {b"into", b"released", b"the"}


def test_license_scan_without_rows(make_docs):
    assert lic.license_scan(make_docs([])).collect() == []


# ------------------------------------------------------------------ runs


def runs_brute(words, min_words=24, repeats=3):
    found, n = {}, len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(min_words, repeats * q):
                found.setdefault((i, j - i + q), q)  # the smallest period of a stretch comes first
            i = j
    return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def describe_brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = runs_brute(words)
    dropped = {i for a, b, q in runs for i in range(a + q, a + b)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{a},{b},{q}\n" for a, b, q in runs).encode()).hexdigest(),
            hashlib.sha256(kept.encode()).hexdigest())


def periodic_words(rnd):
    """Runs of many periods, runs in runs, runs that touch and noise between."""
    out = []
    for _ in range(rnd.randint(1, 4)):
        out += [rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 30))]
        unit = [rnd.choice("abc" * rnd.randint(1, 3)) for _ in range(rnd.randint(1, 40))]
        if rnd.random() < 0.4:
            unit = unit * rnd.randint(1, 4) + unit[:rnd.randint(0, 3)] + ["z"] * rnd.randint(0, 2)
        out += unit * rnd.randint(1, 6) + unit[:rnd.randint(0, len(unit))]
    return out


def test_runs_of_random_texts():
    rnd = random.Random(11)
    some = 0
    for _ in range(400):
        words = periodic_words(rnd)
        want = runs_brute(words)
        assert per.runs_of([w.encode() for w in words]) == want
        some += len(want)
    assert some > 300
    for _ in range(200):  # two letters: runs overlap everywhere
        words = [rnd.choice("ab") for _ in range(120)] * rnd.randint(1, 2) + ["a"] * rnd.randint(0, 40)
        assert per.runs_of([w.encode() for w in words]) == runs_brute(words)


def test_splitting_leaves_only_words_that_recur():
    rnd = random.Random(2)
    words = [f"w{rnd.randint(0, 400)}" for _ in range(3000)] + ["a", "b", "c"] * 30 + [f"u{i}" for i in range(50)]
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a = np.array([ids[w] for w in words])
    parts = per.surviving_segments(a)
    for lo, hi in parts:
        assert hi - lo >= 24 and np.unique(a[lo:hi], return_counts=True)[1].min() >= 3
    assert any(lo <= 3000 and hi >= 3090 for lo, hi in parts)


def test_best_run_by_exact_exponent_and_ties():
    words = ["x"] * 24 + ["p", "q"] + ["y"] * 24
    assert per.runs_of([w.encode() for w in words]) == [(0, 24, 1), (26, 24, 1)]
    with pytest.raises(ValueError):
        per.periodic_runs(None, min_words=8)


def test_periodic_runs_matches_brute_force(make_docs, prose):
    rnd = random.Random(4)
    texts = [None, "", "  \n", "a " * 23, "a " * 24, "a\tb\n" * 40, prose(20_000, 1) + " p q r" * 20, "é ß " * 30,
             ("la " * 30 + "di ") * 5, *(" ".join(periodic_words(rnd)) for _ in range(30))]
    rows = [*enumerate(texts), (None, "n " * 30), (3, "again"), (3, "again")]
    got = per.periodic_runs(make_docs(rows)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, *describe_brute(t)) for i, t in rows], key=repr)
    assert per.periodic_runs(make_docs([])).collect() == []


def test_planted_runs(make_docs, prose):
    def plant(i, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(i).encode())
        g, n = h // 10, len(words)
        if i is None or h % 10 or not n:
            return text
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return " ".join(w if k < a else words[a + (k - a) % p] for k, w in enumerate(words))

    rows = [(i, prose(i % 90, i)) for i in range(300)] + [(None, "a b"), (7, None), (33, ""), (35, " ")]
    got = queries.with_planted_runs(make_docs(rows)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(i, plant(i, t)) for i, t in rows], key=repr)
    assert sum(a != b for (_, a), (_, b) in zip(rows, [(r[0], plant(*r)) for r in rows], strict=True)) > 10


# ------------------------------------------------------------------ fill in the middle


def fim_brute(i, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return (i, n, "plain", None, None, text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 50:
        return (i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def fim_rows(prose):
    rnd = random.Random(8)
    texts = [None, "", "\n", "\n\n\n", "one line", "a\r\nb c\n", "has <P> mark\nx", "<M>", "<<P\n>M>\n", "é🙂\nß\n",
             "x" * 50_000, prose(20_000, 1), "\n" * 20_000]
    texts += ["".join(rnd.choice("ab\n<PSM>é") for _ in range(rnd.randint(0, 80))) for _ in range(150)]
    return [*enumerate(texts), (None, "no\nid\n"), (None, None), (4, "other text\n"), (4, "other text\n"),
            (4, "other text\n")]


@pytest.mark.parametrize("chunk", [1, 7, 8192])
def test_fill_in_middle_matches_brute_force(make_docs, prose, chunk):
    rows = fim_rows(prose) if chunk > 1 else [r for r in fim_rows(prose) if len(r[1] or "") < 200]
    docs = make_docs(rows)
    want = [fim_brute(*r) for r in rows]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    got = fim.fill_in_middle(docs, chunk_bytes=chunk).collect()
    sha = {id(w): hashlib.sha256(w[5].encode()).hexdigest() for w in want}
    restored = [hashlib.sha256((r[1] or "").encode()).hexdigest() for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(
        [(*w[:5], sha[id(w)], r) for w, r in zip(want, restored, strict=True)], key=repr)
    texts = fim.transformed_texts(docs, chunk_bytes=chunk).collect()
    assert sorted(map(tuple, texts), key=repr) == sorted([(w[0], w[2], w[5]) for w in want], key=repr)


def test_fill_in_middle_plan_and_odd_tables(make_docs):
    assert fim.fill_in_middle(make_docs([])).collect() == []
    plan = fim.fill_in_middle(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # restoration sorts again, without a shuffle
    many = fim.output_pieces(make_docs([(1, "same\n")] * 50)).select(*fim.KEY).distinct()
    assert many.count() == 50  # equal rows have keys of their own


def test_rates(make_docs):
    docs = make_docs([(i, "a\nb\n") for i in range(300)])
    forms = [r.form for r in fim.fill_in_middle(docs, fim_rate=50, spm_rate=0).collect()]
    assert set(forms) == {"plain", "psm"} and 100 < forms.count("plain") < 200
