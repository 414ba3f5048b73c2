"""License scans with a positional index of rare licence words.

1. One pass counts, for every word of the licence templates, the documents
   that hold it (a Spark aggregate over all documents; as many rows as the
   templates have words). Few documents mean a high IDF.
2. A template of m words matches a place that differs from it by at most e
   word edits (substituted, missing or added words), e = floor((1 - share) *
   m). Such a place leaves at least m - e template words in order, each
   shifted by at most e. So of any e + 2 template positions two at least are
   hit, at relative positions (place in file - place in template) at most e
   apart. The index holds the e + 2 positions of highest IDF per template.
3. The second pass looks up each file's words in that index, intersects the
   postings of a template by relative position, and aligns the template with
   the words around each hit (Sellers' alignment, one vector step per template
   word). A place counts if it has at most e edits and all mandatory key
   phrases stand within it.

The index proposes every place that alignment of whole files would accept, so
it changes the time, not the result. Phrases that must match word by word are
templates with e = 0.

No text is shuffled and no task holds more than a slice of its texts; the
index has one entry per template word, whatever the corpus.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE_ROWS = 64
MIN_SHARE = 0.8


@dataclass(frozen=True)
class Template:
    """``phrases`` are the mandatory key phrases; ``exact`` templates match
    word by word and are the base that ``first_word`` and ``n_base`` report."""
    label: str
    text: str
    phrases: tuple[str, ...] = ()
    exact: bool = False


# fixed values: phrases and labels of the base
BASE = (
    Template("mit", "under the mit license", exact=True),
    Template("apache-2", "apache license version 2", exact=True),
    Template("cc-by-nc", "cc by nc", exact=True),
)

# fixed values: wording of public licence notices, with the words that tell them apart
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files (the Software), to deal in the Software without restriction",
             ("hereby granted free of charge", "without restriction")),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
             "fee is hereby granted, provided that the above copyright notice and this permission notice appear in "
             "all copies", ("with or without fee",)),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met", ("source and binary forms",)),
    Template("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used "
             "to endorse or promote products derived from this software without specific prior written permission",
             ("endorse or promote products",)),
    Template("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
             "except in compliance with the License", ("apache license version 2 0",)),
    Template("gpl-2", "licensed under the GNU General Public License, version 2",
             ("gnu general public license", "version 2")),
    Template("gpl-3", "licensed under the GNU General Public License, version 3",
             ("gnu general public license", "version 3")),
    Template("agpl-3", "licensed under the GNU Affero General Public License, version 3",
             ("gnu affero general public license", "version 3")),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU General Public License as published by the Free Software Foundation",
             ("gnu general public license",)),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the "
             "GNU Lesser General Public License as published by the Free Software Foundation",
             ("gnu lesser general public license",)),
    Template("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
             "of the MPL was not distributed with this file, You can obtain one at", ("mozilla public license",)),
    Template("cc-by", "licensed under a Creative Commons Attribution 4.0 International License",
             ("creative commons attribution 4 0",)),
    Template("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
             ("attribution sharealike",)),
    Template("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
             ("attribution noncommercial",)),
    Template("cc0", "has waived all copyright and related or neighboring rights to this work",
             ("waived all copyright",)),
    Template("unlicense", "This is free and unencumbered software released into the public domain",
             ("free and unencumbered software",)),
    Template("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the "
             "authors be held liable for any damages arising from the use of this software",
             ("provided as is", "held liable for any damages")),
)

# bytes of words: 0-9, a-z (A-Z lowered) and all bytes of non-ASCII characters
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text."""
    return text.translate(_WORD_BYTES).split()


def word_edits(template: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each word: the fewest word edits between the template and a stretch
    of ``words`` that ends there."""
    at = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, np.int64)
    for t in template:
        up = row + 1
        up[1:] = np.minimum(up[1:], row[:-1] + (words != t))
        row = np.minimum.accumulate(up - at) + at  # words added in the file
    return row[1:]


class Index:
    """Templates as word ids, and postings of their rarest positions."""

    def __init__(self, templates, min_share: float, documents: dict[bytes, int]):
        self.templates = list(templates)
        vocabulary = sorted({w for t in self.templates for p in (t.text, *t.phrases) for w in words_of(p.encode())})
        self.ids = {w: i for i, w in enumerate(vocabulary)}
        def encode(s):
            return np.array([self.ids[w] for w in words_of(s.encode())], np.int64)
        self.words = [encode(t.text) for t in self.templates]
        self.phrases = [[encode(p) for p in t.phrases] for t in self.templates]
        self.edits = [0 if t.exact else int((1 - min_share) * len(w) + 1e-9)
                      for t, w in zip(self.templates, self.words, strict=True)]
        self.need, postings = [], defaultdict(list)
        for k, (w, e) in enumerate(zip(self.words, self.edits, strict=True)):
            by_idf = sorted(range(len(w)), key=lambda i: (documents.get(vocabulary[w[i]], 0), w[i], i))[:e + 2]
            self.need.append(min(2, len(by_idf) - e))
            for i in by_idf:
                postings[int(w[i])].append((k, i))
        self.postings = {w: np.array(p, np.int64) for w, p in postings.items()}
        self.rare = np.zeros(len(vocabulary) + 1, bool)
        self.rare[list(postings)] = True

    def regions(self, ids: np.ndarray):
        """(template, first word, end): stretches around index hits that agree
        on their relative position."""
        found = [np.column_stack([p, np.full(len(p), at)])
                 for at, p in ((i, self.postings[int(ids[i])]) for i in np.flatnonzero(self.rare[ids]))]
        if not found:
            return
        hits = np.concatenate(found)
        for k in np.unique(hits[:, 0]).tolist():
            mine = hits[hits[:, 0] == k]
            e, m = self.edits[k], len(self.words[k])
            shift = mine[:, 2] - mine[:, 1]
            order = np.lexsort((mine[:, 1], shift))
            shift, place = shift[order], mine[order, 1]
            if self.need[k] > 1:
                agree = (np.diff(shift) <= e) & (np.diff(place) != 0)
                lo, hi = shift[:-1][agree], shift[1:][agree]
            else:
                lo = hi = shift
            lo, hi = np.maximum(lo - 2 * e, 0), np.minimum(hi + m + 2 * e, len(ids))
            start = end = None
            for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
                if start is None:
                    start, end = a, b
                elif a <= end:
                    end = max(end, b)
                else:
                    yield k, start, end
                    start, end = a, b
            if start is not None:
                yield k, start, end

    def accepted(self, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words at which template ``k`` ends within its edits and with all its
        key phrases inside, and the edits."""
        w, e = self.words[k], self.edits[k]
        edits = word_edits(w, ids)
        ends = np.flatnonzero(edits <= e)
        first = ends - len(w) - e + 1
        for p in self.phrases[k]:
            here = np.ones(max(len(ids) - len(p) + 1, 0), bool)
            for i, x in enumerate(p):
                here &= ids[i:i + len(here)] == x
            starts = np.flatnonzero(here)
            nearest = np.searchsorted(starts, ends - len(p) + 1, "right") - 1  # the last one that ends in time
            ok = nearest >= 0
            ok[ok] = starts[nearest[ok]] >= first[ok]
            ends, first = ends[ok], first[ok]
        return ends, edits[ends]

    def scan(self, text: bytes):
        """(number of words, base places, hits): base places as (first word,
        label), hits as (label, last word, edits, share matched)."""
        words = words_of(text)
        get, none = self.ids.get, len(self.ids)
        ids = np.fromiter((get(w, none) for w in words), np.int64, len(words))
        base, hits = set(), set()
        for k, a, b in self.regions(ids):
            t, m = self.templates[k], len(self.words[k])
            ends, edits = self.accepted(k, ids[a:b])
            if t.exact:
                base.update((a + int(x) - m + 1, t.label) for x in ends)
                continue
            for cut in np.split(np.arange(len(ends)), np.flatnonzero(np.diff(ends) > 1) + 1):
                if len(cut):  # of neighbouring ends the one with fewest edits
                    best = cut[np.argmin(edits[cut])]
                    hits.add((t.label, a + int(ends[best]), int(edits[best]), 1 - int(edits[best]) / m))
        return len(words), sorted(base), sorted(hits, key=lambda h: (h[1], h[0], h[2]))


def licence_word_documents(df: DataFrame, text_col: str, templates) -> dict[bytes, int]:
    """Documents that hold each word of the templates, over all documents."""
    known = {w for t in templates for p in (t.text, *t.phrases) for w in words_of(p.encode())}

    def count(batches):
        n = defaultdict(int)
        for b in batches:
            for lo in range(0, b.num_rows, SLICE_ROWS):
                for text in b.column(0).slice(lo, SLICE_ROWS).to_pylist():
                    for w in known.intersection(words_of(text)):
                        n[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array(list(n.values()), pa.int64())],
                                         names=["word", "n"])

    texts = df.select(F.col(text_col).cast("binary").alias("t")).filter("t is not null")
    counts = texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counts.collect()}  # one row per template word


def license_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, notices=NOTICES,
                 min_share: float = MIN_SHARE) -> DataFrame:
    """One row per input row: ``id_col, n_words, n_base, first_word, last_word,
    base_labels, labels, score, hits``.

    ``n_base`` counts all places of the exact phrases ``base``, ``first_word``
    and ``last_word`` are the smallest and largest word number at which one
    starts (NULL without any). ``hits`` lists the notices found: label, last
    word, word edits. ``labels`` joins both kinds, ``score`` is the largest
    share of a template that matched (1 for exact phrases, 0 without any).

    NULL and empty texts have no words, no labels and score 0. Repeated rows
    and ids each get their own row, NULL ids included. Texts of any length are
    scanned whole. Other columns are not looked at; an empty table gives an
    empty result.
    """
    templates = (*base, *notices)
    index = Index(templates, min_share, licence_word_documents(df, text_col, templates))
    rows = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    kind = df.schema[id_col].dataType.simpleString()
    hit_type = pa.list_(pa.struct([("label", pa.string()), ("last_word", pa.int64()), ("edits", pa.int64())]))

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(lo, SLICE_ROWS)
                out = []
                for text in part.column(1).to_pylist():
                    n, places, hits = index.scan(text)
                    names = sorted({x[1] for x in places})
                    every = sorted({*names, *(h[0] for h in hits)})
                    out.append((n, len(places), places[0][0] if places else None, places[-1][0] if places else None,
                                ",".join(names), ",".join(every),
                                1.0 if places else max((h[3] for h in hits), default=0.0),
                                [{"label": h[0], "last_word": h[1], "edits": h[2]} for h in hits]))
                cols = list(zip(*out, strict=True))
                types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), hit_type]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                    names=[id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                           "hits"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, "
                                "base_labels string, labels string, score double, "
                                "hits array<struct<label:string,last_word:long,edits:long>>")
