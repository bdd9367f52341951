"""License scans by patience alignment.

A template is found where enough of its words align, in order, with a stretch of a text: words that are unique both in the
stretch and in the template are anchors, the longest increasing subsequence of their places is kept, and the gaps between
kept anchors are aligned in the same way. Coverage is the aligned share of the template's words.

Every text is looked at whole. A template can only reach its coverage if the words that the text holds fill that share of
its places, so texts that do not are settled by set operations, without loss; in the others, stretches twice a template's length that
hold enough of its words are aligned.

Edge cases: null and empty texts have no license; a text with several licenses lists all and is named after the one of
largest coverage, then most words, then name; repeated rows are scanned each; an empty table gives no rows; a null doc_id is
kept; other columns of the input are left out.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftlink.llm.common import ship

#: Fixed texts: (license, may be used for training, public notice).
TEMPLATES = (
    ("Apache-2.0", True, "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", True, 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("MIT", True, "Released under the MIT License."),
    ("MIT", True, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("BSD-3-Clause", True, "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-3.0", False, "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", False, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("CC-BY-NC-4.0", False, "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", True, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("All-Rights-Reserved", False, "All rights reserved."),
)
_MARKS = str.maketrans({c: " " for c in "!\"#$%&'()*+,/:;<=>?@[\\]^`{|}~-"})
_DOT = re.compile(r"\.(?=\s|$)")


def words_of(text: str) -> list[str]:
    """Lower-cased words without punctuation; a point inside a number stays."""
    return _DOT.sub(" ", text.lower().translate(_MARKS)).split()


def increasing(places: Sequence[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    heads: list[int] = []
    before: list[int] = []
    for i, x in enumerate(places):
        pile = bisect_left(tops, x)
        if pile == len(tops):
            tops.append(x)
            heads.append(i)
        else:
            tops[pile], heads[pile] = x, i
        before.append(heads[pile - 1] if pile else -1)
    out, i = [], heads[-1] if heads else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def align(text: Sequence[str], template: Sequence[str], at: int = 0, to: int = 0) -> list[tuple[int, int]]:
    """Aligned pairs (place in the text, place in the template), increasing in both."""
    pairs: list[tuple[int, int]] = []
    while text and template and text[0] == template[0]:
        pairs.append((at, to))
        text, template, at, to = text[1:], template[1:], at + 1, to + 1
    tail: list[tuple[int, int]] = []
    while text and template and text[-1] == template[-1]:
        tail.append((at + len(text) - 1, to + len(template) - 1))
        text, template = text[:-1], template[:-1]
    in_text, in_template = Counter(text), Counter(template)
    where = {w: i for i, w in enumerate(text) if in_text[w] == 1}
    anchors = [(where[w], j) for j, w in enumerate(template) if in_template[w] == 1 and w in where]
    kept = [anchors[k] for k in increasing([a for a, _ in anchors])]
    if kept:
        i0 = j0 = 0
        for i, j in [*kept, (len(text), len(template))]:
            pairs += align(text[i0:i], template[j0:j], at + i0, to + j0)
            if i < len(text):
                pairs.append((at + i, to + j))
            i0, j0 = i + 1, j + 1
    return pairs + tail[::-1]


class Scanner:
    def __init__(self, templates: Sequence[tuple[str, bool, str]], coverage: float):
        self.coverage = coverage
        self.templates = [(name, free, words_of(text)) for name, free, text in templates]
        self.sets = [frozenset(t) for _, _, t in self.templates]
        self.places = [Counter(t) for _, _, t in self.templates]
        self.every = frozenset().union(*self.sets)

    def stretches(self, words: list[str], template: list[str], known: frozenset[str]) -> Iterator[tuple[int, int]]:
        """Parts of the text, up to twice as long as the template, that hold enough of its words; each begins at one of them."""
        hits = [i for i, w in enumerate(words) if w in known]
        need, span, done = self.coverage * len(template), 2 * len(template), -1
        for k, i in enumerate(hits):
            stop = bisect_left(hits, i + span)
            if stop - k >= need and hits[stop - 1] > done:
                done = hits[stop - 1]
                yield i, min(len(words), hits[stop - 1] + 1)

    def scan(self, text: str | None) -> list[tuple[float, int, str, bool, int]]:
        """(coverage, aligned words, license, free, first word) of every template found, best first."""
        if not text:
            return []
        words = words_of(text)
        held = self.every.intersection(words)
        found = {}
        for (name, free, template), known, places in zip(self.templates, self.sets, self.places, strict=True):
            if sum(map(places.__getitem__, held & known)) < self.coverage * len(template):
                continue
            for i, j in self.stretches(words, template, known):
                pairs = align(words[i:j], template)
                share = len(pairs) / len(template)
                if share >= self.coverage:
                    found[name] = max(found.get(name, (0.0,)), (share, len(pairs), name, free, i + pairs[0][0]))
        return sorted(found.values(), key=lambda x: (-x[0], -x[1], x[2]))


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, bool, str]] = TEMPLATES, coverage: float = 0.8) -> DataFrame:
    """doc_id, license (null: none), coverage, n_aligned, first_word, licenses (sorted), permitted for each row of `docs` (doc_id, text)."""
    ship(docs.sparkSession)
    fixed = tuple(templates)

    def run(batches):
        import pyarrow as pa

        scanner = Scanner(fixed, coverage)
        for b in batches:
            found = [scanner.scan(t.as_py()) for t in b.column(1)]
            best = [f[0] if f else (0.0, 0, None, True, None) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([x[2] for x in best], pa.string()),
                    pa.array([x[0] for x in best], pa.float64()),
                    pa.array([x[1] for x in best], pa.int64()),
                    pa.array([x[4] for x in best], pa.int64()),
                    pa.array([sorted(x[2] for x in f) for f in found], pa.list_(pa.string())),
                    pa.array([all(x[3] for x in f) for f in found], pa.bool_()),
                ],
                ["doc_id", "license", "coverage", "n_aligned", "first_word", "licenses", "permitted"],
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, license string, coverage double, n_aligned long, first_word long, licenses array<string>, permitted boolean"
    )
