"""License scan by patience alignment.

A template is anchored on the words that are unique to both it and the text region: their longest
increasing subsequence is kept, and the gaps between anchors are aligned the same way. Coverage is the
share of the template's words that are aligned. Regions are the places of the whole text where enough
of the template's words stand close together; aligning less than that could not reach the coverage.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COVERAGE = 0.9
# a region is this much longer than its template, so that inserted words do not cut it
STRETCH, SLACK = 1.5, 4
_WORDS = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")

# License notices as their publishers word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version."
    ),
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3",
    "BSD-3-Clause": "Released under the BSD 3-Clause License",
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}


def words_of(text: str | None) -> list[str]:
    """Lower-cased words; a hyphen or dot inside a word belongs to it."""
    return _WORDS.findall((text or "").lower())


def rising(values: Sequence[int]) -> list[int]:
    """Positions of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for at, value in enumerate(values):
        pile = bisect_left(tops, value)
        before[at] = ends[pile - 1] if pile else -1
        tops[pile : pile + 1] = [value]
        ends[pile : pile + 1] = [at]
    found, at = [], ends[-1] if ends else -1
    while at >= 0:
        found.append(at)
        at = before[at]
    return found[::-1]


def align(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """Pairs (text position, template position) of aligned words, rising in both.

    Each gap first takes equal words at its two ends, then its own anchors; a gap without anchors is done.
    Gaps are kept on a list, so that depth does not depend on the text.
    """
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {word: at for at, word in enumerate(template[c:d], c) if there[word] == 1}
        unique = [(at, place[word]) for at, word in enumerate(text[a:b], a) if here[word] == 1 and word in place]
        anchors = [unique[i] for i in rising([t for _, t in unique])]
        if not anchors:
            continue
        pairs += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        gaps += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:]) if p + 1 < r and q + 1 < s]
    return sorted(pairs)


class Scanner:
    """Finds the templates in texts; one per task."""

    def __init__(self, templates: Mapping[str, str], coverage: float):
        self.coverage = coverage
        self.templates = [(name, words_of(text)) for name, text in templates.items()]
        self.templates = [(name, words, set(words)) for name, words in self.templates if words]

    def _regions(self, positions: Sequence[int], found: Sequence[str], width: int, need: int) -> Iterator[int]:
        """Starts of the regions of ``width`` words with at least ``need`` different template words."""
        inside: Counter[str] = Counter()
        end = 0
        for begin, start in enumerate(positions):
            while end < len(positions) and positions[end] < start + width:
                inside[found[end]] += 1
                end += 1
            if len(inside) >= need:
                yield start
            inside[found[begin]] -= 1
            if not inside[found[begin]]:
                del inside[found[begin]]

    def hits(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """(template, first word, word after the last, coverage); of hits that overlap the best one stays."""
        words = words_of(text)
        present = set(words)
        found = []
        for name, template, vocabulary in self.templates:
            allowed = len(template) - math.ceil(self.coverage * len(template))
            need = max(1, len(vocabulary) - allowed)
            if len(vocabulary & present) < need:
                continue
            positions = [at for at, word in enumerate(words) if word in vocabulary]
            width = math.ceil(len(template) * STRETCH) + SLACK
            past = -1
            for start in self._regions(positions, [words[at] for at in positions], width, need):
                if start < past:
                    continue
                pairs = align(words[start : start + width], template)
                share = len(pairs) / len(template)
                if share >= self.coverage:
                    past = start + pairs[-1][0] + 1
                    found.append((share, len(pairs), start + pairs[0][0], past, name))
        kept: list[tuple[str, int, int, float]] = []
        for share, _, begin, end, name in sorted(found, key=lambda f: (-f[1] * f[0], -f[0], f[2], f[4])):
            if all(end <= b or e <= begin for _, b, e, _ in kept):
                kept.append((name, begin, end, share))
        return sorted(kept, key=lambda h: h[1])


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``id_col`` and ``hits``, an array of (template, begin, end, coverage).

    ``begin`` and ``end`` count words of the whole text. A hit aligns at least ``coverage`` of the
    template's words in a region little longer than the template; of overlapping hits the one with the
    most aligned words stays, ties to the better covered, then the first by name. NULL, empty and wordless
    texts have no hits, repeated rows stay, an empty table gives no rows. A map over the rows.
    """
    listed = dict(templates)
    kind = docs.schema[id_col].dataType.simpleString()
    hit = pa.struct([("template", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(listed, coverage)
        for batch in batches:
            found = [
                [dict(zip(("template", "begin", "end", "coverage"), h)) for h in scanner.hits(text)]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(hit))], names=[id_col, "hits"])

    fields = "array<struct<template:string,begin:bigint,end:bigint,coverage:double>>"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(scanned, f"`{id_col}` {kind}, hits {fields}")
