"""License scan by patience alignment.

Words that stand once in the text and once in the template are anchors; the longest
subsequence of anchors in the same order is kept, and the gaps between them are
aligned in the same way. Coverage is the share of the template's words that found
their place. Alignments are tried where a text shares a pair of neighbouring words
with a template, in a window of about the template's length, so a notice that stands
twice is found twice and a long text costs no more than its length.

Near relatives differ by a word or two: a version number, "Lesser", "SA". Such telling
words must all be matched where the template has them, and none may stand
among the matched words where it has none.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksift.llm.common import text_or_empty

COVERAGE = 0.8
#: Least share of the words between the first and the last match that are matches.
DENSITY = 0.5
WORD = re.compile(r"[^\W_]+(?:[.'\-][^\W_]+)*")
#: Words that tell licenses of one family apart. Version numbers do so as well.
TELLING = frozenset(
    "lesser library affero nc sa nd by-nc by-sa by-nd by-nc-sa by-nc-nd noncommercial sharealike noderivatives noderivs "
    "attribution attribution-noncommercial attribution-sharealike attribution-noderivatives "
    "attribution-noncommercial-sharealike attribution-noncommercial-noderivatives apache mit gnu mozilla eclipse creative".split()
)
NUMBER = re.compile(r"v?\d+(?:\.\d+)*")
SCHEMA = "doc_id long, license string, start_char long, end_char long, matched int, template_words int, coverage double"

#: Public license notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain "
        "a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT-line": "Released under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    ),
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0",
}


def words_of(text: str) -> list[str]:
    return list(map(str.lower, WORD.findall(text)))


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """Matched places (text, template), ascending in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        # equal words at the ends of a gap need no anchor
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        seen, wanted = Counter(text[a:b]), Counter(template[c:d])
        place = {w: j for j, w in enumerate(template[c:d], c) if wanted[w] == 1 and seen[w] == 1}
        anchors = [(i, place[text[i]]) for i in range(a, b) if text[i] in place]
        if not anchors:
            continue
        kept = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        out += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if i + 1 < k and j + 1 < m]
    return sorted(out)


class Scanner:
    def __init__(self, templates: Mapping[str, str], coverage: float, density: float):
        self.coverage, self.density = coverage, density
        self.words = {name: words_of(text) for name, text in templates.items()}
        self.words = {name: w for name, w in self.words.items() if len(w) > 1}
        # places of each template's words that must be matched
        self.needed = {name: {j for j, x in enumerate(w) if x in TELLING or NUMBER.fullmatch(x)} for name, w in self.words.items()}
        self.seeds: dict[tuple[str, str], list[tuple[str, int]]] = defaultdict(list)
        for name, w in self.words.items():
            for j, pair in enumerate(zip(w, w[1:])):
                self.seeds[pair].append((name, j))

    def windows(self, name: str, size: int, hits: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[int]]]:
        """Stretches of the text where the template may stand, and the diagonals of each, from the places of shared pairs."""
        n = len(self.words[name])
        slack = max(4, n // 2)
        starts, at = sorted({i - j for i, j in hits}), 0
        while at < len(starts):
            end = bisect_right(starts, starts[at] + slack)
            yield max(0, starts[at] - slack), min(size, starts[end - 1] + n + slack), starts[at:end]
            at = end

    def scan(self, text: str) -> list[tuple[str, int, int, int, int, float]]:
        words = words_of(text)
        shared = set(zip(words, words[1:])).intersection(self.seeds)
        if not shared:
            return []
        hits: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, pair in enumerate(zip(words, words[1:])):
            if pair in shared:
                for name, j in self.seeds[pair]:
                    hits[name].append((i, j))
        found = []
        for name, pairs in hits.items():
            template = self.words[name]
            n, own = len(template), set(template)

            def put(lo: int, hi: int, name: str = name, template: list[str] = template) -> bool:
                got = align(words[lo:hi], template)
                share = len(got) / len(template)
                fits = bool(got) and share >= self.coverage and len(got) >= self.density * (got[-1][0] - got[0][0] + 1)
                if fits:
                    matched = {i for i, _ in got}
                    between = range(got[0][0], got[-1][0] + 1)
                    fits = self.needed[name].issubset(j for _, j in got) and not any(i not in matched and words[lo + i] in TELLING for i in between)
                if fits:
                    found.append((-share, got[-1][0] - got[0][0], lo + got[0][0], name, lo + got[-1][0], len(got)))
                return fits

            for lo, hi, starts in self.windows(name, len(words), pairs):
                if put(lo, hi) and len(starts) == 1:
                    continue
                # between neighbours of the same words no word is unique: again without them
                for s in starts:
                    a, b = max(0, s), s + n
                    if sum(map(own.__contains__, words[a:b])) >= self.coverage * n:
                        put(a, b)
        spans = [m.span() for m in WORD.finditer(text)] if found else []
        out, taken = [], defaultdict(list)
        for share, _, a, name, b, n in sorted(found):  # of overlapping finds of a template the best and shortest stays
            k = bisect_left(taken[name], (a, b))
            if (k == 0 or taken[name][k - 1][1] < a) and (k == len(taken[name]) or b < taken[name][k][0]):
                taken[name].insert(k, (a, b))
                out.append((name, spans[a][0], spans[b][1], n, len(self.words[name]), -share))
        return sorted(out, key=lambda r: (r[1], r[0]))


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE, density: float = DENSITY) -> DataFrame:
    """A row for each template found in each document: doc_id, license, the characters from
    the first to the last matched word, and the coverage.

    A find must match the template's version numbers and words of ``TELLING`` and have no
    other word of ``TELLING`` between its first and last match. Two templates may both be found on the
    same words (a notice's line and the whole notice). Null and empty texts and an empty table of templates give no row; other columns are
    not read; repeated rows are scanned each. Templates of a single word are left out.
    A projection: nothing is shuffled.
    """
    scanner = Scanner(templates, coverage, density)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
    names = ["doc_id", "license", "start_char", "end_char", "matched", "template_words", "coverage"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                found = [(k, *hit) for k, t in zip(some.column(0).to_pylist(), some.column(1).to_pylist()) for hit in scanner.scan(t)]
                columns = list(zip(*found)) if found else [[] for _ in kinds]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    return rows.mapInArrow(scan, SCHEMA)
