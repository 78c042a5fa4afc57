"""Licence texts and notices in documents, by Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from vectable.llm import rows

THRESHOLD = 0.8
WORD = re.compile(r"[^\W_]+")

# Public licence texts and the notices by which documents refer to licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",),
}


def words(text: str) -> list[str]:
    """Normalised text: runs of letters and digits, lower-cased."""
    return WORD.findall(text.lower())


Bigram = tuple[str, str]


def bigrams(w: list[str]) -> set[Bigram]:
    return set(zip(w, w[1:]))


@dataclass
class Templates:
    """Templates by number of bigrams, all their bigrams, and the templates that hold each."""

    entries: list[tuple[str, str, frozenset[Bigram]]]
    holders: dict[Bigram, tuple[int, ...]]
    threshold: float

    @property
    def most(self) -> float:
        """No text with more different bigrams can reach the threshold with any template."""
        return max((len(b) for _, _, b in self.entries), default=0) * (2 - self.threshold) / self.threshold


def compiled(templates: dict[str, tuple[str, ...]], threshold: float) -> Templates:
    entries = [(licence, f"{licence}/{k}", frozenset(bigrams(words(t)))) for licence, texts in templates.items() for k, t in enumerate(texts)]
    entries = sorted((e for e in entries if e[2]), key=lambda e: (len(e[2]), e[1]))
    holders: dict[Bigram, list[int]] = {}
    for k, (_, _, b) in enumerate(entries):
        for pair in b:
            holders.setdefault(pair, []).append(k)
    return Templates(entries, {pair: tuple(of) for pair, of in holders.items()}, threshold)


def from_starts(pairs: list[Bigram], starts: set[int], most: float) -> Iterator[tuple[int, list[tuple[Bigram, int]]]]:
    """From the last start to the first: the different bigrams from there on, by first place, one more than `most` of them.

    Going backwards, the bigram at hand moves to the front of the list, so a
    start costs no more than the bigrams it is told, however often they are repeated.
    """
    ahead: OrderedDict[Bigram, int] = OrderedDict()
    for p in range(len(pairs) - 1, -1, -1):
        ahead[pairs[p]] = p
        ahead.move_to_end(pairs[p], last=False)
        if p in starts:
            yield p, list(islice(ahead.items(), int(most) + 1))


def within_reach(pairs: list[Bigram], t: Templates) -> set[int]:
    """The templates of which a text has enough bigrams: a part that reaches one shares at least t/(2-t) of its bigrams."""
    here = t.holders.keys() & set(pairs)
    return {e for e, (_, _, b) in enumerate(t.entries) if len(here & b) * (2 - t.threshold) >= t.threshold * len(b) - 1e-9}


def in_lines(lines: list[tuple[int, list[str]]], t: Templates) -> dict[str, tuple[str, float, int, int]]:
    """{licence: (template, dice, first line, lines)} with the best run of lines for every licence that one reaches."""
    whole = [x for _, w in lines for x in w]
    of = [k for k, (_, w) in enumerate(lines) for _ in w]
    pairs = list(zip(whole, whole[1:]))
    # Without a known bigram in its first line a run agrees no better than the run without that line.
    begins = [p for p in range(len(of)) if not p or of[p] != of[p - 1]]
    ends = [*begins[1:], len(of)]
    starts = {p for p, end in zip(begins, ends) if any(b in t.holders for b in pairs[p:end])}
    best: dict[str, tuple[str, float, int, int]] = {}
    for start, ahead in from_starts(pairs, starts, t.most):
        here: dict[str, tuple[str, float, int, int]] = {}
        shared: dict[int, int] = {}
        first = lines[of[start]][0]
        for k, (pair, p) in enumerate(ahead):
            for e in t.holders.get(pair, ()):
                shared[e] = shared.get(e, 0) + 1
            n, line = k + 1, of[p + 1]
            if n > t.most:
                break
            # A run ends with a line: its last new bigram stands before that of the next line.
            if n < len(ahead) and of[ahead[n][1] + 1] == line:
                continue
            for e in sorted(shared):
                licence, name, b = t.entries[e]
                dice = 2 * shared[e] / (n + len(b))
                if dice >= t.threshold and (licence not in here or dice > here[licence][1]):
                    here[licence] = (name, dice, first, lines[line][0] - first + 1)
        for licence, found in here.items():
            if licence not in best or found[1] >= best[licence][1]:
                best[licence] = found
    return best


def in_words(w: list[str], t: Templates, asked: set[int]) -> list[tuple[str, str, float, int, int]]:
    """(licence, template, dice, first word, end) of word windows that reach a template of `asked` and do not overlap, those that share the most bigrams first.

    A best window begins and ends with bigrams of its template: without
    others at its ends it agrees better.  It holds at most 2(1-t)/t as many
    others as the template has bigrams.
    """
    pairs = list(zip(w, w[1:]))
    others = {e: 2 * (1 - t.threshold) / t.threshold * len(t.entries[e][2]) + 1e-9 for e in asked}
    most = max((len(t.entries[e][2]) + others[e] + 1 for e in asked), default=0)
    starts = {p for p, pair in enumerate(pairs) if any(e in asked for e in t.holders.get(pair, ()))}
    windows = []
    for first, ahead in from_starts(pairs, starts, most):
        for e in asked.intersection(t.holders[pairs[first]]):
            licence, name, b = t.entries[e]
            shared, best = 0, None
            for k, (pair, p) in enumerate(ahead):
                if pair in b:
                    shared += 1
                    dice = 2 * shared / (k + 1 + len(b))
                    if dice >= t.threshold and (best is None or dice > best[0]):
                        best = (dice, shared, p + 2)
                    if shared == len(b):
                        break
                elif k + 1 - shared > others[e]:
                    break
            if best:
                windows.append((-best[1], -best[0], first, best[2], licence, name))
    taken: list[tuple[str, str, float, int, int]] = []
    edges: list[int] = []
    for _, dice, first, end, licence, name in sorted(windows):
        at = bisect_right(edges, first)
        # Begins and ends of what is taken alternate: a free window lies between an end and the next begin.
        if at % 2 == 0 and (at == len(edges) or end <= edges[at]):
            edges[at:at] = [first, end]
            taken.append((licence, name, -dice, first, end))
    return taken


def scan(text: str, t: Templates, inside_lines: bool) -> list[tuple[str, str, float, int, int]]:
    """(licence, template, dice, first line, lines) of every licence: its best run of lines, or else, if inside_lines, its best word window."""
    lines = [(k, w) for k, x in enumerate(text.split("\n")) if (w := words(x))]
    whole = [x for _, w in lines for x in w]
    asked = within_reach(list(zip(whole, whole[1:])), t)
    if not asked:
        return []
    best = in_lines(lines, t)
    inside: dict[str, tuple[str, float, int, int]] = {}
    of: list[int] = []
    for licence, name, dice, first, end in in_words(whole, t, asked) if inside_lines else ():
        if licence not in best and (licence not in inside or (-dice, first) < (-inside[licence][1], inside[licence][2])):
            inside[licence] = (name, dice, first, end)
    if inside:
        of = [k for k, w in lines for _ in w]
    for licence, (name, dice, first, end) in inside.items():
        best[licence] = (name, dice, of[first], of[end - 1] - of[first] + 1)
    return [(licence, *found) for licence, found in best.items()]


def find(df: DataFrame, id_col: str = "doc_id", text: str = "text", templates: dict[str, tuple[str, ...]] | None = None, threshold: float = THRESHOLD, inside_lines: bool = False) -> DataFrame:
    """(id, licence, template, dice, first_line, n_lines): the licences of every text.

    Runs of whole lines are compared with templates by the Dice coefficient of
    their different word bigrams; a licence is reported if one of its
    templates reaches `threshold`, with the best run of lines that begins with a line in which a
    bigram of some template begins (the first and shortest of equally good ones).  With inside_lines a licence that no run of
    lines reaches is reported with its best window of words, which may begin and end inside a
    line; where windows of several templates overlap, the one that shares most bigrams
    is read there.  Templates whose number of bigrams is out
    of bounds for a run are not compared with it, and a run ends where it is
    too long for all of them.  NULL and empty texts have no licence;
    repeated rows are reported each.
    """
    t = compiled(TEMPLATES if templates is None else templates, threshold)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for s in rows.slices(batch.column(1)):
                for k, x in enumerate(batch.column(1).slice(s.first, s.last - s.first)):
                    found += [(s.first + k, *f) for f in scan(x.as_py() or "", t, inside_lines)]
            if found:
                at, licence, template, dice, first, n = zip(*found)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(licence), pa.array(template), pa.array(dice, pa.float64()), pa.array(first, pa.int64()), pa.array(n, pa.int64())], ["doc", "licence", "template", "dice", "first_line", "n_lines"])

    return df.select(id_col, text).mapInArrow(run, f"doc {kind}, licence string, template string, dice double, first_line bigint, n_lines bigint").withColumnRenamed("doc", id_col)
