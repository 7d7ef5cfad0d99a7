"""License scan: winnowed template fingerprints pick candidates, banded alignment judges them.

Templates are few and given by the caller, so their inverted index (fingerprint
to template and position) travels with the task. Every run of ``GRAM`` words of
every text is looked up in it. Hits of a template on neighbouring diagonals are
one candidate; the template's words are aligned with the words there inside a
band around those diagonals. Reported are the share of the template's words
found in order (of the text's words there, if these are more), and where they
stand in the text. Words that tell licenses apart must be the text's, no other:
versions and words like lesser, affero, NC, SA and ND in every template, in one
under ``SHORT`` words also names. A license that says more than another (three
clauses, two clauses) is a template of its own and stands for both.

Winnowing keeps the smallest of each ``SPAN`` consecutive fingerprints of a
template, so ``GRAM + SPAN - 1`` consecutive unchanged words always yield a
candidate.

Words are runs of letters and digits, A-Z as lower case. Null and empty texts
have no matches; repeated rows repeat their matches; an empty table gives none.
Of matches that lie inside one another the one with more matched words stands.
Columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apexlake.llm.common import mix, pieces, text_bytes, word_hashes, word_spans

GRAM, SPAN, BAND = 3, 2, 8
SHORT = 20
# Words that name a license, and words that make another one of it wherever they are put in.
NAMES = "mit apache gnu gpl general mozilla mpl bsd isc cc by creative commons attribution only later unlicense clause"
CHANGES = "nc sa nd noncommercial sharealike noderivatives noderivs lesser lgpl library affero agpl"
NUMBERS = " ".join(map(str, range(1, 100)))  # 2 is 2.0

# Public notices by which texts are licensed.
TEMPLATES = {
    "MIT-statement": "Released under the MIT License.",
    "Apache-2.0-statement": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-statement": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-statement": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-statement": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "MIT-0": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "0BSD": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS."),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission."),
    "BSD-4-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. All advertising materials "
        "mentioning features or use of this software must display the following acknowledgement: This product includes software "
        "developed by the organization. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission."),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This "
        "library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    "LGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    "MPL-1.1-header": (
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/ Software distributed "
        "under the License is distributed on an \"AS IS\" basis, WITHOUT WARRANTY OF ANY KIND, either express or implied. See the License "
        "for the specific language governing rights and limitations under the License."),
    # A line that names a license by its identifier.
    **{f"SPDX-{name}": f"SPDX-License-Identifier: {name}" for name in (
        "MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC-BY-4.0", "CC-BY-SA-4.0",
        "Unlicense")},
}

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False


def _hashes(texts: list[str]) -> list[np.ndarray]:
    """Word hashes of each text."""
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    starts, ends, before = word_spans(data, offsets, _SEPARATOR)
    hashes = word_hashes(data, starts, ends)
    return [hashes[s:e] for s, e in zip(before[:-1], before[1:])]


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n].copy()
    for k in range(1, size):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + words[k:n + k])
    return total


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Positions of the smallest hash of every ``span`` consecutive ones, the last of equals."""
    if len(hashes) <= span:
        return np.unique([len(hashes) - 1 - int(np.argmin(hashes[::-1]))]) if len(hashes) else np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, span)[:, ::-1]
    return np.unique(np.arange(len(windows)) + span - 1 - np.argmin(windows, axis=1))


class Index:
    """Templates as word hashes, and where each winnowed fingerprint stands in them."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words = _hashes(list(templates.values()))
        names, changes, numbers, spdx = _hashes([NAMES, CHANGES, NUMBERS, "spdx"])
        # Per template the telling words, of it and of others, and which of them it has, in order.
        self.telling: list[tuple[np.ndarray, np.ndarray]] = []
        for words in self.words:
            told = [changes, numbers if np.isin(words, numbers).any() else numbers[:0]]
            if len(words) < SHORT:
                told.append(names if (words[:1] == spdx).all() else names[np.isin(names, words)])
            told = np.concatenate(told)
            self.telling.append((told, words[np.isin(words, told)]))
        entries = [
            (int(g[at]), t, int(at)) for t, words in enumerate(self.words)
            for size in [min(GRAM, len(words))] for g in [_grams(words, size)] if size == GRAM for at in winnow(g, SPAN)
        ]
        entries.sort()
        self.prints = np.array([e[0] for e in entries], np.uint64)
        self.template = np.array([e[1] for e in entries], np.int64)
        self.place = np.array([e[2] for e in entries], np.int64)

    def tells(self, t: int, span: np.ndarray) -> bool:
        """Whether the telling words of a stretch of text are those of the template."""
        told, own = self.telling[t]
        return np.array_equal(span[np.isin(span, told)], own)


def coverage(matched: int, template: np.ndarray, span: np.ndarray) -> float:
    """Share of matched words, of the template or of the stretch of text, whichever is longer."""
    return matched / max(len(template), len(span))


def align(template: np.ndarray, words: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """``(matched, first, last)``: most template words found in order near diagonals ``low..high``.

    Cell (i, j) is template word i against text word j; only ``low <= j - i <= high`` is looked at. Of alignments with
    equally many matches the shortest stretch of text counts. ``last`` is inclusive; nothing matched gives -1, -1.
    """
    width = high - low + 1
    # Per diagonal: matches so far, first matched word (later is better), last matched word.
    row: list[tuple[int, int, int]] = [(0, -1, -1)] * (width + 1)
    for i in range(len(template)):
        fresh: list[tuple[int, int, int]] = []
        left = (0, -1, -1)
        for d in range(width):
            j = i + low + d
            best = max(row[d + 1], left, key=lambda c: (c[0], c[1]))  # skip the template word, or the text word
            if 0 <= j < len(words) and words[j] == template[i]:
                n, first, _ = row[d]  # the same diagonal, one word before
                taken = (n + 1, j if first < 0 else first, j)
                if (taken[0], taken[1]) > (best[0], best[1]):
                    best = taken
            fresh.append(best)
            left = best
        fresh.append((0, -1, -1))
        row = fresh
    return max(row, key=lambda c: (c[0], c[1]))


def occurrences(hits: list[tuple[int, int]], length: int) -> list[tuple[int, int, int, int]]:
    """``(lowest, highest diagonal, first word, last word + 1)`` of the stretches of a text that may hold the template once.

    ``hits`` are places in text and template, in order of the text. Hits on neighbouring diagonals are one occurrence
    unless the place in the template goes back; of words between two occurrences each may have any.
    """
    open_: list[list[tuple[int, int]]] = []
    closed: list[list[tuple[int, int]]] = []
    for at, place in hits:
        still = []
        for group in open_:
            (still if at - group[-1][0] <= length + BAND else closed).append(group)
        open_ = still
        near = [g for g in open_ if g[-1][1] < place and abs(at - place - g[-1][0] + g[-1][1]) <= BAND]
        if near:
            min(near, key=lambda g: (abs(at - place - g[-1][0] + g[-1][1]), -g[-1][0])).append((at, place))
        else:
            open_.append([(at, place)])
    groups = sorted(closed + open_)
    out = []
    for k, group in enumerate(groups):
        diagonals = [at - place for at, place in group]
        low, high = min(diagonals) - BAND, max(diagonals) + BAND
        # Another occurrence before or after this one keeps its words, as far as its nearest hit tells where it ends or begins.
        ends = [g[-1][0] - g[-1][1] + length for g in groups[max(0, k - 1):k]]
        begins = [g[0][0] - g[0][1] for g in groups[k + 1:k + 2]]
        start = max([0, low, *[e for e in ends if e <= group[0][0]]])
        stop = min([high + length, *[b for b in begins if b >= group[-1][0] + GRAM]])
        out.append((low, high, start, stop))
    return out


def _outermost(matches: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Matches ``(matched, template, first, last)`` that lie inside none before them in the list.

    A Fenwick tree holds the farthest end of the kept ones by where they begin.
    """
    begins = sorted({m[2] for m in matches})
    place = {b: k + 1 for k, b in enumerate(begins)}
    farthest, kept = [-1] * (len(begins) + 1), []
    for m in matches:
        k, reach = place[m[2]], -1
        while k:
            reach, k = max(reach, farthest[k]), k & (k - 1)
        if reach >= m[3]:
            continue
        kept.append(m)
        k = place[m[2]]
        while k < len(farthest):
            farthest[k] = max(farthest[k], m[3])
            k += k & -k
    return kept


def scan_texts(texts: pa.Array, index: Index, least: float) -> list[tuple[int, str, float, int, int, int]]:
    """``(row, template, coverage, matched words, start, end)`` of a string array; offsets in code points, end exclusive."""
    data, offsets = text_bytes(texts)
    starts, ends, before = word_spans(data, offsets, _SEPARATOR)
    words = word_hashes(data, starts, ends)
    grams = _grams(words, GRAM)
    first = np.searchsorted(index.prints, grams, "left")
    hit = np.flatnonzero(np.searchsorted(index.prints, grams, "right") > first)
    row_of = np.searchsorted(before, hit, "right") - 1
    inside = hit + GRAM <= before[row_of + 1]
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for at, row in zip(hit[inside].tolist(), row_of[inside].tolist()):
        k = int(first[at])
        while k < len(index.prints) and index.prints[k] == grams[at]:
            found.setdefault((row, int(index.template[k])), []).append((at - int(before[row]), int(index.place[k])))
            k += 1
    code_points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)]) if found else None
    rows: dict[int, list] = {}
    for (row, t), hits in found.items():
        template, own = index.words[t], words[before[row]:before[row + 1]]
        for low, high, start, stop in occurrences(hits, len(template)):
            for start, stop in dict.fromkeys([(start, stop), (max(0, low), high + len(template))]):
                part = own[start:stop]
                if np.isin(template, part).sum() < least * len(template):
                    continue
                matched, a, b = align(template, part, low - start, high - start)
                span = part[a:b + 1]
                if coverage(matched, template, span) >= least and index.tells(t, span):
                    rows.setdefault(row, []).append((matched, t, start + a, start + b))
                    break
    out = []
    for row, matches in sorted(rows.items()):
        matches.sort(key=lambda m: (-m[0], m[1], m[2]))
        kept = _outermost(matches)
        for matched, t, a, b in sorted(kept, key=lambda m: (m[2], m[1])):
            zero = code_points[offsets[row]]
            s, e = starts[before[row] + a], ends[before[row] + b]
            share = coverage(matched, index.words[t], words[before[row] + a:before[row] + b + 1])
            out.append((row, index.names[t], share, matched, int(code_points[s] - zero), int(code_points[e] - zero)))
    return out


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, license, coverage, n_matched, start_char, end_char`` for every match of a template in a text.

    ``least`` is the least coverage; templates shorter than ``GRAM`` words never match.
    """
    given = docs.sparkSession.sparkContext.broadcast(dict(TEMPLATES if templates is None else templates))
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))

    def run(batches):
        index = Index(given.value)
        for batch in batches:
            for piece in pieces(batch, "_text"):
                found = scan_texts(piece.column("_text"), index, least)
                columns = [*zip(*found)] or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.string()),
                     pa.array(columns[2], pa.float64()), *[pa.array(c, pa.int64()) for c in columns[3:]]],
                    names=["doc_id", "license", "coverage", "n_matched", "start_char", "end_char"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {kind}, license string, coverage double, n_matched bigint, start_char bigint, end_char bigint")
