"""License scan: winnowed template fingerprints pick candidates, banded alignment confirms them.

Templates are words (lower-case letters and digits of any script's UTF-8 bytes): full licence texts
(``license_texts``, as their publishers give them), short licences, file headers and one-line notices.
Of every template's ``GRAM``-word hashes the minimum of each window of ``WINDOW`` is kept (winnowing), in
an inverted index from hash to (template, place); of templates of fewer than ``SHORT`` words all pairs of
words are kept, as an edit or two leave them no longer run. A document's grams are all looked up,
so a template that shares a run of ``GRAM + WINDOW - 1`` words with it is always met. Seeds of a
template on nearby diagonals form a region; one with fewer seeds than a copy with a fifth of its
words changed still has is no candidate. The others are aligned to the whole template in a band
around their diagonals: +2 for a word matched, -1 for one replaced, missing or extra; rows are as
wide as the band, whatever the document's length. Coverage is the share of the template's words
that matched; regions of at least ``COVERAGE`` are reported with their span in code points. Where
regions overlap, the one with more matched words stays.

The index holds the templates only: its size does not follow the corpus, and it is broadcast (under
1 MB of text). A document is handled in one task, its memory bounded by its own length. Defined results:
null text counts as empty; no match gives zero and an empty string; repeated rows each get their
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from importlib import resources
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import batches, ship, text_or_empty

GRAM, WINDOW, SHORT, COVERAGE = 3, 2, 25, 0.8
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)

_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code"
    " must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this"
    " list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY'
    " AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL"
    " DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: Notices, headers and licences of a few paragraphs; ``templates()`` adds the full texts.
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        ' "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation,"
        " either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
        " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software'
        " without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies"
        ' or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF'
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,"
        " WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this"
        ' permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED'
        " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER"
        " RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
        " PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2-Clause": _BSD_2 + _BSD_END,
    "BSD-3-Clause": _BSD_2 + _BSD_3 + _BSD_END,
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to"
        " anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must"
        " not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not"
        " required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce,"
        " display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:"
        " The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or"
        " in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all"
        " copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an"
        " overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."
    ),
    "EPL-2.0-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
}

#: Full texts by name: file, and the words that begin and end the part that copies carry.
_FULL = {
    "Apache-2.0": ("Apache-2.0", "TERMS AND CONDITIONS FOR USE", "END OF TERMS"),
    "GPL-2.0": ("GPL-2", "Preamble", "END OF TERMS"),
    "GPL-3.0": ("GPL-3", "TERMS AND CONDITIONS", "END OF TERMS"),
    "LGPL-2.1": ("LGPL-2.1", "Preamble", "END OF TERMS"),
    "LGPL-3.0": ("LGPL-3", "This version of the GNU Lesser", None),
    "MPL-2.0-text": ("MPL-2.0", "1. Definitions", "Exhibit A - Source Code Form License Notice"),
    "CC0-1.0": ("CC0-1.0", "Statement of Purpose", None),
    "Artistic-1.0": ("Artistic", "Preamble", "The End"),
}
_AFFERO = (
    "13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users"
    " interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding"
    " Source from a network server at no charge, through some standard or customary means of facilitating copying of software. This Corresponding Source shall include the Corresponding Source for any work covered by"
    " version 3 of the GNU General Public License that is incorporated pursuant to the following paragraph. Notwithstanding any other provision of this License, you have permission to link or combine any covered work"
    " with a work licensed under version 3 of the GNU General Public License into a single combined work, and to convey the resulting work. The terms of this License will continue to apply to the part which is the"
    " covered work, but the work with which it is combined will remain governed by version 3 of the GNU General Public License. "
)


@functools.cache
def templates() -> dict[str, str]:
    """All templates; the driver reads the full texts from the package and sends them on."""
    out = dict(TEMPLATES)
    for name, (file, first, last) in _FULL.items():
        text = (resources.files(__package__) / "license_texts" / f"{file}.txt").read_text("utf-8")
        start = text.index(first)
        out[name] = text[start : text.index(last, start + len(first)) if last else None]
    gpl = out["GPL-3.0"]
    a, b = gpl.index("13. Use with the GNU Affero"), gpl.index("14. Revised Versions")
    affero = lambda t: re.sub(r"GNU\s+General\s+Public\s+License", "GNU Affero General Public License", t)
    out["AGPL-3.0"] = affero(gpl[:a]) + _AFFERO + affero(gpl[b:])
    return out


def _winnow(h: np.ndarray) -> np.ndarray:
    """Places of the window minima, rightmost on ties."""
    if len(h) <= WINDOW:
        return np.array([len(h) - 1 - int(np.argmin(h[::-1]))]) if len(h) else np.zeros(0, np.int64)
    w = np.lib.stride_tricks.sliding_window_view(h[::-1], WINDOW)
    return np.unique(len(h) - 1 - (np.arange(len(w)) + w.argmin(axis=1)))


class TemplateIndex:
    """Fingerprints of all templates, winnowed or (short ones) all pairs, and the templates' words."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = list(templates)
        words = [_WORD.findall(t.encode().lower()) for t in templates.values()]
        if any(len(w) < GRAM for w in words):
            raise ValueError(f"a template needs {GRAM} words at least")
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted({x for w in words for x in w}))}
        self.base = np.uint64(len(self.vocabulary) + 1)
        self.words = [np.array([self.vocabulary[x] for x in w]) for w in words]
        size = np.array([len(w) for w in words])
        self.slack = np.maximum(3, size // 8)
        # what stays of the seeds when a fifth of the words are changed and an eighth put in
        self.least = np.where(size < SHORT, np.maximum(2, size - 1 - 2 * (size // 5) - np.maximum(1, size // 8)), np.maximum(2, size // 12))
        self.tables = []
        for gram, chosen in ((2, np.flatnonzero(size < SHORT)), (GRAM, np.flatnonzero(size >= SHORT))):
            rows = []
            for k in chosen.tolist():
                h = self.grams(self.words[k], gram)
                places = range(len(h)) if gram == 2 else _winnow(h * _MIX)
                rows += [(int(h[p]), k, int(p)) for p in places]
            rows.sort()
            self.tables.append((gram, np.array([r[0] for r in rows], np.uint64), np.array([r[1:] for r in rows], np.int64).reshape(-1, 2)))

    def grams(self, w: np.ndarray, gram: int) -> np.ndarray:
        w = w.astype(np.uint64)
        h = w[: len(w) - gram + 1].copy()
        for k in range(1, gram):
            h = h * self.base + w[k : len(w) - gram + 1 + k]
        return h

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(template, first, last diagonal)`` of a document's regions with seeds enough."""
        found = []
        inside = ids > 0
        for gram, keys, posting in self.tables:
            if len(ids) < gram or not len(keys):
                continue
            whole = inside[: len(ids) - gram + 1].copy()
            for k in range(1, gram):
                whole &= inside[k : len(ids) - gram + 1 + k]
            full = np.flatnonzero(whole)
            if not len(full):
                continue
            h = self.grams(ids, gram)[full]
            lo = np.searchsorted(keys, h)
            hit = lo < len(keys)
            hit[hit] = keys[lo[hit]] == h[hit]
            if not hit.any():
                continue
            full, h, lo = full[hit], h[hit], lo[hit]
            n = np.searchsorted(keys, h, side="right") - lo
            row = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            found.append((posting[row, 0], np.repeat(full, n) - posting[row, 1]))
        if not found:
            return
        template, diagonal = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((diagonal, template))
        template, diagonal = template[order], diagonal[order]
        new = np.ones(len(template), bool)
        new[1:] = (template[1:] != template[:-1]) | (diagonal[1:] - diagonal[:-1] > self.slack[template[1:]])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(new))
        enough = ends - starts >= self.least[template[starts]]
        for s, e in zip(starts[enough].tolist(), ends[enough].tolist()):
            yield int(template[s]), int(diagonal[s]), int(diagonal[e - 1])

    def align(self, t: int, ids: np.ndarray, first: int, last: int) -> tuple[int, int, int]:
        """``(matched, start, end)``: best alignment of a whole template along diagonals of a text.

        Row ``i`` holds the scores of the text places ``i + first - slack`` to ``i + last + slack`` after the
        template's first ``i`` words: nothing outside that band is computed or can be reached.
        """
        words, slack = self.words[t], int(self.slack[t])
        n, base = len(words), first - slack
        width = last - first + 2 * slack + 1
        text = np.zeros(n + width, ids.dtype)  # no word, where the band leaves the text
        a, b = max(base, 0), min(base + n + width, len(ids))
        text[a - base : b - base] = ids[a:b]
        low = -10 * (n + width)
        score, step = np.zeros(width, np.int64), np.arange(width)
        back = np.zeros((n, width), np.int8)  # 0 template word missing, 1 diagonal, 2 text word extra
        missing = np.empty(width, np.int64)
        for i in range(n):
            diagonal = score + np.where(text[i : i + width] == words[i], 2, -1)
            missing[:-1], missing[-1] = score[1:] - 1, low
            best = np.maximum(diagonal, missing)
            score = np.maximum.accumulate(best + step) - step
            back[i] = np.where(score > best, 2, diagonal >= missing)
        w, i = int(np.argmax(score)), n - 1
        matched, start, end = 0, len(ids), 0
        while i >= 0:
            move = back[i, w]
            if move == 2:
                w -= 1
            elif move == 1:
                if text[i + w] == words[i]:
                    matched, start, end = matched + 1, min(start, base + i + w), max(end, base + i + w + 1)
                i -= 1
            else:
                i, w = i - 1, w + 1
        return matched, start, end

    def scan(self, text: bytes) -> list[tuple[int, int, str, float]]:
        """``(start, end, template, coverage)`` in bytes of the text, by start."""
        low = text.lower()
        ids = np.array(list(map(self.vocabulary.get, _WORD.findall(low), repeat(0))), np.int64)
        found = []
        for t, a, b in self.candidates(ids):
            matched, first, last = self.align(t, ids, a, b)
            if matched and matched >= COVERAGE * len(self.words[t]):
                found.append((-matched, first, last, t))
        if not found:
            return []
        kept: list[tuple[int, int, int, int]] = []  # (start, end, -matched, template) by start, disjoint
        for m, a, b, t in sorted(found):
            i = bisect_left(kept, (a,))
            if (i == len(kept) or kept[i][0] >= b) and (i == 0 or kept[i - 1][1] <= a):
                kept.insert(i, (a, b, m, t))
        spans = [m.span() for m in _WORD.finditer(low)]
        return sorted((spans[a][0], spans[b - 1][1], self.names[t], -m / len(self.words[t])) for a, b, m, t in kept)


def spell(text: bytes, found: list[tuple[int, int, str, float]]) -> str:
    """``template:start:end:coverage`` joined by commas, in code points of the text."""
    out, at, points = [], 0, 0
    for start, end, name, coverage in found:
        points += len(text[at:start].decode("utf-8", "replace"))
        stop = points + len(text[start:end].decode("utf-8", "replace"))
        out.append(f"{name}:{points}:{stop}:{coverage:.3f}")
        at, points = end, stop
    return ",".join(out)


def license_spans(docs: DataFrame, given: Mapping[str, str] | None = None) -> DataFrame:
    """``(doc_id, n_matches, matches)`` of every document."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(dict(given or templates()))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(held.value)
        for b in batches(it):
            rows = []
            for t in b.column(1).cast(pa.binary()).to_pylist():
                found = index.scan(t)
                rows.append((len(found), spell(t, found)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["doc_id", "n_matches", "matches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_matches long, matches string")
