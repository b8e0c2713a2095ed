"""Licence scans: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Templates are cut into words; the hashes of their word triples are winnowed (the smallest of every ``WINDOW`` in a row),
and an inverted index from fingerprint to (template, place) is sent to the tasks: it grows with the templates, not with
the texts, and is bounded (``MAX_WORDS``). A text is winnowed in the same way. Triples with a word that is in no template can't
match, so they count as larger than all others, on either side. A run of ``GRAM + WINDOW - 1`` words that a text shares with a
template is always found. Templates under ``SHORT`` words may have no such run: all their word pairs are looked up at every place
of the text, without winnowing.

Fingerprints found are taken in the order of the text, those that can belong to one occurrence together; around each such cluster a banded
local alignment (a match 2, else -1) finds how many of the template's words are matched in order and where in the text. Reading goes on
behind a match, so a text that repeats a notice many times takes time in proportion to its length.
"""

from __future__ import annotations

from bisect import bisect, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martline.llm.common import slices, small_batches, texts

GRAM, WINDOW, BAND, SHORT = 3, 3, 8, 20
#: Words of all templates together, at most.
MAX_WORDS = 200_000
_WORD = regex.compile(r"[\p{L}\p{N}]+")

#: Common notices, headers and whole licences, by a short name; names that end in -grant or -conditions stand for a licence's first part.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
        "express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "mit-notice": "Released under the MIT License",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."),
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that "
        "it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See "
        "the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. "
        "If not, see https://www.gnu.org/licenses/."),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS "
        "IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
        "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    "bsd-2-clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."),
    "all-rights-reserved": "All rights reserved",
}


class Index:
    def __init__(self, templates: dict[str, str]) -> None:
        self.names = sorted(templates)
        words = [_WORD.findall(templates[n].lower()) for n in self.names]
        if sum(map(len, words)) > MAX_WORDS:
            raise ValueError(f"templates have more than {MAX_WORDS} words")
        self.word: dict[str, int] = {}
        for w in words:
            for x in w:
                self.word.setdefault(x, len(self.word) + 1)
        self.ids = [[self.word[x] for x in w] for w in words]
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.pairs: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for k, ids in enumerate(self.ids):
            if len(ids) < SHORT:
                for at, pair in enumerate(zip(ids, ids[1:], strict=False)):
                    self.pairs[pair].append((k, at))
                continue
            for at, h in self.winnow(np.array(ids, np.int64)):
                self.places[h].append((k, at))

    def winnow(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(place, fingerprint) of the triples that are the smallest, the rightmost of several, of some window."""
        n = len(ids) - GRAM + 1
        if n < 1:
            return []
        part = [ids[i : i + n].astype(np.uint64) for i in range(GRAM)]
        h, odd = np.zeros(n, np.uint64), np.zeros(n, bool)
        for p in part:
            h = (h * np.uint64(len(self.word) + 1) + p) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
            odd |= p == 0
        h[odd] = ~np.uint64(0)
        if odd.all():
            return []
        wide = min(WINDOW, n)
        rows = np.lib.stride_tricks.sliding_window_view(h, wide)
        at = np.unique(np.arange(len(rows)) + wide - 1 - rows[:, ::-1].argmin(axis=1))
        at = at[~odd[at]]
        return list(zip(at.tolist(), h[at].tolist(), strict=True))

    def seeds(self, ids: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """By template: (place in the text, diagonal) of shared fingerprints, in the order of the text."""
        found: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for at, h in self.winnow(ids):
            for k, there in self.places.get(h, ()):
                found[k].add((at, at - there))
        known = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        for at, a, b in zip(known.tolist(), ids[known].tolist(), ids[known + 1].tolist(), strict=True):
            for k, there in self.pairs.get((a, b), ()):
                found[k].add((at, at - there))
        return {k: sorted(v) for k, v in found.items()}

    def template_matches(self, k: int, seeds: list[tuple[int, int]], ids: list[int], least: float) -> list[tuple[int, int, int]]:
        """(first word, word behind the last, matched words) of one template's matches, none overlapping.

        Seeds are taken in the order of the text. One and those that go on from it (no further on than the template is long, on
        diagonals within a band of the one before) are a cluster, which is aligned once, between the matches that are there already.
        A cluster without a match is done with: its band holds every alignment through its seeds. So a seed is aligned once, or lies in
        a match, and the work grows with the text, however often it repeats."""
        size, done, taken = len(self.ids[k]), [False] * len(seeds), []
        for i, (at, diagonal) in enumerate(seeds):
            while not done[i]:
                p = bisect(taken, (at, len(ids) + 1))
                lo, hi = taken[p - 1][1] if p else 0, taken[p][0] if p < len(taken) else len(ids)
                if at < lo:  # in a match
                    break
                cluster, low, high, last, j = [i], diagonal, diagonal, diagonal, i + 1
                while j < len(seeds) and seeds[j][0] < min(hi, diagonal + size + BAND):
                    if not done[j] and abs(seeds[j][1] - last) <= BAND:
                        cluster.append(j)
                        last = seeds[j][1]
                        low, high = min(low, last), max(high, last)
                    j += 1
                if lo <= diagonal <= hi - size and ids[diagonal : diagonal + size] == self.ids[k]:
                    matched, a, b = size, diagonal, diagonal + size  # no alignment is better
                else:
                    matched, a, b = self.align(ids, k, low - BAND, high + BAND, lo, hi)
                if matched and matched / size >= least:
                    insort(taken, (a, b, matched))
                else:
                    for j in cluster:
                        done[j] = True
        return taken

    def align(self, ids: list[int], k: int, low: int, high: int, lo: int, hi: int) -> tuple[int, int, int]:
        """(matched words, first word, word behind the last) of the best local alignment of a template with words lo to hi of the text,
        on diagonals from ``low`` to ``high``."""
        template = self.ids[k]
        best = (0, 0, 0, 0)  # score, matched, start, end
        before: dict[int, tuple[int, int, int]] = {}  # place behind in the text -> score, matched, start
        for i, w in enumerate(template):
            row: dict[int, tuple[int, int, int]] = {}
            for j in range(max(lo, i + low), min(hi, i + high + 1)):
                s, m, a = before.get(j, (0, 0, j))
                cell = (s + 2, m + 1, a) if ids[j] == w else (s - 1, m, a)
                up = before.get(j + 1)
                if up and (up[0] - 1, up[1]) > cell[:2]:
                    cell = (up[0] - 1, up[1], up[2])
                left = row.get(j)
                if left and (left[0] - 1, left[1]) > cell[:2]:
                    cell = (left[0] - 1, left[1], left[2])
                if cell[0] > 0:
                    row[j + 1] = cell
                    if cell[0] > best[0]:
                        best = (*cell, j + 1)
            before = row
        return best[1:]

    def matches(self, text: str, least: float) -> list[tuple[str, int, int, float, int, int]]:
        """(template, matched, words, coverage, start, end) with character offsets; matches of one template don't overlap."""
        get = self.word.get
        words = [get(w, 0) for w in _WORD.findall(text.lower())]
        if len(words) < 2 or not any(words):
            return []
        out = [(k, m, a, b) for k, seeds in self.seeds(np.array(words, np.int64)).items() for a, b, m in self.template_matches(k, seeds, words, least)]
        if not out:
            return []
        spans = [m.span() for m in _WORD.finditer(text)] if text.isascii() else _spans(text)
        return sorted((self.names[k], m, len(self.ids[k]), m / len(self.ids[k]), spans[a][0], spans[b - 1][1]) for k, m, a, b in out)


def _spans(text: str) -> list[tuple[int, int]]:
    """Spans in the text itself of the words of its lower-case form, which may be longer than the text."""
    of = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
    lower = "".join(c.lower() for c in text)
    return [(of[m.start()], of[m.end() - 1] + 1) for m in _WORD.finditer(lower)]


_OUT = pa.schema([("doc_id", pa.int64()), ("licence", pa.string()), ("n_matched", pa.int64()), ("n_words", pa.int64()), ("coverage", pa.float64()),
                  ("span_start", pa.int64()), ("span_end", pa.int64())])


def scan(df: DataFrame, templates: dict[str, str] | None = None, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, licence, n_matched, n_words, coverage, span_start, span_end): one row per match that covers at least ``least`` of a
    template's words, with character offsets into the text.

    Null and empty texts and those without a match give no rows; rows that repeat give their matches each; a null id
    stays null; an empty table gives no rows. Matches of one template don't overlap: where they could, the alignment with the best score
    (the first of several) takes its words, and what is left beside it is aligned again. Templates of one word are never found. Narrow."""
    small_batches(df.sparkSession)
    chosen = TEMPLATES if templates is None else templates
    Index(chosen)  # an error in the templates shows here, not in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(chosen)
        for batch in batches:
            for part in slices(batch):
                rows = [(d, *m) for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for m in index.matches(t, least)]
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _OUT, strict=True)], schema=_OUT)

    return texts(df, id_col, text_col).mapInArrow(
        run, "doc_id long, licence string, n_matched long, n_words long, coverage double, span_start long, span_end long")
