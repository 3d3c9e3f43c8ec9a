"""License scan: winnowed fingerprints pick templates, banded alignment measures the match.

Templates are cut into words; the smallest hash of each window of ``WINDOW`` word k-grams is a
fingerprint, and an inverted index tells the places where templates have it. A text's fingerprints,
chosen the same way, point at templates and diagonals; winnowing guarantees one for every shared run
of ``K + WINDOW - 1`` words. Hits near one diagonal make a candidate, which is aligned with the
template by local alignment in a band around that diagonal, again and again over the words that are
left. Alignments that follow each other in the text and in the template are chained. The result tells
how much of the template is matched and where it stands in the text.

Long texts: hits of a long template are looked at only where enough of them ascend together in the text and in
the template (a match of ``min_coverage`` of its words can't have fewer, however long the template), an alignment keeps
to the surroundings of its hits, and chains come from one sweep. Work grows with the text and its hits.

Templates and their index are a parameter of the job, small beside any corpus, and go with the task.
Texts are independent: one pass, no shuffle.
"""

from __future__ import annotations

import bisect
import heapq
import math
import re
from collections import defaultdict
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.common import runs_in_tasks

runs_in_tasks(__name__)

K = 3
WINDOW = 2
#: Diagonals on either side of a candidate's that the alignment may use.
BAND = 8
MIN_COVERAGE = 0.8
_MATCH, _MISMATCH, _GAP = 2, -1, -1
#: Stands for a word that belongs to another alignment; none goes across it.
_TAKEN = -1
_FAR = 1 << 32

#: Alignments before one that it is chained to, at most the nearest so many.
LOOK_BACK = 64
#: Words of the template beyond the hits of a candidate that an alignment may reach.
REACH = 64

# License notices as their publishers word them.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "mit-notice": "Released under the MIT License.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."
    ),
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "all-rights-reserved-notice": "All rights reserved.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-sa-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nd-4.0-notice": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-nd-4.0-notice": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty."
    ),
    "gpl-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "lgpl-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "lgpl-2.1-notice": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "mit-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
        "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
        "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution."
    ),
    "bsd-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
        "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


def _variant(name: str, *changes: tuple[str, str]) -> str:
    text = TEMPLATES[name]
    for old, new in changes:
        text = text.replace(old, new)
    return text


TEMPLATES |= {
    "gpl-2.0-header": _variant("gpl-3.0-header", ("version 3 of", "version 2 of")),
    "agpl-3.0-header": _variant("gpl-3.0-header", ("GNU General", "GNU Affero General")),
    "lgpl-3.0-header": _variant("gpl-3.0-header", ("GNU General", "GNU Lesser General")),
    "lgpl-2.1-header": _variant(
        "gpl-3.0-header", ("GNU General", "GNU Lesser General"), ("This program", "This library"), ("version 3 of", "version 2.1 of")
    ),
}
# whole texts, read where the job is planned and sent with it
TEMPLATES |= {f.stem: f.read_text("utf-8") for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}

_WORD = re.compile(r"[^\W_]+")


def template_words(text: str) -> list[str]:
    # words first: lower case can change the length of a text, never the number of its words
    return [w.lower() for w in _WORD.findall(text)]


def _ascending(hits: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """For each hit the length of the longest sequence of hits, ascending in both places, that ends with it."""
    out: dict[tuple[int, int], int] = {}
    ends: list[int] = []
    # of hits at one place of the text at most one counts
    for p, a in sorted(hits, key=lambda h: (h[0], -h[1])):
        i = bisect.bisect_left(ends, a)
        ends[i : i + 1] = [a]
        out[p, a] = i + 1
    return out


def fingerprints(ids: np.ndarray, k: int = K, window: int = WINDOW, also: np.ndarray | None = None) -> dict[int, list[int]]:
    """Winnowed fingerprints of a sequence of word ids: hash to places. A k-gram with id 0 (a word
    of no template) is never one, those with a hash in ``also`` always are."""
    if len(ids) < k:
        return {}
    code = np.zeros(len(ids) - k + 1, np.uint64)
    known = np.ones(len(code), bool)
    for i in range(k):
        part = ids[i : len(ids) - k + 1 + i]
        code = (code + part.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
        known &= part > 0
    code >>= np.uint64(1)
    code[~known] = np.uint64((1 << 64) - 1)
    out: dict[int, list[int]] = defaultdict(list)
    last = -1
    at = np.flatnonzero(known)
    starts = np.unique(np.clip((at[:, None] - np.arange(window)).ravel(), 0, max(0, len(code) - window)))
    for s in starts:
        part = code[s : s + window]
        place = int(s + len(part) - 1 - np.argmin(part[::-1]))  # the last of equal ones
        if place > last and known[place]:
            out[int(code[place])].append(place)
            last = place
    if also is not None and len(also):
        for place in at[np.isin(code[at], also)].tolist():
            if place not in out[int(code[place])]:
                out[int(code[place])].append(place)
    return out


@dataclass(frozen=True)
class Match:
    template: str
    matched: int
    words: int
    first: int
    last: int
    score: int
    #: First and last matched word of the template.
    begin: int = 0
    end: int = 0

    def edits(self) -> int:
        """Words that only the template or only the text has."""
        return self.words + self.last - self.first + 1 - 2 * self.matched

    def fits_better(self, other: Match) -> bool:
        """Whether this match explains the words of the other one, and with fewer edits."""
        shared = min(self.last, other.last) - max(self.first, other.first) + 1
        return shared >= other.matched - other.edits() and shared > 0 and self.matched >= other.matched and self.edits() < other.edits()


class Scanner:
    """Templates with their inverted index of fingerprints."""

    def __init__(self, templates: dict[str, str], k: int = K, window: int = WINDOW, band: int = BAND):
        self.k, self.window, self.band = k, window, band
        self.ids: dict[str, int] = {}
        self.templates = {
            name: np.array([self.ids.setdefault(w, len(self.ids) + 1) for w in template_words(text)], np.int64)
            for name, text in templates.items()
        }
        self.index: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for name, words in self.templates.items():
            for code, places in fingerprints(words, k, window).items():
                self.index[code] += [(name, p) for p in places]
        # winnowing finds shared runs of k + window - 1 words; shorter templates are always looked for
        short = [w for w in self.templates.values() if len(w) < k + window - 1]
        self.short = np.array([c for w in short for c in fingerprints(w, k, 1)], np.uint64)

    def least_places(self, name: str, least: float) -> int:
        """Places of the template that must be hit if ``least`` of its words are matched one after the other.
        Each word that is not matched touches at most k + window - 1 runs of that many words; each run
        without one has a fingerprint, and a fingerprint is that of at most ``window`` runs."""
        run = self.k + self.window - 1
        n = len(self.templates[name])
        return max(1, math.ceil(((n - run + 1) - run * (n - least)) / self.window))

    def collinear_hits(self, name: str, hits: list[tuple[int, int]], least: float) -> list[tuple[int, int]]:
        """The hits (place in the text, place in the template) that lie on a sequence of hits, ascending in both, which is
        long enough for ``least`` matched words in a piece of text at most twice as long as the template."""
        need = self.least_places(name, least)
        if need == 1:
            return hits
        stretch = 2 * len(self.templates[name]) + 2 * self.band
        pieces: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for hit in hits:
            pieces[hit[0] // stretch].append(hit)
        kept = set()
        for at, piece in pieces.items():
            both = piece + pieces.get(at + 1, [])
            if len({a for _, a in both}) >= need:
                up = _ascending(both)
                down = _ascending([(-p, -a) for p, a in both])
                kept |= {(p, a) for p, a in both if up[p, a] + down[-p, -a] > need}
        return sorted(kept)

    def candidates(self, words: np.ndarray, min_coverage: float = MIN_COVERAGE) -> dict[str, list[list[tuple[int, int]]]]:
        """For each template its candidates: hits (diagonal, place) near one diagonal."""
        hits = defaultdict(list)
        for code, places in fingerprints(words, self.k, self.window, self.short).items():
            for name, at in self.index.get(code, ()):
                hits[name] += [(p, at) for p in places]
        out = {}
        for name, pairs in hits.items():
            pairs = self.collinear_hits(name, pairs, min_coverage * len(self.templates[name]))
            found = sorted((p - at, p) for p, at in pairs)
            if not found:
                continue
            groups = [[found[0]]]
            for hit in found[1:]:
                if hit[0] - groups[-1][0][0] > self.band:
                    groups.append([])
                groups[-1].append(hit)
            out[name] = [part for group in groups for part in self.parts_of(group)]
        return out

    @staticmethod
    def parts_of(group: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
        """The hits of a candidate by place, cut where none is within the reach of two alignments."""
        group = sorted(group, key=lambda h: h[1])
        out = [[group[0]]]
        for hit in group[1:]:
            if hit[1] - out[-1][-1][1] > 2 * REACH:
                out.append([])
            out[-1].append(hit)
        return out

    def segments(self, words: np.ndarray, name: str, groups: list[list[tuple[int, int]]]) -> list[Match]:
        """Local alignments with the template, those of candidates with most hits first, each over words
        outside the others, until no candidate has a hit left. A candidate is looked at again only after
        it has lost hits to an alignment."""
        free, out = words.copy(), []
        queue = [(-len(group), i) for i, group in enumerate(groups)]
        heapq.heapify(queue)
        while queue:
            size, i = heapq.heappop(queue)
            left = [h for h in groups[i] if (free[h[1] : h[1] + self.k] != _TAKEN).all()]
            groups[i] = left
            if len(left) < -size:
                if left:
                    heapq.heappush(queue, (-len(left), i))
                continue
            places = [p - d for d, p in left]
            m = self.align(free, name, min(left)[0], min(places) - REACH, max(places) + self.k + REACH)
            if m is None:
                continue
            out.append(m)
            free[m.first : m.last + 1] = _TAKEN
            groups[i] = [h for h in left if h[1] + self.k <= m.first or h[1] > m.last]
            if groups[i]:
                heapq.heappush(queue, (-len(groups[i]), i))
        return out

    def chains(self, parts: list[Match], least: float) -> list[Match]:
        """Matches of at least ``least`` words: alignments that follow each other in the text and in
        the template, as where words are inserted or cut, count as one. Between two of them may be half
        the template's words. One sweep finds the best chain that ends with each; the longest are taken first."""
        parts = sorted(parts, key=lambda m: m.first)
        total, back = [m.matched for m in parts], [-1] * len(parts)
        for j, b in enumerate(parts):
            far = max(2 * self.band, b.words // 2)
            for i in range(j - 1, max(-1, j - 1 - LOOK_BACK), -1):
                a = parts[i]
                if a.last < b.first <= a.last + 1 + far and a.begin < b.begin and a.end < b.end:
                    more = total[i] + b.matched - max(0, a.end - b.begin + 1)
                    if more > total[j]:
                        total[j], back[j] = more, i
        out: list[Match] = []
        used = [False] * len(parts)
        firsts = [m.first for m in parts]
        for at in sorted(range(len(parts)), key=lambda i: (-total[i], i)):
            chain, i = [], at
            while i >= 0 and not used[i]:
                chain.append(i)
                i = back[i]
            if not chain:
                continue
            matched = total[at] - (total[i] if i >= 0 else 0)
            if matched < least:
                continue
            a, b = parts[chain[-1]], parts[chain[0]]
            score = sum(parts[i].score for i in chain)
            out.append(Match(a.template, matched, a.words, a.first, b.last, score, a.begin, b.end))
            for i in range(bisect.bisect_left(firsts, a.first), bisect.bisect_right(firsts, b.last)):
                used[i] = True
        return out

    def align(
        self, words: np.ndarray, name: str, diagonal: int, begin: int = 0, end: int | None = None
    ) -> Match | None:
        """Best local alignment of the template's places from ``begin`` to ``end`` in the band around the
        diagonal (of place in the text less place in the template)."""
        begin = max(0, begin)
        whole = self.templates[name]
        m = self._align(words, name, whole[begin:end], diagonal + begin)
        if m is None:
            return None
        return Match(name, m.matched, len(whole), m.first, m.last, m.score, m.begin + begin, m.end + begin)

    def _align(self, words: np.ndarray, name: str, template: np.ndarray, diagonal: int) -> Match | None:
        band = self.band
        width = 2 * band + 1
        score = np.zeros((len(template) + 1, width + 2), np.int64)
        step = np.zeros((len(template) + 1, width + 2), np.int8)
        # the words that the band meets; places outside the text count as taken
        low = diagonal - band
        met = np.full(len(template) + width, _TAKEN, np.int64)
        from_, to = max(0, low), min(len(words), low + len(met))
        if from_ < to:
            met[from_ - low : to - low] = words[from_:to]
        column = np.arange(width)
        for i in range(1, len(template) + 1):
            row = met[i - 1 : i - 1 + width]
            if (row == _TAKEN).all():
                continue
            taken = row == _TAKEN
            down = score[i - 1, 1:-1] + np.where(row == template[i - 1], _MATCH, _MISMATCH)
            skip = score[i - 1, 2:] + _GAP
            best = np.maximum(np.maximum(down, skip), 0)
            best[taken] = 0
            # gaps along the row by a running maximum that starts anew at taken words
            lift = _FAR * np.cumsum(taken) - _GAP * column
            best = np.maximum.accumulate(best + lift) - lift
            best[taken] = 0
            score[i, 1:-1] = best
            step[i, 1:-1] = np.where(best <= 0, 0, np.where(best == down, 1, np.where(best == skip, 2, 3)))
        i, c = np.unravel_index(np.argmax(score), score.shape)
        top = int(score[i, c])
        if not top:
            return None
        matched, first, last, begin, end = 0, None, None, None, None
        low, mark = top, None
        while score[i, c] > 0:
            if score[i, c] < low:
                low, mark = score[i, c], (matched, first, begin)
            elif score[i, c] > low + 3 * band:
                # the text left the band: what is on the other side is aligned on its own diagonal
                matched, first, begin = mark
                break
            j = diagonal + i - 1 + (c - 1 - band)
            if step[i, c] == 1:
                if words[j] == template[i - 1]:
                    matched, first, last = matched + 1, j, j if last is None else last
                    begin, end = i - 1, i - 1 if end is None else end
                i -= 1
            elif step[i, c] == 2:
                i, c = i - 1, c + 1
            else:
                c -= 1
        return Match(name, matched, len(template), int(first), int(last), top, int(begin), int(end))

    def scan(self, text: str | None, min_coverage: float) -> list[tuple[Match, int, int]]:
        """Matches with at least ``min_coverage`` of the template, and their span in code points.
        Matches of one template don't overlap."""
        if not text:
            return []
        found = template_words(text)
        ids = np.fromiter((self.ids.get(w, 0) for w in found), np.int64, len(found))
        if np.count_nonzero(ids) < self.k:
            return []
        kept: list[Match] = []
        for name, groups in self.candidates(ids, min_coverage).items():
            kept += self.chains(self.segments(ids, name, groups), min_coverage * len(self.templates[name]))
        # of templates that differ in a few words, such as versions, the one that fits the words better
        kept = self.best_fits(kept)
        if not kept:
            return []
        spans = [x.span() for x in _WORD.finditer(text)]
        return [(m, spans[m.first][0], spans[m.last][1]) for m in kept]

    @staticmethod
    def best_fits(matches: list[Match]) -> list[Match]:
        """In order of place, without those that another one fits better. Only matches that share words are compared."""
        matches = sorted(matches, key=lambda m: (m.first, m.template))
        worse = [False] * len(matches)
        near: list[int] = []
        for j, m in enumerate(matches):
            near = [i for i in near if matches[i].last >= m.first]
            for i in near:
                worse[j] |= matches[i].fits_better(m)
                worse[i] |= m.fits_better(matches[i])
            near.append(j)
        return [m for m, w in zip(matches, worse, strict=True) if not w]


_SCHEMA = "id long, template string, coverage double, matched_words long, template_words long, start long, end long, span string"


def _scan(templates: dict[str, str], min_coverage: float):
    def run(batches):
        scanner = Scanner(templates)
        for b in batches:
            rows = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for m, start, end in scanner.scan(text, min_coverage):
                    rows.append((key, m.template, m.matched / m.words, m.matched, m.words, start, end, text[start:end]))
            columns = list(zip(*rows, strict=True)) or [()] * 8
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["id", "template", "coverage", "matched_words", "template_words", "start", "end", "span"],
            )

    return run


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    *,
    min_coverage: float = MIN_COVERAGE,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """A row for each template that a text holds: key, template, coverage (matched words over the
    template's words), matched_words, template_words, start and end (code points of the text) and
    span (the text there). A template that stands in a text several times gives several rows. NULL
    and empty texts, and those without a template, give none; rows that repeat a key are scanned one
    by one."""
    sent = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return sent.mapInArrow(_scan(templates or TEMPLATES, min_coverage), _SCHEMA).withColumnRenamed("id", key)
