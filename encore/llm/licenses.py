"""License scan by patience alignment with license texts.

A text's words are aligned with a template's: words unique to both (in the
stretch at hand) are anchors, the longest increasing subsequence of their
places is kept, and the gaps between kept anchors are aligned in the same way.
A gap without anchors is aligned by its equal ends, then by a longest common
subsequence. Coverage is the share of the template's words that are aligned.
Templates with ``REQUIRED`` names and versions match only where these stand in
the text without other words between.

Texts are scanned whole, for each template whose words they hold in sufficient
number (counted with multiplicity, a bound that loses nothing). A stretch worth
aligning is where the template's rarer words (those that are no everyday words)
stand within ``max_stretch`` template lengths of each other, the most that a
match may span, so no match is split; it is aligned in windows of twice that
length, half overlapping, if the window's words could cover the template at all.
A matched place is cut out and both sides are looked at again, so repeated
notices are all found. Short notices and headings are ``REQUIRED`` names and
versions for the most part, so a foreign word inside is no match.

Defined cases: null, empty and wordless texts have no license; of several
templates that cover the same words the one with more aligned words counts,
then the better covered, then the first by name; repeated rows get equal
results; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from encore.llm.common import ALPHANUMERIC, as_texts, pieces, words_of
from encore.llm.decontamination import char_spans

RESULT = "license string, coverage double, matches array<struct<license:string,start:long,end:long,coverage:double>>"
PIECE_BYTES = 4 << 20

# Public license texts and notices.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "BSD-3-Clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder "
        "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed "
        "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."),
    "Reserved": "All rights reserved.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD": "Released under the BSD License.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-ND-4.0-short": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-ND-4.0-short": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0-short": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "ISC": "Released under the ISC License.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "Released under the Mozilla Public License, version 2.0.",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Apache-2.0-heading": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
    "Apache-2.0-short": "Licensed under Apache 2.0.",
    "AGPL-3.0-heading": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "GPL-2.0-heading": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "GPL-3.0-heading": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.1-heading": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "LGPL-3.0-heading": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "MIT-heading": "The MIT License (MIT)",
    "MIT-copyright": "MIT License Copyright (c)",
    "ISC-copyright": "ISC License Copyright (c)",
    "MPL-2.0-heading": "Mozilla Public License Version 2.0 1. Definitions",
    "MIT-warranty": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
        "THIS SOFTWARE."),
    "BSD-2-Clause-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution."),
    "BSD-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
        "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
        "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
        "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
        "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
}

# The names and versions that a notice must hold, each as a run of words without others between.
REQUIRED: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("apache license", "version 2 0"),
    "Apache-2.0-notice": ("apache license", "version 2 0"),
    "CC-BY-4.0": ("creative commons attribution 4 0",),
    "CC-BY-NC-4.0": ("cc by nc 4 0",),
    "GPL-3.0": ("gnu general public license", "version 3"),
    "GPL-3.0-notice": ("gnu general public license", "version 3"),
    "MIT": ("mit license",),
    "AGPL-3.0": ("gnu affero general public license", "version 3"),
    "BSD": ("bsd license",),
    "BSD-2-Clause": ("bsd 2 clause",),
    "BSD-3-Clause": ("bsd 3 clause",),
    "CC-BY-SA-4.0": ("creative commons attribution sharealike 4 0",),
    "CC-BY-4.0-short": ("cc by 4 0",),
    "CC-BY-ND-4.0-short": ("cc by nd 4 0",),
    "CC-BY-NC-ND-4.0-short": ("cc by nc nd 4 0",),
    "CC-BY-NC-SA-4.0-short": ("cc by nc sa 4 0",),
    "CC-BY-SA-4.0-short": ("cc by sa 4 0",),
    "GPL-2.0": ("gnu general public license", "version 2"),
    "ISC": ("isc license",),
    "LGPL-2.1": ("gnu lesser general public license", "version 2 1"),
    "LGPL-3.0": ("gnu lesser general public license", "version 3"),
    "MPL-2.0": ("mozilla public license", "version 2 0"),
    "MPL-2.0-notice": ("mozilla public license v 2 0",),
    "Reserved": ("all rights reserved",),
    "Apache-2.0-heading": ("apache license version 2 0",),
    "Apache-2.0-short": ("apache 2 0",),
    "AGPL-3.0-heading": ("gnu affero general public license version 3",),
    "GPL-2.0-heading": ("gnu general public license version 2",),
    "GPL-3.0-heading": ("gnu general public license version 3",),
    "LGPL-2.1-heading": ("gnu lesser general public license version 2 1",),
    "LGPL-3.0-heading": ("gnu lesser general public license version 3",),
    "MIT-heading": ("the mit license mit",),
    "MIT-copyright": ("mit license copyright",),
    "ISC-copyright": ("isc license copyright",),
    "MPL-2.0-heading": ("mozilla public license version 2 0",),
    "ISC-text": ("permission to use",),
}

# License identifiers of SPDX lines.
SPDX = ("0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-2.0 GPL-2.0-only "
        "GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MPL-2.0 Unlicense Zlib").split()
for _id in SPDX:
    TEMPLATES[f"{_id}-spdx"] = f"SPDX-License-Identifier: {_id}"
    REQUIRED[f"{_id}-spdx"] = (f"SPDX-License-Identifier: {_id}".lower().replace("-", " ").replace(".", " ").replace(":", ""),)

# Everyday words, which alone don't make a stretch worth aligning.
EVERYDAY = frozenset("a all an and any are at be but by can do following for free in included is it later may name not of on or out see so "
                     "that the these this to use version will with without work you your 0 1 2 3 4".split())


def increasing(values: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[pile], piles[pile] = v, i
        back[i] = piles[pile - 1] if pile else -1
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def _common_subsequence(a, b, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    n, m = a1 - a0, b1 - b0
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[a0 + i] == b[b0 + j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[a0 + i] == b[b0 + j]:
            out.append((a0 + i, b0 + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of places of equal words, increasing in both, by patience alignment."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        anchors = [(i, where[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in where]
        if not anchors:
            out += _common_subsequence(a, b, a0, a1, b0, b1)
            continue
        kept = [anchors[i] for i in increasing([j for _, j in anchors])]
        out += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


def _places(words: list[int], phrase: list[int]) -> list[int]:
    return [p for p in range(len(words) - len(phrase) + 1) if words[p:p + len(phrase)] == phrase]


class Scanner:
    """Templates as word numbers, in a task."""

    def __init__(self, templates: dict[str, str], min_coverage: float, max_stretch: float, required: dict[str, tuple[str, ...]] | None = None):
        self.min_coverage, self.max_stretch = min_coverage, max_stretch
        self.names = sorted(templates)
        lists = [words_of(as_texts(pa.array([templates[n]])), ALPHANUMERIC)[0].to_pylist() for n in self.names]
        self.vocabulary = sorted({w for ws in lists for w in ws})
        code = {w: i for i, w in enumerate(self.vocabulary)}
        self.templates = [[code[w] for w in ws] for ws in lists]
        self.bags = [Counter(t) for t in self.templates]
        self.sizes = np.array([len(t) for t in self.templates])
        self.counts = np.array([np.bincount(t, minlength=len(self.vocabulary)) for t in self.templates])
        self.required = [[[code[w] for w in phrase.split()] for phrase in (required or {}).get(n, ())] for n in self.names]
        telling = np.array([w not in EVERYDAY for w in self.vocabulary], bool)
        self.telling = [np.append((own > 0) & (telling if (telling & (own > 0)).any() else True), False) for own in self.counts]  # the last is -1's

    def best(self, codes: list[int], start: int, end: int, t: int):
        """Template t's alignment of most words among words start ... end: (aligned words, first, last) or None."""
        bag, template, found = Counter(codes[start:end]), self.templates[t], None
        if sum(min(n, bag[w]) for w, n in self.bags[t].items()) < self.min_coverage * len(template):
            return None
        for pairs in self._alignments(codes, start, end, template, self.required[t]):
            if len(pairs) >= self.min_coverage * len(template) and (found is None or len(pairs) > found[0]):
                found = (len(pairs), pairs[0][0], pairs[-1][0] + 1)
        return found

    def _alignments(self, codes: list[int], start: int, end: int, template: list[int], phrases: list[list[int]]):
        """The template's alignment; with required phrases one around each place of the first phrase, if it holds them all."""
        if not phrases:
            yield self._together([(i + start, j) for i, j in align(codes[start:end], template)], len(template))
            return
        first, reach = phrases[0], int(self.max_stretch * len(template)) + 1
        size = len(first)
        for at in range(start, end - size + 1):
            if codes[at:at + size] != first:
                continue
            low, high = max(start, at - reach), min(end, at + size + reach)
            for place in _places(template, first):
                # The left side is aligned backwards, so that the words next to the phrase count first.
                left = [(at - 1 - i, place - 1 - j) for i, j in align(codes[low:at][::-1], template[:place][::-1])]
                right = [(at + size + i, place + size + j) for i, j in align(codes[at + size:high], template[place + size:])]
                pairs = self._together([*sorted(left), *((at + k, place + k) for k in range(size)), *right], len(template))
                where = {j: i for i, j in pairs}
                if all(any(all(where.get(p + k, -1) == where.get(p, -2) + k for k in range(len(phrase))) for p in _places(template, phrase))
                       for phrase in phrases):
                    yield pairs

    def _together(self, pairs: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
        """The most aligned words that stand within ``max_stretch`` template lengths."""
        best, low = [], 0
        for high in range(len(pairs)):
            while pairs[high][0] - pairs[low][0] >= self.max_stretch * size:
                low += 1
            if high + 1 - low > len(best):
                best = pairs[low:high + 1]
        return best

    def scan(self, codes: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(license, first word, word after the last, coverage) in a text; -1 are words of no template."""
        counts = np.bincount(codes[codes >= 0], minlength=len(self.vocabulary))
        likely = np.flatnonzero(np.minimum(counts, self.counts).sum(1) >= self.min_coverage * self.sizes)
        listed = codes.tolist() if len(likely) else []
        # Neighbouring windows may both see a match, or a part of it, and templates share words: the one with more aligned words stays.
        firsts: list[int] = []
        kept: list[tuple[str, int, int, float]] = []
        for match in sorted({m for t in likely for m in self._matches(codes, listed, int(t))}, key=lambda m: (-m[0], -m[4], m[1], m[2])):
            at = bisect_left(firsts, match[2])
            if (at == 0 or kept[at - 1][2] <= match[2]) and (at == len(kept) or match[3] <= kept[at][1]):
                firsts.insert(at, match[2])
                kept.insert(at, match[1:])
        return kept

    def _matches(self, codes: np.ndarray, listed: list[int], t: int) -> Iterator[tuple[int, str, int, int, float]]:
        """(aligned words, license, first word, word after the last, coverage) of template t in a text."""
        places = np.flatnonzero(self.telling[t][codes])
        half = int(self.max_stretch * self.sizes[t]) + 1
        todo = []
        for g in np.split(places, np.flatnonzero(np.diff(places) > half) + 1) if len(places) else []:
            start, end = max(0, int(g[0]) - half), min(len(codes), int(g[-1]) + half + 1)
            todo += [(a, min(a + 2 * half, end)) for a in range(start, max(start + 1, end - half), half)]
        while todo:
            start, end = todo.pop()
            found = self.best(listed, start, end, t)
            if found:
                aligned, first, last = found
                yield aligned, self.names[t], first, last, aligned / int(self.sizes[t])
                todo += [(start, first), (last, end)]


def scan_licenses(text_col: str = "text", templates: dict[str, str] | None = None, min_coverage: float = 0.8, max_stretch: float = 1.5) -> Column:
    """A column expression: license (of the match with most words), its coverage, and all matches as ranges of code points."""
    chosen = dict(TEMPLATES if templates is None else templates)
    required = REQUIRED if templates is None else {}

    def scan(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(chosen, min_coverage, max_stretch, required)
        vocabulary = pa.array(scanner.vocabulary, pa.large_string())
        for raw in arrays:
            texts, out = as_texts(raw), []
            for start, rows in pieces(texts, PIECE_BYTES):
                part = texts.slice(start, rows)
                flat, starts = words_of(part, ALPHANUMERIC)
                codes = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                for r in range(rows):
                    found = scanner.scan(codes[starts[r]:starts[r + 1]])
                    if not found:
                        out.append({"license": None, "coverage": 0.0, "matches": []})
                        continue
                    spans = char_spans(part[r].as_py(), [(a, b) for _, a, b, _ in found])
                    most = max(found, key=lambda m: (m[2] - m[1], m[3]))
                    out.append({"license": most[0], "coverage": most[3], "matches": [
                        {"license": m[0], "start": s, "end": e, "coverage": m[3]} for m, (s, e) in zip(found, spans)]})
            match = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])
            yield pa.array(out, pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("matches", pa.list_(match))]))

    return F.arrow_udf(scan, RESULT).asNondeterministic()(F.col(text_col))
