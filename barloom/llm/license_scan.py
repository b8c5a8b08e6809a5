"""License scans: patience alignment of texts with license templates.

A stretch of text and a template are anchored on words that are unique in both; the longest
increasing run of anchors stays, and the gaps between are aligned in the same way, after
equal words at their ends. Coverage is the share of the template's words that are aligned.

Only stretches that can reach the wanted coverage are aligned: those where, within one and
a half times the template's length, enough words of the text occur in the template at all,
and that have the phrases which tell the template from its kin (``DISTINCT``). A notice is a
license's name, word for word, after an opener, which is aligned: the longest name counts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from barloom.llm import words as W
from barloom.llm.shared import append_columns, table

COVERAGE = 0.8
#: Length of an aligned stretch, in template lengths.
STRETCH = 1.5
#: Of templates of more words the first stretch that reaches the coverage is kept, aligned once more where it points to.
LONG = 100

_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
    "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
    "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
    "other materials provided with the distribution. "
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} "
    "as published by the Free Software Foundation, either version {1} of the License, or (at your "
    "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
    "GNU {0} for more details."
)
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
    "OR PERFORMANCE OF THIS SOFTWARE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so"
)

# Public license headers and texts. Longer texts lie in ``licenses/``.
TEMPLATES = {
    "0BSD": f"{_ISC_GRANT}.{_ISC_WARRANTY}",
    "AGPL-3.0-header": _GNU_HEADER.format("Affero General Public License", "3"),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": _BSD + _BSD_WARRANTY,
    "BSD-3-Clause": (
        f"{_BSD}3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        f"promote products derived from this software without specific prior written permission. {_BSD_WARRANTY}"
    ),
    "BSD-4-Clause": (
        f"{_BSD}3. All advertising materials mentioning features or use of this software must display the following "
        "acknowledgement: This product includes software developed by the organization. 4. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        f"software without specific prior written permission. {_BSD_WARRANTY}"
    ),
    "GPL-2.0-header": _GNU_HEADER.format("General Public License", "2"),
    "GPL-3.0-header": _GNU_HEADER.format("General Public License", "3"),
    "ISC": (
        f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies."
        f"{_ISC_WARRANTY}"
    ),
    "LGPL-2.1-header": _GNU_HEADER.format("Lesser General Public License", "2.1"),
    "LGPL-3.0-header": _GNU_HEADER.format("Lesser General Public License", "3"),
    "MIT-0": f"{_MIT_GRANT}.{_WARRANTY}",
    "MIT-text": (
        f"{_MIT_GRANT}, subject to the following conditions: The above copyright notice and this permission notice shall "
        f"be included in all copies or substantial portions of the Software.{_WARRANTY}"
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
        "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        "this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE. For more information, please refer to http://unlicense.org/"
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."
    ),
}

#: What tells a template from its kin: phrases of it, each to be aligned word by word with words in a row.
DISTINCT = {
    "AGPL-3.0-header": ("GNU Affero General Public License", "version 3 of the"),
    "AGPL-3.0-text": ("Affero General Public License Version 3",),
    "Apache-2.0-header": ("Apache License, Version 2.0",),
    "Apache-2.0-text": ("Apache License Version 2.0",),
    "Artistic-1.0-text": ("Artistic License",),
    "BSD-3-Clause": ("endorse or promote products",),
    "BSD-4-Clause": ("advertising materials mentioning features", "endorse or promote products"),
    "BSL-1.0-text": ("machine-executable object code",),
    "CC0-1.0-text": ("CC0 1.0 Universal",),
    "GFDL-1.2-text": ("Free Documentation License Version 1.2",),
    "GFDL-1.3-text": ("Free Documentation License Version 1.3",),
    "GPL-1.0-text": ("GNU General Public License Version 1",),
    "GPL-2.0-header": ("GNU General Public License", "version 2 of the"),
    "GPL-2.0-text": ("GNU General Public License Version 2",),
    "GPL-3.0-header": ("GNU General Public License", "version 3 of the"),
    "GPL-3.0-text": ("GNU General Public License Version 3",),
    "ISC": ("provided that the above copyright notice",),
    "LGPL-2.0-text": ("GNU Library General Public License Version 2",),
    "LGPL-2.1-header": ("GNU Lesser General Public License", "version 2.1 of the"),
    "LGPL-2.1-text": ("GNU Lesser General Public License Version 2.1",),
    "LGPL-3.0-header": ("GNU Lesser General Public License", "version 3 of the"),
    "LGPL-3.0-text": ("GNU Lesser General Public License Version 3",),
    "MIT-text": ("this permission notice shall be included",),
    "MPL-1.1-text": ("Mozilla Public License Version 1.1",),
    "MPL-2.0-header": ("Mozilla Public License, v. 2.0",),
    "MPL-2.0-text": ("Mozilla Public License Version 2.0",),
    "Unlicense": ("unencumbered software released into the public domain",),
}

#: A notice is one of these, aligned to the wanted coverage, and then a license's name, word for word.
OPENERS = (
    "Licensed under",
    "Licensed under the",
    "Licensed under a",
    "Released under",
    "Released under the",
    "Released under a",
    "Distributed under the",
    "Published under the",
    "Available under the",
    "Made available under the",
    "Provided under the",
    "Subject to the",
    "Subject to the terms of the",
    "Under the terms of the",
    "Licensed under the terms of the",
    "Released under the terms of the",
    "Distributed under the terms of the",
    "This work is licensed under",
    "This work is licensed under the",
    "This work is licensed under a",
    "SPDX-License-Identifier:",
)


def _names() -> dict[str, list[str]]:
    """The names of each license in notices. A longer name goes before one inside it, so that of a kind without a version stands for no other."""
    names = {
        "0BSD": ["0BSD", "Zero-Clause BSD License", "BSD Zero Clause License"],
        "Artistic-1.0": ["Artistic License 1.0", "Artistic-1.0", "Artistic License, Version 1.0"],
        "Artistic-2.0": ["Artistic License 2.0", "Artistic-2.0", "Artistic License, Version 2.0"],
        "BSD": ["BSD License", "BSD licence", "BSD-style License"],
        "BSL-1.0": ["Boost Software License", "Boost Software License 1.0", "Boost Software License, Version 1.0", "BSL-1.0"],
        "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons Zero v1.0 Universal"],
        "ISC": ["ISC License", "ISC licence", "ISC"],
        "MIT": ["MIT License", "MIT licence", "Expat License", "MIT"],
        "MIT-0": ["MIT No Attribution License", "MIT No Attribution", "MIT-0"],
        "ODbL-1.0": ["Open Database License", "ODbL", "ODbL 1.0", "Open Database License 1.0", "Open Data Commons Open Database License"],
        "PSF-2.0": ["Python Software Foundation License", "PSF License", "PSF-2.0", "Python Software Foundation License Version 2"],
        "Unlicense": ["Unlicense"],
        "WTFPL": ["WTFPL", "Do What The Fuck You Want To Public License"],
        "Zlib": ["zlib License", "zlib"],
    }
    for n, word in ((2, "two"), (3, "three"), (4, "four")):
        names[f"BSD-{n}-Clause"] = [x for k in (str(n), word) for x in (f"BSD {k}-Clause", f"BSD {k}-Clause License", f"{k}-Clause BSD License", f"{k}-Clause BSD")]
    names["BSD-2-Clause"] += ["Simplified BSD License", "FreeBSD License"]
    names["BSD-3-Clause"] += ["New BSD License", "Modified BSD License", "Revised BSD License"]

    def versions(id: str, full: list[str], short: list[str], known: list[str]) -> None:
        names[id] = [*full, *short, *(f"{s} License" for s in short)]
        for v in known:
            spelled = [v] if not v.endswith(".0") else [v, v[:-2]]
            names[f"{id}-{v}"] = [
                f"{name}{mark}{s}{end}"
                for s in spelled
                for name, marks in [*((f, (" ", ", version ", " v", " v. ")) for f in full), *((s_, (" ", " v", " v. ", " version ", "v")) for s_ in short)]
                for mark in marks
                for end in ("", " License")
            ]

    gnu = "General Public License"
    versions("GPL", [f"GNU {gnu}", f"GNU {gnu} (GPL)", "GNU Public License"], ["GPL", "GNU GPL"], ["1.0", "2.0", "3.0"])
    versions("LGPL", [f"GNU Lesser {gnu}", f"GNU Library {gnu}", f"GNU Lesser {gnu} (LGPL)"], ["LGPL", "GNU LGPL"], ["2.0", "2.1", "3.0"])
    versions("AGPL", [f"GNU Affero {gnu}", f"Affero {gnu}", f"GNU Affero {gnu} (AGPL)"], ["AGPL", "GNU AGPL"], ["1.0", "3.0"])
    versions("GFDL", ["GNU Free Documentation License"], ["GFDL", "GNU FDL"], ["1.1", "1.2", "1.3"])
    versions("Apache", ["Apache License", "Apache Software License", "Apache licence"], ["Apache"], ["1.0", "1.1", "2.0"])
    versions("MPL", ["Mozilla Public License"], ["MPL"], ["1.0", "1.1", "2.0"])
    versions("EPL", ["Eclipse Public License"], ["EPL"], ["1.0", "2.0"])
    versions("CDDL", ["Common Development and Distribution License"], ["CDDL"], ["1.0", "1.1"])
    versions("EUPL", ["European Union Public Licence", "European Union Public License"], ["EUPL"], ["1.1", "1.2"])
    parts = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
    spellings = {"NC": ("NonCommercial", "Non-Commercial"), "SA": ("ShareAlike", "Share-Alike"), "ND": ("NoDerivatives", "No-Derivatives", "NoDerivs")}
    for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        full = [parts["BY"]]
        for part in kind.split("-")[1:]:
            full = [f"{f} {s}" for f in full for s in spellings[part]]
        full = [f"Creative Commons {f}" for f in full]
        short = [f"CC {kind}", f"Creative Commons {kind}"]
        names[f"CC-{kind}"] = [f"{x}{end}" for x in [*full, *short] for end in ("", " License")]
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            names[f"CC-{kind}-{v}"] = [
                f"{x} {version}{area}{end}"
                for x in [*full, *short]
                for version in (v, f"version {v}", f"v{v}")
                for area in ("", " International", " Unported", " Generic")
                for end in ("", " License", " Public License")
            ]
    return names


def _texts() -> dict[str, str]:
    """All templates. Preamble and section 13 of the AGPL are not in its template: its other terms are those of the GPL."""
    texts = TEMPLATES | {f.stem: f.read_text() for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}
    gpl = texts["GPL-3.0-text"]
    terms = gpl[gpl.index("TERMS AND CONDITIONS", 0) : gpl.index("END OF TERMS AND CONDITIONS")]
    cut = terms[: terms.index("13. Use with the GNU Affero")] + terms[terms.index("14. Revised Versions") :]
    texts["AGPL-3.0-text"] = "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 " + cut.replace(
        "GNU General Public License", "GNU Affero General Public License"
    )
    return texts


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence, by patience sorting."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, value in enumerate(values):
        pile = bisect_left(tops, value)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            at.append(i)
        else:
            tops[pile], at[pile] = value, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Aligned places of equal items of a and b, increasing in both."""
    found: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        once = [(i, place[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in place]
        anchors = [once[k] for k in longest_increasing([j for _, j in once])]
        if not anchors:
            continue
        found.extend(anchors)
        ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        gaps.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:]))
    return sorted(found)


def _words_of(text: str) -> tuple[np.ndarray, list[int]]:
    data = text.encode()
    block = W.block(np.frombuffer(data, np.uint8), np.array([0, len(data)]), slice(0, 1), W.ALNUM_BYTE)
    h = block.hashes(W.LOWER)
    return h, h.tolist()


class Template:
    """A template's words and vocabulary, the aligned words it needs, and the places of each phrase that must be aligned."""

    def __init__(self, name: str, text: str, coverage: float, phrases: Sequence[str] = ()):
        hashes, self.words = _words_of(text)
        self.name, self.vocabulary, self.size = name, np.unique(hashes), len(self.words)
        self.need = max(1, -(-int(round(coverage * 1000)) * self.size // 1000))
        self.phrases = [_words_of(p)[1] for p in phrases]
        self.places = [[i for i in range(self.size) if self.words[i : i + len(p)] == p] for p in self.phrases]

    def possible(self, words: np.ndarray) -> bool:
        """Whether the text has each phrase at all."""
        for phrase in self.phrases:
            room = len(words) - len(phrase) + 1
            if room <= 0 or not np.logical_and.reduce([words[i : i + room] == np.uint64(w) for i, w in enumerate(phrase)]).any():
                return False
        return True

    def align(self, words: np.ndarray, begin: int) -> tuple[list[tuple[int, int]], bool]:
        """Aligned places in the stretch from ``begin``, and whether they are enough and have each phrase, words in a row."""
        pairs = patience(words[begin : begin + int(STRETCH * self.size)].tolist(), self.words)
        if len(pairs) < self.need:
            return pairs, False
        at = {j: i for i, j in pairs}
        return pairs, all(
            any(p in at and all(at.get(p + k) == at[p] + k for k in range(len(phrase))) for p in places)
            for phrase, places in zip(self.phrases, self.places)
        )


def _overlaps(words: np.ndarray, hits: np.ndarray, begins: np.ndarray, span: int, template: Template) -> np.ndarray:
    """How many words of the stretch from each begin the template has, each as often as it has it: no alignment has more."""
    codes = np.searchsorted(template.vocabulary, words[hits]).tolist()
    left = np.bincount(np.searchsorted(template.vocabulary, np.array(template.words, np.uint64)), minlength=len(template.vocabulary)).tolist()
    ends = np.searchsorted(hits, begins + span).tolist()
    out, at, upto, held = [], 0, 0, 0
    for first, end in zip(np.searchsorted(hits, begins).tolist(), ends):
        while upto < end:
            left[codes[upto]] -= 1
            held += left[codes[upto]] >= 0
            upto += 1
        while at < first:
            held -= left[codes[at]] >= 0
            left[codes[at]] += 1
            at += 1
        out.append(held)
    return np.array(out)


def find_licenses(words: np.ndarray, template: Template) -> Iterator[tuple]:
    """(license, coverage, first word, end word, aligned words) of each stretch that reaches the coverage.

    Of stretches of one template that overlap, the one that begins first among those of the highest coverage stays.
    """
    name, size, need = template.name, template.size, template.need
    span = int(STRETCH * size)
    hits = np.flatnonzero(np.isin(words, template.vocabulary))
    if len(hits) < need or not template.possible(words):
        return
    begins = np.flatnonzero(hits[need - 1 :] - hits[: len(hits) - need + 1] < span)
    upto, best = -1, None

    def found(begin: int, pairs: list) -> tuple:
        return name, len(pairs) / size, begin + pairs[0][0], begin + pairs[-1][0] + 1, len(pairs)

    places = hits[begins]
    if size > LONG and len(places):
        places = places[_overlaps(words, hits, places, span, template) >= need]
    for begin in places.tolist():
        if best is not None and begin >= best[3]:
            yield best
            upto, best = best[3], None
        if begin < upto:
            continue
        pairs, good = template.align(words, begin)
        if size > LONG:
            if len(pairs) >= need:
                i, j = pairs[len(pairs) // 2]
                again = max(begin, begin + i - j - size // 8)
                pairs_again, good_again = template.align(words, again)
                if good_again and (not good or len(pairs_again) > len(pairs)):
                    begin, pairs, good = again, pairs_again, True
            if good:
                best = found(begin, pairs)
        elif good and (best is None or len(pairs) > best[4]):
            best = found(begin, pairs)
        if best is not None and (size > LONG or best[4] == size):
            yield best
            upto, best = best[3], None
    if best is not None:
        yield best


class Notices:
    """The names of licenses as a tree of words, and the openers that go before them."""

    END = -1

    def __init__(self, names: dict[str, list[str]], openers: Sequence[str], coverage: float):
        self.tree: dict = {}
        for license, spelled in names.items():
            for name in spelled:
                node = self.tree
                for word in _words_of(name)[1]:
                    node = node.setdefault(word, {})
                node.setdefault(self.END, license)
        self.first = np.array(sorted(self.tree), np.uint64)
        told = [_words_of(w)[1][0] for w in ("under", "subject", "identifier")]
        self.openers = []
        for opener in openers:
            words = _words_of(opener)[1]
            self.openers.append((words, next(t for t in told if t in words)))
        self.told, self.coverage = set(told), coverage
        self.back = max(len(o) for o, _ in self.openers)

    def find(self, words: list[int], places: list[int]) -> Iterator[tuple]:
        """Finds as of ``find_licenses``, given the places of words that begin a name."""
        upto = 0
        for p in places:
            if p < upto:
                continue
            node, i, end = self.tree, p, None
            while i < len(words) and words[i] in node:
                node, i = node[words[i]], i + 1
                if self.END in node:
                    license, end = node[self.END], i
            if end is None:
                continue
            size, best = end - p, None
            widest = int(STRETCH * (self.back + size)) - size
            if self.told.isdisjoint(words[max(upto, p - widest) : p]):
                continue
            for opener, told in self.openers:
                total = len(opener) + size
                begin = max(upto, p - (int(STRETCH * total) - size))
                pairs = patience(words[begin:p], opener)
                share = (len(pairs) + size) / total
                if round(share * 1000) < round(self.coverage * 1000) or 2 * len(pairs) < len(opener):
                    continue
                if all(opener[j] != told for _, j in pairs):
                    continue
                if best is None or (share, total) > (best[1], best[5]):
                    best = (license, share, begin + pairs[0][0], end, len(pairs) + size, total)
            if best is not None:
                yield best[:5]
                upto = end


def resolve(found: list[tuple]) -> list[tuple]:
    """Finds by place, without those more than half of which lie in a find of more aligned words."""
    out: list[tuple] = []
    active: list[tuple] = []
    gone: set[tuple] = set()
    for f in sorted(set(found), key=lambda f: (f[2], -f[3], -f[4], f[0])):
        active = [a for a in active if a[3] > f[2] and a not in gone]
        for a in active:
            common = min(a[3], f[3]) - f[2]
            less, more = (f, a) if (f[4], f[1]) <= (a[4], a[1]) else (a, f)
            if 2 * common > less[3] - less[2]:
                gone.add(less)
        active.append(f)
        out.append(f)
    return sorted((f for f in out if f not in gone), key=lambda f: (f[2], f[3], f[0]))


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """All columns of ``docs`` and n_licenses, license, coverage, licenses.

    ``licenses`` lists each find as (license, coverage, first, end) in words, by place;
    ``license`` and ``coverage`` are those of the highest coverage, ties to the longer
    template and then the earlier place. A find inside one of more aligned words is part of
    that one. ``templates`` takes the place of the known texts and notices. Words are runs of
    letters and digits in any case. Null and empty texts have no find: 0, null, 0.0, empty. Repeated
    rows repeat; an empty table gives an empty one; columns with the name of an added one are replaced.
    """
    given = _texts() if templates is None else templates
    phrases = DISTINCT if templates is None else {}
    known = [t for name, text_ in given.items() if (t := Template(name, text_, coverage, phrases.get(name, ()))).size]
    notices = Notices(_names(), OPENERS, coverage) if templates is None else None
    every = np.unique(np.concatenate([t.vocabulary for t in known])) if known else np.zeros(0, np.uint64)
    # The last place is for words of no template.
    member = np.array([np.append(np.isin(every, t.vocabulary), False) for t in known]).reshape(len(known), len(every) + 1)
    kind = pa.list_(
        pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first", pa.int32()), ("end", pa.int32())])
    )

    def make(texts: pa.Array) -> list[pa.Array]:
        rows = []
        for block in W.blocks(texts, W.ALNUM_BYTE):
            h = block.hashes(W.LOWER)
            first = block.first.tolist()
            found: list[list] = [[] for _ in first[1:]]
            if len(h) and len(every):
                code = np.minimum(np.searchsorted(every, h), len(every) - 1)
                code = np.where(every[code] == h, code, len(every))
                hit = np.flatnonzero(code < len(every))
                bounds, code = np.searchsorted(hit, block.first), code[hit]
                for t, of in zip(known, member):
                    sums = np.concatenate(([0], np.cumsum(of[code], dtype=np.int64)))
                    for row in np.flatnonzero(np.diff(sums[bounds]) >= t.need).tolist():
                        found[row] += find_licenses(h[first[row] : first[row + 1]], t)
            if len(h) and notices is not None:
                begins = np.flatnonzero(np.isin(h, notices.first))
                bounds = np.searchsorted(begins, block.first)
                for row in np.flatnonzero(np.diff(bounds)).tolist():
                    places = (begins[bounds[row] : bounds[row + 1]] - first[row]).tolist()
                    found[row] += notices.find(h[first[row] : first[row + 1]].tolist(), places)
            rows += [resolve(f) for f in found]
        best = [min(f, key=lambda x: (-x[1], -x[4], x[2]), default=None) for f in rows]
        return [
            pa.array([len(f) for f in rows], pa.int64()),
            pa.array([b and b[0] for b in best], pa.string()),
            pa.array([b[1] if b else 0.0 for b in best], pa.float64()),
            pa.array([[dict(zip(("license", "coverage", "first", "end"), x)) for x in f] for f in rows], kind),
        ]

    added = (
        "n_licenses long, license string, coverage double, "
        "licenses array<struct<license: string, coverage: double, first: int, end: int>>"
    )
    return append_columns(docs, text, added, make)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_licenses", "license", "coverage", "licenses")
