"""Licence scan by patience alignment.

A text and a template are aligned on the words that occur once in both: of these anchors the longest
subsequence that rises in both is kept, words next to an anchor are matched outwards while they agree, and
the gaps in between are aligned again. A template is found where the aligned words cover at least
THRESHOLD of it, all of its words that tell licences apart (TELLING, and numbers) are among them, and no word of
EXCLUDING stands in between that it lacks: a version 2 is no version 3, and a Lesser licence no other. Of finds that
overlap, the one that covers the most words stays. Long texts are aligned in windows about places where enough of the template's words lie
together, so a notice may stand anywhere, and more than once.

Null and empty texts have no licence, and an empty table gives no rows. Rows without doc_id are looked at too. Repeated rows get the same answer. Words are lower-case runs of
letters and digits. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from widefold.llm.common import read_table, whole_text

WORDS = re.compile(r"[^\W_]+")
THRESHOLD = 0.8
#: A notice may be spread over so many times the template's length.
STRETCH = 1.5

#: Words that tell licences and notices apart.
TELLING = frozenset(
    "apache mit bsd isc gnu lesser affero mozilla eclipse boost artistic unlicense wtfpl zlib cc cc0 by nc sa nd attribution "
    "sharealike noncommercial noderivatives released licensed dedicated international unported".split()
)
EXCLUDING = frozenset("lesser library affero sharealike noncommercial noderivatives noderivs nc sa nd".split())

#: Public licence notices.
AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
BSD_3 = (
    f"{BSD_2} Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
GNU_HEADER = (
    "{program} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} "
    "License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
    "later version. {program} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
    "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} "
    "License for more details."
)
GNU_LICENSES = {
    "GPL-2.0": ("General Public", "2"), "GPL-3.0": ("General Public", "3"), "LGPL-2.1": ("Lesser General Public", "2.1"),
    "LGPL-3.0": ("Lesser General Public", "3"), "AGPL-3.0": ("Affero General Public", "3"),
}
CREATIVE_COMMONS = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
PERMISSION = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        'you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License."
    ),
    "MIT notice": "Released under the MIT License",
    "MIT licensed notice": "Licensed under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "BSD notice": "Released under the BSD License",
    "BSD licensed notice": "Licensed under the BSD License",
    "BSD-2-Clause": BSD_2,
    "BSD-2-Clause full": f"{BSD_2} {AS_IS}",
    "BSD-3-Clause": BSD_3,
    "BSD-3-Clause full": f"{BSD_3} {AS_IS}",
    "ISC": f"{PERMISSION}, provided that the above copyright notice and this permission notice appear in all copies. {ISC_END}",
    "0BSD": f"{PERMISSION}. {ISC_END}",
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
        "be appreciated but is not required. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. This notice may not be removed or altered from any source distribution."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "BSL-1.0 notice": "Distributed under the Boost Software License, Version 1.0",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at http://www.eclipse.org/legal/epl-2.0"
    ),
    "Artistic-2.0 notice": "Licensed under the Artistic License 2.0",
    "WTFPL": "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION",
    "CC0-1.0 notice": "dedicated to the public domain under CC0 1.0 Universal",
}
for _name, (_kind, _version) in GNU_LICENSES.items():
    TEMPLATES[f"{_name} notice"] = f"licensed under the GNU {_kind} License, version {_version}"
    TEMPLATES[f"{_name} header"] = GNU_HEADER.format(program="This program", kind=_kind, version=_version)
for _code, _kind in CREATIVE_COMMONS.items():
    for _version, _scope in (("3.0", "Unported"), ("4.0", "International")):
        TEMPLATES[f"CC-{_code}-{_version} notice"] = f"Licensed under CC {_code} {_version}"
        TEMPLATES[f"CC-{_code}-{_version} long notice"] = (
            f"licensed under a Creative Commons {_kind} {_version} {_scope} License"
        )


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    distinct: frozenset[str]
    telling: frozenset[int]

    @classmethod
    def of(cls, name: str, text: str) -> Template:
        words = tuple(words_of(text))
        telling = frozenset(i for i, w in enumerate(words) if w in TELLING or w.isdigit())
        return cls(name, words, frozenset(words), telling)

    def told(self) -> frozenset[str]:
        return frozenset(self.words[i] for i in self.telling)

    def is_told(self, matched: list[tuple[int, int]], text: list[str]) -> bool:
        """Whether the words that tell the template apart are aligned, and no other licence's stand in between."""
        if not self.telling.issubset(i for i, _ in matched):
            return False
        aligned = {j for _, j in matched}
        between = {text[j] for j in range(matched[0][1], matched[-1][1] + 1) if j not in aligned}
        return not between & (EXCLUDING - self.distinct)


@dataclass(frozen=True)
class Found:
    template: str
    start: int
    end: int
    covered: int
    words: int
    anchors: int


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs, which rise in the first number, that rises in the second, too."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        before.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(y)
            at.append(i)
        else:
            tops[pile], at[pile] = y, i
    chain, i = [], at[-1] if at else -1
    while i >= 0:
        chain.append(pairs[i])
        i = before[i]
    return chain[::-1]


def align(a: tuple[str, ...] | list[str], b: list[str]) -> tuple[list[tuple[int, int]], int]:
    """Matched places of a and b, in order, and the number of anchors, by patience alignment."""
    matched: list[tuple[int, int]] = []
    anchors = 0
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        # What the ends of a gap share belongs to the anchors beside it.
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        chain = rising([(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in where])
        if not chain:
            continue
        anchors += len(chain)
        matched += chain
        edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        gaps += [(x + 1, z, y + 1, w) for (x, y), (z, w) in zip(edges, edges[1:], strict=False)]
    return sorted(matched), anchors


def find(text: list[str], template: Template, threshold: float = THRESHOLD) -> list[Found]:
    """Occurrences of a template in a text that do not overlap.

    Windows begin at words of the template, and the next one half a template further on. They are that
    much wider than STRETCH asks for, so one of them holds any notice whole, and a text is gone through
    a fixed number of times. Only windows with enough different words of the template are aligned.
    """
    step = max(1, len(template.words) // 2)
    width = int(STRETCH * len(template.words)) + step + 1
    need = threshold * len(template.distinct)
    hits = [i for i, w in enumerate(text) if w in template.distinct]
    out = []
    at = 0
    while at < len(hits):
        start = hits[at]
        window = text[start : start + width]
        following = start + step
        if len(template.distinct.intersection(window)) >= need:
            matched, anchors = align(template.words, window)
            if len(matched) >= threshold * len(template.words) and template.is_told(matched, window):
                first, following = start + matched[0][1], start + matched[-1][1] + 1
                out.append(Found(template.name, first, following, len(matched), len(template.words), anchors))
        at = bisect_left(hits, following, at + 1)
    return out


def best_covered(found: list[Found]) -> list[Found]:
    """Of finds that overlap, the one that covers the most words, then the greater part of its template."""
    kept: list[tuple[int, int, Found]] = []
    for f in sorted(found, key=lambda f: (-f.covered, -f.covered / f.words, f.start, f.template)):
        at = bisect_left(kept, (f.start,))
        if (at == 0 or kept[at - 1][1] <= f.start) and (at == len(kept) or f.end <= kept[at][0]):
            insort(kept, (f.start, f.end, f))
    return [f for _, _, f in kept]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, license, start_word, end_word (exclusive), covered_words, template_words and anchors of each
    notice found. Every text is gone through in one task; nothing is shuffled. A template whose words are not
    there to the needed share cannot be covered, and is not looked for."""
    shared = [Template.of(k, v) for k, v in (TEMPLATES if templates is None else templates).items()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = frozenset(w for t in shared for w in t.distinct)
        for batch in batches:
            rows = []
            for doc_id, text in batch.itertuples(index=False):
                words = words_of(text)
                there = known.intersection(words)
                found = []
                for t in shared:
                    enough = t.words and len(there & t.distinct) >= threshold * len(t.distinct)
                    if enough and t.told() <= there:
                        found += find(words, t, threshold)
                rows += [
                    (doc_id, f.template, f.start, f.end, f.covered, f.words, f.anchors) for f in best_covered(found)
                ]
            names = ["doc_id", "license", "start_word", "end_word", "covered_words", "template_words", "anchors"]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return rows.mapInPandas(
        run,
        "doc_id long, license string, start_word int, end_word int, covered_words int, template_words int, anchors int",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read_table(spark, sf_dir, "documents"))
