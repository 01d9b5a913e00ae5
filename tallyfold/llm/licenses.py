"""License scans: patience alignment of texts with license templates.

Words (lower-cased, letters and digits) that occur once in a text window and
once in the template are anchors; the longest increasing subsequence of their
positions fixes the alignment, which is grown over equal neighbours and then
repeated inside every gap between fixed words; in a gap without such words the
rarest word that both sides have is anchored, occurrence by occurrence, so no
equal words are left that could still be aligned.  A template's coverage is the
share of its words that get aligned.

A template stands in a text where its words are aligned within ``spread`` times
the template's words (twice, unless asked otherwise), so up to as many other
words may stand between them.  A text holds a template as often as there are
such places side by side: the best one is taken first, and what lies before and
after it is searched again.  A text is searched whole: a window of that width starts at every word of the
template that the text has, so what is found does not depend on what stands
before, and a license pasted twice is still unique in its windows.  A window
is aligned only if it holds enough words to reach ``threshold`` and to better
the best window so far; the bound used is exact: aligned words are common
words, counted with their multiplicity.

Templates are a small fixed mapping (a parameter); it is shipped to the tasks
with the function.  Edge cases: null or wordless texts match nothing; of equal
coverages the template first in name order wins, then the earlier place;
repeated rows repeat; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.text import texts

THRESHOLD = 0.8

# Public license notices as their publishers print them.
TEMPLATES: dict[str, str] = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "MIT notice": "Released under the MIT License",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        'copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF '
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "AGPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "LGPL-2.1 header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version. This library is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE "
        'COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause condition": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
}

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (ordered by the first) increasing in the
    second: patience piles with back links."""
    tops: list[int] = []
    pile: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        back.append(pile[at - 1] if at else -1)
        if at == len(tops):
            tops.append(b)
            pile.append(i)
        else:
            tops[at], pile[at] = b, i
    out, i = [], pile[-1] if pile else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """Aligned (text position, template position) pairs, increasing in both."""
    out: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and text[a0] == template[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and text[a1 - 1] == template[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a = {w for w, n in Counter(text[a0:a1]).items() if n == 1}
        where = {w: j for j, w in enumerate(template[b0:b1], b0)}
        once = {w for w, n in Counter(template[b0:b1]).items() if n == 1} & once_a
        fixed = _increasing([(i, where[w]) for i, w in enumerate(text[a0:a1], a0) if w in once])
        if not fixed:
            fixed = _rarest(text, a0, a1, template, b0, b1)
        if not fixed:
            continue
        out += fixed
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *fixed], [*fixed, (a1, b1)]):
            if k - i > 1 and m - j > 1:
                # A gap starts and ends beside fixed words, so equal
                # neighbours of an anchor are aligned as its ends.
                work.append((i + 1, k, j + 1, m))
    return sorted(out)


def _rarest(text: Sequence[str], a0: int, a1: int, template: Sequence[str], b0: int, b1: int) -> list[tuple[int, int]]:
    """The occurrences, in turn, of the rarest word that both stretches have."""
    left, right = Counter(text[a0:a1]), Counter(template[b0:b1])
    word = min(left.keys() & right.keys(), key=lambda w: (left[w] * right[w], w), default=None)
    if word is None:
        return []
    at = (i for i in range(a0, a1) if text[i] == word)
    return list(zip(at, (j for j in range(b0, b1) if template[j] == word)))


def best_match(words: Sequence[str], template: Sequence[str], threshold: float, spread: float = 2.0) -> tuple[float, int, int] | None:
    """(coverage, start, end) in words of the best window that reaches the
    threshold."""
    m, best, most = len(template), None, 0
    width = int(spread * m)
    need = Counter(template)
    at = [i for i, w in enumerate(words) if w in need]
    held: Counter[str] = Counter()
    common = end = 0
    for a in at:
        while end < len(at) and at[end] < a + width:
            w = words[at[end]]
            common += held[w] < need[w]
            held[w] += 1
            end += 1
        if common >= threshold * m and common > most:
            pairs = align(words[a : a + width], template)
            if len(pairs) >= threshold * m and len(pairs) > most:
                most, best = len(pairs), (len(pairs) / m, a + pairs[0][0], a + pairs[-1][0] + 1)
        held[words[a]] -= 1
        common -= held[words[a]] < need[words[a]]
    return best


def all_matches(words: Sequence[str], template: Sequence[str], threshold: float, spread: float = 2.0) -> list[tuple[float, int, int]]:
    """(coverage, start, end) of every place, in the order of the text."""
    out, work = [], [(0, len(words))]
    while work:
        a, b = work.pop()
        if b - a >= threshold * len(template) and (hit := best_match(words[a:b], template, threshold, spread)):
            out.append((hit[0], a + hit[1], a + hit[2]))
            work += [(a, a + hit[1]), (a + hit[2], b)]
    return sorted(out, key=lambda place: place[1])


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    spread: float = 2.0,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per document: id, ``license`` of highest coverage (null if no
    template reaches the threshold), its ``coverage`` and word span, and
    ``licenses``, every place of every template, by name and then place."""
    known = {name: words_of(t) for name, t in sorted(templates.items())}
    found = {name: (w, set(w)) for name, w in known.items() if w}
    schema = "struct<license:string,coverage:double,start_word:long,end_word:long,licenses:array<struct<license:string,coverage:double,start_word:long,end_word:long>>>"
    match = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())]))

    @F.arrow_udf(schema)
    def scanned(column: pa.Array) -> pa.Array:
        rows = []
        for x in texts(column):
            words = words_of(x.as_py())
            there, got = set(words), []
            for name, (template, distinct) in found.items():
                # Words aligned are words in common: missing too many ends it.
                if sum(template.count(w) for w in distinct - there) > (1 - threshold) * len(template):
                    continue
                got += [(name, *place) for place in all_matches(words, template, threshold, spread)]
            top = max(got, key=lambda g: g[1], default=(None, None, None, None))
            rows.append((*top, [dict(zip(("license", "coverage", "start_word", "end_word"), g)) for g in got]))
        kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), match]
        return pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
            ["license", "coverage", "start_word", "end_word", "licenses"],
        )

    return (
        docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
        .select("_i", scanned("_t").alias("_l"))
        .select(F.col("_i").alias(id_col), "_l.*")
    )
