"""License scans by patience alignment of texts with license templates.

Words that occur once in both the text window and the template are anchors; the longest run of anchors that ascends in
both is kept, and the gaps between them are aligned the same way, after equal words at a gap's two ends. The share of
template words aligned is the coverage.

A notice is a range of words, at most a quarter (or a few words) longer than the template, whose first and last words are aligned, with enough
of the template aligned in all, short templates in full. The words in braces name the license: a range in which one of them is
missing, or a word has been put among or right beside them, is no notice of it. Of the ranges of a text the densest is taken,
then the densest of those apart from it, and so on. To find them without aligning every range, the longest common
subsequence, which no alignment exceeds, is worked out for all ends of a start at once; ranges are aligned from the
highest bound down, until the best one aligned exceeds what is left.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import doc_texts, slices

COVERAGE = 0.8
#: Templates of fewer words have to be aligned in full: the one word left out could be the license's name.
SHORT_WORDS = 20

#: Words that a notice of a few words may hold besides its own, longer ones a quarter of theirs.
MOST_PUT_IN = 3

#: Public license notices, as their licenses state them; braces mark the words that name the license.
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_ISC_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_NO_WARRANTY = (
    "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
)


def _gnu(what: str, name: str, version: str) -> str:
    """The notice that a version of a GNU license asks for."""
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the {{{name}}} as published "
        f"by the Free Software Foundation, either {{version {version}}} of the License, or (at your option) any later version."
    )


_GPL, _LESSER, _AFFERO = "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"
TEMPLATES = {
    "Apache-2.0": "Licensed under the {Apache License, Version 2.0}.",
    "Apache-2.0 header": (
        "Licensed under the {Apache License, Version 2.0} (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the {MIT License}.",
    "MIT text": _MIT,
    "MIT full text": f"{_MIT} {_AS_IS}",
    "GPL-3.0": f"This work is licensed under the {{{_GPL}, version 3}}.",
    "GPL header": _gnu("program", _GPL, "3"),
    "GPL-2.0 header": _gnu("program", _GPL, "2"),
    "GPL header with warranty": f"{_gnu('program', _GPL, '3')} This program {_NO_WARRANTY} {{{_GPL}}} for more details.",
    "AGPL-3.0 header": _gnu("program", _AFFERO, "3"),
    "LGPL": f"This library is licensed under the {{{_LESSER}}}.",
    "LGPL-3.0 header": _gnu("program", _LESSER, "3"),
    "LGPL-2.1 header": _gnu("library", _LESSER, "2.1"),
    "BSD text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "BSD-2-Clause full text": f"{_BSD_2} {_BSD_AS_IS}",
    "BSD-3-Clause full text": f"{_BSD_2} {_BSD_3} {_BSD_AS_IS}",
    "ISC text": _ISC,
    "ISC full text": f"{_ISC} {_ISC_AS_IS}",
    "MPL-2.0": "This Source Code Form is subject to the terms of the {Mozilla Public License, v. 2.0}.",
    "CC-BY-4.0": "This work is licensed under a {Creative Commons Attribution 4.0 International License}.",
    "CC-BY-NC-4.0": "Licensed under {CC BY-NC 4.0}.",
    "CC-BY-SA-4.0": "Licensed under {CC BY-SA 4.0}.",
    "Reserved": "All rights reserved.",
}

FOUND = "doc_id long, license string, start_char long, end_char long, matched_words int, template_words int, coverage double"

_word = re.compile(r"[^\W_]+(?:[.\-'][^\W_]+)*")


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Lower-case words with their character spans; inner dots, hyphens and apostrophes belong to a word."""
    return [(m.group().lower(), m.start(), m.end()) for m in _word.finditer(text)]


def ascending(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs, sorted by their first part, that ascends in the second."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, b) in enumerate(pairs):
        i = bisect_left(tails, b)
        tails[i : i + 1] = [b]
        at[i : i + 1] = [k]
        back.append(at[i - 1] if i else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Patience alignment: pairs of positions with equal words, ascending in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        once_b = {w for w, n in Counter(b[b0:b1]).items() if n == 1}
        once_a = {w for w, n in Counter(w for w in a[a0:a1] if w in once_b).items() if n == 1}
        if not once_a:
            continue
        place = {b[j]: j for j in range(b0, b1) if b[j] in once_a}
        anchors = ascending([(i, place[a[i]]) for i in range(a0, a1) if a[i] in once_a])
        out += anchors
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
            gaps.append((i + 1, k, j + 1, m))
    return sorted(out)


@dataclass(frozen=True)
class Template:
    """A template's words, their counts, the places of the names in it, and how many words have to be aligned."""

    license: str
    words: tuple[str, ...]
    count: Counter
    names: tuple[tuple[int, int], ...]
    need: int

    @property
    def longest(self) -> int:
        """Most words of a notice."""
        return len(self.words) + max(len(self.words) // 4 + 1, MOST_PUT_IN)


def prepared(templates: dict[str, str], least: float = COVERAGE) -> list[Template]:
    """Templates in words; those without a word are left out."""
    out = []
    for license_, marked in templates.items():
        parts = re.split(r"[{}]", marked)
        words: list[str] = []
        names: list[tuple[int, int]] = []
        for k, part in enumerate(parts):
            start = len(words)
            words += [w for w, _, _ in words_of(part)]
            if k % 2 and len(words) > start:
                names.append((start, len(words)))
        n = len(words)
        need = n if n < SHORT_WORDS else -(-int(least * 1_000_000) * n // 1_000_000)
        if n:
            out.append(Template(license_, tuple(words), Counter(words), tuple(names), max(1, need)))
    return out


def clusters(positions: list[int], width: int) -> list[tuple[int, int]]:
    """[start, end) word ranges that hold every stretch of `width` words that begins and ends at positions: those no more
    than `width` apart belong together."""
    out: list[tuple[int, int]] = []
    for p in positions:
        if out and p - out[-1][1] < width:
            out[-1] = (out[-1][0], p + 1)
        else:
            out.append((p, p + 1))
    return out


def named(pairs: list[tuple[int, int]], template: Template) -> bool:
    """Whether the words that name the license are all aligned, in one run, with no other word right beside them."""
    at = {j: i for i, j in pairs}
    for start, end in template.names:
        if any(j not in at for j in range(start, end)) or at[end - 1] - at[start] != end - 1 - start:
            return False
        for inner, outer in ((start, start - 1), (end - 1, end)):
            beside = at[inner] + outer - inner
            if pairs[0][0] <= beside <= pairs[-1][0] and at.get(outer) != beside:
                return False
    return True


def notice(words: list[str], a: int, b: int, template: Template) -> int:
    """Words aligned of the range [a, b), 0 if it is no notice."""
    pairs = align(words[a:b], list(template.words))
    whole = len(pairs) >= template.need and pairs[0][0] == 0 and pairs[-1][0] == b - a - 1
    return len(pairs) if whole and named(pairs, template) else 0


def bounds(words: list[str], template: Template) -> list[tuple[float, int, int]]:
    """(-bound, a, b) of the ranges that can be notices; the bound is the density of the longest common subsequence.

    A range is passed over only where it can be none: its first word must be among those that leave enough of the template
    behind them, its last word likewise, and the subsequence, kept as bits of a number, must reach the need.
    """
    n, need, longest = len(template.words), template.need, template.longest
    masks: dict[str, int] = {}
    for j, w in enumerate(template.words):
        masks[w] = masks.get(w, 0) | 1 << j
    first, last = set(template.words[: n - need + 1]), set(template.words[need - 1 :])
    full = (1 << n) - 1
    inside: Counter = Counter()  # of the stretch of `longest` words from a on
    common = ahead = 0
    out = []
    for a, w in enumerate(words):
        while ahead < min(a + longest, len(words)):
            v = words[ahead]
            inside[v] += 1
            common += inside[v] <= template.count.get(v, 0)
            ahead += 1
        if common >= need and w in first:
            state = full
            for b in range(a, min(a + longest, len(words))):
                v = words[b]
                mask = masks.get(v)
                if mask:
                    seen = state & mask
                    state = ((state + seen) | (state - seen)) & full
                    if v in last:
                        length = n - state.bit_count()
                        if length >= need:
                            out.append((-2 * length / (b + 1 - a + n), a, b + 1))
        common -= inside[w] <= template.count.get(w, 0)
        inside[w] -= 1
    return out


def notices(words: list[str], template: Template) -> list[tuple[int, int, int]]:
    """(first word, last word, aligned words) of the notices in words, apart from each other: the densest range first, by
    2 * aligned / (words + template words), of equal ones the first and shortest."""
    heap = [(*range_, 0) for range_ in bounds(words, template)]
    heapify(heap)
    taken: list[tuple[int, int, int]] = []
    while heap:
        _, a, b, aligned = heappop(heap)
        k = bisect_left(taken, (a,))
        if (k and taken[k - 1][1] >= a) or (k < len(taken) and taken[k][0] < b):
            continue
        if aligned:
            insort(taken, (a, b - 1, aligned))
        elif aligned := notice(words, a, b, template):
            heappush(heap, (-2 * aligned / (b - a + len(template.words)), a, b, aligned))
    return taken


def matches(text: str, templates: list[Template]) -> list[tuple[str, int, int, int, int, float]]:
    """License, character span, matched and template words and coverage of the notices in a text.

    Of overlapping notices of different templates the one of the highest coverage stays, then that of more words, then the first.
    """
    vocabulary = {w for t in templates for w in t.count}
    found: list[tuple[str, int, int, int, int, float]] = []
    spelled = words_of(text)
    hits: dict[str, list[int]] = {}
    for i, (w, _, _) in enumerate(spelled):
        if w in vocabulary:
            hits.setdefault(w, []).append(i)
    for t in templates if hits else ():
        if sum(min(n, len(hits.get(w, ()))) for w, n in t.count.items()) < t.need:
            continue
        for a, b in clusters(sorted(i for w in t.count for i in hits.get(w, ())), t.longest):
            if b - a >= t.need:
                for i, j, n in notices([w for w, _, _ in spelled[a:b]], t):
                    found.append((t.license, spelled[a + i][1], spelled[a + j][2], n, len(t.words), n / len(t.words)))
    stay: list[tuple[int, int, tuple]] = []
    for m in sorted(found, key=lambda x: (-x[5], -x[3], x[1], x[0])):
        k = bisect_left(stay, (m[1],))
        if not ((k and stay[k - 1][1] > m[1]) or (k < len(stay) and stay[k][0] < m[2])):
            insort(stay, (m[1], m[2], m))
    return [m for _, _, m in stay]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE) -> DataFrame:
    """One row per license notice found in the whole texts: doc_id, license, start_char, end_char (exclusive),
    matched_words, template_words, coverage.

    Null, empty and clean texts give no row; a text that repeats a notice gives a row for each; repeated documents
    repeat their rows; other columns are left out. Templates are a fixed dictionary of texts that every worker holds;
    braces in them mark names.
    """
    ready = prepared(templates if templates is not None else TEMPLATES, least)

    def run(batches):
        for batch in slices(batches):
            rows = [
                (i, *m)
                for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                for m in matches(t or "", ready)
            ]
            columns = list(zip(*rows)) if rows else [[]] * 7
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                ["doc_id", "license", "start_char", "end_char", "matched_words", "template_words", "coverage"],
            )

    return doc_texts(docs).mapInArrow(run, FOUND)
