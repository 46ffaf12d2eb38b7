"""License scans: patience alignment of texts with license templates."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from starwise.llm.text import map_slices, row_schema, texts, words

_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: "
    "This product includes software developed by the organization. 4. "
)
_ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)


def _gnu(what: str, license: str, version: str) -> str:
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {license} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    )


# Notices, headers and short licenses to look for. ``full_texts`` has the long licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "GPL-3.0": "This program is free software under the GNU General Public License, version 3.",
    "GPL-3.0-short": "the GNU General Public License, version 3.",
    "GPL-2.0-short": "the GNU General Public License, version 2.",
    "GPL-2.0-header": _gnu("program", "General Public License", "2"),
    "GPL-3.0-header": _gnu("program", "General Public License", "3"),
    "AGPL-3.0-header": _gnu("program", "Affero General Public License", "3"),
    "LGPL-2.0-header": _gnu("library", "Library General Public License", "2"),
    "LGPL-2.1-header": _gnu("library", "Lesser General Public License", "2.1"),
    "LGPL-3.0-header": _gnu("library", "Lesser General Public License", "3"),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MIT-opening": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "MIT-short": "Released under the MIT License.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "BSD-2": _BSD + _WARRANTY,
    "BSD-3": _BSD + "3. " + _ENDORSE + _WARRANTY,
    "BSD-4": _BSD + _ADVERTISING + _ENDORSE + _WARRANTY,
    "BSD-opening": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "All rights reserved": "All rights reserved.",
}
# Word runs that a hit must hold, as they tell versions and relatives apart.
REQUIRED = {
    "Apache-2.0": ["version 2 0"], "Apache-2.0-header": ["version 2 0"], "Apache-2.0-text": ["version 2 0"],
    "GPL-3.0": ["version 3"], "GPL-3.0-short": ["version 3"], "GPL-2.0-short": ["version 2"],
    "GPL-2.0-header": ["gnu general", "version 2 of"], "GPL-3.0-header": ["gnu general", "version 3"],
    "AGPL-3.0-header": ["affero", "version 3"], "LGPL-2.0-header": ["library general", "version 2 of"],
    "LGPL-2.1-header": ["lesser", "version 2 1"], "LGPL-3.0-header": ["lesser", "version 3"],
    "MPL-2.0-header": ["mozilla public license", "2 0"], "MPL-1.1-text": ["1 1"], "MPL-2.0-text": ["2 0"],
    "CC-BY-NC-4.0": ["nc 4 0"], "CC-BY-4.0": ["by 4 0"], "BSD-3": ["endorse"], "BSD-4": ["advertising", "endorse"],
    "GPL-1.0-text": ["version 1"], "GPL-2.0-text": ["version 2"], "GPL-3.0-text": ["version 3"],
    "LGPL-2.0-text": ["library general", "version 2"], "LGPL-2.1-text": ["lesser", "version 2 1"], "LGPL-3.0-text": ["lesser", "version 3"],
    "GFDL-1.2-text": ["version 1 2"], "GFDL-1.3-text": ["version 1 3"],
}


def full_texts() -> dict[str, str]:
    """The long licenses, read by the driver from the files beside this module."""
    files = sorted((Path(__file__).resolve().parent / "licenses").glob("*.txt"))
    return {f"{file.stem}-text": file.read_text("utf-8") for file in files}


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Matched positions (in ``a``, in ``b``) by patience alignment.

    Words that occur once in either are anchors; of these the longest run ascending in both is
    kept, and the gaps between are aligned alike. A gap without anchors matches its common ends.
    """
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
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {word: n for n, word in enumerate(b[b0:b1], b0) if in_b[word] == 1}
        anchors = [(n, at_b[word]) for n, word in enumerate(a[a0:a1], a0) if in_a[word] == 1 and word in at_b]
        chain = rising(anchors)
        if not chain:
            continue
        last_a, last_b = a0, b0
        for x, y in chain:
            out.append((x, y))
            todo.append((last_a, x, last_b, y))
            last_a, last_b = x + 1, y + 1
        todo.append((last_a, a1, last_b, b1))
    return sorted(out)


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence whose second values ascend, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, value) in enumerate(pairs):
        pile = bisect_left(tops, value)
        before[n] = piles[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(value)
            piles.append(n)
        else:
            tops[pile], piles[pile] = value, n
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(pairs[at])
        at = before[at]
    return out[::-1]


def holds(found: list[bytes], run: list[bytes]) -> bool:
    """Whether the words of ``run`` follow each other in ``found``."""
    return any(found[n : n + len(run)] == run for n in range(len(found) - len(run) + 1))


@dataclass(frozen=True)
class Hit:
    template: str
    coverage: float
    start: int
    end: int


class Scanner:
    """Finds templates in a text: windows that hold enough of a template's words are aligned with it.

    An alignment matches a word at most as often as both sides have it. So a text or window whose
    words, counted that way, stay below the coverage has no hit, and only such are passed over.
    """

    def __init__(self, templates: dict[str, str], coverage: float, required: dict[str, list[str]] = REQUIRED):
        self.coverage = coverage
        self.required = {name: [run.encode().split() for run in required.get(name, [])] for name in templates}
        self.templates = {name: words(text.encode()) for name, text in templates.items()}
        self.templates = {name: found for name, found in self.templates.items() if found}
        self.own = {name: Counter(found) for name, found in self.templates.items()}
        self.known = frozenset(word for found in self.templates.values() for word in found)

    def _enough(self, name: str, counts: Counter) -> bool:
        """Whether words with these counts can cover as much of the template as is asked for."""
        own = self.own[name]
        most = sum(min(n, own[word]) for word, n in counts.items() if word in own)
        return most / len(self.templates[name]) >= self.coverage

    def find(self, text: bytes | None) -> list[Hit]:
        found = words(text)
        if not text or self.known.isdisjoint(found):
            return []
        counts = Counter(word for word in found if word in self.known)
        hits = []
        for name, template in self.templates.items():
            if len(found) / len(template) >= self.coverage and self._enough(name, counts):
                hits += self._within(name, template, found)
        return self._best(hits)

    def _within(self, name: str, template: list[bytes], found: list[bytes]) -> list[Hit]:
        """Hits in windows of twice the template, half a template apart, so that repeats are told apart.

        A window starts at a word of the template; an occurrence that spreads over no more than one
        and a half times the template lies whole in one of them, whatever is inserted in it.
        """
        size, out, own = len(template), [], self.own[name]
        there = [n for n, word in enumerate(found) if word in own]
        k = 0
        while k < len(there):
            start = there[k]
            stop = bisect_left(there, start + 2 * size)
            after = start + max(1, size // 2)
            if self._enough(name, Counter(found[n] for n in there[k:stop])):
                pairs = align(found[start : start + 2 * size], template)
                share = len(pairs) / size
                first, last = (start + pairs[0][0], start + pairs[-1][0] + 1) if pairs else (start, start)
                if share >= self.coverage and all(holds(found[first:last], run) for run in self.required[name]):
                    out.append(Hit(name, share, first, last))
                    after = last
            k = bisect_left(there, after)
        return out

    def _best(self, hits: list[Hit]) -> list[Hit]:
        """Of overlapping hits the one that covers most words, then the better covered one."""
        sizes = {name: len(found) for name, found in self.templates.items()}
        kept: list[Hit] = []
        for hit in sorted(hits, key=lambda h: (-h.coverage * sizes[h.template], -h.coverage, h.start, h.template)):
            if all(hit.end <= other.start or other.end <= hit.start for other in kept):
                kept.append(hit)
        return sorted(kept, key=lambda h: h.start)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8, key: str = "doc_id") -> DataFrame:
    """``key`` and ``hits`` (template, coverage, start, end in words) for every row.

    A null or empty text has no hits; null keys and repeated rows come back as they are; no other
    column is read. Of overlapping hits the one with most matched words stays. ``coverage`` is the
    matched share of the whole template; a hit of the given licenses holds the words in ``REQUIRED``.
    """
    scanner = Scanner(TEMPLATES | full_texts(), coverage) if templates is None else Scanner(templates, coverage, {})
    scanner = docs.sparkSession.sparkContext.broadcast(scanner)
    item = pa.struct([("template", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = [[vars(hit) for hit in scanner.value.find(text)] for text in texts(batch)]
        return pa.RecordBatch.from_arrays([batch.column(key), pa.array(hits, pa.list_(item))], [key, "hits"])

    kind = "array<struct<template:string,coverage:double,start:bigint,end:bigint>>"
    return map_slices(docs.select(key, "text"), work, row_schema(docs, key, f"hits {kind}"))
