"""License scans: patience alignment of texts with license templates.

A template's key words (those that are not common words) are looked up in every whole
text.  Each key hit votes for the place where the template would have to begin; from the
place with the most votes on, the words around it are aligned with the template: words
unique to both sides are anchors, the longest increasing subsequence of their places is
kept, and the gaps between them are aligned in the same way.  Gaps without a unique word
end in their common head and tail, and small ones in a longest common subsequence.

Coverage is the share of the template's words that found their place.  Every place with
``least`` coverage is a finding if the license's name and version are matched word by word and,
for short templates, the words put in between do not bring it below ``least``; of findings that overlap, the one with more matched words
stays.

Null and empty texts: nothing found.  Null ``doc_id``: kept.  Repeated rows are scanned
each.  Empty table: no rows.  Very long texts are scanned whole, place by place, in time that follows their words and findings.
Ties between findings: the earlier place, then the license's name.  Further columns of the table are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import doc_texts, map_arrow, table

LEAST = 0.75
#: Templates of at most this many words count inserted words against a finding.
SHORT = 16
_BSD_OPENING = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                "the following conditions are met:")
_BSD_TWO = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
            "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
            "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
            "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
            "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
            "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
            "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
            "OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
#: License statements, notices and whole texts by SPDX name, "BSD" if they do not say which; several texts of one name share it.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                   "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License "
                   "for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
            "this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "
            "\"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
            "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
            "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                "later version."),
    ("BSD", "Released under the BSD License."),
    ("BSD", _BSD_OPENING),
    ("BSD-2-Clause", f"{_BSD_OPENING} {_BSD_TWO} {_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD_OPENING} {_BSD_TWO} 3. Neither the name of the copyright holder nor the names of its contributors may be "
                     f"used to endorse or promote products derived from this software without specific prior written permission. {_BSD_END}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    # Siblings: the best aligned of them is the finding.
    *((f"{kind}-{v}", f"This work is licensed under the {_GNU[kind]}, version {v.removesuffix('.0')}.")
      for kind, v in (("GPL", "2.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0"))),
    *((f"{kind}-{v}", f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the {_GNU[kind]} as "
                      f"published by the Free Software Foundation, either version {v.removesuffix('.0')} of the License, or (at your "
                      "option) any later version.")
      for kind, v, thing in (("GPL", "2.0", "program"), ("LGPL", "2.1", "library"), ("LGPL", "3.0", "library"), ("AGPL", "3.0", "program"))),
    *((f"CC-{kind}-4.0", f"Licensed under CC {kind} 4.0.") for kind in _CC if kind != "BY-NC"),
    *((f"CC-{kind}-4.0", f"This work is licensed under a Creative Commons {_CC[kind]} 4.0 International License.")
      for kind in _CC if kind != "BY"),
    # Whole texts, openings and notices of others.
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" "
            "AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
            "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
            "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
            "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("ISC", "Released under the ISC License."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
                "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
                "Software is furnished to do so, all subject to the following:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
                "is available at https://www.eclipse.org/legal/epl-2.0/"),
    # Titles, which whole texts and their copies begin with.
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"), ("EPL-2.0", "Eclipse Public License - v 2.0"),
    # Short names and tags.
    ("MIT", "or the MIT License"),
    *((f"{kind}-{v}", f"Licensed under the GNU {kind} version {v.removesuffix('.0')}.")
      for kind, v in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0"))),
    *((f"BSD-{n}-Clause", f"Released under the BSD {n}-Clause License.") for n in (2, 3)),
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "BSL-1.0", "Unlicense", "EPL-2.0", "MPL-2.0", "CC0-1.0", "GPL-2.0",
        "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", *(f"CC-{kind}-4.0" for kind in _CC))),
)
#: Phrases, by name, that must be matched word by word in one piece, if the template has them: name and version; the name itself is one.
MUST: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("apache", "2"), "MIT": ("mit", "subject to the following conditions"), "MPL-2.0": ("mozilla public license", "2"),
    "BSD": ("bsd",), "BSD-3-Clause": ("endorse or promote",),
    "ISC": ("isc", "provided that the above copyright notice"), "BSL-1.0": ("boost software license", "any person or organization", "1"),
    "EPL-2.0": ("eclipse public license", "2"), "Unlicense": ("unencumbered",),
    **{f"{kind}-{v}": (_GNU[kind], f"GNU {kind}", v.removesuffix(".0"))
       for kind, v in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0"))},
    **{f"CC-{kind}-4.0": (f"CC {kind}", f"Creative Commons {_CC[kind]}", "4") for kind in _CC},
}
FOUND = ("doc_id long, found array<struct<license:string,start:long,end:long,coverage:double,matched:int,template_words:int>>")

# Same length in and out, so places in the plain bytes are places in the text's bytes.
_PLAIN = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else 32 if b < 128 else b for b in range(256))
_WORD = re.compile(rb"[^ ]+")
_COMMON = frozenset(b"a an and any are as at be by can for from if in is it not of on one or see that the this to under use was "
                    b"with without you all do so".split())


_VERSION = re.compile(rb"(?<![^ ])v(?=[0-9])")


def plain(text: str) -> bytes:
    """Lower-case words; ``v3`` is the word ``3``."""
    return _VERSION.sub(b" ", text.encode("utf-8", "surrogatepass").translate(_PLAIN))


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[bytes, ...]

    @property
    def keys(self) -> dict[bytes, list[int]]:
        """Places of each key word; a template of common words alone keys on all of them."""
        out: dict[bytes, list[int]] = {}
        for i, w in enumerate(self.words):
            out.setdefault(w, []).append(i)
        return {w: p for w, p in out.items() if w not in _COMMON} or out

    @property
    def must(self) -> list[tuple[int, list[int]]]:
        """Length and places of each phrase that a finding has to match."""
        out = []
        for phrase in (tuple(plain(p).split()) for p in (*MUST.get(self.name, ()), self.name)):
            n = len(phrase)
            if at := [i for i in range(len(self.words) - n + 1) if self.words[i:i + n] == phrase]:
                out.append((n, at))
        return out


def increasing(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience sorting with back pointers."""
    tops: list[int] = []
    piles: list[int] = []
    back = []
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(p)
            piles.append(i)
        else:
            tops[k], piles[k] = p, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def _subsequence(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two short lists."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list, b: list, small: int = 32) -> list[tuple[int, int]]:
    """Matched places of ``a`` and ``b``, increasing on both sides."""
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
        ca, cb = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if cb[w] == 1 and ca.get(w) == 1}
        shared = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if w in where]
        anchors = [shared[k] for k in increasing([j for _, j in shared])]
        if anchors:
            out += anchors
            ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
            todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends, ends[1:])]
        elif a1 - a0 <= small and b1 - b0 <= small:
            out += [(a0 + i, b0 + j) for i, j in _subsequence(a[a0:a1], b[b0:b1])]
    return sorted(out)


class Scanner:
    """Findings of all templates in one text."""

    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST):
        self.templates = [Template(n, tuple(plain(t).split())) for n, t in templates]
        self.least = least
        self.keys = [t.keys for t in self.templates]
        self.must = [t.must for t in self.templates]
        self.must_words = [{w for n, at in m for w in t.words[at[0]:at[0] + n] if w in k}
                           for t, k, m in zip(self.templates, self.keys, self.must)]
        self.by_word: dict[bytes, list[int]] = {}
        for i, k in enumerate(self.keys):
            for w in k:
                self.by_word.setdefault(w, []).append(i)
        self.known = frozenset(self.by_word)
        # A finding misses at most this many words, so it has the other key words.
        self.need = [max(1, len(k) - int((1 - least) * len(t.words) + 1e-9)) for t, k in zip(self.templates, self.keys)]

    def scan(self, text: str) -> list[tuple[str, int, int, float, int, int]]:
        """(license, start, end, coverage, matched words, template words); places in code points."""
        raw = plain(text)
        present = self.known.intersection(raw.split())
        counts = Counter(i for w in present for i in self.by_word[w])
        wanted = [i for i, n in counts.items() if n >= self.need[i] and self.must_words[i] <= present]
        if not wanted:
            return []
        spans = [m.span() for m in _WORD.finditer(raw)]
        words = [raw[a:b] for a, b in spans]
        at: dict[bytes, list[int]] = {}
        for p, w in enumerate(words):
            if w in present:
                at.setdefault(w, []).append(p)
        found = [x for i in wanted for x in self._places(self.templates[i], self.keys[i], self.must[i], words, at)]
        # Kept findings do not overlap: of those that begin before another one's end, the last reaches furthest.
        starts: list[int] = []
        out: list[tuple[str, int, int, int, float, int]] = []
        for x in sorted(found, key=lambda x: (-x[3], -x[4], x[1], x[0])):
            k = bisect_left(starts, x[2])
            if not k or out[k - 1][2] <= x[1]:
                starts.insert(k, x[1])
                out.insert(k, x)
        result, at_byte, at_char = [], 0, 0
        encoded = text.encode("utf-8", "surrogatepass")
        for name, first, after, matched, cover, total in out:
            a, b = spans[first][0], spans[after - 1][1]
            start = at_char + len(encoded[at_byte:a].decode("utf-8", "surrogatepass"))
            at_byte, at_char = b, start + len(encoded[a:b].decode("utf-8", "surrogatepass"))
            result.append((name, start, at_char, cover, matched, total))
        return result

    def _places(self, template: Template, keys: Mapping[bytes, list[int]], must: list[tuple[int, list[int]]], words: list[bytes],
                at: dict[bytes, list[int]]):
        total = len(template.words)
        slack = max(3, total // 4)
        votes = Counter(p - i for w, places in keys.items() for p in at.get(w, ()) for i in places)
        used: set[int] = set()
        for begin, _ in sorted(votes.items(), key=lambda x: (-x[1], x[0])):
            if begin in used:
                continue
            lo, hi = max(0, begin - slack), min(len(words), begin + total + slack)
            pairs = align(words[lo:hi], list(template.words))
            if pairs and len(pairs) / total >= self.least:
                pairs = self._tight(pairs)
                if len(pairs) / (total + self._inserted(pairs, words, lo, total)) >= self.least and self._named(pairs, must):
                    used.update(range(begin - total // 2, begin + total // 2 + 1))
                    yield (template.name, lo + pairs[0][0], lo + pairs[-1][0] + 1, len(pairs), len(pairs) / total, total)

    @staticmethod
    def _inserted(pairs: list[tuple[int, int]], words: list[bytes], lo: int, total: int) -> int:
        """Words of the text inside a short template's finding that are neither matched nor common."""
        if total > SHORT:
            return 0
        matched = {i for i, _ in pairs}
        return sum(i not in matched and words[lo + i] not in _COMMON for i in range(pairs[0][0], pairs[-1][0]))

    @staticmethod
    def _named(pairs: list[tuple[int, int]], must: list[tuple[int, list[int]]]) -> bool:
        """Whether every phrase is matched in one piece at one of its places."""
        place = {j: i for i, j in pairs}
        return all(any(k in place and all(place.get(k + d) == place[k] + d for d in range(n)) for k in at) for n, at in must)

    @staticmethod
    def _tight(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Without single words at either end that a wide gap cuts off from the rest."""
        while len(pairs) > 1 and pairs[1][0] - pairs[0][0] > 3 + 2 * (pairs[1][1] - pairs[0][1]):
            pairs = pairs[1:]
        while len(pairs) > 1 and pairs[-1][0] - pairs[-2][0] > 3 + 2 * (pairs[-1][1] - pairs[-2][1]):
            pairs = pairs[:-1]
        return pairs


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """``doc_id`` and ``found``, all findings in order of their places; one row per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("coverage", pa.float64()), ("matched", pa.int32()), ("template_words", pa.int32())]))
        names = [f.name for f in kind.value_type]
        for b in batches:
            rows = [[dict(zip(names, x)) for x in scanner.scan(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], ["doc_id", "found"])

    return map_arrow(doc_texts(docs), run, FOUND)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of findings, the licenses (sorted, distinct), best coverage, and all places."""
    return scan_licenses(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "cast(size(found) as bigint) as n_found",
        "array_join(array_sort(array_distinct(found.license)), ',') as licenses",
        "coalesce(array_max(found.coverage), 0.0D) as coverage",
        "array_join(transform(found, f -> concat(f.license, ':', f.start, ':', f.end)), ',') as spans")
