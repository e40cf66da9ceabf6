"""License notices in texts, by Dice coefficient over word bigrams.

A unit is any run of words, wherever its lines begin and end; a run of whole lines is the special case that `Scanner.scan`
looks at alone. A unit and a template are normalised to lower-case words of letters, digits and inner dots; their likeness
is the Dice coefficient of their sets of word bigrams. Units at or above `LEAST` match.

Size bounds prune: with a template of b bigrams a unit needs from b * LEAST / (2 - LEAST) to b * (2 - LEAST) / LEAST of
them, and since dropping a bigram at an end that the template lacks never lowers the likeness, a unit starts and ends with
a bigram of the template. Of overlapping matches the best stays (by likeness, then the longer, then the earlier, then the
template's name); the opening that the BSD licences share (`EITHER_BSD`) yields to any match of a single licence. The work
grows with the length of a text, also of one that repeats a notice many thousand times.

Edge cases: null and empty texts match nothing; a unit or template of one word has that word as its only bigram; matches
are given by the lines they touch, so two on one line have the same lines; repeated rows match alike; an empty table gives an empty table.
Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from hydrolens.llm.common import map_rows

LEAST = 0.8

# The opening that the BSD licences share: it counts only where no match of a single licence overlaps it.
EITHER_BSD = "BSD-2-Clause OR BSD-3-Clause"
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_KEEP = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.",
)
_BSD_ADVERT = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by"
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
    "without specific prior written permission."
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
    "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_END = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
    "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
    "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_USE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
# Siblings of the GNU licences: name, what the header calls the work, the licence and the version.
_GNU = (
    ("GPL-1.0", "program", "General", "1"), ("GPL-2.0", "program", "General", "2"), ("LGPL-2.0", "library", "Library General", "2"),
    ("LGPL-2.1", "library", "Lesser General", "2.1"), ("LGPL-2.1", "program", "Lesser General", "2.1"), ("LGPL-3.0", "program", "Lesser General", "3"),
    ("AGPL-3.0", "program", "Affero General", "3"),
)
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}

# Wordings of public licence notices, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (EITHER_BSD, _BSD),
    ("BSD-2-Clause", " ".join((_BSD, *_BSD_KEEP, _BSD_END))),
    ("BSD-3-Clause", " ".join((_BSD, *_BSD_KEEP, _BSD_NAMES, _BSD_END))),
    ("BSD-3-Clause", _BSD_NAMES),
    ("BSD-4-Clause", " ".join((_BSD, *_BSD_KEEP, _BSD_ADVERT, _BSD_NAMES, _BSD_END))),
    ("BSD-4-Clause", _BSD_ADVERT + " " + _BSD_NAMES),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "LGPL-3.0",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
        "by the Free Software Foundation; either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
        "You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *(
        (name, f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the "
         f"Free Software Foundation, either version {version} of the License, or (at your option) any later version.")
        for name, work, kind, version in _GNU
    ),
    *(
        (name, f"This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version {version} "
         "as published by the Free Software Foundation.")
        for name, version in (("GPL-2.0", "2"), ("GPL-3.0", "3"))
    ),
    *((name, f"This work is licensed under the GNU {kind} Public License, version {version}.") for name, kind, version in sorted({(n, k, v) for n, _, k, v in _GNU} - {("GPL-2.0", "General", "2")})),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Apache-1.0", "Licensed under the Apache License, Version 1.0."),
    *(
        (f"CC-{kind}-{version}", text)
        for kind, words in _CC.items()
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0")
        for text in (
            f"Licensed under CC {kind} {version}.",
            f"This work is licensed under a Creative Commons {words} {version} {'International' if version == '4.0' else 'Unported' if version == '3.0' else ''} License.",
        )
        if (kind, version) not in {("BY", "4.0"), ("BY-SA", "4.0"), ("BY-NC", "4.0")}
    ),
)
_BODIES = tuple(text for name, text in TEMPLATES if text.startswith("Permission"))
TEMPLATES += (
    ("MIT", f"{_BODIES[0]} {_MIT_END}"),
    ("ISC", f"{_BODIES[1]} {_ISC_END}"),
    ("0BSD", f"{_USE}. {_ISC_END}"),
)

_WORD = re.compile(r"[a-z0-9]+(?:\.[a-z0-9]+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def bigrams(words: list[str]) -> set[tuple[str, ...]]:
    return set(zip(words, words[1:])) if len(words) > 1 else {tuple(words)} if words else set()


def dice(a: set, b: set) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


@dataclass(frozen=True)
class Template:
    name: str
    bigrams: frozenset
    least: float
    most: float


def templates(listed: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> list[Template]:
    made = []
    for name, text in listed:
        own = frozenset(bigrams(words_of(text)))
        if own:
            made.append(Template(name, own, len(own) * least / (2 - least) - 1e-9, len(own) * (2 - least) / least + 1e-9))
    return made


class Scanner:
    """Finds the templates in texts."""

    def __init__(self, listed: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST):
        self.templates, self.least = templates(listed, least), least
        self.by_bigram: dict[tuple[str, ...], list[int]] = {}
        for number, template in enumerate(self.templates):
            for pair in template.bigrams:
                self.by_bigram.setdefault(pair, []).append(number)
        self.has_single = any(len(pair) == 1 for pair in self.by_bigram)
        used = {re.escape(word) for pair in self.by_bigram for word in pair}
        self.hint = re.compile(r"(?<![a-z0-9])(?:" + "|".join(sorted(used, key=len, reverse=True)) + r")(?![a-z0-9])")

    def scan(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """Matches of runs of whole lines as (name, first line, line after the last, likeness), in order of place."""
        lines = (text or "").split("\n")
        words: dict[int, list[str]] = {}
        touched: dict[int, set[int]] = {}
        before = None  # the line with words before this one, if it has a word of some template
        for i, line in enumerate(lines):
            low = line.lower()
            if not self.hint.search(low):
                before = before if not _WORD.search(low) else None
                continue
            words[i] = words_of(low)
            self._touch(bigrams(words[i]), (i,), touched)
            if before is not None:
                self._touch({(words[before][-1], words[i][0])}, (before, i), touched)
            before = i
        found = []
        for number, places in touched.items():
            found += self._runs(self.templates[number], sorted(places), lines, words)
        found.sort(key=lambda m: (-m[3], m[1] - m[2], m[1], m[0]))
        kept: list[tuple[str, int, int, float]] = []
        taken: set[int] = set()
        for match in found:
            if taken.isdisjoint(range(match[1], match[2])):
                kept.append(match)
                taken.update(range(match[1], match[2]))
        return sorted(kept, key=lambda m: m[1])

    def find(self, text: str | None) -> list[tuple[str, int, int, float]]:
        """Matches of runs of words as (name, first line, line after the last, likeness), in order of place."""
        low = (text or "").lower()
        words = words_of(low)
        keys = list(zip(words, words[1:]))
        seen: dict[int, int] = {}
        for pair in set(keys) | ({(w,) for w in set(words)} if self.has_single else set()):
            for number in self.by_bigram.get(pair, ()):
                seen[number] = seen.get(number, 0) + 1
        heap: list[tuple] = []
        before, after = _neighbours(keys) if any(n >= self.templates[t].least for t, n in seen.items()) else ([], [])
        firsts: dict[tuple[int, int], array] = {}  # by template and start
        last_own: dict[int, array] = {}
        for number, distinct in seen.items():
            template = self.templates[number]
            if distinct < template.least:
                continue
            if any(len(pair) == 1 for pair in template.bigrams):
                heap += [(-1.0, -1, i, template.name, number, i + 1) for i, w in enumerate(words) if (w,) in template.bigrams]
                continue
            last_own[number] = _last_of(template.bigrams, keys)
            for start, places in _first_places(self._starts(template, keys), int(template.most) + 1, before, after):
                best = self._best(number, keys, start, len(words), places, last_own[number])
                if best:
                    firsts[number, start] = places
                    heap += best
        if not heap:
            return []
        kept: list[tuple[int, int, str, float]] = []
        taken: list[int] = []  # first words of the units kept, in order
        ends: dict[int, int] = {}
        late = {number for number, template in enumerate(self.templates) if template.name == EITHER_BSD}
        after = [entry for entry in heap if entry[4] in late]
        heap = [entry for entry in heap if entry[4] not in late]
        heapify(heap)
        while heap or after:
            if not heap:
                heap, after = after, []
                heapify(heap)
            minus, _, start, name, number, stop = heappop(heap)
            at = bisect_right(taken, start)
            if at and ends[taken[at - 1]] > start:
                continue
            free = taken[at] if at < len(taken) else len(words)
            if stop > free:  # a better unit took its end: the best one that is left from here
                if (number, start) in firsts:  # a unit of one word has nothing shorter
                    for other in self._best(number, keys, start, free, firsts[number, start], last_own[number]):
                        heappush(heap, other)
                continue
            insort(taken, start)
            ends[start] = stop
            kept.append((start, stop, name, -minus))
        line_of = [i for i, line in enumerate(low.split("\n")) for _ in words_of(line)]
        return [(name, line_of[start], line_of[stop - 1] + 1, likeness) for start, stop, name, likeness in sorted(kept)]

    def _starts(self, template: Template, keys: list[tuple]) -> list[int]:
        """Places of the template's bigrams from which a unit within the size bounds can hold enough of them."""
        own, most, least = template.bigrams, template.most, template.least
        held: dict[tuple, int] = {}
        hits = reach = 0
        starts = []
        for start, pair in enumerate(keys):
            while reach < len(keys) and (len(held) < int(most) or keys[reach] in held):
                held[keys[reach]] = (n := held.get(keys[reach], 0)) + 1
                hits += not n and keys[reach] in own
                reach += 1
            if pair in own and hits >= least:
                starts.append(start)
            if held[pair] == 1:
                del held[pair]
                hits -= pair in own
            else:
                held[pair] -= 1
        return starts

    def _best(self, number: int, keys: list[tuple], start: int, free: int, firsts: array, last_own: array) -> list[tuple]:
        """The best unit from the word `start` to before the word `free`, if it matches, as an entry of the heap.

        The likeness changes only where a bigram is met for the first time; between two such places the longest unit is
        the one up to the last of the template's own bigrams, wherever it has occurred before.
        """
        template = self.templates[number]
        own, hits, best = template.bigrams, 0, None
        for met, place in enumerate(firsts, 1):
            if place >= free - 1 or met > template.most:
                break
            hits += keys[place] in own
            end = last_own[min(firsts[met] if met < len(firsts) else len(keys), free - 1) - 1]
            if end >= place:
                likeness = 2 * hits / (met + len(own))
                if likeness >= self.least and (best is None or likeness >= best[0]):
                    best = likeness, end + 2
        return [(-best[0], start - best[1], start, template.name, number, best[1])] if best else []

    def _touch(self, pairs: set, at: tuple[int, ...], touched: dict[int, set[int]]) -> None:
        """Notes the lines `at` for the templates that have one of the bigrams."""
        for pair in pairs:
            for number in self.by_bigram.get(pair, ()):
                touched.setdefault(number, set()).update(at)

    def _runs(self, template: Template, places: list[int], lines: list[str], words: dict[int, list[str]]) -> Iterator[tuple[str, int, int, float]]:
        ends = set(places)
        for start in places:
            run: list[str] = []
            unit: set = set()
            for i in range(start, len(lines)):
                own = words.get(i) if i in words else words_of(lines[i])
                joined = run[-1:] + own
                unit |= set(zip(joined, joined[1:]))
                run += own
                if len(unit) > template.most or i > places[-1]:
                    break
                whole = unit or bigrams(run)
                if i in ends and len(whole) >= template.least:
                    likeness = dice(whole, template.bigrams)
                    if likeness >= self.least:
                        yield template.name, start, i + 1, likeness


def _neighbours(keys: list[tuple]) -> tuple[array, array]:
    """For each place the one before and the one after with the same bigram (-1, and the end, if there is none)."""
    before, after, last = array("l", bytes(8 * len(keys))), array("l", [len(keys)]) * len(keys), {}
    for i, pair in enumerate(keys):
        before[i] = at = last.get(pair, -1)
        if at >= 0:
            after[at] = i
        last[pair] = i
    return before, after


def _last_of(own: frozenset, keys: list[tuple]) -> array:
    """For each place the last one up to it that holds one of the bigrams `own`, -1 if none does."""
    out, last = array("l"), -1
    for i, pair in enumerate(keys):
        last = i if pair in own else last
        out.append(last)
    return out


def _first_places(starts: list[int], most: int, before: array, after: array) -> Iterator[tuple[int, array]]:
    """For each of the rising `starts` the first `most` places at which a bigram occurs for the first time from there on.

    The list slides along: past a place, the next occurrence of its bigram becomes a first one.
    """
    at = reach = 0
    places: list[int] = []
    for start in starts:
        if start >= reach:
            at = reach = start
            places = []
        while at < start:
            places.pop(0)  # `at` itself, always a first place
            if after[at] < reach:
                insort(places, after[at])
            at += 1
        while len(places) < most and reach < len(before):
            if before[reach] < at:
                places.append(reach)
            reach += 1
        yield start, array("l", places)


def license_matches(docs: DataFrame, listed: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Per document the number of matches, the best one's `license` and `dice`, and all as name:first line:line after:likeness."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        scanner = Scanner(listed, least)
        for row in rows:
            found = scanner.find(row["text"])
            best = min(found, key=lambda m: (m[0] == EITHER_BSD, -m[3], m[1], m[0]), default=None)
            yield {
                "doc_id": row["doc_id"],
                "n_matches": len(found),
                "license": best[0] if best else None,
                "dice": best[3] if best else 0.0,
                "matches": ",".join(f"{name}:{first}:{after}:{likeness:.4f}" for name, first, after, likeness in found),
            }

    return map_rows(docs.select("doc_id", "text"), run, "doc_id bigint, n_matches int, license string, dice double, matches string")
