"""Licence scan: normalised text against licence templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from tramline.llm.shared import keyed, slices

_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
_BREAK = re.compile(r"\r\n?|[\n\x0b\x0c]")

_DISCLAIMER = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."

#: Short notices, and the whole texts of short licences. whole_texts() reads long ones.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MIT notice": "Released under the MIT License.",
    "MIT notice (licensed)": "Licensed under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission." + _DISCLAIMER,
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution." + _DISCLAIMER,
    "BSD notice": "Licensed under the BSD License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-or-later header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}


def whole_texts(folder: str = "/usr/share/common-licenses") -> dict[str, str]:
    """Further templates: the texts in a folder of the driver, by file name; links and other folders are left out."""
    return {f.name: f.read_text(errors="replace") for f in sorted(Path(folder).iterdir()) if f.is_file() and not f.is_symlink()}


SCANNED = "doc_id long, n_words long, licence string, dice double, n_matches long, matches array<struct<licence:string,dice:double,start:int,end:int>>"


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    """Neighbouring words; a single word pairs with nothing."""
    return set(zip(words, words[1:], strict=False)) or {(w, "") for w in words}


class Scanner:
    """Templates sorted by size: at a Dice coefficient of t, 2 * min / (a + b) bounds the size of a match."""

    def __init__(self, templates: dict[str, str], least: float):
        sets = sorted(((len(g := bigrams(_WORD.findall(t.lower()))), name, g) for name, t in templates.items()), key=lambda x: x[:2])
        self.least, self.sets, self.sizes = least, sets, [s[0] for s in sets]
        self.known = frozenset().union(*(s[2] for s in sets)) if sets else frozenset()
        self.of: dict[tuple, list[int]] = {}
        for k, (_, _, grams) in enumerate(sets):
            for g in grams:
                self.of.setdefault(g, []).append(k)

    def best(self, grams: set) -> tuple[float, str] | None:
        n, found = len(grams), None
        if not n:
            return None
        lo, hi = bisect_left(self.sizes, n * self.least / (2 - self.least) - 1e-9), bisect_right(self.sizes, n * (2 - self.least) / self.least + 1e-9)
        for size, name, template in self.sets[lo:hi]:
            dice = 2 * len(grams & template) / (n + size)
            if dice >= self.least and (not found or (-dice, name) < (-found[0], found[1])):
                found = (dice, name)
        return found

    def windows(self, grams: list[tuple[str, str]]) -> Iterator[tuple[float, int, int, str]]:
        """The best window, of neighbouring bigrams from one that a template has to another, for each template: Dice, first, last, name.

        A window that reaches `least` shares at least size * least / (2 - least) bigrams with the template and is not longer than
        its size bound. Only where so many lie together are windows compared, and after a hit the search goes on behind it.
        """
        places: dict[int, list[int]] = {}
        for i, g in enumerate(grams):
            for k in self.of.get(g, ()):
                places.setdefault(k, []).append(i)
        for k, at in places.items():
            size, name, template = self.sets[k]
            need, longest = size * self.least / (2 - self.least) - 1e-9, int(size * (2 - self.least) / self.least + 1e-9)
            i, j, until = 0, 0, -1
            while i < len(at):
                j = max(i, j)
                while j < len(at) and at[j] - at[i] < longest + size:  # repeated bigrams count once, so a window may be longer
                    j += 1
                if at[i] <= until or j - i < need:
                    i += 1
                    continue
                seen, shared, best, place = set(), 0, (0.0, 0), at[i]
                for end in at[i:j]:
                    for g in grams[place : end + 1]:
                        if g not in seen:
                            seen.add(g)
                            shared += g in template
                    place = end + 1
                    if len(seen) > longest:
                        break
                    best = max(best, (2 * shared / (len(seen) + size), -end))
                if best[0] >= self.least:
                    # A later start may do better: drop bigrams in front as long as that helps.
                    first, last = at[i], -best[1]
                    for start in at[i + 1 : j]:
                        if start > last or len(own := set(grams[start : last + 1])) < need:
                            break
                        dice = 2 * len(own & template) / (len(own) + size)
                        if dice > best[0]:
                            best, first = (dice, best[1]), start
                        elif dice < self.least:
                            break
                    yield best[0], first, last, name
                    until = last
                i += 1

    def scan(self, text: str) -> tuple[int, list[tuple[str, float, int, int]]]:
        """Words of the text, and its matches by place: licence, Dice, and the range in code points.

        Units are each line, each run of lines that share a bigram with a template, the whole text, and within runs the windows
        of words of about a template's size; of overlapping matches the one with the greater Dice stays, then the longer, then
        the first.
        """
        lines, at, total = [], 0, 0
        for m in [*_BREAK.finditer(text), None]:
            end = m.start() if m else len(text)
            words = _WORD.findall(text[at:end].lower())
            total += len(words)
            lines.append((at, end, words, not self.known.isdisjoint(zip(words, words[1:], strict=False)) or len(words) == 1 and (words[0], "") in self.known))
            at = m.end() if m else at
        units, runs, run = [], [], []
        for line in [*lines, None]:
            if line and line[3]:
                run.append(line)
                units.append([line])
            elif line and not line[2] and run:
                continue  # a blank line inside a notice
            elif run:
                if len(run) > 1:
                    units.append(run)
                runs.append(run)
                run = []
        if units and len(lines) > 1:
            units.append(lines)
        found = []
        for unit in units:
            if hit := self.best(bigrams([w for line in unit for w in line[2]])):
                found.append((-hit[0], unit[0][0] - unit[-1][1], unit[0][0], unit[-1][1], hit[1]))
        for run in runs:
            words = [w for line in run for w in line[2]]
            if len(words) > 1:
                places = None
                for dice, first, last, name in self.windows(list(zip(words, words[1:], strict=False))):
                    if places is None:  # lower() may change how long a word is, so places are those of the words as they stand
                        places = [(line[0] + m.start(), line[0] + m.end()) for line in run for m in _WORD.finditer(text[line[0] : line[1]])]
                    if len(places) == len(words):
                        found.append((-dice, places[first][0] - places[last + 1][1], places[first][0], places[last + 1][1], name))
        starts, ends, kept = [], [], []
        for f in sorted(found):
            i = bisect_left(starts, f[2])
            if (i == len(starts) or f[3] <= starts[i]) and (not i or ends[i - 1] <= f[2]):
                starts.insert(i, f[2])
                ends.insert(i, f[3])
                kept.append(f)
        return total, [(k[4], -k[0], k[2], k[3]) for k in sorted(kept, key=lambda k: k[2])]


def scan_licences(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.9) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, licence and dice of its best match, n_matches, matches.

    Words are runs of letters and digits in lower case; punctuation and case don't count. Null and empty texts have no
    match: licence and dice are null. Ties go to the name that sorts first, and to the first place. Repeated rows
    are scanned alike. Other columns are ignored. Templates are a stated table, sent with the task. No shuffle.
    """
    scanner = Scanner(templates, least)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in slices(batches):
            found = [scanner.scan(t) for t in b.column("text").to_pylist()]
            best = [min(m, key=lambda x: (-x[1], x[0], x[2]), default=(None, None)) for _, m in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([x[0] for x in best], pa.string()), pa.array([x[1] for x in best], pa.float64()), pa.array([len(m) for _, m in found], pa.int64()), pa.array([[dict(zip(("licence", "dice", "start", "end"), x, strict=True)) for x in m] for _, m in found], kind)],
                ["doc_id", "n_words", "licence", "dice", "n_matches", "matches"],
            )

    return keyed(docs).select("doc_id", "text").mapInArrow(scan, SCANNED)
