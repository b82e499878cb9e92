"""Licence scans: the Dice coefficient of word bigrams against templates.

A text is normalised (lower case, words of letters and digits; versions keep their parts as words) and
compared as a whole, by paragraphs (blocks between blank lines), by lines, and by every run of words, also
across lines and paragraphs. The coefficient of two sets of sizes a and b is at most 2 min(a, b) / (a + b), so
only templates within [t/(2-t), (2-t)/t] of a unit's size can reach the threshold t, and only if the text holds
t/(2-t) of their bigrams; no other text or template is looked at further. The best run starts and ends at
bigrams of the template that occur in it once, which bounds the search by words times template size.

Null and empty texts have no licence. Among equal coefficients the template named first wins.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts of public licences and of the notices by which works refer to them.
TEMPLATES = {
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
           "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
           "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
           "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
           "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
           "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
           "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice-2": "Licensed under the MIT License.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
           "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "
           "\"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
           "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
           "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
           "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
           "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
           "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
           "with the distribution.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
           "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
           "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
           "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
           "governing permissions and limitations under the License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
           "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
           "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
           "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
           "more details.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
           "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense-notice": "This is free and unencumbered software released into the public domain.",
}
THRESHOLD = 0.8
WORD = re.compile(r"[^\W_]+")
FOUND = "array<struct<licence:string,dice:double,unit:string,start:int,end:int>>"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def bigrams(text: str | None) -> frozenset[tuple[str, str]]:
    w = words(text)
    return frozenset(zip(w, w[1:]))


class Templates:
    """Templates in order of size, and the templates of each bigram."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        made = [(len(g), i, name, g) for i, (name, text) in enumerate(templates.items()) if (g := bigrams(text))]
        self.order = sorted(made)
        self.sizes = [m[0] for m in self.order]
        self.place = {m[2]: place for place, m in enumerate(self.order)}
        self.of: dict[tuple[str, str], list[int]] = {}
        for place, m in enumerate(self.order):
            for g in m[3]:
                self.of.setdefault(g, []).append(place)
        self.least, self.most = self.range(self.sizes[0])[0] if made else 1, self.range(self.sizes[-1])[1] if made else 0

    def range(self, size: int) -> tuple[float, float]:
        """Sizes of sets that can reach the threshold with a set of ``size``."""
        t = self.threshold
        return size * t / (2 - t) - 1e-9, size * (2 - t) / t + 1e-9

    def best(self, unit: str) -> tuple[str, float] | None:
        """The most similar template, if similar enough."""
        w = words(unit)
        if len(w) - 1 < self.least:
            return None
        own = frozenset(zip(w, w[1:]))
        if len(own) > self.most:
            return None
        low, high = self.range(len(own))
        first, last = bisect_left(self.sizes, low), bisect_right(self.sizes, high)
        common = Counter(p for g in own for p in self.of.get(g, ()) if first <= p < last)
        ranked = [(2 * n / (len(own) + self.sizes[p]), -self.order[p][1], self.order[p][2]) for p, n in common.items()]
        if not ranked or (top := max(ranked))[0] < self.threshold - 1e-12:
            return None
        return top[2], top[0]

    def able(self, own: frozenset) -> list[int]:
        """Templates of which some part of a text with these bigrams may be similar enough."""
        common = Counter(p for g in self.of.keys() & own for p in self.of[g])
        return sorted(p for p, n in common.items() if n >= self.range(self.sizes[p])[0])

    def runs(self, grams: list[tuple[str, str]], p: int) -> list[tuple[float, int, int, int]]:
        """(dice, common bigrams, first, last bigram) of the runs of a text that are like a template, the
        best of those that overlap."""
        size, _, _, wanted = self.order[p]
        most, found = self.range(size)[1], []
        for a in (i for i, g in enumerate(grams) if g in wanted):
            own, common, best = set(), 0, (0.0, 0, a, a)
            for i in range(a, len(grams)):
                g = grams[i]
                if g in own:
                    if g == grams[a]:  # the same set without the first
                        break
                    continue
                own.add(g)
                if len(own) > most:
                    break
                if g in wanted:
                    common += 1
                    if (dice := 2 * common / (len(own) + size)) > best[0]:
                        best = (dice, common, a, i)
            if best[0] >= self.threshold - 1e-12:
                found.append(best)
        return apart(sorted(found, key=lambda x: (-x[0], x[2])), lambda x: (x[2], x[3] + 1))

    def units(self, text: str) -> list[dict]:
        """The whole text, else its paragraphs, else their lines."""
        if found := self.best(text):
            return [{"licence": found[0], "dice": found[1], "unit": "text", "start": 0, "end": len(text)}]
        out, paragraphs = [], [m.span() for m in re.finditer(r"[^\n]+(?:\n[^\n]+)*", text)]
        for start, end in paragraphs:
            if (start, end) != (0, len(text)) and (found := self.best(text[start:end])):
                out.append({"licence": found[0], "dice": found[1], "unit": "paragraph", "start": start, "end": end})
                continue
            for m in re.finditer(r"[^\n]+", text[start:end]):
                if m.span() != (0, end - start) and (found := self.best(m.group())):
                    out.append({"licence": found[0], "dice": found[1], "unit": "line", "start": start + m.start(), "end": start + m.end()})
        return out

    def scan(self, text: str | None) -> list[dict]:
        """Licensed units: the whole text, else paragraphs, lines and runs of words. Of those that overlap the
        one with most bigrams of its template stands, a unit before a run. Places are code points."""
        text = text or ""
        low, places = lowered(text)
        found = [(m.group(), m.start(), m.end()) for m in WORD.finditer(low)]
        grams = [(x[0], y[0]) for x, y in zip(found, found[1:])]
        if not (able := self.able(frozenset(grams))):
            return []
        units = self.units(text)
        if units and units[0]["unit"] == "text":
            return units
        made = []
        for u in units:
            p = self.place[u["licence"]]
            made.append((-len(bigrams(text[u["start"]:u["end"]]) & self.order[p][3]), 0, -u["dice"], self.order[p][1], u))
        for p in able:
            for dice, common, a, b in self.runs(grams, p):
                start, end = found[a][1], found[b + 1][2]
                run = {"licence": self.order[p][2], "dice": dice, "unit": "run", "start": places[start] if places else start,
                       "end": places[end - 1] + 1 if places else end}
                made.append((-common, 1, -dice, self.order[p][1], run))
        chosen = apart([x[-1] for x in sorted(made, key=lambda x: (*x[:4], x[4]["start"]))], lambda u: (u["start"], u["end"]))
        return sorted(chosen, key=lambda u: u["start"])


def apart(ranked: list, span) -> list:
    """What overlaps nothing before it in the list."""
    taken, out = [], []
    for x in ranked:
        start, end = span(x)
        k = bisect_left(taken, (start, end))
        if (k == 0 or taken[k - 1][1] <= start) and (k == len(taken) or taken[k][0] >= end):
            taken.insert(k, (start, end))
            out.append(x)
    return out


def lowered(text: str) -> tuple[str, list[int] | None]:
    """The text in lower case and, if its length changes, the place of each character in the text."""
    low = text.lower()
    if len(low) == len(text):
        return low, None
    return "".join(c.lower() for c in text), [i for i, c in enumerate(text) for _ in c.lower()]


def with_licences(docs: DataFrame, text: str = "text", name: str = "licences", templates: dict[str, str] = TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with an array of the licences found and their places."""
    kind = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("unit", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    known = Templates(templates, threshold)

    @F.arrow_udf(FOUND)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([known.scan(t.as_py()) for t in texts], kind)

    return docs.withColumn(name, scan(F.col(text)))


def best_licence(docs: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """(key, licence, dice, n_matches) per row; licence and dice are those of the most similar unit, the
    first among equals, or null."""
    found = with_licences(docs.select(key, "text"), **how)
    top = F.array_max(F.transform("licences", lambda x: F.struct(x["dice"].alias("dice"), (-x["start"]).alias("at"), x["licence"].alias("licence"))))
    return found.select(key, top["licence"].alias("licence"), top["dice"].alias("dice"), F.size("licences").cast("long").alias("n_matches"))
