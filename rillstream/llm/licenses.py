"""Licence scans: normalised text against licence templates by Dice's coefficient over word bigrams.

Every line, every paragraph (lines between blank ones) and the whole text is compared. Two sets of bigrams can reach a
coefficient t only if the smaller has at least t / (2 - t) times the size of the larger, and only if they share as
large a part of the template; templates outside these bounds are not compared. The second bound needs no bigrams: a template is
out for a text, or for a passage, that lacks the words of too many of the template's bigrams.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_slice

#: Notices and headers that licences ask for, as (licence, text).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
     " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by"
     " applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS,"
     " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language"
     " governing permissions and limitations under the License."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
     " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
     " version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
     " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the"
     " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
     " persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and"
     " this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
     " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)
THRESHOLD = 0.8
WORD = re.compile(r"[a-z0-9]+")
LOWER = {code: code + 32 for code in range(65, 91)}


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    """Pairs of consecutive words, runs of a-z and 0-9 after lower-casing A-Z; of a single word that word alone."""
    words = WORD.findall(text.translate(LOWER))
    return frozenset(zip(words, words[1:] if len(words) > 1 else [""]))


def passages(text: str | None) -> Iterator[tuple[int, int]]:
    """Begin and end of the lines, the paragraphs of several lines, and the whole text if it has several paragraphs."""
    text = text or ""
    at = 0
    begin = end = lines = paragraphs = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            yield at, at + len(line)
            begin = begin if lines else at
            end, lines = at + len(line), lines + 1
        elif lines:
            if lines > 1:
                yield begin, end
            lines, paragraphs = 0, paragraphs + 1
        at += len(line) + 1
    if lines > 1:
        yield begin, end
    if paragraphs + (lines > 0) > 1:
        yield 0, len(text)


class Matcher:
    """Templates by their number of bigrams; those that cannot reach the threshold are skipped."""

    def __init__(self, templates: tuple[tuple[str, str], ...], threshold: float) -> None:
        self.templates = [(name, bigrams(text)) for name, text in templates]
        self.words = frozenset(word for _, grams in self.templates for pair in grams for word in pair if word)
        self.threshold, self.ratio = threshold, threshold / (2 - threshold) - 1e-9

    def possible(self, text: str, among: list[tuple[str, frozenset]] | None = None) -> list[tuple[str, frozenset]]:
        """Those of the templates that can be like ``text`` or a part of it, by the words in it."""
        found = self.words.intersection(WORD.findall(text.translate(LOWER)))
        if not found:
            return []
        found |= {""}  # the second word of a passage of one word
        return [(name, grams) for name, grams in (self.templates if among is None else among)
                if sum(a in found and b in found for a, b in grams) >= self.ratio * len(grams)]

    def best(self, text: str, among: list[tuple[str, frozenset]]) -> tuple[float, str] | None:
        """Highest coefficient and its licence, the first by name of equal ones; None below the threshold."""
        among = self.possible(text, among)
        grams = bigrams(text) if among else frozenset()
        size = len(grams)
        found = None
        for name, other in among:
            if min(size, len(other)) < self.ratio * max(size, len(other)):
                continue
            dice = 2 * len(grams & other) / (size + len(other))
            if dice >= self.threshold and (found is None or (-dice, name) < (-found[0], found[1])):
                found = (dice, name)
        return found

    def spans(self, text: str | None) -> list[dict[str, object]]:
        """The passages of ``text`` like a template."""
        among = self.possible(text) if text else []
        out: list[dict[str, object]] = []
        for begin, end in passages(text) if among else ():
            best = self.best(text[begin:end], among)  # type: ignore[index]
            if best:
                out.append({"begin": begin, "end": end, "license": best[1], "dice": best[0]})
        return out


def license_spans(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES,
                  threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, spans) of every row of ``docs`` (doc_id, text): passages like a template, as (begin, end, license, dice).

    begin and end count code points. Null and empty texts have none; repeated rows give repeated results; other
    columns are left out.
    """
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("dice", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])
    matcher = Matcher(templates, threshold)

    def run(rows: dict[str, list]) -> dict[str, list]:
        return {"doc_id": rows["doc_id"], "spans": [matcher.spans(text) for text in rows["text"]]}

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        per_slice(run, schema), "doc_id long, spans array<struct<begin:long,end:long,license:string,dice:double>>")


def licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_passages, license, dice): the best match of every row, null and 0 without one."""
    spans = license_spans(docs, templates, threshold)
    best = F.get(F.array_sort(F.transform("spans", lambda s: F.struct((-s["dice"]).alias("d"), s["license"].alias("l")))), F.lit(0))
    return spans.select("doc_id", F.size("spans").cast("long").alias("n_passages"), best["l"].alias("license"),
                        F.coalesce(-best["d"], F.lit(0.0)).alias("dice"))
