"""Licences in texts: passages compared with licence templates by the Dice coefficient over word bigrams.

A passage is a line, a paragraph or the whole text. It is normalised to lower-case words of a-z and 0-9 and becomes the set
of its bigrams. Two sets of a and b bigrams with a Dice coefficient of at least t have sizes within t / (2 - t) of each
other, so only the templates in that range of sizes are compared; they stand in order of size.

A notice in the middle of a line, or wrapped inside a longer paragraph, is a window: a run of the text's words, whatever
stands between them, that begins and ends with a bigram of the template and is at most as long as the size bounds let it
be. Windows are looked for only near a template's rarer bigrams: so many of them that a match must hold one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Wordings of common notices and short licences, by SPDX name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
        "to do so, subject to the following conditions:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("All-rights-reserved", "All rights reserved."),
)
_WORD, _LINE, _PARAGRAPH = re.compile(rb"[a-z0-9]+"), b"\n", re.compile(rb"\n[ \t\r]*\n")


@dataclass(frozen=True)
class LicenceSpec:
    """``percent``: least Dice coefficient, in hundredths, at which a passage is taken for a template."""

    percent: int = 85
    templates: tuple[tuple[str, str], ...] = TEMPLATES


def bigrams(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip(words, words[1:], strict=False))


def _words(passage: bytes) -> list[bytes]:
    return _WORD.findall(passage)


@dataclass(frozen=True)
class Wanted:
    """A template as windows meet it: ``least`` of its bigrams must be there, within ``most`` bigrams of the text."""

    name: str
    pairs: frozenset[tuple[bytes, bytes]]
    least: int
    most: int


class Scanner:
    """Templates by size, and the range of sizes that a passage of some size can match."""

    def __init__(self, spec: LicenceSpec) -> None:
        self.percent = spec.percent
        known = [(name, bigrams(_words(text.encode().lower()))) for name, text in spec.templates]
        self.known = sorted(((len(found), name, found) for name, found in known if found), key=lambda k: k[:2])
        self.sizes = [size for size, _, _ in self.known]
        self.least = self._bounds(self.sizes[0])[0] if self.sizes else 1
        self.most = self._bounds(self.sizes[-1])[1] if self.sizes else 0
        self.wanted: list[Wanted] = []
        self.anchors: dict[tuple[bytes, bytes], list[int]] = {}
        for name, text in spec.templates:
            words = _words(text.encode().lower())
            pairs = frozenset(bigrams(words))
            if not pairs:
                continue
            least = max(1, self._bounds(len(pairs))[0])
            # A match lacks at most len(pairs) - least bigrams, so it holds one of any more than that. Long words are rare.
            for pair in sorted(pairs, key=lambda p: (-len(p[0]) - len(p[1]), p))[: len(pairs) - least + 1]:
                self.anchors.setdefault(pair, []).append(len(self.wanted))
            self.wanted.append(Wanted(name, pairs, least, self._bounds(len(words) - 1)[1]))

    def _bounds(self, size: int) -> tuple[int, int]:
        """Sizes s with 100 * 2 * min(s, size) >= percent * (s + size)."""
        t = self.percent
        return -(-t * size // (200 - t)), (200 - t) * size // t

    def compare(self, words: list[bytes], found: dict[str, float]) -> None:
        """Add the licence of the most like template to ``found``; of licences as like, the first by name."""
        if not self.least < len(words):
            return
        own = bigrams(words)
        size = len(own)
        low, high = self._bounds(size)
        best: tuple[float, str] | None = None
        for at in range(bisect_left(self.sizes, low), bisect_right(self.sizes, high)):
            other, name, wanted = self.known[at]
            shared = len(own & wanted)
            dice = 2 * shared / (size + other)
            if 200 * shared >= self.percent * (size + other) and (best is None or (-dice, name) < (-best[0], best[1])):
                best = dice, name
        if best:
            found[best[1]] = max(found.get(best[1], 0.0), best[0])

    def _windows_of(self, wanted: Wanted, near: list[int], pairs: list[tuple[bytes, bytes]]) -> Iterator[tuple[float, str, int, int]]:
        """-dice, licence, first and last bigram of the most like window from each bigram on, around the places ``near``."""
        places: list[int] = []
        done = 0
        for at in near:
            start, done = max(done, at - wanted.most + 1), min(len(pairs), at + wanted.most)
            places += [i for i in range(start, done) if pairs[i] in wanted.pairs]
        size = len(wanted.pairs)
        for k in range(len(places) - wanted.least + 1):
            first = places[k]
            if places[k + wanted.least - 1] - first >= wanted.most:
                continue
            own: set[tuple[bytes, bytes]] = set()
            shared, best, seen = 0, None, first
            for last in places[k : k + wanted.most]:
                if last - first >= wanted.most:
                    break
                shared += pairs[last] not in own
                own.update(pairs[seen : last + 1])
                seen = last + 1
                dice = 2 * shared / (size + len(own))
                if 200 * shared >= self.percent * (size + len(own)) and (best is None or dice > best[0]):
                    best = dice, last
            if best:
                yield -best[0], wanted.name, first, best[1]

    def windows(self, words: list[bytes], found: dict[str, float]) -> None:
        """Add the licences that windows match to ``found``, without those mostly inside better matches of other licences."""
        pairs = list(pairwise(words))
        near: dict[int, list[int]] = {}
        for at, pair in enumerate(pairs):
            if pair in self.anchors:
                for template in self.anchors[pair]:
                    near.setdefault(template, []).append(at)
        matches = sorted(m for template, places in near.items() for m in self._windows_of(self.wanted[template], places, pairs))
        taken: dict[int, set[str]] = {}
        for minus, name, first, last in matches:
            held = range(first, last + 1)
            if 2 * sum(any(other != name for other in taken.get(i, ())) for i in held) > len(held):
                continue
            found[name] = max(found.get(name, 0.0), -minus)
            for i in held:
                taken.setdefault(i, set()).add(name)

    def scan(self, text: str | None) -> dict[str, float]:
        """The best coefficient of each licence that a line, a paragraph, the whole text or a window of it matches."""
        found: dict[str, float] = {}
        if not text:
            return found
        raw = text.encode("utf-8", "surrogatepass").lower()
        lines, paragraphs = raw.split(_LINE), _PARAGRAPH.split(raw)
        for line in lines:
            self.compare(_words(line), found)
        for paragraph in paragraphs if len(paragraphs) > 1 else ():
            self.compare(_words(paragraph), found)
        words = _words(raw)
        if len(lines) > 1:
            self.compare(words, found)
        self.windows(words, found)
        return found


def licences(docs: DataFrame, spec: LicenceSpec = LicenceSpec()) -> DataFrame:
    """doc_id, licence, dice for each licence found in a row of ``docs`` (doc_id, text); null and empty texts have none.

    Rows of one doc_id give one row per licence, with the best coefficient.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(spec)
        for batch in batches:
            ids, names, dice = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                for name, value in scanner.scan(text.as_py()).items():
                    ids.append(doc_id)
                    names.append(name)
                    dice.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(dice, pa.float64())], ["doc_id", "licence", "dice"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id long, licence string, dice double")
    return rows.groupBy("doc_id", "licence").agg(F.max("dice").alias("dice"))


def licences_sql(spec: LicenceSpec = LicenceSpec()) -> str:
    """DuckDB SQL for the same rows."""
    values = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(spec.templates))

    def pairs(key: str, text: str, rows: str) -> str:
        words = f"regexp_extract_all(lower({text}), '[a-z0-9]+')"
        return f"SELECT {key}, unnest(list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) AS pair FROM (SELECT {key}, {words} AS w FROM {rows})"

    return f"""
WITH passages AS (
  SELECT DISTINCT doc_id, unnest(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), [text])) AS passage FROM documents),
texts AS (SELECT DISTINCT passage FROM passages),
templates(template, licence, wording) AS (VALUES {values}),
a AS ({pairs("passage", "passage", "texts")}),
b AS ({pairs("template, licence", "wording", "templates")}),
a_size AS (SELECT passage, count(*) AS n FROM a GROUP BY ALL),
b_size AS (SELECT template, count(*) AS n FROM b GROUP BY ALL),
met AS (SELECT passage, template, licence, count(*) AS shared FROM a JOIN b USING (pair) GROUP BY ALL),
best AS (
  SELECT passage, licence, 2 * shared / (a_size.n + b_size.n) AS dice
  FROM met JOIN a_size USING (passage) JOIN b_size USING (template)
  WHERE 200 * shared >= {spec.percent} * (a_size.n + b_size.n)
  QUALIFY row_number() OVER (PARTITION BY passage ORDER BY 2 * shared / (a_size.n + b_size.n) DESC, licence) = 1)
SELECT doc_id, licence, max(dice) AS dice FROM passages JOIN best USING (passage)
GROUP BY doc_id, licence"""
