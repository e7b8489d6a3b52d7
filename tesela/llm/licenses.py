"""Licence scans: lines against licence templates by the Dice coefficient of word bigrams.

A template can only reach the threshold for lines of about its own size, so the number of
bigrams of a line selects the templates that are compared with it.  Notices that are wrapped over
several lines, or stand inside a longer one, are found as windows of words of a paragraph: lines
up to the next one without words, with their ends joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_of, whole_number

THRESHOLD = 0.8

#: Notices and paragraphs of public licences, by the name of the licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("Apache-2.0", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD", "Released under the BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
    ("Public-Domain", "This work is dedicated to the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: A word: anything but ASCII control, blank and punctuation characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Scanner:
    """Finds the templates of a text."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        import re

        self.words = re.compile(WORD).findall
        self.threshold = threshold
        self.templates = [(name, self.bigrams(text)) for name, text in templates]
        self.templates = [(name, grams) for name, grams in self.templates if grams]
        #: The templates that lines of a size can reach.  Dice is at most 2 min(a, b) / (a + b).
        self.of_size: dict[int, list] = {}
        for name, grams in self.templates:
            b = len(grams)
            for a in range(1, int((2 - threshold) / threshold * b) + 2):
                if 2 * min(a, b) / (a + b) >= threshold:
                    self.of_size.setdefault(a, []).append((name, grams))
        #: For each bigram the templates that have it, and how many of theirs a window must have.
        self.owners: dict[tuple[str, str], list[int]] = {}
        for k, (_, grams) in enumerate(self.templates):
            for gram in grams:
                self.owners.setdefault(gram, []).append(k)
        self.every = frozenset(self.owners)
        self.needed = [threshold * len(grams) / (2 - threshold) - 1e-9 for _, grams in self.templates]

    def split(self, line: str) -> list[str]:
        return self.words(line.translate(TO_LOWER))

    def bigrams(self, line: str) -> set[tuple[str, str]]:
        words = self.split(line)
        return set(zip(words, words[1:]))

    def scan(self, text: str) -> list[tuple[int, str, float]]:
        """(line, licence, dice) of each line that reaches the threshold: its best template, of
        equals the first by name; and of each window of a paragraph, by its first line.

        A window inside a line that reaches the threshold is that line.  A window of several
        lines takes the place of lines in it that reach less.  Windows do not overlap; the best
        ones come first.
        """
        found: dict[int, tuple[str, float]] = {}
        blocks: list[tuple[int, str, float]] = []
        words: list[str] = []
        places: list[int] = []
        known: set[tuple[str, str]] = set()

        def close() -> None:
            if len(known) > 1 or self.every and len(known) >= min(self.needed):
                blocks.extend(self._windows(words, places, known, found))
            words.clear()
            places.clear()
            known.clear()

        for number, line in enumerate(text.split("\n")):
            own = self.split(line)
            if not own:
                close()
                continue
            grams = set(zip(own, own[1:]))
            best = None
            for name, other in self.of_size.get(len(grams), ()):
                dice = 2 * len(grams & other) / (len(grams) + len(other))
                if dice >= self.threshold and (best is None or (-dice, name) < best):
                    best = (-dice, name)
            if best:
                found[number] = (best[1], -best[0])
            known |= self.every & grams
            if words and (words[-1], own[0]) in self.every:
                known.add((words[-1], own[0]))
            words += own
            places += [number] * len(own)
        close()
        return sorted([(number, *hit) for number, hit in found.items()] + blocks)

    def _windows(self, words: list[str], places: list[int], known: set, found: dict) -> list[tuple[int, str, float]]:
        counts: dict[int, int] = {}
        for gram in known:
            for k in self.owners[gram]:
                counts[k] = counts.get(k, 0) + 1
        counts = {k: n for k, n in counts.items() if n >= self.needed[k]}
        if not counts or len(words) > 1 and places[0] == places[-1] and places[0] in found:
            return []
        grams = list(zip(words, words[1:]))
        at: dict[int, list[int]] = {k: [] for k in counts}
        for i, gram in enumerate(grams):
            for k in self.owners.get(gram, ()):
                if k in at:
                    at[k].append(i)
        reached = []
        for k, starts in at.items():
            name, other = self.templates[k]
            most = (2 - self.threshold) / self.threshold * len(other) + 1e-9
            for start in starts:
                seen, both, best = set(), 0, None
                for end in range(start, len(grams)):
                    gram = grams[end]
                    if end > start and gram == grams[start]:
                        break  # without its first bigram the window has the same ones
                    if gram in seen:
                        continue
                    seen.add(gram)
                    if len(seen) > most:
                        break
                    if gram in other:
                        both += 1
                        dice = 2 * both / (len(seen) + len(other))
                        if dice >= self.threshold and (best is None or dice > best[0]):
                            best = (dice, end)
                if best:
                    reached.append((-best[0], name, -len(other), start, best[1] + 1))
        taken, out = [], []
        for dice, name, _, start, end in sorted(reached):
            first, last = places[start], places[end]
            lines = [n for n in range(first, last + 1) if n in found]
            if any(start <= b and a <= end for a, b in taken):
                continue
            if lines and (first == last or any(found[n][1] >= -dice for n in lines)):
                continue
            for n in lines:
                del found[n]
            taken.append((start, end))
            out.append((first, name, -dice))
        return out


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_lines, licenses, best_dice) for every row of `docs`: how many lines and
    windows reach a template, which licences they name (sorted, comma-joined), and the highest coefficient.

    Null and empty texts have no lines that match: 0, an empty string and 0.0.  Keys may be
    null or repeated.  Other columns are not read.
    """
    known = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known, threshold)
        for batch in batches:
            found = [scanner.scan(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([",".join(sorted({name for _, name, _ in f})) for f in found], pa.string()),
                    pa.array([max((d for _, _, d in f), default=0.0) for f in found], pa.float64()),
                ],
                names=["doc_id", "n_lines", "licenses", "best_dice"],
            )

    return docs.select(whole_number(key).alias("doc_id"), text_of(text)).mapInArrow(run, "doc_id bigint, n_lines bigint, licenses string, best_dice double")
