"""License scans: normalised text compared to licence templates by Dice coefficient over word bigrams.

A text is looked at as a whole and in its paragraphs, lines and sentences (in lines and across them). A notice inside other
words, whatever its line breaks and comment signs, is found as a passage: a run of words that begins and ends with word pairs of
a template of two words or more and is at least ``PASSAGE`` times as long. Each
such unit and each template is normalised (lower case, words only, copyright lines left out) to the multiset of
its word bigrams; Dice is twice the common ones over the sum of both sizes. Since that is at most
``2 * smaller / (smaller + larger)``, a unit meets only templates of similar size.

NULL, empty and wordless texts have no match. Of several units that match one licence the best counts, of equal ones the
first. Repeated rows get equal results. Positions count code points, the end is exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import in_arrow, sliced, texts_of

THRESHOLD = 0.8
PASSAGE = 0.9  # a run of words that stops earlier is the beginning of another notice rather than a copy of this one

# Licence notices and short licence texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)

_NOT_WORD = re.compile(r"[\W_]+")
# Not the words "copyright notice" and the like, with which a line of a wrapped licence text may begin.
_COPYRIGHT = re.compile(r"^\W*(?:copyright\b(?!\W+(?:notices?|holders?|owners?|laws?)\b)|\(c\)|©).*$", re.IGNORECASE | re.MULTILINE)
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n")
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s")


class Match(NamedTuple):
    license: str
    dice: float
    start: int
    end: int


def normalised(text: str) -> list[str]:
    return _NOT_WORD.sub(" ", _COPYRIGHT.sub(" ", text).lower()).split()


def bigrams(words: Sequence[str]) -> Counter:
    """The multiset of word pairs; of one word, that word."""
    return Counter(zip(words, words[1:])) if len(words) != 1 else Counter([(words[0],)])


class Templates:
    """Templates in order of their sizes."""

    def __init__(self, templates: Iterable[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold = threshold
        known = [(name, bigrams(normalised(text))) for name, text in templates]
        self.known = sorted(((c.total(), name, c) for name, c in known if c), key=lambda x: x[:2])
        self.sizes = [n for n, _, _ in self.known]

        self.signs = self._signs()
        self.having: dict[tuple, list[int]] = {}  # the templates of each word pair
        for t, (_, _, counts) in enumerate(self.known):
            for pair in counts:
                if len(pair) == 2:
                    self.having.setdefault(pair, []).append(t)

    def _signs(self) -> list[str]:
        """Words of which every text with a match has one: of each template the longest, until the bigrams without them
        are too few for a match."""
        signs: set[str] = set()
        for size, _, counts in self.known:
            left = counts.copy()
            for word in sorted({w for pair in counts for w in pair}, key=lambda w: (-len(w), w)):
                # A match with a unit of n bigrams needs threshold * (size + n) / 2 common ones, and n is at least the common ones.
                if left.total() * (2 - self.threshold) < self.threshold * size:
                    break
                signs.add(word)
                left = Counter({pair: n for pair, n in left.items() if word not in pair})
        return sorted(w for w in signs if not any(v != w and v in w for v in signs))

    def may_match(self, text: str) -> bool:
        lowered = text.lower()
        return any(sign in lowered for sign in self.signs)

    def similar(self, size: int) -> list[tuple[int, str, Counter]]:
        """Templates that a unit of ``size`` bigrams can match."""
        ratio = self.threshold / (2 - self.threshold)
        return self.known[bisect_left(self.sizes, size * ratio - 1e-9) : bisect_right(self.sizes, size / ratio + 1e-9)]

    def best(self, unit: str) -> tuple[str, float] | None:
        """The licence whose template is most similar to the unit, if similar enough; of equal ones the first by name."""
        words = normalised(unit) if self.may_match(unit) else []
        if not words:
            return None
        found: list[tuple[float, str]] = []
        size = max(1, len(words) - 1)
        near = self.similar(size)
        own = bigrams(words) if near else None
        for other_size, name, other in near:
            if not own.keys().isdisjoint(other.keys()):
                dice = 2 * (own & other).total() / (size + other_size)
                if dice >= self.threshold:
                    found.append((-dice, name))
        return (min(found)[1], -min(found)[0]) if found else None


def _pieces(text: str, start: int, end: int, cut: re.Pattern) -> Iterator[tuple[int, int]]:
    at = start
    for m in cut.finditer(text, start, end):
        yield at, m.start()
        at = m.end()
    yield at, end


_LINE = re.compile("\n")


def _wrapped(text: str, ranges: Iterable[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The ranges, from their first word on, that go on in another line."""
    for a, b in ranges:
        m = _WORD.search(text, a, b)
        if m and "\n" in text[m.start() : b].rstrip():
            yield m.start(), b


def _passages(text: str, templates: Templates) -> Iterator[tuple[float, int, int]]:
    """(dice, start, end) of the runs of words that a template matches: for each place one may begin, the most similar."""
    tokens = list(_WORD.finditer(_COPYRIGHT.sub(lambda m: " " * len(m.group()), text)))
    words = [m.group().lower() for m in tokens]
    places: dict[int, list[int]] = {}
    for i, pair in enumerate(zip(words, words[1:])):
        for t in templates.having.get(pair, ()):
            places.setdefault(t, []).append(i)
    for t, at in places.items():
        size, _, counts = templates.known[t]
        longest = size * (2 - templates.threshold) / templates.threshold + 1e-9
        shortest = PASSAGE * size
        need = max(1, int(templates.threshold * (size + shortest) / 2))
        for k in range(len(at) - need + 1):
            first = at[k]
            if at[k + need - 1] - first >= longest:
                continue
            used: Counter = Counter()
            common, best = 0, (0.0, 0)
            for last in at[k:]:
                n = last - first + 1
                if n > longest:
                    break
                pair = (words[last], words[last + 1])
                used[pair] += 1
                common += used[pair] <= counts[pair]
                dice = 2 * common / (size + n)
                if n >= shortest and dice > best[0]:
                    best = dice, last
            if best[0] >= templates.threshold:
                yield best[0], tokens[first].start(), tokens[best[1] + 1].end()


def _judged(text: str, templates: Templates) -> Iterator[tuple[int, int, tuple[str, float] | None]]:
    """Units with what they match, each range once: the whole text, its paragraphs, lines and sentences, then passages that overlap
    no better match. A line or the like that is a part of a better passage is left out: it may look like another licence."""
    ranges = [(0, len(text))]
    for cut in (_PARAGRAPH, _LINE):
        for a, b in _pieces(text, 0, len(text), cut):
            ranges.append((a, b))
            sentences = _pieces(text, a, b, _SENTENCE)
            ranges.extend(sentences if cut is _LINE else _wrapped(text, sentences))
    judged = {(a, b): templates.best(text[a:b]) for a, b in ranges if a < b}
    if templates.may_match(text):
        matches = [(-best[1], False, *r) for r, best in judged.items() if best is not None]
        starts: list[int] = []  # of all that is matched so far, merged, in order; and the ends
        ends: list[int] = []
        passages: list[tuple[int, int]] = []  # in order
        proposed = {(-dice, True, a, b) for dice, a, b in _passages(text, templates)}
        for _, is_passage, a, b in sorted([*matches, *proposed]):
            i, j = bisect_right(ends, a), bisect_left(starts, b)  # i to j - 1 overlap
            if is_passage and i == j:
                insort(passages, (a, b))
                judged.setdefault((a, b), templates.best(text[a:b]))
            elif is_passage:
                continue
            else:
                k, n = bisect_right(passages, a, key=lambda p: p[1]), bisect_left(passages, b, key=lambda p: p[0])
                if any(y - x > b - a for x, y in passages[k:n]):
                    del judged[a, b]
                    continue
            merged = (min(a, *starts[i:j]), max(b, *ends[i:j])) if i < j else (a, b)
            starts[i:j], ends[i:j] = [merged[0]], [merged[1]]
    return ((a, b, best) for (a, b), best in judged.items())


_DEFAULT = Templates()


def units(text: str, templates: Templates = _DEFAULT) -> Iterator[tuple[int, int]]:
    """The ranges of a text that are compared with templates."""
    return ((a, b) for a, b, _ in _judged(text, templates))


def find_licenses(text: str | None, templates: Templates) -> list[Match]:
    """The best match of each licence, by start and name. A unit matches one licence at most."""
    found: dict[str, Match] = {}
    if not text or not templates.may_match(text):
        return []
    for a, b, best in _judged(text, templates):
        if best is not None:
            name, dice = best
            now = found.get(name)
            if now is None or (dice, -a, -b) > (now.dice, -now.start, -now.end):
                found[name] = Match(name, dice, a, b)
    return sorted(found.values(), key=lambda m: (m.start, m.license))


def license_matches(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, license, dice, start, end) for every row and licence that match."""
    kept = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(templates, threshold)
        for batch in sliced(batches, "_text"):
            rows = [
                (k, *m) for k, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "_text")) for m in find_licenses(t, known)
            ]
            columns = list(zip(*rows)) or [[]] * 5
            types = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "license", "dice", "start", "end"])

    return in_arrow(kept, run, "doc_id long, license string, dice double, start long, end long")
