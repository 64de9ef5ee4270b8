"""License scan: winnowed fingerprints find candidates, banded alignment measures them.

Templates are cut into grams of up to GRAM words; of each few neighbouring grams the smallest
hash is kept (winnowing) in an inverted index of fingerprints. Gram and window of a template are such that,
whichever words of a copy are changed, missing or preceded by a foreign one within the wanted coverage, the longest
stretch left intact holds a kept gram. A document's grams are
looked up there. Hits of one template on neighbouring diagonals are one candidate, aligned
with the template inside a band around them; the words matched give coverage and span.
"""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlife.llm.words import chunks, grams, text_words, word_hashes

GRAM, BAND = 3, 8
MATCH, OTHER = 2, -1
#: Words at most in all templates: their index goes to every task.
MOST_WORDS = 1_000_000

#: Wordings that licenses ask for.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-line": "Licensed under CC BY 4.0.",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-line": "Licensed under CC BY-SA 4.0.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
}


def winnowing(words: int, coverage: float) -> tuple[int, int]:
    """(words of a gram, grams of a window) for a template of so many words.

    With e words spoilt, the rest falls into e + 1 stretches, one of which has at least
    (words - e) / (e + 1) words; a window of grams fits into it.
    """
    spoilt = words - int(np.ceil(coverage * words - 1e-9))
    intact = max(1, -(-(words - spoilt) // (spoilt + 1)))
    gram = min(GRAM, intact)
    return gram, intact - gram + 1


class Index:
    """Template words, and the places of each fingerprint by gram size."""

    def __init__(self, templates: dict[str, str], coverage: float = 0.8):
        self.words = {name: text_words(text) for name, text in templates.items()}
        if sum(map(len, self.words.values())) > MOST_WORDS:
            raise ValueError(f"templates have more than {MOST_WORDS} words")
        self.places = defaultdict(list)
        for name, words in self.words.items():
            gram, window = winnowing(len(words), coverage)
            own = grams(np.array(words, np.uint64), gram).tolist()
            kept = {min(range(i, min(i + window, len(own))), key=lambda j: (own[j], -j)) for i in range(max(1, len(own) - window + 1))} if own else set()
            for at in kept:
                self.places[gram, own[at]].append((name, at))
        sizes = sorted({size for size, _ in self.places})
        self.prints = {size: np.array(sorted(h for s, h in self.places if s == size), np.uint64) for size in sizes}


def aligned(template, words, low, high):
    """Best local alignment of the template with ``words`` on diagonals low - BAND to high + BAND.

    A diagonal is the place in ``words`` less the place in the template. Returns (words
    matched, first, last) with the places of the first and last matched word.
    """
    left, right = low - BAND, high + BAND
    width = right - left + 1
    nothing = (0, 0, -1, -1)  # score, matched, first, last
    before, best = [nothing] * (width + 1), nothing
    for i, word in enumerate(template):
        row, last = [], nothing
        for d in range(width):
            j = i + left + d
            if 0 <= j < len(words):
                score, matched, first, end = before[d]
                if words[j] == word:
                    step = (score + MATCH, matched + 1, j if first < 0 else first, j)
                else:
                    step = (score + OTHER, matched, first, end)
                up = before[d + 1]
                if up[0] + OTHER > step[0]:
                    step = (up[0] + OTHER, *up[1:])
                if last[0] + OTHER > step[0]:
                    step = (last[0] + OTHER, *last[1:])
                if step[0] <= 0:
                    step = nothing
            else:
                step = nothing
            row.append(step)
            last = step
            if step[0] > best[0]:
                best = step
        before = [*row, nothing]
    return best[1:]


def _places(template, words, hits, least):
    """(words matched, first, last) of each copy of the template in ``words``, given hits (place, diagonal), from left to right.

    Every step aligns the template once, with one template's length of words, and leaves at least one hit behind.
    """
    hits, low, i = sorted(hits), 0, 0
    while i < len(hits):
        at, d = hits[i]
        if at < low:
            i += 1
            continue
        left = right = d
        for near, other in hits[i + 1 :]:
            if near > d + len(template) + BAND:
                break
            if left - BAND <= other <= right + BAND:
                left, right = min(left, other), max(right, other)
        base = max(low, left - BAND)
        part = words[base : right + BAND + len(template)].tolist()
        matched, first, last = aligned(template, part, left - base, right - base)
        if matched >= least * len(template):
            yield matched, base + first, base + last
            low = base + last + 1
        i += 1


def _matches(index, words, hits, least):
    """(template, coverage, first word, last word) of one document; overlapping finds of a template are one."""
    by_template = defaultdict(list)
    for at, size, gram in hits:
        for name, place in index.places[size, gram]:
            by_template[name].append((at, at - place))
    for name, own in sorted(by_template.items()):
        template, until = index.words[name], -1
        for matched, first, last in sorted(_places(template, words, own, least), key=lambda f: f[1:]):
            if first > until:
                until = last
                yield name, matched / len(template), first, last


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = 0.8) -> DataFrame:
    """Every place where at least ``coverage`` of a template's words stand in a text, in order.

    Takes doc_id and text; returns (doc_id, license, coverage, start, finish), start and finish
    in code points, finish exclusive. Case and punctuation are not minded. One text may
    hold several templates, and one template several times. Null, empty and foreign texts
    give no row; a template without words is never found. Repeated rows give
    repeated finds; an empty table gives an empty result.
    """
    told = docs.sparkSession.sparkContext.broadcast(Index(TEMPLATES if templates is None else templates, coverage))

    def run(batches):
        index = told.value
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for low, high, data, offsets in chunks(batch.column(1)):
                hashes, starts, ends, first = word_hashes(data, offsets, plain=True)
                hits = []
                for size, prints in index.prints.items():
                    own = grams(hashes, size)
                    near = np.minimum(np.searchsorted(prints, own), len(prints) - 1)
                    found = np.flatnonzero(prints[near] == own)
                    rows = np.searchsorted(first, found, "right") - 1
                    found, rows = (x[found + size <= first[rows + 1]] for x in (found, rows))
                    hits += zip(rows.tolist(), found.tolist(), [size] * len(found), own[found].tolist())
                by_row = defaultdict(list)
                for row, at, size, gram in hits:
                    by_row[row].append((at - int(first[row]), size, gram))
                for row in sorted(by_row):
                    a, b, found = int(first[row]), int(first[row + 1]), by_row[row]
                    text = data[offsets[row] : offsets[row + 1]]
                    for name, share, s, e in _matches(index, hashes[a:b], found, coverage):
                        begin, end = int(starts[a + s] - offsets[row]), int(ends[a + e] - offsets[row])
                        points = [int(((text[:n] & 0xC0) != 0x80).sum()) for n in (begin, end)]
                        out.append((ids[low + row], name, share, *points))
            kinds = (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["doc_id", "license", "coverage", "start", "finish"])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "doc_id long, license string, coverage double, start int, finish int")
