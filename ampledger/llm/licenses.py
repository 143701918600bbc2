"""License scan: winnowed fingerprints pick candidates, banded alignment measures them.

The templates' fingerprints form an inverted index of bounded size that goes
with the job. Every document is fingerprinted the same way; where a print meets
the index, the words around it are aligned with the template in a band around
the common diagonal. Map-only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame

from ampledger.llm.arrays import LOWER, NOT_ALNUM, ngrams, spans, text_bytes, word_keys

#: Names and wording of public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT": "Released under the MIT License.",
    "MIT grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "BSD grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}

#: Words in a print, and prints of which the smallest is kept: a run of K + WINDOW - 1 equal words of a text always
#: meets, and so does a text of K words.
K = 3
WINDOW = 2
#: Words that an alignment may leave its diagonal by.
BAND = 6
MIN_COVERAGE = 0.7
#: Most words of all templates together; they travel with every task.
MAX_TEMPLATE_WORDS = 1_000_000


def _tokens(raw: np.ndarray, offsets: np.ndarray):
    low = LOWER[raw]
    starts, ends, _ = spans(low, offsets, NOT_ALNUM)
    return word_keys(low, starts, ends)[0], starts, ends, np.searchsorted(starts, offsets)


def winnow(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest of each ``window`` neighbours, the last one among equals.

    Neighbours are prints of one text: places begins[i] to ends[i] - 1. A text
    with fewer prints than a window keeps its smallest.
    """
    few = np.flatnonzero((ends > begins) & (ends - begins < window))
    short = [ends[i] - 1 - int(codes[begins[i] : ends[i]][::-1].argmin()) for i in few]
    if len(codes) < window:
        return np.array(sorted(short), np.int64)
    back = sliding_window_view(codes, window)[:, ::-1].argmin(axis=1)
    open_ = np.zeros(len(codes) + 1, np.int64)
    long = ends - begins >= window
    np.add.at(open_, begins[long], 1)
    np.add.at(open_, ends[long] - window + 1, -1)
    inside = np.flatnonzero(np.cumsum(open_)[: len(back)])
    return np.unique(np.concatenate([inside + window - 1 - back[inside], np.array(short, np.int64)]))


def align(doc: np.ndarray, template: np.ndarray, diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """Best local alignment in the band: first and end word in ``doc`` and the matched template words.

    A match counts 2, a substitution or gap -1; ``diagonal`` is document place
    less template place. Among equal scores the earliest end wins.
    """
    width = 2 * band + 1
    score = [0] * (width + 1)
    start = [-1] * (width + 1)
    equal = [0] * (width + 1)
    best = (0, 0, 0, 0)
    words, pattern = doc.tolist(), template.tolist()
    for t, want in enumerate(pattern):
        left_score, left_start, left_equal = 0, -1, 0
        row_score, row_start, row_equal = [0] * (width + 1), [-1] * (width + 1), [0] * (width + 1)
        for c in range(width):
            d = t + diagonal + c - band
            if d < 0 or d >= len(words):
                left_score, left_start, left_equal = 0, -1, 0
                continue
            same = words[d] == want
            s, b, m = (score[c] if start[c] >= 0 else 0) + (2 if same else -1), start[c] if start[c] >= 0 else d, equal[c] + same
            if start[c + 1] >= 0 and score[c + 1] - 1 > s:
                s, b, m = score[c + 1] - 1, start[c + 1], equal[c + 1]
            if left_start >= 0 and left_score - 1 > s:
                s, b, m = left_score - 1, left_start, left_equal
            if s <= 0:
                s, b, m = 0, -1, 0
            row_score[c], row_start[c], row_equal[c] = s, b, m
            left_score, left_start, left_equal = s, b, m
            if s > best[0]:
                best = (s, b, d + 1, m)
        score, start, equal = row_score, row_start, row_equal
    return best[1], best[2], best[3]


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """One row per match: id, license, coverage, n_matched, first_word, end_word, start_char, end_char.

    Coverage is the share of the template's words that the aligned span
    matches. A template may match several times in a document, and spans of
    different templates may overlap. Null and empty texts, and templates
    without a word, match nothing. Repeated rows each give their matches;
    a null id is kept; other columns are ignored. A text's matches depend on it
    alone, whatever rows stand beside it. Templates shorter than a
    print match by their whole wording.
    """
    names = sorted(templates)
    raw, offsets = text_bytes(pa.array([templates[n] for n in names], pa.string()))
    all_words, _, _, bounds = _tokens(raw, offsets)
    if len(all_words) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"the templates have more than {MAX_TEMPLATE_WORDS} words")
    patterns = [all_words[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    # Every print of a template is indexed: the kept prints of a document then meet it wherever they fall.
    prints = sorted((int(code), t, at, n) for t, p in enumerate(patterns) for n in [min(K, len(p))] if n for at, code in enumerate(ngrams(p, n)))
    sizes = sorted({p[3] for p in prints})
    index = {n: {} for n in sizes}
    for code, t, at, n in prints:
        index[n].setdefault(code, []).append((t, at))
    keys = {n: np.array(sorted(index[n]), np.uint64) for n in sizes}
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, license string, coverage double, n_matched int, first_word int, end_word int, start_char int, end_char int"

    def matches(words: np.ndarray, lo: int, hi: int, hits: list[tuple[int, int, int]]) -> Iterator[tuple[int, float, int, int, int]]:
        by_template: dict[int, list[tuple[int, int]]] = {}
        for t, place, at in hits:
            by_template.setdefault(t, []).append((place, place - at))
        for t, found in sorted(by_template.items()):
            done = -1
            for place, diagonal in sorted(found):
                if place < done:
                    continue
                pattern = patterns[t]
                first = lo + max(0, diagonal - BAND, done)
                last = min(hi, lo + diagonal + len(pattern) + BAND)
                a, b, m = align(words[first:last], pattern, lo + diagonal - first)
                a, b = a + first - lo, b + first - lo
                if m / len(pattern) >= min_coverage and b > max(place, done):
                    done = b
                    yield t, m / len(pattern), m, a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                raw, offsets = text_bytes(batch.column(1))
                words, starts, ends, per_text = _tokens(raw, offsets)
                hits: dict[int, list[tuple[int, int, int]]] = {}
                for n in sizes:
                    codes = ngrams(words, n)
                    kept = winnow(codes, per_text[:-1], np.maximum(per_text[1:] - K + 1, per_text[:-1])) if n == K else np.arange(len(codes))
                    spot = np.searchsorted(keys[n], codes[kept])
                    spot[spot == len(keys[n])] = 0
                    kept = kept[keys[n][spot] == codes[kept]]
                    owner = np.searchsorted(per_text, kept, side="right") - 1
                    for p, d in zip(kept.tolist(), owner.tolist()):
                        if p + n <= per_text[d + 1]:
                            hits.setdefault(d, []).extend((t, p - int(per_text[d]), q) for t, q in index[n][int(codes[p])])
                rows = []
                for d, found in sorted(hits.items()):
                    lo, hi = int(per_text[d]), int(per_text[d + 1])
                    begin = offsets[d]
                    for t, coverage, m, a, b in matches(words, lo, hi, found):
                        s, e = starts[lo + a], ends[lo + b - 1]
                        first = len(raw[begin:s].tobytes().decode())
                        rows.append((d, names[t], coverage, m, a, b, first, first + len(raw[s:e].tobytes().decode())))
                cols = list(zip(*rows)) if rows else [[]] * 8
                kinds = [pa.string(), pa.float64(), *[pa.int32()] * 5]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[0], pa.int64())), *(pa.array(c, k) for c, k in zip(cols[1:], kinds))],
                    [id_col, "license", "coverage", "n_matched", "first_word", "end_word", "start_char", "end_char"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
