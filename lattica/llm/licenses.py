"""License scans: winnowed fingerprints, an inverted index, chained alignment.

Templates are cut into words, and their sequences of GRAM words hashed; of each
run of WINDOW such hashes the least is a fingerprint. The index maps a
fingerprint to the templates and places that have it. A document is
fingerprinted alike; fingerprints in the index vote for a template and a place.
All of the document that an alignment through a vote can reach is aligned with
the template at once, across diagonals: words of the template may be missing
anywhere, and words may be added anywhere, but each SKIP added words cost as
much as an aligned word gains. The aligned words give the coverage and the span
in the original text.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.shingles import mix, word_hashes

GRAM = 3
WINDOW = 2
#: So many words left out of the document between two aligned ones outweigh an aligned word.
SKIP = 8
COVERAGE = 0.8
#: Words of all templates; the index is broadcast, so it has a bound.
MOST_WORDS = 2_000_000

# fixed values: names and texts of licenses, as their authors word them
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "All-rights-reserved": "All rights reserved.",
    "LGPL-2.1-header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "LGPL-3.0-header": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "EPL-2.0-header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "MIT-disclaimer": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-disclaimer": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
}

_WORD = re.compile(r"[^\W_]+")
#: Bytes of ASCII that belong to no word become spaces; the rest of words is kept, in lower case.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def _hashes(text: bytes) -> np.ndarray:
    data = np.frombuffer(text.translate(_FOLD), np.uint8)
    return word_hashes(data, np.array([0, len(data)]))[0]


def grams(words: np.ndarray) -> np.ndarray:
    """Hashes of the sequences of GRAM words; of fewer words, but not none, that of all."""
    if not len(words):
        return words
    m = max(1, len(words) - GRAM + 1)
    out = np.zeros(m, np.uint64)
    for k in range(min(GRAM, len(words))):
        out = mix(out + words[k : k + m])
    return out


def winnow(values: np.ndarray) -> np.ndarray:
    """Places of the least of each WINDOW values in a row, the rightmost of equals; of fewer, all."""
    if len(values) <= WINDOW:
        return np.arange(len(values))
    runs = np.lib.stride_tricks.sliding_window_view(values, WINDOW)
    return np.unique(np.arange(len(runs)) + WINDOW - 1 - runs[:, ::-1].argmin(1))


@dataclass
class Index:
    names: list[str]
    words: list[np.ndarray]
    #: Fingerprints, sorted, and with each the template and place that has it.
    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray
    #: Fingerprints of templates of under WINDOW grams, which a document's own fingerprints may lack.
    short: np.ndarray


def build_index(templates: Mapping[str, str]) -> Index:
    names = sorted(templates)
    words = [_hashes(templates[n].encode()) for n in names]
    if sum(map(len, words)) > MOST_WORDS:
        raise ValueError(f"templates have more than {MOST_WORDS} words")
    values = [grams(w) for w in words]
    found = sorted((int(v[p]), t, int(p)) for t, v in enumerate(values) for p in winnow(v))
    short = np.concatenate([np.zeros(0, np.uint64), *(v for v in values if len(v) < WINDOW)])
    return Index(names, words, np.array([f[0] for f in found], np.uint64), np.array([f[1] for f in found], np.int64), np.array([f[2] for f in found], np.int64), short)


def regions(places: np.ndarray, at: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The stretches of a document that alignments of a template of ``n`` words through votes (its ``places``, the document's ``at``) can reach."""
    low = at - (SKIP + 1) * places
    high = at + (SKIP + 1) * (n - places)
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.flatnonzero(np.r_[True, low[1:] > high[:-1]])
    return list(zip(low[new].tolist(), high[np.r_[new[1:] - 1, len(high) - 1]].tolist(), strict=True))


def align(template: np.ndarray, words: np.ndarray, coverage: float) -> list[tuple[int, int, int]]:
    """(aligned words, first, last) of the alignments that cover enough of the template and do not overlap, those of the best score first.

    An alignment pairs equal words in order. Its score is SKIP for each pair
    less one for each word of the document between its ends that has no pair.
    """
    n, m = len(template), len(words)
    order = np.argsort(words, kind="stable")
    ordered = words[order]
    low, high = np.searchsorted(ordered, template), np.searchsorted(ordered, template, "right")
    if np.count_nonzero(high > low) < coverage * n:
        return []
    # A number holds (SKIP + 1) * pairs + first, which is the score and the last place plus one, and below it the first place.
    fresh = np.arange(m, dtype=np.int64) << 32 | np.arange(m)
    best = np.full(m + 1, -1, np.int64)
    ends = np.full(m, -1, np.int64)
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        if a == b:
            continue
        at = order[a:b]
        value = np.maximum(best[at], fresh[at]) + (SKIP + 1 << 32)
        ends[at] = np.maximum(ends[at], value)
        start = int(at[0]) + 1
        tail = best[start:]
        tail[at + 1 - start] = np.maximum(tail[at + 1 - start], value)
        np.maximum.accumulate(tail, out=tail)
    last = np.flatnonzero(ends >= 0)
    first = ends[last] & 0xFFFFFFFF
    total = ends[last] >> 32
    pairs = (total - first) // (SKIP + 1)
    enough = pairs >= coverage * n
    found = zip((total - last)[enough].tolist(), first[enough].tolist(), last[enough].tolist(), pairs[enough].tolist(), strict=True)
    return [(p, i, j) for _, i, j, p in apart(sorted(((-s, i, j, p) for s, i, j, p in found)), 1, 2)]


def apart(found: Sequence[tuple], first: int, last: int) -> list[tuple]:
    """Those of ``found``, taken in order, whose span from column ``first`` to ``last`` overlaps no span taken before."""
    starts: list[int] = []
    stops: list[int] = []
    kept = []
    for x in found:
        k = bisect_right(starts, x[last])
        if not k or stops[k - 1] < x[first]:
            starts.insert(k, x[first])
            stops.insert(k, x[last])
            kept.append(x)
    return kept


def scan(index: Index, text: str | None, coverage: float = COVERAGE) -> list[tuple[str, float, int, int]]:
    """(template, share of its words that are aligned, start, end) of all matches, by place.

    Of matches whose spans overlap the one with more aligned words stays, then
    that of the larger share, then the earlier, then the first by name. Offsets count characters.
    """
    raw = (text or "").encode()
    words = _hashes(raw)
    values = grams(words)
    at = np.union1d(winnow(values), np.flatnonzero(np.isin(values, index.short)))
    if not len(at) or not len(index.prints):
        return []
    low, high = np.searchsorted(index.prints, values[at]), np.searchsorted(index.prints, values[at], "right")
    hits = np.flatnonzero(high > low)
    if not len(hits):
        return []
    votes: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for h in hits.tolist():
        for e in range(low[h], high[h]):
            votes[int(index.template[e])].append((int(index.place[e]), int(at[h])))
    found = []
    for t, pairs in votes.items():
        n = len(index.words[t])
        for start, end in regions(*np.array(pairs).T, n):
            start = max(start, 0)
            found += [(-count, -count / n, start + i, index.names[t], start + j) for count, i, j in align(index.words[t], words[start:end], coverage)]
    if not found:
        return []
    folded = raw.translate(_FOLD)
    spots = [m.span() for m in re.finditer(rb"[^ ]+", folded)]
    kept = apart(sorted(found), 2, 4)
    count = lambda b: len(raw[:b].decode("utf-8", "ignore"))
    return sorted(((name, -share, count(spots[a][0]), count(spots[b][1])) for _, share, a, name, b in kept), key=lambda x: (x[2], x[0]))


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])


def scan_documents(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """A row per match: (doc_id, license, coverage, start, end).

    Null and empty texts have no matches; a null id stays null; rows that
    repeat are scanned each; an empty table gives an empty table. Only doc_id
    and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(build_index(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc_id, *m) for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in scan(shared.value, text.as_py())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 5, _SCHEMA.types, strict=True)], schema=_SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, license string, coverage double, start long, end long")
