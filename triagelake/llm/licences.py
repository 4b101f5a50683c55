"""Licence scans: Dice coefficient of word bigrams between parts of a text and licence notices.

Parts are the text, its paragraphs (between empty lines) and its lines.  Notices that stand inside a longer part or across
lines are found by windows: all runs of as many words as the notice has.  A Dice coefficient of t needs the smaller bigram
set to have at least t / (2 - t) times the size of the larger, which prunes notices by size before any bigram is compared.
"""

from __future__ import annotations

import pkgutil
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.llm.arrow_text import ALNUM, Words, pieces, text_bytes, windows

LEAST = 0.75

# Customary notices, headers and texts of public licences.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_3 = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY"
    " AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,"
    " STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_END = (
    " The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH"
    " THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_ISC_END = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    " IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,"
    " WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_GNU_HEADER = "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."

for _mark, _name in {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}.items():
    NOTICES[f"CC-{_mark}-4.0"] = f"This work is licensed under a Creative Commons {_name} 4.0 International License."
    NOTICES[f"CC-{_mark}-4.0-short"] = f"Licensed under CC {_mark} 4.0."
    _name = _name.replace("NoDerivatives", "NoDerivs")
    NOTICES[f"CC-{_mark}-3.0"] = f"This work is licensed under a Creative Commons {_name} 3.0 Unported License."
    NOTICES[f"CC-{_mark}-3.0-short"] = f"Licensed under CC {_mark} 3.0."

for _mark, _name, _version in (
    ("GPL-2.0", "General Public License", "2"), ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"),
    ("AGPL-3.0", "Affero General Public License", "3"),
):
    NOTICES[_mark] = f"This work is licensed under the GNU {_name}, version {_version}."
    NOTICES[f"{_mark}-header"] = _GNU_HEADER.format("This library" if _mark == "LGPL-2.1" else "This program", _name, _version)

NOTICES |= {
    "BSD-2-Clause-short": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause-short": "Licensed under the BSD 3-Clause License.",
    "BSD-2-Clause-text": _BSD_2 + _BSD_END,
    "BSD-3-Clause-text": _BSD_2 + _BSD_3 + _BSD_END,
    "GPL-2.0-only-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "ISC-full": NOTICES["ISC"] + _ISC_END,
    "MIT-full": NOTICES["MIT-text"] + _MIT_END,
    "Unlicense-full": NOTICES["Unlicense"] + (
        " Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
        " In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain."
        " We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors."
        " We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."
        " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
        " IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}

# whole licences, kept as files of the package
for _mark in ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"):
    NOTICES[f"{_mark}-full"] = pkgutil.get_data(__package__, f"licence_texts/{_mark}.txt").decode("ascii")


class Notices:
    """Bigram sets of the notices, by bigram."""

    def __init__(self, notices: dict[str, str]):
        self.names = sorted(notices)
        raw, offsets = text_bytes(pa.array([notices[n] for n in self.names], pa.large_string()))
        words = Words(raw, offsets, ALNUM, lower=True)
        pairs = windows(words.hashes(), 2)
        inside = words.doc[: len(pairs)] == words.doc[1:] if len(pairs) else np.zeros(0, dtype=bool)
        own = sorted({(int(h), int(d)) for h, d in zip(pairs[inside], words.doc[: len(pairs)][inside])})
        self.bigrams = np.array([h for h, _ in own], dtype=np.uint64)
        self.owner = np.array([d for _, d in own], dtype=np.int64)
        self.words = words.per_doc
        self.sizes = np.bincount(self.owner, minlength=len(self.names)) if own else np.zeros(len(self.names), dtype=np.int64)
        # owners of known[i] are owner[first_owner[i] : first_owner[i] + n_owners[i]]
        self.known, self.first_owner, self.n_owners = np.unique(self.bigrams, return_index=True, return_counts=True)


def _segments(body: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the text, its paragraphs and its lines; equal ranges once."""
    out = {(0, len(body))}
    at = 0
    for part in body.split(b"\n\n"):
        out.add((at, at + len(part)))
        at += len(part) + 2
    at = 0
    for line in body.split(b"\n"):
        out.add((at, at + len(line)))
        at += len(line) + 1
    return sorted(out)


def _possible(doc: np.ndarray, gram: np.ndarray, notices: Notices, fewest: np.ndarray) -> dict[int, list[int]]:
    """Notices of which a document has enough different bigrams, by document; gram is the number in notices.known."""
    n = len(notices.known)
    if not len(doc):
        return {}
    seen = np.unique(doc.astype(np.int64) * n + gram)
    many = notices.n_owners[seen % n]
    place = np.repeat(notices.first_owner[seen % n] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
    pair, count = np.unique(np.repeat(seen // n, many) * len(notices.names) + notices.owner[place], return_counts=True)
    out: dict[int, list[int]] = {}
    for p in pair[count >= fewest[pair % len(notices.names)]].tolist():
        out.setdefault(p // len(notices.names), []).append(p % len(notices.names))
    return out


def _before(grams: np.ndarray) -> np.ndarray:
    """The place of the same bigram before each place, -1 for none."""
    order = np.argsort(grams, kind="stable")
    out = np.full(len(grams), -1, dtype=np.int64)
    again = grams[order[1:]] == grams[order[:-1]]
    out[order[1:][again]] = order[:-1][again]
    return out


def _different(places: np.ndarray, before: np.ndarray, length: int, n: int) -> np.ndarray:
    """Numbers of different bigrams at `places` in each run of `length` places of n."""
    many = n - length + 1
    change = np.zeros(many + 1, dtype=np.int64)
    # a place is its bigram's first in the runs that begin behind the one before
    first, last = np.maximum(before[places] + 1, places - length + 1), np.minimum(places, many - 1)
    some = first <= last
    np.add.at(change, first[some], 1)
    np.add.at(change, last[some] + 1, -1)
    return np.cumsum(change[:-1])


def _window_scores(grams: np.ndarray, before: np.ndarray, member: np.ndarray, length: int, size: int, fewest: int) -> np.ndarray:
    """The coefficients of all runs of `length` bigrams with a notice of `size` (none if no run can have enough); member: the notice has the bigram."""
    places = np.flatnonzero(member)
    if length < 1 or len(grams) <= length or len(places) < fewest or (places[fewest - 1 :] - places[: len(places) - fewest + 1]).min() >= length:
        return np.zeros(0)
    common = _different(places, before, length, len(grams))
    return 2.0 * common / (_different(np.arange(len(grams)), before, length, len(grams)) + size)


def _best_window(grams: np.ndarray, before: np.ndarray, member: np.ndarray, length: int, size: int, fewest: int) -> float:
    """The best coefficient of the runs of `length` bigrams."""
    return float(_window_scores(grams, before, member, length, size, fewest).max(initial=0.0))


def _peaks(scores: np.ndarray, least: float, reach: int) -> np.ndarray:
    """Places that score at least `least` and no less than any place within `reach`."""
    width = 2 * reach + 1
    padded = np.full(-(-(len(scores) + 2 * reach) // width) * width, -1.0)
    padded[reach : reach + len(scores)] = scores
    blocks = padded.reshape(-1, width)
    head = np.maximum.accumulate(blocks, axis=1).ravel()
    tail = np.maximum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    at = np.arange(len(scores))
    return np.flatnonzero((scores >= least) & (scores >= np.maximum(tail[at], head[at + width - 1])))


def standing(matches: list[tuple[int, int, float]]) -> np.ndarray:
    """Which of the matches (first word, end, coefficient) stand: none better shares more than half of the shorter one's words."""
    if not matches:
        return np.zeros(0, dtype=bool)
    start, end, dice = (np.array(c) for c in zip(*matches))
    order = np.argsort(start, kind="stable")
    # matches of different groups share no word
    groups = np.flatnonzero(start[order][1:] >= np.maximum.accumulate(end[order])[:-1]) + 1
    out = np.ones(len(matches), dtype=bool)
    for own in np.split(order, groups):
        for i in own.tolist():
            shared = np.minimum(end[own], end[i]) - np.maximum(start[own], start[i])
            shorter = np.minimum(end[own] - start[own], end[i] - start[i])
            out[i] = not ((dice[own] > dice[i]) & (2 * shared > shorter)).any()
    return out


def _matches(raw, offsets, notices: Notices, least: float):
    """(document, notice, best coefficient, number of parts) over the standing matches of some documents."""
    words = Words(raw, offsets, ALNUM, lower=True)
    pairs = windows(words.hashes(), 2)
    inside = np.zeros(len(pairs), dtype=bool)
    if len(pairs):
        inside = words.doc[: len(pairs)] == words.doc[1:]
    at = np.searchsorted(notices.known, pairs)
    at[at == len(notices.known)] = 0
    hit = inside & (notices.known[at] == pairs) if len(notices.known) else np.zeros(len(pairs), dtype=bool)
    out: list[tuple[int, int, float, int]] = []
    # a document can reach a notice only with c >= t (size + notice) / 2 common bigrams, size >= c
    fewest = np.maximum(1, np.ceil(least / (2 - least) * notices.sizes - 1e-9)).astype(np.int64)
    for d, kinds in _possible(words.doc[: len(pairs)][hit], at[hit], notices, fewest).items():
        lo, hi = int(words.first[d]), int(words.first[d + 1])
        begin = int(words.offsets[d])
        starts, ends = words.starts[lo:hi], words.ends[lo:hi]
        mine = np.isin(notices.owner, kinds)
        own, owner = notices.bigrams[mine], notices.owner[mine]
        own_hits = np.flatnonzero(np.isin(pairs[lo : hi - 1], own)) + lo
        enough = fewest[kinds].min()
        matches: list[tuple[int, int, float]] = []
        named: list[tuple[int, bool]] = []  # notice, whether a part
        for a, b in _segments(raw[offsets[d] : offsets[d + 1]].tobytes()):
            first = lo + int(np.searchsorted(starts, begin + a))
            last = lo + int(np.searchsorted(ends, begin + b, side="right"))
            if np.searchsorted(own_hits, last - 1) - np.searchsorted(own_hits, first) < enough:
                continue
            segment = np.unique(pairs[first : last - 1])
            size = len(segment)
            fits = (least * size <= (2 - least) * notices.sizes) & (least * notices.sizes <= (2 - least) * size)
            if not fits[kinds].any():
                continue
            common = Counter(owner[np.isin(own, segment)].tolist())
            for k, n in common.items():
                if fits[k] and 2.0 * n / (size + int(notices.sizes[k])) >= least:
                    matches.append((first, last, 2.0 * n / (size + int(notices.sizes[k]))))
                    named.append((k, True))
        grams = pairs[lo : hi - 1]
        before = _before(grams)
        for k in kinds:
            many = int(notices.words[k])
            scores = _window_scores(grams, before, np.isin(grams, own[owner == k]), many - 1, int(notices.sizes[k]), int(fewest[k]))
            for s in _peaks(scores, least, (many - 1) // 2).tolist() if len(scores) else []:
                matches.append((lo + s, lo + s + many, float(scores[s])))
                named.append((k, False))
        best: dict[int, list] = {}
        for (k, part), (_, _, dice), stands in zip(named, matches, standing(matches).tolist()):
            if stands:
                now = best.setdefault(k, [0.0, 0])
                best[k] = [max(now[0], dice), now[1] + part]
        out += [(d, k, dice, n) for k, (dice, n) in sorted(best.items())]
    return out


def scan_licences(docs: DataFrame, *, key: str = "doc_id", text: str = "text", notices: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """(key, licence, dice, n_parts): one row per document and notice that a part or window of the text matches best.

    A match is a part or window with a coefficient of at least `least`.  It stands if no better match shares more than half of
    the shorter one's words, so of notices that differ in a word only the printed one is named; equally good ones are all named.
    dice is the best coefficient of the standing matches, n_parts the number of parts among them (0: only windows).  Words are ASCII letters (case
    folded), digits and all characters beyond ASCII.  Null, empty and one-word texts match nothing; repeated rows match
    each for itself; other columns of docs are not read; an empty table or no notices give an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Notices(NOTICES if notices is None else notices))
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField(key, given.schema["key"].dataType), T.StructField("licence", T.StringType()), T.StructField("dice", T.DoubleType()), T.StructField("n_parts", T.LongType())])

    def run(batches):
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            rows = []
            for i, j in pieces(offsets):
                rows += [(d + i, k, best, n) for d, k, best, n in _matches(raw, offsets[i : j + 1], shared.value, least)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array([r[0] for r in rows], pa.int64())), pa.array([shared.value.names[r[1]] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.int64())],
                names=[key, "licence", "dice", "n_parts"],
            )

    return given.mapInArrow(run, schema)
