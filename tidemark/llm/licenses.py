"""License scans: MinHash bands over overlapping windows, then exact shingle containment."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shingles, utf8, word_bounds, word_hashes

K = 5
CONTAINED = 0.8
#: Chance that a contained template meets no band.
MISSED = 0.001

# Fixed texts: what the bodies of the MIT and ISC families share.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so"
)
_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted"
)
_ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING '
    "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
    "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
    "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
    "USE OR PERFORMANCE OF THIS SOFTWARE."
)

#: Fixed texts: usual notices of public licenses and bodies of the short ones, by SPDX id.
NOTICES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted",
    ),
    *(
        (name, f"it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, either {version}")
        for name, kind, number in (
            ("GPL-1.0", "", "1"),
            ("GPL-2.0", "", "2"),
            ("GPL-3.0", "", "3"),
            ("LGPL-2.0", "Library ", "2"),
            ("LGPL-2.1", "Lesser ", "2.1"),
            ("LGPL-3.0", "Lesser ", "3"),
            ("AGPL-3.0", "Affero ", "3"),
        )
        for version in (
            f"version {number} of the License, or (at your option) any later version.",
            f"version {number}, or (at your option) any later version.",
        )
        if (name, version[:14]) not in (("GPL-2.0", "version 2 of t"), ("GPL-3.0", "version 3 of t"))
    ),
    *(
        (name, f"{work} licensed under the {before}GNU {kind}General Public License{after}.")
        for name, kind, number in (
            ("GPL-2.0", "", "2"),
            ("GPL-3.0", "", "3"),
            ("LGPL-2.1", "Lesser ", "2.1"),
            ("LGPL-3.0", "Lesser ", "3"),
            ("AGPL-3.0", "Affero ", "3"),
        )
        for work, before, after in (
            ("This work is", "", f", version {number}"),
            ("This program is", "terms of the ", f", version {number}"),
        )
        if (name, before) != ("GPL-3.0", "")
    ),
    (
        "GPL-2.0",
        "it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    ),
    (
        "GPL-3.0",
        "it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation.",
    ),
    (
        "BSD-2-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS",
    ),
    *(
        (
            "BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            f"that the following conditions are met: {one} Redistributions of source code must retain the above "
            f"copyright notice, this list of conditions and the following disclaimer. {two} Redistributions in binary "
            "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
            f"the documentation and/or other materials provided with the distribution. {three} Neither the name of the "
            "copyright holder nor the names of its contributors may be used to endorse or promote products derived "
            "from this software without specific prior written permission.",
        )
        for one, two, three in (("1.", "2.", "3."), ("a.", "b.", "c."), ("i.", "ii.", "iii."), ("*", "*", "*"), ("-", "-", "-"), ("o", "o", "o"), ("", "", ""))
    ),
    (
        "BSD-3-Clause",
        "nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Zlib",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
        "to alter it and redistribute it freely, subject to the following restrictions",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    *(
        (name, f"{_MIT_GRANT}{condition} {_MIT_WARRANTY}")
        for name, condition in (
            (
                "MIT",
                ", subject to the following conditions: The above copyright notice and this permission notice shall be "
                "included in all copies or substantial portions of the Software.",
            ),
            ("MIT-0", "."),
        )
    ),
    *(
        (name, f"{_ISC_GRANT}{condition} {_ISC_WARRANTY}")
        for name, condition in (
            ("ISC", ", provided that the above copyright notice and this permission notice appear in all copies."),
            ("0BSD", "."),
        )
    ),
)

_PLAIN = bytes.maketrans(b",.;:()\"'", b"        ")


def normal(text: bytes) -> bytes:
    """Lower-case letters, punctuation as blanks; every byte keeps its place."""
    return text.lower().translate(_PLAIN)


def bands(contained: float = CONTAINED, missed: float = MISSED) -> int:
    """Single-row bands needed by the least alike window.

    A template of n shingles is looked for in windows of two blocks of s shingles, s the next
    power of two, so that an occurrence lies within one window whole. Then at least
    ``contained * n`` of at most ``2 s + n (1 - contained)`` shingles are shared, and s < 2 n.
    """
    alike = contained / (4 + (1 - contained))
    return math.ceil(math.log(missed) / math.log(1 - alike))


class BandIndex:
    """Templates by band and minimum: a table of the minima's low bits lets most windows pass,
    the others are searched in the sorted minima. All bands are looked up at once."""

    BITS = np.uint64((1 << 12) - 1)

    def __init__(self, minima: np.ndarray, members: Sequence[int]) -> None:
        count, n = minima.shape
        order = np.argsort(minima, axis=None, kind="stable")
        self.values = minima.ravel()[order]
        self.bands = order // n
        self.members = np.asarray(members)[order % n]
        self.start = (np.arange(count, dtype=np.uint64) * (self.BITS + np.uint64(1)))[:, None]
        self.seen = np.zeros(count * (int(self.BITS) + 1), bool)
        self.seen[self._slots(minima)] = True

    def _slots(self, minima: np.ndarray) -> np.ndarray:
        return ((minima & self.BITS) + self.start).view(np.int64)

    def lookup(self, windows: np.ndarray) -> Iterator[tuple[int, int]]:
        """Template and window of each shared minimum; ``windows`` holds a row per band."""
        may = np.flatnonzero(self.seen[self._slots(windows)])
        if not len(may):
            return
        band, at = np.divmod(may, windows.shape[1])
        x = windows[band, at]
        first, end = np.searchsorted(self.values, x), np.searchsorted(self.values, x, side="right")
        some = end > first
        for band, at, a, b in zip(*(c[some].tolist() for c in (band, at, first, end))):
            for i in range(a, b):
                if self.bands[i] == band:
                    yield int(self.members[i]), at


class Templates:
    """Shingles and minima of each template, by block size."""

    def __init__(self, texts: Sequence[tuple[str, str]], contained: float = CONTAINED) -> None:
        self.contained = contained
        self.keys = np.random.default_rng(9).integers(0, 1 << 63, bands(contained), dtype=np.uint64)
        self.names: list[str] = []
        self.grams: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.by_block: dict[int, list[int]] = {}
        for name, text in texts:
            grams, places = np.unique(shingles(word_hashes(normal(text.encode())), K), return_index=True)
            if len(grams):
                block = 1 << (len(grams) - 1).bit_length()
                self.by_block.setdefault(block, []).append(len(self.names))
                self.names.append(name)
                self.grams.append(grams)
                self.places.append(places)
        self.index = {
            block: BandIndex(np.stack([self.hashed(self.grams[i]).min(axis=1) for i in members], axis=1), members)
            for block, members in self.by_block.items()
        }

    def hashed(self, grams: np.ndarray) -> np.ndarray:
        h = (grams[None, :] ^ self.keys[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))

    def retrieved(self, grams: np.ndarray) -> dict[int, set[tuple[int, int]]]:
        """Windows, as shingle ranges, in which each template may lie. Blocks double from size
        to size, so each shingle is hashed once a band."""
        found: dict[int, set[tuple[int, int]]] = {}
        if not len(grams) or not self.by_block:
            return found
        step = 1 << 15
        low = np.concatenate([self.hashed(grams[at : at + step]) for at in range(0, len(grams), step)], axis=1)
        block = 1
        while True:
            if block in self.by_block:
                last = max(low.shape[1] - 1, 1)
                for left in range(0, last, step):
                    right = min(last, left + step)
                    window = low[:, left:right]
                    if low.shape[1] > 1:
                        window = np.minimum(window, low[:, left + 1 : right + 1])
                    for member, at in self.index[block].lookup(window):
                        first = (left + at) * block
                        found.setdefault(member, set()).add((first, min(len(grams), first + 2 * block)))
            if block >= max(self.by_block):
                return found
            if low.shape[1] % 2:
                low = np.concatenate([low, np.full((len(low), 1), np.iinfo(np.uint64).max, np.uint64)], axis=1)
            low = np.minimum(low[:, ::2], low[:, 1::2])
            block *= 2

    def matches(self, text: bytes) -> list[tuple[str, int, int, float]]:
        """License, first and end byte, and the share of the template's shingles found.

        A match starts and ends at a shingle of the template that is nowhere else in it and
        reaches over at most 1.25 times its length; matches of one template do not overlap, of
        several that cover each other with the same license one stays, and of different
        licenses at one place those with the most shingles in the template's order.
        """
        plain = normal(text)
        _, starts, ends = word_bounds(plain)
        if not len(starts):
            return []
        grams = shingles(word_hashes(plain), K)
        out: set[tuple[str, int, int, float, int]] = set()
        for member, windows in self.retrieved(grams).items():
            own = self.grams[member]
            inside = np.unique(np.concatenate([np.arange(a, b) for a, b in windows]))
            places = inside[np.isin(grams[inside], own)]
            for at, to, new, rising in self._placed(member, grams, places):
                last = min(int(places[to - 1]) + K, len(ends)) - 1
                out.add((self.names[member], int(starts[places[at]]), int(ends[last]), new / len(own), rising))
        kept = _strongest(out)
        return sorted({m[:4] for m in kept}, key=lambda m: (m[1], m[2], m[0]))

    def _placed(self, member: int, grams: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """First and end of each match as positions in ``places``, its distinct shingles and those
        in order."""
        own = self.grams[member]
        reach, enough = math.ceil(1.25 * len(own)), self.contained * len(own)
        parts = [(0, len(places))]
        while parts:
            i, hi = parts.pop()
            if hi - i < enough:
                continue
            if len(np.unique(grams[places[i : self._end(places, i, hi, reach)]])) < enough:
                parts.append((i + 1, hi))
                continue
            # shingles before and after a notice may be its own as well: of all starts within
            # reach take that with the most in order, then at all, then in the least space, and end
            # with the last new one; look again from there, as a better one may be in its reach
            best, at, to, k, j = (0, 0, 0), i, i, i, self._end(places, i, hi, reach)
            while k < j:
                _, new = np.unique(grams[places[k : self._end(places, k, hi, reach)]], return_index=True)
                end = k + int(new.max()) + 1
                wide = int(places[end - 1] - places[k])
                held = (_rising(self.places[member][np.searchsorted(own, grams[places[k:end]])]), len(new), -wide)
                if held > best and len(new) >= enough:
                    best, at, to = held, k, end
                    j = self._end(places, k, hi, reach)
                k += 1
            yield at, to, best[1], best[0]
            # what lies before may be a weaker match of its own
            parts += [(to, hi), (i, at)]

    @staticmethod
    def _end(places: np.ndarray, at: int, hi: int, reach: int) -> int:
        return min(hi, int(np.searchsorted(places, places[at] + reach)))


def _rising(places: np.ndarray) -> int:
    """Length of the longest rising run of places, others left out."""
    tails: list[int] = []
    for p in places.tolist():
        i = bisect_left(tails, p)
        tails[i : i + 1] = [p]
    return len(tails)


def _strongest(found: set[tuple[str, int, int, float, int]]) -> list[tuple[str, int, int, float, int]]:
    """Matches from most to least shingles in order, without those that overlap a kept one of the
    same license, or share most of their place with kept ones of other licenses which have more,
    or as many and the larger share, or most of the place of one. Only matches of one stretch
    that they cover without a gap are compared."""
    kept: list[tuple[str, int, int, float, int]] = []
    stretch: list[tuple[str, int, int, float, int]] = []
    reach = 0
    for m in sorted(found, key=lambda m: (m[1], m[2], m[0])):
        if m[1] >= reach:
            kept += _settled(stretch)
            stretch = []
        stretch.append(m)
        reach = max(reach, m[2])
    return kept + _settled(stretch)


def _settled(stretch: list[tuple[str, int, int, float, int]]) -> list[tuple[str, int, int, float, int]]:
    kept: list[tuple[str, int, int, float, int]] = []
    for m in sorted(stretch, key=lambda m: (-m[4], -m[3], m[1] - m[2], m[1], m[0])):
        over = [(k, min(k[2], m[2]) - max(k[1], m[1])) for k in kept if k[1] < m[2] and m[1] < k[2]]
        other = [(k, n) for k, n in over if k[0] != m[0] and (k[4], k[3]) > (m[4], m[3])]
        same = any(k[0] == m[0] for k, _ in over)
        if not same and 2 * sum(n for _, n in other) <= m[2] - m[1] and all(2 * n <= k[2] - k[1] for k, n in other):
            kept.append(m)
    return kept


def scan(docs: DataFrame, texts: Sequence[tuple[str, str]] = NOTICES, contained: float = CONTAINED) -> DataFrame:
    """Every license notice in every whole text: doc_id, license, first, end, share.

    ``texts`` are (license, template) pairs; they are broadcast, so keep them to some thousand
    notices. Places are code points, ends exclusive. Case and light punctuation do not count; a
    template of fewer than five words is one shingle. Documents without a match, null and empty
    texts have no row; repeated rows repeat their matches; an empty table or no templates give
    an empty result. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Templates(texts, contained))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                found = shared.value.matches(text)
                # code points before each byte: all bytes but those that continue one
                before = np.cumsum(np.frombuffer(text, np.uint8) & 0xC0 != 0x80) if found else None
                for name, first, end, share in found:
                    rows.append((doc_id, name, int(before[first]) - 1, int(before[end - 1]), share))
            columns = list(zip(*rows)) or [[], [], [], [], []]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "license", "first", "end", "share"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, license string, first long, end long, share double")
