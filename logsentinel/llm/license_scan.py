"""License notices by MinHash bands over overlapping windows.

Texts are normalised to lower-case words without punctuation and cut into
overlapping windows of shingles.  Each size class of templates has its own
window, twice its longest template, moved on by half a window, so any passage
of a template's length lies whole in one window.  A window retrieves the
templates with which it shares a band (one MinHash value); the number of
bands of a class is set from the smallest Jaccard similarity that a passage
at the containment limit can have to its window, such that the chance to miss
it stays below ``MISS``.  Retrieved templates are verified by the exact share
of their shingles in the window.  Where templates of different licenses match
the same words, these belong to the best match, and the others have to reach
the limit without them.

The templates are a small dictionary that goes to every task.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsentinel.llm.common import pick

WORDS = 5
CONTAINMENT = 0.8
MISS = 1e-4
#: Shingles in the smallest unit from which windows are made.
UNIT = 4
#: Bytes of text, and templates, at most at once.
BLOCK = 1 << 21
MOST_TEMPLATES = 10_000
#: Values of the low bits by which most windows' values are told from all
#: templates', and places of a block that the permutations take at once.
LOW = 1 << 12
PLACES = 1 << 13

# Wordings of public license notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License"),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
)
#: Further licenses, versions and body passages.
_FURTHER = (
    ("Apache-1.1", "The Apache Software License, Version 1.1"),
    ("Apache-2.0-text", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("MIT-text", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT-short", "Licensed under the MIT License"),
    ("MIT-0-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND"),
    ("GPL-2.0-text", "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users."),
    ("GPL-3.0-text", "The licenses for most software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change all versions of a program--to make sure it remains free software for all its users."),
    ("AGPL-3.0-text", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."),
    ("LGPL-2.1-text", "This license, the Lesser General Public License, applies to some specially designated software packages--typically libraries--of the Free Software Foundation and other authors who decide to use it."),
    ("LGPL-3.0-text", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("MPL-1.1-notice", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/"),
    ("MPL-2.0-short", "Mozilla Public License, version 2.0"),
    ("EPL-1.0", "Eclipse Public License - v 1.0"),
    ("EPL-2.0", "Eclipse Public License - v 2.0"),
    ("EPL-1.0-notice", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0-notice", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("CC0-1.0-notice", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("BSL-1.0-permission", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"),
)


def _gnu() -> Iterator[tuple[str, str]]:
    """Wordings of the GNU licenses and versions."""
    for short, long in (("GPL", "General"), ("LGPL", "Lesser General"), ("AGPL", "Affero General")):
        for version in {"GPL": ("2", "3"), "LGPL": ("2.1", "3"), "AGPL": ("3",)}[short]:
            name = f"{short}-{version}" if "." in version else f"{short}-{version}.0"
            title = f"GNU {long} Public License"
            # GPL-3.0 has the first wording already.
            yield (f"{name}-title" if name == "GPL-3.0" else name), f"{title}, version {version}"
            yield f"{name}-title-v", f"{title} v{version}"
            yield f"{name}-title-of", f"version {version} of the {title}"
            for thing in ("program", "library", "software"):
                if (name, thing) != ("GPL-3.0", "program"):
                    yield f"{name}-notice-{thing}", f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."
                yield f"{name}-notice-only-{thing}", f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation; version {version} of the License."
                yield f"{name}-notice-version-{thing}", f"This {thing} is free software; you can redistribute it and/or modify it under the terms of the {title} version {version} as published by the Free Software Foundation."
    yield "LGPL-2.0-notice-library", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."


def _creative_commons() -> Iterator[tuple[str, str]]:
    parts = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
    for kind in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        long = "-".join(parts[k] for k in kind.split("-"))
        for version, area in (("4.0", "International"), ("3.0", "Unported")):
            name = f"CC-{kind}-{version}"
            old = long.replace("NoDerivatives", "NoDerivs") if version == "3.0" else long
            if name != "CC-BY-NC-4.0":
                yield f"{name}-short", f"Licensed under CC {kind} {version}"
            if name not in ("CC-BY-4.0", "CC-BY-SA-4.0"):
                yield f"{name}-long", f"Creative Commons {old} {version} {area} License"


def _bsd() -> Iterator[tuple[str, str]]:
    start = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    clauses = (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    )
    end = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    for n in (2, 3):
        yield f"BSD-{n}-Clause-text", " ".join((start, *clauses[:n], end))
        yield f"BSD-{n}-Clause-text-numbered", " ".join((start, *(f"{i + 1}. {c}" for i, c in enumerate(clauses[:n])), end))


#: All that the query looks for.
WORDINGS = (*TEMPLATES, *_FURTHER, *_gnu(), *_creative_commons(), *_bsd())
_WORDING = re.compile(r"-(?:notice|permission|text|short|long|title|tag)\b.*")


def license_of(name: str) -> str:
    """The license of a template's name: without the kind of its wording."""
    return _WORDING.sub("", name)


def license_id(name: str) -> str:
    """The license that a template's wording grants; of the GNU licenses, a
    notice tells whether later versions may be chosen."""
    license = license_of(name)
    if license.split("-")[0] in ("GPL", "LGPL", "AGPL") and "-notice" in name:
        return f"{license}-only" if "-notice-only" in name or "-notice-version" in name else f"{license}-or-later"
    return license


def _tags() -> Iterator[tuple[str, str]]:
    """The identifier lines of all licenses."""
    known = {license_id(name) for name, _ in WORDINGS}
    gnu = {x.removesuffix("-only").removesuffix("-or-later") for x in known if x.endswith(("-only", "-or-later"))}
    for license in sorted(known | {f"{x}{end}" for x in gnu for end in ("", "-only", "-or-later", "+")}):
        yield f"{license.replace('+', '-or-later')}-tag", f"SPDX-License-Identifier: {license.replace('+', ' or later') if license.endswith('+') else license}"


def _normal_table() -> bytes:
    """ASCII letters in lower case and digits stay, other ASCII becomes a
    space, bytes of other characters stay."""
    return bytes(i + 32 if 65 <= i <= 90 else i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


_NORMAL = _normal_table()


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_NORMAL).split()


def shingle_hashes(words: list[bytes], n: int = WORDS) -> np.ndarray:
    """64-bit hashes of the n-word shingles (fewer words: the whole text)."""
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    n = min(n, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ w[i : len(w) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


def bands_for(jaccard: float, miss: float = MISS) -> int:
    """Bands of one MinHash value with which a pair of that similarity is
    missed with a chance of at most ``miss``."""
    return 1 if jaccard >= 1 else math.ceil(math.log(miss) / math.log(1 - jaccard))


@dataclass
class _Class:
    """Templates of one size class: window length and step in units, bands,
    and by band the templates' values in order, whose they are, and which low
    bits a value has."""

    units: int
    bands: int
    members: list[int]
    values: np.ndarray
    owners: np.ndarray
    low: np.ndarray

    def retrieve(self, k: int, value: np.ndarray) -> Iterator[tuple[int, int]]:
        """Windows that share band k with a template, and the template."""
        some = np.flatnonzero(self.low[k][value & np.uint32(LOW - 1)])
        if not len(some):
            return
        first, end = (np.searchsorted(self.values[k], value[some], side) for side in ("left", "right"))
        for w in np.flatnonzero(first < end).tolist():
            for j in range(first[w], end[w]):
                yield int(some[w]), self.members[self.owners[k, j]]


def _passage(held: list[tuple[int, bytes]], n: int) -> list[int]:
    """Places of the n neighbouring ones with the most distinct shingles, the
    first of equals."""
    count: Counter[bytes] = Counter()
    first, best, span = 0, 0, (0, 0)
    for last, (place, part) in enumerate(held):
        count[part] += 1
        while place - held[first][0] >= n:
            count[held[first][1]] -= 1
            if not count[held[first][1]]:
                del count[held[first][1]]
            first += 1
        if len(count) > best:
            best, span = len(count), (first, last + 1)
    return [place for place, _ in held[span[0] : span[1]]]


class Scanner:
    """The templates, their classes and the permutations."""

    def __init__(self, templates: Sequence[tuple[str, str]], words: int = WORDS, containment: float = CONTAINMENT, miss: float = MISS):
        if len(templates) > MOST_TEMPLATES:
            raise ValueError(f"at most {MOST_TEMPLATES} templates")
        self.words, self.containment = words, containment
        known = [(name, words_of(text.encode())) for name, text in templates]
        known = [(name, w) for name, w in known if w]
        self.names = [name for name, _ in known]
        licenses = [license_of(name) for name in self.names]
        self.license = [licenses.index(x) for x in licenses]
        self.shingles = [np.unique(shingle_hashes(w, words)) for _, w in known]
        self.exact = [self._exact(w) for _, w in known]
        self.places = [max(len(w) - words + 1, 1) for _, w in known]
        self.short = {i: w for i, (_, w) in enumerate(known) if len(w) < words}
        self.starts: dict[bytes, list[int]] = {}
        for t, w in self.short.items():
            self.starts.setdefault(w[0], []).append(t)
        sized: dict[int, list[int]] = {}
        for i, (s, (_, w)) in enumerate(zip(self.shingles, known)):
            if len(w) >= words:
                units = -(-(len(w) - words + 1) // UNIT)
                sized.setdefault(1 << (units - 1).bit_length(), []).append(i)
        most, self.classes = 0, []
        for units, members in sorted(sized.items()):
            # A passage with the least share of the template's shingles, in a
            # window that is otherwise foreign.
            window = 2 * units * UNIT
            least = min(len(self.shingles[i]) * containment / (window + len(self.shingles[i]) * (1 - containment)) for i in members)
            self.classes.append(_Class(units, bands_for(least, miss), members, np.zeros(0), np.zeros(0), np.zeros(0)))
            most = max(most, self.classes[-1].bands)
        rng = np.random.default_rng(1)
        self.multiply = rng.integers(0, 1 << 63, most, dtype=np.uint64) << np.uint64(1) | np.uint64(1)
        for c in self.classes:
            values = np.array([[self._permuted(self.shingles[i], k).min() for i in c.members] for k in range(c.bands)], np.uint32)
            c.owners = np.argsort(values, axis=1, kind="stable")
            c.values = np.take_along_axis(values, c.owners, 1)
            c.low = np.zeros((c.bands, LOW), bool)
            c.low[np.arange(c.bands)[:, None], values & np.uint32(LOW - 1)] = True

    def _exact(self, words: list[bytes]) -> set[bytes]:
        n = min(self.words, len(words))
        return {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}

    def _permuted(self, hashes: np.ndarray, k: int) -> np.ndarray:
        x = hashes * self.multiply[k]
        return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)

    def _minima(self, flat: np.ndarray, k: int) -> np.ndarray:
        """Least permuted value of each column, as much at once as stays near
        the processor."""
        out = np.empty(flat.shape[1], np.uint32)
        x, y = np.empty((2, len(flat), PLACES), np.uint64)
        for at in range(0, flat.shape[1], PLACES):
            n = min(PLACES, flat.shape[1] - at)
            a, b = x[:, :n], y[:, :n]
            np.multiply(flat[:, at : at + n], self.multiply[k], out=a)
            np.right_shift(a, np.uint64(32), out=b)
            np.bitwise_xor(a, b, out=a)
            np.multiply(a, np.uint64(0xD6E8FEB86659FD93), out=a)
            np.minimum.reduce(a, axis=0, out=b[0])
            np.right_shift(b[0], np.uint64(32), out=out[at : at + n], casting="unsafe")
        return out

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, int, float, int, int]]:
        """``(text, template, containment, first word, end word)`` of each
        template that a text holds: its best window, the first of equals.
        Words of a better match of another license do not count; of equal
        matches the longer template is better, then the earlier one."""
        all_words, hits = self._hits(texts)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for d, some in hits.items():
            owner = np.full(len(all_words[d]), -1)
            for _, t, _, places, parts in sorted(some, key=lambda h: (-h[0], -len(self.exact[h[1]]), h[1], h[2])):
                # Shingles without a word of another license's match.
                taken = np.append(0, np.cumsum((owner >= 0) & (owner != self.license[t])))
                at = np.array(places)
                free = np.flatnonzero(taken[at + self.words] == taken[at])
                share = len({parts[i] for i in free}) / len(self.exact[t])
                if share >= self.containment:
                    # Of the window, only the passage itself takes its words.
                    for i in _passage([(int(at[i]), parts[i]) for i in free], self.places[t]):
                        owner[i : i + self.words] = self.license[t]
                    if share > best.get((d, t), (0.0, 0, 0))[0]:
                        best[d, t] = (share, int(at[free[0]]), int(at[free[-1]]) + self.words)
        # A template shorter than a shingle is found as a whole.
        for d, words in enumerate(all_words):
            for t, at in self._short_places(words):
                if best.get((d, t), (0.0, 0, 0))[0] < 1:
                    best[d, t] = (1.0, at, at + len(self.short[t]))
        return [(d, t, *v) for (d, t), v in sorted(best.items())]

    def _short_places(self, words: list[bytes]) -> list[tuple[int, int]]:
        """Templates shorter than a shingle that the words hold, and where, in
        order of both: looked up where a template's first word stands."""
        held = []
        for first in self.starts.keys() & set(words):
            at = -1
            for _ in range(words.count(first)):
                at = words.index(first, at + 1)
                held += [(t, at) for t in self.starts[first] if words[at : at + len(self.short[t])] == self.short[t]]
        return sorted(held)

    def _hits(self, texts: list[bytes | None]) -> tuple[list[list[bytes]], dict[int, list[tuple[float, int, int, list[int], list[bytes]]]]]:
        """The words of each text, and by text the verified windows: share of
        the passage, template, first word, places and shingles held."""
        all_words = [words_of(t) for t in texts]
        hashes = [shingle_hashes(w, self.words) if len(w) >= self.words else np.zeros(0, np.uint64) for w in all_words]
        # Texts side by side, each filled up to whole units by its last
        # shingle, which changes no minimum.
        units = np.array([-(-len(h) // UNIT) for h in hashes], np.int64)
        first = np.cumsum(units) - units
        total = int(units.sum())
        found: set[tuple[int, int, int, int]] = set()
        if total and self.classes:
            flat = np.concatenate([np.concatenate([h, np.full(u * UNIT - len(h), h[-1])]) if len(h) else h for h, u in zip(hashes, units.tolist())])
            flat = np.ascontiguousarray(flat.reshape(total, UNIT).T)
            doc = np.repeat(np.arange(len(texts)), units)
            place = np.arange(total) - first[doc]
            # A window is two blocks of its class, of one text; each block is
            # some blocks of the class before.
            spans, before = [], np.arange(total)
            for c in self.classes:
                start = np.flatnonzero(place % c.units == 0)
                end = np.minimum(start + 2 * c.units, (first + units)[doc[start]])
                spans.append((start, end, np.searchsorted(before, start), np.flatnonzero(doc[start[1:]] == doc[start[:-1]])))
                before = start
            for k in range(len(self.multiply)):
                block = self._minima(flat, k)
                used = max(i for i, c in enumerate(self.classes) if k < c.bands) + 1
                for c, (start, end, joined, pairs) in zip(self.classes[:used], spans):
                    if len(joined) < len(block):
                        block = np.minimum.reduceat(block, joined)
                    if k < c.bands:
                        value = block.copy()
                        value[pairs] = np.minimum(block[pairs], block[pairs + 1])
                        for w, t in c.retrieve(k, value):
                            d = int(doc[start[w]])
                            found.add((d, t, int(start[w] - first[d]) * UNIT, int(end[w] - first[d]) * UNIT))
        hits: dict[int, list[tuple[float, int, int, list[int], list[bytes]]]] = {}
        for d, t, lo, hi in sorted(found):
            words = all_words[d][lo : min(hi, len(hashes[d])) + self.words - 1]
            held = [(i, x) for i in range(len(words) - self.words + 1) if (x := b" ".join(words[i : i + self.words])) in self.exact[t]]
            share = len({x for _, x in held}) / len(self.exact[t])
            if share >= self.containment:
                at = set(_passage(held, self.places[t]))
                tight = len({x for i, x in held if i in at}) / len(self.exact[t])
                hits.setdefault(d, []).append((tight, t, lo, [lo + i for i, _ in held], [x for _, x in held]))
        return all_words, hits

    def passages(self, texts: list[bytes | None]) -> list[tuple[int, int, float, int, int]]:
        """``(text, template, containment, first word, end word)`` of every
        passage: the matches that explain most shingles come first (of equals
        the fuller, then the earlier template and place), and a word belongs
        to one match only; what is left of others has to reach the limit
        without it."""
        all_words, hits = self._hits(texts)
        for d, words in enumerate(all_words):
            for t, at in self._short_places(words):
                hits.setdefault(d, []).append((1.0, t, at, [at], [b" ".join(self.short[t])]))
        out = []
        for d, some in sorted(hits.items()):
            owned = np.zeros(len(all_words[d]) + 1, np.int64)

            def left(t: int, places: list[int], parts: list[bytes]) -> tuple[float, list[tuple[int, bytes]], float]:
                """Share of the template that is left, where, and how much it explains."""
                width = min(self.words, len(parts[0].split(b" ")))
                taken = np.append(0, np.cumsum(owned[:-1]))
                held = [(i, x) for i, x in zip(places, parts) if taken[i + width] == taken[i]]
                n = len({x for _, x in held})
                return n / len(self.exact[t]), held, n * width / self.words

            # Lazily greedy: what a match explains only shrinks as others take
            # their words, so one that still explains the most is chosen.
            heap = []
            for _, t, lo, places, parts in some:
                share, _, explained = left(t, places, parts)
                heap.append((-explained, -share, t, lo, places, parts))
            heapq.heapify(heap)
            while heap:
                key, full, t, lo, places, parts = heapq.heappop(heap)
                share, held, explained = left(t, places, parts)
                if share < self.containment:
                    continue
                if -explained > key:
                    heapq.heappush(heap, (-explained, -share, t, lo, places, parts))
                    continue
                at = _passage(held, self.places[t])
                width = min(self.words, len(parts[0].split(b" ")))
                for i in at:
                    owned[i : i + width] = 1
                out.append((d, t, share, at[0], at[-1] + width))
                # The window may hold the wording once more.
                heapq.heappush(heap, (key, full, t, lo, places, parts))
        return out


#: The wordings and identifier lines that `notices` looks for.
NOTICES = (*WORDINGS, *dict(_tags()).items())


def notices(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = NOTICES, words: int = WORDS, containment: float = CONTAINMENT, miss: float = MISS
) -> DataFrame:
    """``documents`` → ``(doc_id, license, wording, containment, first_word,
    end_word)``: one row per notice in a text, with its license (see
    `license_id`) and the best wording; a text that repeats a notice has a row
    for each.  Nulls, empty texts, repeated rows and empty tables are as in
    `scan_licenses`."""
    found = _scanned(docs, Scanner(templates, words, containment, miss), Scanner.passages)
    names = {name: license_id(name) for name, _ in templates}
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return found.select("doc_id", lookup[F.col("license")].alias("license"), F.col("license").alias("wording"), "containment", "first_word", "end_word")


def scan_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = WORDINGS, words: int = WORDS, containment: float = CONTAINMENT, miss: float = MISS
) -> DataFrame:
    """``documents`` → ``(doc_id, license, containment, first_word,
    end_word)``: one row per input row and template of which the text holds
    at least ``containment`` of the shingles in one window (words numbered
    from 0, end exclusive; the best window, the first of equals).  Words of a
    better match of another license do not count (see `Scanner.scan`).

    Null and empty texts hold nothing; null ids stay; repeated rows give
    equal rows; templates without a word are left out, no templates or an
    empty table give no rows; other columns are ignored.
    """
    return _scanned(docs, Scanner(templates, words, containment, miss), Scanner.scan)


def _scanned(docs: DataFrame, scanner: Scanner, method) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()
            at = 0
            while at < len(ids):
                end, size = at, 0
                while end < len(ids) and size < BLOCK:
                    size += len(texts[end] or b"")
                    end += 1
                hits = method(scanner, texts[at:end])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[at + h[0]] for h in hits], pa.int64()), pa.array([scanner.names[h[1]] for h in hits], pa.string()),
                        pa.array([h[2] for h in hits], pa.float64()), pa.array([h[3] for h in hits], pa.int64()), pa.array([h[4] for h in hits], pa.int64()),
                    ],
                    ["doc_id", "license", "containment", "first_word", "end_word"],
                )
                at = end

    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, license string, containment double, first_word long, end_word long"
    )
