"""License scan by patience alignment of notices with texts.

Words are runs of letters and digits, lower-cased (ASCII), compared by 64-bit hash. To align a template
with a stretch of text, equal beginnings and ends are matched first; then the words that occur once in
both become anchors, the longest increasing subsequence of their places is kept, and the gaps between are
aligned in the same way. Coverage is the share of the template's words that are matched; a stretch with at
least ``coverage`` is a match, if it also holds the words that tell the license from others (``MARKS``: version, ND,
NC, SA and the like) without a gap and none that make it another (``OTHERS``). A short notice with a word of
``DENIALS`` just before it or in it ("not licensed under …") is no match. Known are the notices of ``TEMPLATES``
and identifier lines of ``IDENTIFIERS``; full license texts are found by the notices that they hold.

Where to look: a match leaves out at most ``1 - coverage`` of the template's words, so it contains one of
any larger set of them; of the longest words such a set is taken, and only stretches around its words are
aligned. Copies of one notice next to each other are found one by one.

Null and empty texts match nothing; templates without words match nothing. Repeated rows have equal
results, an empty table none. Overlapping matches of one template count once, by coverage, then place.
Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from latentspark.llm.words import CLASSES, blocks, hash_spans, owners, spans, text_bytes

COVERAGE = 0.8
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.")


def _gnu(what: str, kind: str, version: str) -> str:
    return (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} "
            f"Public License as published by the Free Software Foundation, either version {version} of the License, "
            "or (at your option) any later version.")


# Public notices by SPDX name, fixed values.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": _BSD,
    "BSD-3-Clause": _BSD + (
        " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    "CC0-1.0-short": "Licensed under CC0 1.0.",
    "GPL-2.0-only": (
        "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    "GPL-2.0-or-later": _gnu("program", "General", "2"),
    "LGPL-2.1-or-later": _gnu("library", "Lesser General", "2.1"),
    "LGPL-3.0-or-later": _gnu("program", "Lesser General", "3"),
    "AGPL-3.0-or-later": _gnu("program", "Affero General", "3"),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."),
    "GPL-3.0-only": "This work is licensed under the GNU General Public License, version 3.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "EPL-1.0": "Licensed under the Eclipse Public License v1.0.",
    "EPL-2.0": "Made available under the terms of the Eclipse Public License 2.0",
    "EPL-2.0-short": "Licensed under the Eclipse Public License v2.0.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "LGPL-2.0-or-later": _gnu("library", "Library General", "2"),
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-Share Alike 3.0 Unported License.",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported License.",
}
_KINDS = {"NC": "NonCommercial", "ND": "NoDerivatives", "NC-SA": "NonCommercial-ShareAlike", "NC-ND": "NonCommercial-NoDerivatives"}
for _short, _long in _KINDS.items():
    TEMPLATES[f"CC-BY-{_short}-4.0"] = f"This work is licensed under a Creative Commons Attribution-{_long} 4.0 International License."
    TEMPLATES[f"CC-BY-{_short}-4.0-short"] = f"Licensed under CC BY-{_short} 4.0."
# Words that must stand in the text without a gap, for the notices of other licenses differ in them alone.
MARKS = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License version 2.0"],
    "BSD-3-Clause": ["Neither the name"],
    "BSD-2-Clause": ["binary form must reproduce"],
    "ISC": ["provided that the above copyright notice"],
    "CC0-1.0": ["waived all copyright"],
    "CC0-1.0-short": ["CC0 1.0"],
    "GPL-2.0-only": ["GNU General Public License version 2 as"],
    "GPL-2.0-or-later": ["GNU General Public License", "version 2 of the License", "any later version"],
    "LGPL-2.1-or-later": ["GNU Lesser General Public License", "version 2.1 of the License", "any later version"],
    "LGPL-3.0-or-later": ["GNU Lesser General Public License", "version 3 of the License", "any later version"],
    "AGPL-3.0-or-later": ["GNU Affero General Public License", "version 3 of the License", "any later version"],
    "GPL-3.0-or-later": ["GNU General Public License", "version 3 of the License", "any later version"],
    "GPL-3.0-only": ["GNU General Public License version 3"],
    "MPL-2.0": ["Mozilla Public License v 2.0"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0"],
    "CC-BY-4.0-short": ["CC BY 4.0"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution ShareAlike 4.0"],
    "CC-BY-SA-4.0-short": ["CC BY SA 4.0"],
} | {f"CC-BY-{s}-4.0": [f"Creative Commons Attribution {w} 4.0"] for s, w in _KINDS.items()} | {
    f"CC-BY-{s}-4.0-short": [f"CC BY {s} 4.0"] for s in _KINDS}
MARKS |= {
    "EPL-1.0": ["Eclipse Public License v1.0"], "EPL-2.0": ["Eclipse Public License 2.0"],
    "EPL-2.0-short": ["Eclipse Public License v2.0"], "BSL-1.0": ["Boost Software License version 1.0"],
    "Unlicense": ["free and unencumbered software"],
    "LGPL-2.0-or-later": ["GNU Library General Public License", "version 2 of the License", "any later version"],
    "CC-BY-SA-3.0": ["Creative Commons Attribution Share Alike 3.0"], "CC-BY-3.0": ["Creative Commons Attribution 3.0"]}
# Names in identifier lines; all words of the name must stand after the label.
IDENTIFIERS = (
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "CC0-1.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
    "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only",
    "AGPL-3.0-or-later", "MPL-2.0", "EPL-1.0", "EPL-2.0", "BSL-1.0", "Unlicense", "Zlib", "CC-BY-4.0", "CC-BY-SA-4.0")
for _name in IDENTIFIERS:
    TEMPLATES[f"{_name}-identifier"] = f"SPDX-License-Identifier: {_name}"
    MARKS[f"{_name}-identifier"] = [f"SPDX License Identifier {_name}"]
# Words that make it another license if they stand in the stretch or in the few words after it.
OTHERS = {"BSD-2-Clause": ["Neither the name"], "GPL-3.0-only": ["or later", "or any later", "any later version"],
          "MIT-identifier": ["Identifier MIT 0"]}
_AFTER = 12
# A short notice says nothing if one of these stands among the few words before it or in it.
DENIALS = ("not", "never", "no", "neither", "cannot")
_SHORT, _BEFORE = 16, 3
_WORDS = np.where(CLASSES == 1, 1, 0).astype(np.uint8)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = spans(data, offsets, _WORDS)
    return owners(offsets, starts), hash_spans(data, starts, ends)


def _rising(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence, by patience piles."""
    tops, index, back = [], [], []
    for i, p in enumerate(places):
        pile = bisect_left(tops, p)
        tops[pile:pile + 1], index[pile:pile + 1] = [p], [i]
        back.append(index[pile - 1] if pile else -1)
    out, i = [], index[-1] if index else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places of ``a`` and ``b``, rising in both."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, n = todo.pop()
        while i < j and k < n and a[i] == b[k]:
            found.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < n and a[j - 1] == b[n - 1]:
            j, n = j - 1, n - 1
            found.append((j, n))
        if i == j or k == n:
            continue
        once_a, once_b = _once(a, i, j), _once(b, k, n)
        shared = sorted((once_a[w], once_b[w]) for w in once_a.keys() & once_b.keys())
        anchors = [shared[x] for x in _rising([p for _, p in shared])]
        if anchors:
            found += anchors
            edges = [(i - 1, k - 1), *anchors, (j, n)]
            todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:])]
    return sorted(found)


def _once(words: list[int], i: int, j: int) -> dict[int, int]:
    place: dict[int, int] = {}
    for p in range(i, j):
        place[words[p]] = -1 if words[p] in place else p
    return {w: p for w, p in place.items() if p >= 0}


def _hashes(text: str) -> list[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends = spans(data, np.array([0, len(data)]), _WORDS)
    return hash_spans(data, starts, ends).tolist()


def _stands(phrase: list[int], words: list[int]) -> bool:
    return any(words[i:i + len(phrase)] == phrase for i, w in enumerate(words) if w == phrase[0])


class Templates:
    def __init__(self, texts: dict[str, str], coverage: float):
        self.coverage = coverage
        self.denials = {h for w in DENIALS for h in _hashes(w)}
        self.items = []
        for name, text in texts.items():
            data = np.frombuffer(text.encode(), np.uint8)
            starts, ends = spans(data, np.array([0, len(data)]), _WORDS)
            h = hash_spans(data, starts, ends)
            if len(h):
                spare = int((1 - coverage) * len(h) + 1e-9)
                longest = np.argsort(-(ends - starts), kind="stable")[:spare + 1]
                # All places of a chosen word help to guess where the template would start.
                places: dict[int, list[int]] = {}
                for p, w in enumerate(h.tolist()):
                    if w in h[longest]:
                        places.setdefault(w, []).append(p)
                marks, others = ([_hashes(x) for x in of.get(name, ())] for of in (MARKS, OTHERS))
                self.items.append((name, h.tolist(), places, marks, others))
        self.seeds = np.unique(np.array([w for _, _, places, *_ in self.items for w in places], np.uint64))

    def scan(self, words: np.ndarray, at: np.ndarray) -> list[tuple[str, int, int, float]]:
        """Matches ``(template, first word, last word + 1, coverage)``; ``at`` are the places of seeds."""
        found, seeds = [], list(zip(at.tolist(), words[at].tolist()))
        for name, template, places, marks, others in self.items:
            m = len(template)
            begins = sorted({p - q for p, w in seeds for q in places.get(w, ())})
            own, i = [], 0
            while i < len(begins):
                j = i
                while j < len(begins) and begins[j] - begins[i] <= m // 2:
                    j += 1
                best = (0.0, 0, 0)
                for pad in (0, m // 4 + 1, m // 2 + 1):
                    low = max(0, begins[i] - pad)
                    part = words[low:max(low, begins[j - 1] + m + pad)].tolist()
                    pairs = align(template, part)
                    if pairs and len(pairs) / m > best[0]:
                        best = (len(pairs) / m, low + pairs[0][1], low + pairs[-1][1] + 1)
                if best[0] >= self.coverage:
                    _, a, b = best
                    held, after = words[a:b].tolist(), words[a:b + _AFTER].tolist()
                    denied = m <= _SHORT and any(w in self.denials for w in words[max(0, a - _BEFORE):b].tolist())
                    if not denied and all(_stands(x, held) for x in marks) and not any(_stands(x, after) for x in others):
                        own.append(best)
                i = j
            taken: list[tuple[float, int, int]] = []
            for c, a, b in sorted(own, key=lambda x: (-x[0], x[1])):
                if all(b <= x or a >= y for _, x, y in taken):
                    taken.append((c, a, b))
            found += [(name, a, b, c) for c, a, b in taken]
        return sorted(found, key=lambda x: (x[1], x[0]))


def matches(text: Column, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> Column:
    """``array<struct<license, first_word, end_word, coverage>>`` in order of place."""
    @F.arrow_udf("array<struct<license:string,first_word:bigint,end_word:bigint,coverage:double>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()),
                                   ("coverage", pa.float64())]))
        known = Templates(templates, coverage)
        for batch in batches:
            data, offsets = text_bytes(batch)
            out: list[list] = [[] for _ in range(len(batch))]
            for i, j in blocks(offsets):
                own, h = words_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                if not len(h) or not len(known.seeds):
                    continue
                place = np.minimum(np.searchsorted(known.seeds, h), len(known.seeds) - 1)
                hits = np.flatnonzero(known.seeds[place] == h)
                for text_no in np.unique(own[hits]).tolist():
                    first, last = np.searchsorted(own, (text_no, text_no + 1))
                    mine = hits[np.searchsorted(hits, first):np.searchsorted(hits, last)] - first
                    out[i + text_no] = [dict(zip(("license", "first_word", "end_word", "coverage"), x))
                                        for x in known.scan(h[first:last], mine)]
            yield pa.array(out, made)
    return run(text)
