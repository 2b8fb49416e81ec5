"""License scan by winnowed fingerprints and banded alignment.

Every run of ``gram`` words is hashed; of each ``window`` runs in a row the smallest hashes are kept, so a document
and a template that share ``gram + window - 1`` words in a row share a fingerprint.  An inverted index of the templates'
fingerprints gives candidates: a template, and the diagonal on which it would lie in the document.  Around each
diagonal a local alignment within a band then counts the template's words that the document has in order.

The templates are a parameter and small beside any corpus; they go to the tasks, and documents are never shuffled.

Defined cases: words are lower-cased runs of letters, digits and underscores; a template of fewer words than a run is
one run as it stands; null, empty and wordless texts match nothing; of alignments of one template that overlap, the
one with most matched words, then the first, is reported, and the words beside it are aligned again; repeated rows are
each scanned.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame

from shelfcast.llm.common import texts

GRAM = 3
WINDOW = 3
BAND = 8
COVERAGE = 0.8

#: Public licenses' notices and permission paragraphs; ``-text`` is the beginning of a long license's own text.
TEMPLATES: dict[str, str] = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
        in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS
        OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
        limitations under the License.""",
    "MIT-line": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all copies
        or substantial portions of the Software.""",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-2.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, either version 2 of the License,
        or (at your option) any later version.""",
    "LGPL-2.1-or-later": """This library is free software; you can redistribute it and/or modify it under the terms of
        the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License,
        or (at your option) any later version.""",
    "LGPL-3.0-or-later": """This library is free software; you can redistribute it and/or modify it under the terms of
        the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version.""",
    "AGPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version.""",
    "GPL-2.0-only": """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, version 2 of the License.""",
    "GPL-3.0-only": """This program is free software: you can redistribute it and/or modify it under the terms of
        the GNU General Public License as published by the Free Software Foundation, version 3 of the License.""",
    "GPL-2.0-text": """GNU General Public License Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.
        Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not
        allowed.""",
    "GPL-3.0-text": """GNU General Public License Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.
        Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not
        allowed.""",
    "LGPL-2.1-text": """GNU Lesser General Public License Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc.
        Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not
        allowed.""",
    "LGPL-3.0-text": """GNU Lesser General Public License Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.
        Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not
        allowed.""",
    "AGPL-3.0-text": """GNU Affero General Public License Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc.
        Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not
        allowed.""",
    "Apache-2.0-text": """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR
        USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use,
        reproduction, and distribution as defined by Sections 1 through 9 of this document.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "MPL-2.0-text": """Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal
        entity that creates, contributes to the creation of, or owns Covered Software.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy
        at http://www.boost.org/LICENSE_1_0.txt)""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce
        the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
        other materials provided with the distribution. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior
        written permission.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use
        this software for any purpose, including commercial applications, and to alter it and redistribute it freely,
        subject to the following restrictions""",
    "CC0-1.0": """To the extent possible under law, the author has waived all copyright and related or neighboring rights
        to this work.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
        for any purpose, commercial or non-commercial, and by any means.""",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0": """This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0
        International License.""",
    "CC-BY-NC-ND-4.0": """This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0
        International License.""",
}

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def run_hashes(words: list[str], gram: int = GRAM):
    """A hash of each run of ``gram`` words."""
    import numpy as np

    coded = "\n".join(words).encode("utf-8", "replace").split(b"\n") if words else []
    codes = np.fromiter(map(zlib.crc32, coded), np.uint64, len(coded))
    size = min(gram, len(codes))
    out = np.zeros(len(codes) - size + 1 if size else 0, np.uint64)
    for i in range(size):
        out = (out + codes[i : i + len(out)] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(32))


def winnow(hashes, window: int = WINDOW):
    """Places whose hash is the smallest of some ``window`` in a row, ties included."""
    import numpy as np

    if len(hashes) <= window:
        return np.flatnonzero(hashes == hashes.min()) if len(hashes) else np.empty(0, np.int64)
    least = hashes[: len(hashes) - window + 1].copy()
    for i in range(1, window):
        np.minimum(least, hashes[i : i + len(least)], out=least)
    kept = np.zeros(len(hashes), bool)
    for i in range(window):
        kept[i : i + len(least)] |= hashes[i : i + len(least)] == least
    return np.flatnonzero(kept)


def align(template: list[str], words: list[str], diagonal: int, band: int = BAND) -> tuple[int, int, int] | None:
    """Best local alignment within ``band`` of the diagonal: matched words, first word and last word.

    A match scores 2, a mismatch or a word left out of either side -1.
    """
    width = 2 * band + 1
    # A cell is (score, matched, first word); cell ``c`` of row ``i`` is word ``i + diagonal + c - band``.
    none = (0, 0, -1)
    row = [none] * (width + 2)
    best, end = none, -1
    for i, term in enumerate(template):
        base = i + diagonal - band
        new = [none] * (width + 2)
        for c in range(width):
            at = base + c
            if not 0 <= at < len(words):
                continue
            score, matched, first = row[c + 1]  # the diagonal step keeps the cell's number
            if words[at] == term:
                cell = (score + 2, matched + 1, first if score > 0 else at)
            else:
                cell = (score - 1, matched, first)
            up, left = row[c + 2], new[c]
            if up[0] - 1 > cell[0]:
                cell = (up[0] - 1, *up[1:])
            if left[0] - 1 > cell[0]:
                cell = (left[0] - 1, *left[1:])
            if cell[0] > 0:
                new[c + 1] = cell
                if words[at] == term and cell[0] > best[0]:
                    best, end = cell, at
        row = new
    return (best[1], best[2], end) if end >= 0 else None


class TemplateIndex:
    """The templates' fingerprints, each with the templates and places that have it."""

    def __init__(self, templates: Mapping[str, str], gram: int = GRAM, window: int = WINDOW, band: int = BAND):
        import numpy as np

        self.gram, self.window, self.band = gram, window, band
        self.templates = [(name, words_of(text)) for name, text in sorted(templates.items()) if words_of(text)]
        found: dict[int, list[tuple[int, int]]] = {}
        for n, (_, words) in enumerate(self.templates):
            hashes = run_hashes(words, gram)
            for place in winnow(hashes, window).tolist():
                found.setdefault(int(hashes[place]), []).append((n, place))
        order = sorted(found)
        self.hashes, self.places = np.array(order, np.uint64), [found[h] for h in order]
        self.shortest = min((len(words) for _, words in self.templates), default=0)

    def matches(self, words: list[str], coverage: float, best: bool = False) -> list[tuple[int, int, int, int]]:
        """``(template, matched words, first word, last word)`` of the alignments that cover enough.

        With ``best``, of those of several templates that overlap, only the one with most matched words, then the
        best covered.
        """
        import numpy as np

        if not self.templates or len(words) < self.shortest * coverage:
            return []
        hashes = run_hashes(words, self.gram)
        kept = winnow(hashes, self.window)
        at = np.minimum(np.searchsorted(self.hashes, hashes[kept]), len(self.hashes) - 1)
        diagonals: dict[int, set[int]] = {}
        for i in np.flatnonzero(self.hashes[at] == hashes[kept]).tolist():
            for n, place in self.places[at[i]]:
                diagonals.setdefault(n, set()).add(int(kept[i]) - place)
        out = []
        for n, found in sorted(diagonals.items()):
            template, hits, last = self.templates[n][1], set(), None
            for diagonal in sorted(found):
                if last is not None and diagonal - last <= self.band // 2:
                    continue  # the band of the last one takes this diagonal in
                last = diagonal
                self._align_all(template, words, diagonal, coverage, hits)
            # What a band cut off on one side may stand whole in the next band.
            taken: list[tuple[int, int, int]] = []
            for hit in sorted(hits, key=lambda h: (-h[0], h[1], h[2])):
                if all(hit[1] > other[2] or hit[2] < other[1] for other in taken):
                    taken.append(hit)
                    out.append((n, *hit))
        if best:
            every, out = sorted(out, key=lambda x: (-x[1], len(self.templates[x[0]][1]), x[2], x[0])), []
            for hit in every:
                if all(hit[2] > other[3] or hit[3] < other[2] for other in out):
                    out.append(hit)
        return sorted(out, key=lambda x: (x[2], x[0]))

    def _align_all(self, template: list[str], words: list[str], diagonal: int, coverage: float, hits: set) -> None:
        """Adds the alignments within the band that cover enough; each takes its words from the next ones."""
        low, high = diagonal - self.band, diagonal + len(template) + self.band
        spans = [(max(0, low), min(len(words), high))]
        while spans:
            begin, end = spans.pop()
            if end - begin < coverage * len(template):
                continue
            hit = align(template, words[begin:end], diagonal - begin, self.band)
            if hit and hit[0] >= coverage * len(template):
                first, last = begin + hit[1], begin + hit[2]
                hits.add((hit[0], first, last))
                spans += [(begin, first), (last + 1, end)]


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] | None = None,
    coverage: float = COVERAGE,
    gram: int = GRAM,
    window: int = WINDOW,
    band: int = BAND,
    best: bool = False,
) -> DataFrame:
    """A row for each place where a document holds a template; with ``best``, one for places that overlap.

    ``doc_id``, ``license``, ``matched`` and ``words`` of the template, ``coverage``, and ``start`` and ``end`` in code
    points, end exclusive.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    chosen = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index = TemplateIndex(chosen, gram, window, band)
        for batch in batches:
            out = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                if hits := index.matches(words, coverage, best):
                    places = [m.span() for m in _WORD.finditer(text)]
                    if len(places) != len(words):  # lower-casing made or undid a word's border
                        places = [m.span() for m in _WORD.finditer(text.lower())]
                    for n, matched, first, last in hits:
                        name, terms = index.templates[n]
                        share = matched / len(terms)
                        out.append((row, name, matched, len(terms), share, places[first][0], places[last][1]))
            if out:
                row, *rest = zip(*out, strict=True)
                columns = [batch.column(0).take(pa.array(row, pa.int64())), *map(pa.array, rest)]
                names = ["doc_id", "license", "matched", "words", "coverage", "start", "end"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = (
        f"doc_id {kind}, license string, matched bigint, words bigint, coverage double, start bigint, end bigint"
    )
    return texts(docs).mapInArrow(run, schema)
