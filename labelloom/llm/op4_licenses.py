"""License scans by conditional compression: a block that says what a template says costs almost nothing once the template is known.

Candidate blocks are the paragraphs with a license cue: the cue's line and its neighbours up to lines without words, so wrapping and comment marks do
not matter. Around each cue lies a window as wide as a template can reach; it is compressed by zstandard alone and with every template as raw dictionary. All
pairs of window and template are ranked by the bytes that the template saves, and only those that save at least ``LEAST_SHARE`` of what
the template saves on itself go on. The winner is confirmed by its exact wording: its best stretch of the window (Sellers' dynamic program: missing and extra
words count one each, a changed word two) may differ in at most ``most_differences`` of the template's words, must hold a cue, and for a template of fewer than ``BRIEF``
words all words that are its license's alone. If it is refused, the next one in rank is asked; runners-up down to ``RUNNER_UP`` of the winner's saving are confirmed too, and of these the one that saves most on its
exact stretch wins (equal ones: fewer differences, then name). A confirmed
stretch is cut out and the words before and behind it are ranked anew, so a block may hold several notices.

Null and empty text: no blocks. Texts are scanned whole. Repeated rows get equal results; other columns pass through (a column named like an appended one is replaced).
"""
from __future__ import annotations

import bisect
import difflib
import functools
import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from labelloom.llm.common import annotate, texts

BRIEF = 16
#: Share of what a template saves on its own wording that it must save on a window to be asked for its wording.
LEAST_SHARE = 0.25
#: Runners-up are held against the winner down to this share of its saving: the words around a stretch blur the savings of windows.
RUNNER_UP = 0.8

GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, "
       "either version {} of the License, or (at your option) any later version.")
CC = "This work is licensed under a Creative Commons {} 4.0 International License."

#: Notices that name a license (name, wording): short ones, standard headers, openings of full texts, identifiers. A parameter of ``scan``.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    ("all-rights-reserved", "All rights reserved."),
    ("AGPL-3.0", GNU.format("Affero ", 3)),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-3-Clause", """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission."""),
    ("CC-BY-4.0", CC.format("Attribution")),
    ("CC-BY-NC-4.0", CC.format("Attribution-NonCommercial")),
    ("CC-BY-SA-4.0", CC.format("Attribution-ShareAlike")),
    ("GPL-2.0", GNU.format("", 2)),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", GNU.format("", 3)),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", GNU.format("Lesser ", 2.1)),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", GNU.format("Lesser ", 3)),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "MIT License"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions:"""),
    ("MIT", """The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular
        purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or
        otherwise, arising from, out of or in connection with the software or the use or other dealings in the software."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        https://mozilla.org/MPL/2.0/."""),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    *[(name, f"SPDX-License-Identifier: {name}") for name in ("Apache-2.0", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "MIT", "MPL-2.0")],
    *[(name, f"SPDX-License-Identifier: {name}{end}") for name in ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0") for end in ("", "+", "-only", "-or-later")],
)
CUE = re.compile(r"licen[sc]e|copyright|all rights reserved|warrant(?:y|ies)|redistribution and use|permission is hereby|spdx", re.I)
WORD = re.compile(r"[\w.+-]*\w")
#: Marks of comments that are words.
MARK = re.compile(r"^[ \t]*(?:rem|dnl)\b", re.I | re.M)
#: A line without words ends a paragraph.
EMPTY = re.compile(r"\n[^\w\n]*(?=\n)")
STOP = re.compile(r"[.!?:]*")


class Template:
    """Name, words, those words that a brief one's stretch must have, and how it compresses."""

    def __init__(self, name: str, text: str, others: list[list[str]]):
        self.name, self.words = name, WORD.findall(text.lower())
        self.own = set(self.words).difference(*others) if len(self.words) < BRIEF else set()
        self.z = zstandard.ZstdCompressor(level=9, write_content_size=False, dict_data=zstandard.ZstdCompressionDict(folded(text), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        raw = folded(" ".join(self.words))
        self.own_saving = len(_PLAIN.compress(raw)) - len(self.z.compress(raw))


_PLAIN = zstandard.ZstdCompressor(level=9, write_content_size=False)


@functools.lru_cache(4)
def prepared(templates: tuple[tuple[str, str], ...]) -> list[Template]:
    split = [(name, WORD.findall(text.lower())) for name, text in templates]
    return [Template(name, text, [w for other, w in split if other != name]) for name, text in templates]


def folded(text: str) -> bytes:
    return " ".join(text.lower().split()).encode()


def differences(want: list[str], have: list[str]) -> tuple[int, list[str]]:
    """How many words differ, and how: ``-word`` missing, ``+word`` extra."""
    out = []
    for op, a, b, c, d in difflib.SequenceMatcher(None, want, have, autojunk=False).get_opcodes():
        if op != "equal":
            out += [f"-{w}" for w in want[a:b]] + [f"+{w}" for w in have[c:d]]
    return len(out), out


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of paragraphs with a cue. Cues are looked for first, so texts without one cost a single pass."""
    out, done, edges = [], 0, None
    for m in CUE.finditer(text):
        if m.start() < done:
            continue
        if edges is None:
            edges = [e.span() for e in EMPTY.finditer(text)]
        at = bisect.bisect_right(edges, (m.start(), 0))
        begin, done = edges[at - 1][1] + 1 if at else 0, edges[at][0] if at < len(edges) else len(text)
        out.append((begin, done))
    return out


def aligned(words: list[str], have: list[str], most: float) -> list[tuple[int, int, int]]:
    """(differences, start, end) of the best stretch that ends at each word of ``have``, where it has at most ``most`` differences."""
    want, n, out = np.array(words, object), len(have), []
    one = np.int64(1) << 32  # a value is differences, then how far from the end the stretch begins: the later the better
    steps = np.arange(len(words) + 1) * one
    col = steps + n
    for j, w in enumerate(have):
        new = col + one
        new[0] = n - j - 1
        hit = np.flatnonzero(want == w)
        new[hit + 1] = np.minimum(new[hit + 1], col[hit])
        col = np.minimum.accumulate(new - steps) + steps
        if (cost := int(col[-1] >> 32)) <= most:
            out.append((cost, n - int(col[-1] & (one - 1)), j + 1))
    return out


def ranked(have: list[str], cues: list[int], templates: list[Template], most_differences: float) -> list[tuple[int, float, int, int, int]]:
    """(bytes saved, share of the window saved, template, low, high) of the windows of words around cues, the largest saving first."""
    plain: dict[tuple[int, int], tuple[bytes, int]] = {}
    out = []
    for number, t in enumerate(templates):
        reach = int(len(t.words) * (1 + most_differences))  # no stretch is longer
        for low, high in {(max(0, c - reach), min(len(have), c + reach + 1)) for c in cues}:
            if (low, high) not in plain:
                raw = folded(" ".join(have[low:high]))
                plain[low, high] = raw, len(_PLAIN.compress(raw))
            raw, size = plain[low, high]
            saved = size - len(t.z.compress(raw))
            if saved > 0 and saved >= LEAST_SHARE * t.own_saving:
                out.append((saved, saved / size, number, low, high))
    return sorted(out, key=lambda r: (-r[0], r[2:]))


def confirmed(have: list[str], low: int, high: int, t: Template, most_differences: float, has_cue) -> tuple[int, int, int] | None:
    """(differences, start, end) of the template's best stretch of the window, if its wording allows it."""
    found = [(n, low + a, low + b) for n, a, b in aligned(t.words, have[low:high], most_differences * len(t.words))
             if b > a and t.own.issubset(have[low + a:low + b]) and has_cue(low + a, low + b)]
    return min(found, default=None)


def stretches(block: str, templates: tuple[tuple[str, str], ...], most_differences: float) -> list[tuple[int, int, str, float, list[str]]]:
    """(start, end, license, share saved, wording differences) of the stretches that templates are found in; none overlap."""
    some = [m.span() for m in WORD.finditer(MARK.sub(lambda m: " " * len(m[0]), block))]
    words, begins = [block[a:b].lower() for a, b in some], [a for a, _ in some]
    all_cues = sorted({max(0, bisect.bisect_right(begins, m.start()) - 1) for m in CUE.finditer(block)}) if some else []
    ready, out, left = prepared(templates), [], [(0, len(words))]

    def has_cue(a: int, b: int) -> bool:
        return CUE.search(block, some[a][0], some[b - 1][1]) is not None

    while left:
        begin, end = left.pop()
        have, cues = words[begin:end], [c - begin for c in all_cues if begin <= c < end]
        best, at = None, None
        for saved, share, number, low, high in ranked(have, cues, ready, most_differences):
            if best and saved < RUNNER_UP * at:
                break
            hit = confirmed(have, low, high, ready[number], most_differences, lambda a, b: has_cue(begin + a, begin + b))
            if hit:
                at = at or saved
                raw = folded(" ".join(have[hit[1]:hit[2]]))
                row = len(ready[number].z.compress(raw)) - len(_PLAIN.compress(raw)), hit[0], ready[number].name, hit[1:], share, number
                best = min(best or row, row)
        if best:
            *_, (a, b), share, number = best
            out.append((some[begin + a][0], STOP.match(block, some[begin + b - 1][1]).end(), ready[number].name, share, differences(ready[number].words, have[a:b])[1]))
            left += [(x, y) for x, y in ((begin, begin + a), (begin + b, end)) if y > x]
    return sorted(out)


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, most_differences: float = 0.34, text: str = "text") -> DataFrame:
    """Narrow: appends n_blocks, licenses (names, comma-joined) and found (array of start, end, license, saved, differences)."""
    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        n, names, found = [], [], []
        for x in texts(batch, text):
            places = candidates(x)
            rows = []
            for a, b in places:
                rows += [{"start": a + begin, "end": a + end, "license": name, "saved": round(share, 6), "differences": " ".join(what)} for begin, end, name, share, what in stretches(x[a:b], templates, most_differences)]
            n.append(len(places))
            names.append(",".join(sorted({r["license"] for r in rows})))
            found.append(rows)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("saved", pa.float64()), ("differences", pa.string())]))
        return [pa.array(n, pa.int64()), pa.array(names, pa.string()), pa.array(found, kind)]

    row = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("license", T.StringType()), T.StructField("saved", T.DoubleType()), T.StructField("differences", T.StringType())])
    return annotate(docs, run, [T.StructField("n_blocks", T.LongType()), T.StructField("licenses", T.StringType()), T.StructField("found", T.ArrayType(row))])
