"""License scans by patience alignment.

A text's words are aligned with a template's: words that both have exactly once
are anchors, the longest increasing run of them is kept, and the gaps between
anchors are aligned the same way, first the words next to the anchors (a gap
without anchors takes its longest common run of words). Matches that stand close together in the text make a hit if they
cover enough of the template; the text before and after a hit is searched again,
so a repeated notice gives a hit each time. Copies with different edits share
the anchors, so where no matches cover enough, a long range is searched again in
overlapping windows, a short one on both sides of the widest cut between matches.

A template can only be found if the text has enough of its words, so most texts
are done after a set operation. Templates are a parameter and few; texts are
scanned whole, each on its own. Null and empty texts have no hit; repeated rows
have the same hits. Of hits that overlap, the one with more matched words stays
(ties: larger coverage, then the first by name).
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import append_columns, slices

#: Public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
}

WORD = re.compile(r"[^\W_]+")
FIELDS = "license string, coverage double, start int, end int"


def increasing(places: list[int]) -> list[int]:
    """Indices of a longest strictly increasing run of ``places`` (not necessarily adjacent)."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, p in enumerate(places):
        k = bisect_left(tails, p)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(p)
            at.append(i)
        else:
            tails[k], at[k] = p, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def longest_run(a: list[str], b: list[str], a0: int, a1: int, b0: int, b1: int) -> tuple[int, int, int]:
    """The first longest run of words that both ranges have: its starts and its length."""
    of: dict[str, list[int]] = {}
    for j in range(b0, b1):
        of.setdefault(b[j], []).append(j)
    best, ending = (a0, b0, 0), {}
    for i in range(a0, a1):
        now = {}
        for j in of.get(a[i], ()):
            n = now[j] = ending.get(j - 1, 0) + 1
            if n > best[2]:
                best = (i - n + 1, j - n + 1, n)
        ending = now
    return best


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of the words of ``a`` and ``b`` that the patience alignment matches, in order."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 and a0 < a1 and b0 < b1 and a[a0] == b[b0]:  # next to the anchor before
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a1 < len(a) and a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:  # next to the anchor after
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        single = {w for w, n in in_b.items() if n == 1 and in_a.get(w) == 1}
        if single:
            i_of = [i for i in range(a0, a1) if a[i] in single]
            j_of = {b[j]: j for j in range(b0, b1) if b[j] in single}
            kept = [(i_of[k], j_of[a[i_of[k]]]) for k in increasing([j_of[a[i]] for i in i_of])]
        else:
            i, j, n = longest_run(a, b, a0, a1, b0, b1)
            if not n:
                continue
            kept = [(i + k, j + k) for k in range(n)]
        out += kept
        for (i0, j0), (i1, j1) in zip([(a0 - 1, b0 - 1), *kept], [*kept, (a1, b1)], strict=True):
            todo.append((i0 + 1, i1, j0 + 1, j1))
    return sorted(out)


def enough(words: Counter, template: Counter, size: int, least: float) -> bool:
    """Whether so many of the template's words stand in the text that it can be covered."""
    return sum(min(n, words[w]) for w, n in template.items()) >= least * size


def scan(words: list[str], templates: dict[str, list[str]], least: float = 0.75, gap: int = 8) -> list[tuple[str, float, int, int]]:
    """Hits (name, coverage, first word, word after the last), by place."""
    present, found = set(words), []
    for name, template in templates.items():
        bag = Counter(template)
        if sum(n for w, n in bag.items() if w in present) < least * len(template):
            continue
        todo, seen, reach = [(0, len(words))], set(), 2 * len(template) + gap
        while todo:
            lo, hi = todo.pop()
            if hi - lo < least * len(template) or (lo, hi) in seen or not enough(Counter(words[lo:hi]), bag, len(template), least):
                continue
            seen.add((lo, hi))
            pairs = align(words[lo:hi], template)
            cuts = [0, *(k for k in range(1, len(pairs)) if pairs[k][0] - pairs[k - 1][0] > gap + 1), len(pairs)]
            start, stop = max(zip(cuts, cuts[1:], strict=False), key=lambda c: (c[1] - c[0], -c[0]))
            matched = stop - start
            if matched and matched >= least * len(template):
                first, after = lo + pairs[start][0], lo + pairs[stop - 1][0] + 1
                found.append((matched, matched / len(template), name, first, after))
                todo += [(lo, first), (after, hi)]
            elif hi - lo > 2 * reach:
                todo += [(i, min(hi, i + 2 * reach)) for i in range(lo, hi - reach, reach)]
                todo += [(max(lo, lo + pairs[i][0] - reach), min(hi, lo + pairs[j - 1][0] + 1 + reach)) for i, j in zip(cuts, cuts[1:], strict=False) if pairs[j - 1][0] - pairs[i][0] + 2 * reach + 1 < hi - lo]
            elif len(pairs) > 1:
                k = max(range(1, len(pairs)), key=lambda k: (pairs[k][0] - pairs[k - 1][0], -k))
                todo += [(lo, lo + pairs[k][0]), (lo + pairs[k - 1][0] + 1, hi)]
    chosen: list[tuple] = []
    for hit in sorted(found, key=lambda h: (-h[0], -h[1], h[2], h[3])):
        if all(hit[4] <= c[3] or hit[3] >= c[4] for c in chosen):
            chosen.append(hit)
    return sorted(((name, coverage, first, after) for _, coverage, name, first, after in chosen), key=lambda h: h[2])


def scan_licenses(df: DataFrame, templates: dict[str, str] | None = None, text: str = "text", out: str = "licenses", least: float = 0.75, gap: int = 8) -> DataFrame:
    """``df`` with an array of the licenses found: name, coverage, and the characters where each starts and ends."""
    of = {k: WORD.findall(v.lower()) for k, v in sorted((templates or TEMPLATES).items())}
    kind = T.ArrayType(T._parse_datatype_string(FIELDS), False)
    arrow = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))

    def compute(column: pa.Array) -> list[pa.Array]:
        made = []
        for _, run in slices(column.to_pylist()):
            for body in run:
                hits = scan(WORD.findall(body.lower()), of, least, gap)
                spans = [m.span() for m in WORD.finditer(body.lower())] if hits else []
                made.append([{"license": n, "coverage": c, "start": spans[a][0], "end": spans[b - 1][1]} for n, c, a, b in hits])
        return [pa.array(made, arrow)]

    return append_columns(df, text, T.StructType([T.StructField(out, kind)]), compute)


def summary(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of hits, and the first of largest coverage."""
    found = scan_licenses(df.select(key, text), text=text)
    top = F.array_max(F.transform("licenses", lambda h: F.struct(h["coverage"].alias("coverage"), (-h["start"]).alias("at"), h["license"].alias("license"), h["start"].alias("start"), h["end"].alias("end"))))
    return found.select(key, F.size("licenses").alias("n_hits"), top.alias("_top")).select(
        key, "n_hits", F.col("_top.license").alias("license"), F.col("_top.coverage").alias("coverage"),
        F.col("_top.start").alias("start_char"), F.col("_top.end").alias("end_char"),
    )
