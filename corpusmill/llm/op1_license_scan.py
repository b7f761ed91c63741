"""License scans: winnowed fingerprints, or single words of short templates, pick candidates, banded alignment reports coverage and spans."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import K2, mix, slices, span_hashes, utf8

# Notices of well-known licenses, public texts. Case and punctuation don't count.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mit": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "mit-notice": "Released under the MIT License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
GRAM, WINDOW, BAND = 3, 4, 12
#: Templates of at most so many words are found by single words: a quarter of them missing can leave no gram whole.
SHORT = 16
#: Bytes of a word: ASCII letters and digits and all bytes beyond ASCII.
_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start, end and text of each word, A-Z lower-cased; punctuation separates."""
    if not len(buf):
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, e
    inside = _WORD[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return span_hashes(_LOWER[buf], starts, ends), starts, ends, np.searchsorted(off, starts, side="right") - 1


def grams(h: np.ndarray, k: int = GRAM) -> np.ndarray:
    if len(h) < k:
        return np.zeros(0, np.uint64)
    s = np.zeros(len(h) - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            s = s * K2 + h[j : len(h) - k + 1 + j]
    return mix(s)


def winnow(g: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the fingerprints: of each `window` grams in a row the smallest, the last of equal ones (Schleimer et al.,
    2003). A shared run of window + k - 1 words has one in common; a shorter list of grams keeps its smallest."""
    if len(g) <= window:
        return np.array([len(g) - 1 - int(np.argmin(g[::-1]))]) if len(g) else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(g, window)
    return np.unique(np.arange(len(view)) + window - 1 - view[:, ::-1].argmin(axis=1))


@dataclass
class Index:
    names: list[str]
    words: list[np.ndarray]
    keys: np.ndarray  # sorted fingerprints
    owner: np.ndarray  # their templates
    place: np.ndarray  # and places in them
    single: Index | None = None  # the same of short templates, by single words


def build_index(templates: Mapping[str, str], coverage: float = 0.75) -> Index:
    """The inverted index of the templates: winnowed fingerprints of long ones, single words of those up to SHORT words.

    Where n words have at most m missing at `coverage`, any m + 1 of them have one that isn't: the m + 1 longest words of a
    short template, which are seldom common ones, meet every occurrence, wherever words are changed, dropped or put in."""
    names, hashed, keys, owner, place = sorted(templates), [], [], [], []
    one: list[tuple[np.uint64, int, int]] = []
    for i, name in enumerate(names):
        raw = np.frombuffer(templates[name].encode(), np.uint8)
        h, starts, ends, _ = tokens(raw, np.array([0, len(raw)]))
        if len(h) < GRAM:
            raise ValueError(f"{name}: fewer than {GRAM} words")
        hashed.append(h)
        if len(h) <= SHORT:
            missing = len(h) - needed(len(h), coverage)
            one += [(h[at], i, int(at)) for at in np.argsort(starts - ends, kind="stable")[: missing + 1]]
            continue
        g = grams(h)
        for at in winnow(g):
            keys.append(g[at])
            owner.append(i)
            place.append(int(at))

    def index(keys: list, owner: list, place: list, single: Index | None = None) -> Index:
        order = np.argsort(np.array(keys, np.uint64), kind="stable")
        return Index(names, hashed, np.array(keys, np.uint64)[order], np.array(owner, np.int64)[order], np.array(place, np.int64)[order], single)

    return index(keys, owner, place, index(*([x[k] for x in one] for k in range(3))))


def needed(n: int, coverage: float) -> int:
    """The fewest of n words that reach `coverage`, as scan_text compares."""
    return next((k for k in range(1, n + 1) if k / n >= coverage), n)


def align(a: np.ndarray, b: np.ndarray, shift: int, band: int = BAND) -> list[tuple[int, int]]:
    """Word pairs (i, j) of the best banded alignment of template a with text b around the diagonal j - i = shift: most
    matches less half a point for each word passed over within the alignment; ends are free."""
    n, m, width = len(a), len(b), 2 * band + 1
    score = np.zeros((n + 1, width))
    move = np.zeros((n + 1, width), np.int8)
    gap, miss = 0.5, 0.5
    for i in range(1, n + 1):
        j = i + shift - band + np.arange(width)  # columns are counted from 1, as rows
        ok = (j >= 1) & (j <= m)
        same = np.zeros(width, bool)
        same[ok] = b[j[ok] - 1] == a[i - 1]
        diag = score[i - 1] + np.where(same, 1.0, -miss)
        up = np.full(width, -np.inf)
        up[:-1] = score[i - 1, 1:] - gap
        row, mv = np.zeros(width), np.zeros(width, np.int8)
        for x, best in ((diag, 1), (up, 2)):
            better = ok & (x > row)
            row, mv = np.where(better, x, row), np.where(better, best, mv)
        # Words of the text passed over: a running maximum along the row.
        ramp = np.arange(width) * gap
        reach = np.maximum.accumulate(row + ramp) - ramp
        left = np.concatenate([[-np.inf], reach[:-1] - gap])
        better = ok & (left > row)
        score[i], move[i] = np.where(better, left, row), np.where(better, 3, mv)
    i, k = np.unravel_index(int(score.argmax()), score.shape)
    out = []
    while i > 0 and score[i, k] > 0:
        j = i + shift - band + k
        if move[i, k] == 1:
            if b[j - 1] == a[i - 1]:
                out.append((int(i - 1), int(j - 1)))
            i -= 1
        elif move[i, k] == 2:
            i, k = i - 1, k + 1
        elif move[i, k] == 3:
            k -= 1
        else:
            break
    return out[::-1]


def scan_text(h: np.ndarray, index: Index, coverage: float, hits: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, matched words, first word, last word) of the templates in one text, by its word hashes.

    `hits` are templates and diagonals of the text, as candidates() gives them. Those of a long template that lie within
    half a band of diagonals make one candidate; each diagonal of a short one is a candidate, and its band is half of its
    words. Among reported matches whose spans overlap, one whose matched words are all of a longer match's span goes: the
    notice inside a header is part of the header. So does a short template's match that overlaps a longer one of its own."""
    if hits is None:
        hits = candidates(h, np.zeros(len(h), np.int64), index, coverage)[1:]
    tmpl, shift = hits
    found: list[tuple[str, float, int, int, int]] = []
    if not len(tmpl):
        return found
    order = np.lexsort((shift, tmpl))
    tmpl, shift = tmpl[order], shift[order]
    last = None
    for t, s in zip(tmpl, shift, strict=True):
        a = index.words[t]
        band = min(BAND, len(a) // 2)
        if last and last[0] == t and s - last[1] <= (0 if len(a) <= SHORT else band // 2):
            continue
        last = (t, s)
        lo, hi = max(0, s - band), min(len(h), s + len(a) + band)
        pairs = align(a, h[lo:hi], int(s - lo), band)
        share = len({i for i, _ in pairs}) / len(a)
        if share >= coverage:
            found.append((index.names[t], share, len(pairs), int(lo + pairs[0][1]), int(lo + pairs[-1][1])))
    found = sorted(set(found), key=lambda f: (-f[2], f[3], f[0], f[4]))
    short = {n for n, a in zip(index.names, index.words, strict=True) if len(a) <= SHORT}
    kept: list[tuple[str, float, int, int, int]] = []
    for f in found:
        if not any(g[3] <= f[3] and f[4] <= g[4] or g[0] == f[0] and f[0] in short and f[3] <= g[4] and g[3] <= f[4] for g in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: (f[3], f[4], f[0]))


def find_hits(g: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Places of grams that are fingerprints, and the index entries they meet: one for each template that has it."""
    if not len(index.keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lo = np.searchsorted(index.keys, g, side="left")
    known = index.keys[np.minimum(lo, len(index.keys) - 1)] == g
    at = np.flatnonzero(known)
    many = np.searchsorted(index.keys, g[at], side="right") - lo[at]
    return np.repeat(at, many), np.repeat(lo[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def candidates(h: np.ndarray, owner: np.ndarray, index: Index, coverage: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word of the text, template, diagonal from the start of `h`) of each hit, given the words of texts in a row and the
    text of each. A hit of a single word needs as many words of its template in its band as coverage asks for; fewer can't align."""
    at, entry = find_hits(grams(h), index)
    inside = owner[at] == owner[at + GRAM - 1] if len(at) else np.zeros(0, bool)
    at, entry = at[inside], entry[inside]
    found = [(at, index.owner[entry], at - index.place[entry])]
    at, entry = find_hits(h, index.single)
    tmpl, shift = index.single.owner[entry], at - index.single.place[entry]
    for t in np.unique(tmpl):
        a = index.words[t]
        band = min(BAND, len(a) // 2)
        every = np.flatnonzero(tmpl == t)
        for k in range(0, len(every), 1 << 16):  # in parts, for texts that are one word again and again
            mine = every[k : k + (1 << 16)]
            near = shift[mine, None] + np.arange(-band, len(a) + band)
            there = (near >= 0) & (near < len(h))
            near = np.clip(near, 0, len(h) - 1)
            there &= owner[near] == owner[at[mine], None]
            mine = mine[(there & np.isin(h[near], a)).sum(axis=1) >= needed(len(a), coverage)]
            found.append((at[mine], tmpl[mine], shift[mine]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


FOUND = "license string, coverage double, n_matched int, start_pos int, end_pos int, matched string"


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", coverage: float = 0.75) -> DataFrame:
    """(id, license, coverage, n_matched, start_pos, end_pos, matched) of each template found in a text, whole.

    coverage: matched words over the template's words, at least `coverage`. start_pos and end_pos: code points, end
    exclusive, from the first to the last matched word. Null, empty and clean texts give no rows; a text that holds a
    template twice gives two; rows that repeat give the same again. Other columns are ignored. Templates are a parameter
    of fixed size and travel with the tasks; nothing is shuffled.
    """
    schema = f"{id_col} long, {FOUND}"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
    index = build_index(templates, coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            buf, off = utf8(batch.column("text"))
            h, starts, ends, owner = tokens(buf, off)
            at, tmpl, shift = candidates(h, owner, index, coverage)
            ids, rows = batch.column("id").to_pylist(), []
            for d in np.unique(owner[at]):
                lo, hi = np.searchsorted(owner, [d, d + 1])
                mine = (at >= lo) & (at < hi)
                for name, share, n, first, last in scan_text(h[lo:hi], index, coverage, (tmpl[mine], shift[mine] - lo)):
                    a, b = int(starts[lo + first]), int(ends[lo + last])
                    raw = buf[off[d] : b].tobytes()
                    text = raw[a - off[d] :].decode("utf-8", "replace")
                    before = len(raw[: a - off[d]].decode("utf-8", "replace"))
                    rows.append((ids[d], name, share, n, before, before + len(text), text))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
