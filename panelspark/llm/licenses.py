"""Finds license texts: winnowed fingerprints pick candidates, banded alignment tells what of a template is there and where.

Fingerprints are hashes of three tokens; of every two neighbours the smaller is chosen, so a stretch of four tokens that a text
shares with a template always yields a common one.  An inverted index leads from fingerprints to places in templates.  Hits of
a template that lie close together become one candidate, which is aligned with the template token by token inside a band
around their diagonal.  Of candidates that overlap in the text the best covered template is reported.

Tokens are runs of letters and digits in lower case.  Null and empty texts match nothing.  A text may hold several licenses,
and one more than once; repeated rows are reported each.  Texts are never shuffled.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.words import Hasher, Words, buffer_of, code_points, find_words, mix, slices, winnowed

U = np.uint64
GRAM, WINDOW = 3, 2

# Notices and clauses by which these public licenses are applied.
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met:",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
}


@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point whether it is a letter or digit, and its lower case (itself, where that has another length)."""
    inside = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
    low = np.fromiter((ord(c) if len(c := chr(i).lower()) == 1 else i for i in range(0x110000)), np.uint32, 0x110000)
    return inside, low


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Tokens of a run of texts (places are code points of the run) and a hash of each."""
    points, at = code_points(data, offsets)
    inside, low = _characters()
    words = find_words(points, at, inside[points])
    with np.errstate(over="ignore"):
        code = mix(low[points].astype(U) * U(0x9E3779B97F4A7C15)) | U(1)
    return words, Hasher(points, code)(words.start, words.end)


def prints(tok: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed fingerprints of texts, and the token where each begins."""
    n = len(tok)
    if n < GRAM:
        return np.zeros(0, U), np.zeros(0, np.int64)
    h = tok[: n - GRAM + 1].copy()
    with np.errstate(over="ignore"):
        for i in range(1, GRAM):
            h = mix(h * U(0x9FB21C651E98DF25) + tok[i : n - GRAM + 1 + i])
    own = np.repeat(bounds[1:], np.diff(bounds))[: len(h)] >= np.arange(len(h)) + GRAM
    h[~own] = U(0xFFFFFFFFFFFFFFFF)
    at = np.flatnonzero(winnowed(h, WINDOW) & own)
    return h[at], at


@dataclass
class Index:
    """The templates with their fingerprints, sorted by hash."""

    names: list[str]
    tok: list[np.ndarray]
    hashes: np.ndarray
    template: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(templates: Mapping[str, list[str]]) -> Index:
        names = [name for name, texts in templates.items() for _ in texts]
        words, tok = tokens(*buffer_of(pa.array([t for texts in templates.values() for t in texts], pa.string())))
        h, at = prints(tok, words.bounds)
        order = np.argsort(h, kind="stable")
        template = np.searchsorted(words.bounds, at, "right") - 1
        parts = [tok[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
        return Index(names, parts, h[order], template[order], (at - words.bounds[template])[order])


def align(template: list[int], text: list[int], shift: int, band: int) -> tuple[int, int, int]:
    """Best local alignment with ``text[i + shift ± band]`` against ``template[i]``: matched tokens, start and end in the text.

    A match scores 2, a mismatch or gap -1.  Of equally good alignments the first to end counts.
    """
    width = 2 * band + 1
    # For each cell of the band: score, matches, start in the text.
    above = [(0, 0, -1)] * (width + 2)
    best = (0, 0, -1, -1)
    for i, token in enumerate(template):
        row = [(0, 0, -1)] * (width + 2)
        for b in range(width):
            j = i + shift + b - band
            if not 0 <= j < len(text):
                continue
            # The same cell of the row above is one step back on the diagonal; its right neighbour skips a template token.
            score, matched, start = above[b + 1]
            same = token == text[j]
            cell = (score + 2, matched + 1, start if score else j) if same else (score - 1, matched, start)
            for score, matched, start in (above[b + 2], row[b]):
                if score - 1 > cell[0]:
                    cell = (score - 1, matched, start)
            if cell[0] > 0:
                row[b + 1] = cell
                if cell[0] > best[0]:
                    best = (cell[0], cell[1], cell[2], j + 1)
        above = row
    return best[1:]


def scan(index: Index, data: np.ndarray, offsets: np.ndarray, band: int, least_coverage: float) -> list[tuple]:
    """(text, template, matched, start, end) of the licenses in a run of texts; places are code points of the text."""
    words, tok = tokens(data, offsets)
    h, at = prints(tok, words.bounds)
    lo, hi = np.searchsorted(index.hashes, h), np.searchsorted(index.hashes, h, "right")
    hits = []
    for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
        text = int(np.searchsorted(words.bounds, p, "right")) - 1
        hits += [(text, t, p - q) for t, q in zip(index.template[a:b].tolist(), index.at[a:b].tolist())]
    found = []
    last = None
    for text, t, diagonal in sorted(set(hits)):
        # Hits whose diagonals lie in one band are one candidate.
        if last is not None and last[:2] == (text, t) and diagonal - last[2] <= band:
            continue
        last = (text, t, diagonal)
        size = len(index.tok[t])
        first = max(int(words.bounds[text]), diagonal - band)
        window = tok[first : min(int(words.bounds[text + 1]), diagonal + size + 2 * band)].tolist()
        matched, start, end = align(index.tok[t].tolist(), window, diagonal - first, band)
        if matched and matched >= least_coverage * size:
            found.append((text, matched / size, matched, t, first + start, first + end))
    kept: dict[int, list[tuple]] = {}
    # Best coverage first, then the longer template; ties go to the first in order.
    for text, coverage, matched, t, start, end in sorted(found, key=lambda f: (f[0], -f[1], -f[2], f[3], f[4])):
        others = kept.setdefault(text, [])
        if all(end <= a or b <= start for _, _, a, b in others):
            others.append((t, matched, start, end))
    before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    return sorted(
        (text, t, matched, int(words.start[start] - before[text]), int(words.end[end - 1] - before[text]))
        for text, of_text in kept.items()
        for t, matched, start, end in of_text
    )


def licenses_of(spark: SparkSession, text: Column | str, index: Index, band: int, least_coverage: float) -> Column:
    """Array of structs (license, template, coverage, matched, start, end)."""
    shared = spark.sparkContext.broadcast(index)

    @F.arrow_udf("array<struct<license: string, template: int, coverage: double, matched: int, start: int, end: int>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for batch in batches:
            rows = [(first + r[0], *r[1:]) for first, _, d, o in slices(*buffer_of(batch)) for r in scan(known, d, o, band, least_coverage)]
            cols = np.array(rows, np.int64).reshape(-1, 5)
            size = np.array([len(t) for t in known.tok])[cols[:, 1]]
            numbers = [pa.array(cols[:, k].astype(np.int32)) for k in (2, 3, 4)]
            values = [pa.array([known.names[t] for t in cols[:, 1]], pa.string()), pa.array(cols[:, 1].astype(np.int32)), pa.array(cols[:, 2] / size), *numbers]
            at = np.concatenate([[0], np.cumsum(np.bincount(cols[:, 0], minlength=len(batch)))]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays(values, names=["license", "template", "coverage", "matched", "start", "end"]))

    return run(text if isinstance(text, Column) else F.col(text))


def find_licenses(
    docs: DataFrame, templates: Mapping[str, list[str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text", band: int = 8, least_coverage: float = 0.8
) -> DataFrame:
    """One row per license text found: id, license, template (its number), coverage, matched tokens, start and end (code points).

    ``coverage`` is the share of the template's tokens that the alignment matches.  The index of the templates is broadcast; it
    belongs to the program, not to the data.
    """
    found = licenses_of(docs.sparkSession, text_col, Index.of(templates), band, least_coverage)
    hit = docs.select(F.col(id_col), F.explode(found).alias("_hit"))
    return hit.select(id_col, *[F.col(f"_hit.{c}") for c in ("license", "template", "coverage", "matched", "start", "end")])
