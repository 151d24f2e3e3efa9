"""License texts found by winnowed fingerprints and banded alignment.

Templates are cut into words; windows of ``K`` words are hashed and winnowed (the
smallest hash of every ``W`` neighbours is kept, all of a short template), which
gives an inverted index from hash to places in templates. The index has the size
of the templates, not of the corpus, and goes to every task. All windows of a
document are looked up in it; a hit names a template and a diagonal, and along
each diagonal the words are aligned within a band (Smith-Waterman). A short template
need not leave a window whole: every one of its words names a diagonal, and those
are aligned around which enough of its words stand. Reported are
the matched share of the template and the matched characters of the document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import ids_and_texts

#: words of a window, windows of which winnowing keeps one, half the width of the band
K, W, BAND = 3, 3, 8
#: reported when so much of a template's words match
COVERAGE = 0.8
#: words of a template up to which single words name diagonals
SHORT = 12
#: most bytes of template text that the index may be built from and sent to tasks
MAX_TEMPLATE_BYTES = 16 << 20
MATCH, MISMATCH, GAP = 2, -1, -1

# License names, and the short notices by which texts declare them.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
                "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
                "following conditions: The above copyright notice and this permission notice shall be included in all "
                "copies or substantial portions of the Software.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                "that the following conditions are met: Redistributions of source code must retain the above copyright "
                "notice, this list of conditions and the following disclaimer.",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                         "in compliance with the License. You may obtain a copy of the License at",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                  "(at your option) any later version.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                      "MPL was not distributed with this file, You can obtain one at",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
               "this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_word = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def word_codes(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.lower().encode()) for w in words), np.uint64, len(words))


def window_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all windows of ``K`` words."""
    n = max(0, len(codes) - K + 1)
    h = np.zeros(n, np.uint64)
    for i in range(K):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i:i + n]
        h ^= h >> np.uint64(29)
    return h


def winnow(h: np.ndarray) -> np.ndarray:
    """Places of the hashes that winnowing keeps; ties to the right, all of a short text."""
    if len(h) <= W:
        return np.arange(len(h))
    around = np.lib.stride_tricks.sliding_window_view(h, W)
    return np.unique(np.arange(len(around)) + W - 1 - around[:, ::-1].argmin(1))


class Index:
    """Winnowed hashes of the templates and their words."""

    def __init__(self, templates: Mapping[str, str]):
        if sum(len(t.encode()) for t in templates.values()) > MAX_TEMPLATE_BYTES:
            raise ValueError("templates are too large to send to every task")
        self.names = list(templates)
        self.codes = [word_codes(_word.findall(t)) for t in templates.values()]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for n, codes in enumerate(self.codes):
            if len(codes) <= SHORT:
                continue
            h = window_hashes(codes)
            for p in winnow(h).tolist():
                self.places.setdefault(int(h[p]), []).append((n, p))
        self.short = [n for n, codes in enumerate(self.codes) if 0 < len(codes) <= SHORT]
        self.short_words = np.unique(np.concatenate([self.codes[n] for n in self.short] or [np.zeros(0, np.uint64)]))
        self.hashes = np.array(sorted(self.places), np.uint64)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """Which of the hashes are in the index."""
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        return np.flatnonzero(self.hashes[at] == h)


def align(a: np.ndarray, b: np.ndarray, diagonal: int) -> list[tuple[int, int]]:
    """Matched places (in a, in b) of the best local alignment within ``BAND`` of ``b = a + diagonal``."""
    width = 2 * BAND + 1
    score, step = np.zeros((len(a) + 1, width + 2), np.int64), np.zeros((len(a) + 1, width + 2), np.int8)
    best, at = 0, (0, 0)
    for i in range(1, len(a) + 1):
        for k in range(1, width + 1):
            j = i - 1 + diagonal + k - 1 - BAND  # place in b
            if not 0 <= j < len(b):
                continue
            same = a[i - 1] == b[j]
            options = (0, score[i - 1, k] + (MATCH if same else MISMATCH),
                       score[i - 1, k + 1] + GAP, score[i, k - 1] + GAP)
            s = int(np.argmax(options))
            score[i, k], step[i, k] = options[s], s
            if options[s] > best:
                best, at = options[s], (i, k)
    out, (i, k) = [], at
    while best and score[i, k] > 0:
        j = i - 1 + diagonal + k - 1 - BAND
        if step[i, k] == 1:
            if a[i - 1] == b[j]:
                out.append((i - 1, j))
            i -= 1
        elif step[i, k] == 2:
            i, k = i - 1, k + 1
        elif step[i, k] == 3:
            k -= 1
        else:
            break
    return out[::-1]


def near_diagonals(codes: np.ndarray, known: np.ndarray, template: np.ndarray, coverage: float) -> list[int]:
    """Diagonals of shared words along which the band holds enough words of a short template.

    ``known`` are the places in ``codes`` of words that any short template has.
    """
    words, at_most = np.unique(template, return_counts=True)
    places = [known[codes[known] == w] for w in words]
    if sum(min(len(p), m) for p, m in zip(places, at_most.tolist())) < coverage * len(template):
        return []
    found = np.unique(np.concatenate([p - q for w, p in zip(words, places) for q in np.flatnonzero(template == w)]))
    inside = [np.searchsorted(p, found + len(template) + BAND) - np.searchsorted(p, found - BAND) for p in places]
    enough = sum(np.minimum(n, m) for n, m in zip(inside, at_most.tolist())) >= coverage * len(template)
    return found[enough].tolist()


def best_apart(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of (matches, first, last) those that overlap no better one: more matches, then a shorter span."""
    out: list[tuple[int, int, int]] = []
    for n, a, b in sorted(set(found), key=lambda m: (-m[0], m[2] - m[1], m[1])):
        if all(b < x or a > y for _, x, y in out):
            out.append((n, a, b))
    return out


def scan(index: Index, text: str, coverage: float = COVERAGE) -> list[tuple[str, float, int, int]]:
    """(license, coverage, start, end) of every match; a notice inside a longer match of another one stays."""
    if not len(index.codes):
        return []
    codes = word_codes(_word.findall(text))
    h = window_hashes(codes)
    hits = index.lookup(h) if len(index.hashes) else np.zeros(0, np.int64)
    known = np.flatnonzero(np.isin(codes, index.short_words))
    if not len(hits) and not len(known):
        return []
    seeds: dict[int, set[int]] = {}
    for p, x in zip(hits.tolist(), h[hits].tolist()):
        for n, q in index.places[x]:
            seeds.setdefault(n, set()).add(p - q)

    def along(n: int, d: int) -> tuple[int, int, int] | None:
        # the whole template along this diagonal; gaps up to the band on either side
        template = index.codes[n]
        low, high = max(0, d - BAND), min(len(codes), d + len(template) + BAND)
        found = align(template, codes[low:high], d - low)
        if found and len(found) >= coverage * len(template):
            return len(found), low + found[0][1], low + found[-1][1]
        return None

    matches = []
    for n, diagonals in sorted(seeds.items()):
        covered = -1
        for d in sorted(diagonals):
            if d <= covered:
                continue  # inside the band of the diagonal aligned last
            if found := along(n, d):
                matches.append((n, *found))
                covered = found[2]
    for n in index.short:
        tried = [along(n, d) for d in near_diagonals(codes, known, index.codes[n], coverage)]
        matches += [(n, *m) for m in best_apart([m for m in tried if m])]
    if not matches:
        return []
    places = np.array([m.span() for m in _word.finditer(text)])
    out = {(index.names[n], k / len(index.codes[n]), int(places[a, 0]), int(places[b, 1])) for n, k, a, b in matches}
    return sorted(out, key=lambda m: (m[2], m[3], m[0]))


def read_templates(table: DataFrame, name_col: str = "license", text_col: str = "text") -> dict[str, str]:
    """Templates of a table (name, text), as for full licence texts; their size is checked before they are read.

    Rows without a name or text are left out; of rows that share a name the text that
    sorts first counts. More than ``MAX_TEMPLATE_BYTES`` of text is an error.
    """
    rows = table.select(F.col(name_col).cast("string").alias("name"), F.col(text_col).cast("string").alias("text")) \
        .where("name is not null and text is not null").groupBy("name").agg(F.min("text").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + F.octet_length("name"))).first()[0] or 0
    if size > MAX_TEMPLATE_BYTES:
        raise ValueError(f"{size} bytes of templates, at most {MAX_TEMPLATE_BYTES} are sent to the tasks")
    return {r["name"]: r["text"] for r in rows.orderBy("name").collect()}


def license_scan(docs: DataFrame, templates: Mapping[str, str] | DataFrame | None = None, coverage: float = COVERAGE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: doc_id, license, coverage, start and end (characters, end exclusive).

    ``templates`` are names and texts, a table (license, text) of them, or by default
    short notices and headers. ``coverage`` is the share of the template's words found
    in order. Every place
    where a template matches is reported. Null and empty texts and texts without a
    match give no row; null and repeated ids keep theirs; an empty table or no
    template gives an empty result; other columns are not read.
    """
    if isinstance(templates, DataFrame):
        templates = read_templates(templates)
    index = Index(NOTICES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(d.as_py(), *m) for d, t in zip(batch.column("doc_id"), batch.column("text"))
                    for m in scan(index, t.as_py() or "", coverage)]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)],
                names=["doc_id", "license", "coverage", "start", "end"])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, license string, coverage double, start long, end long")
