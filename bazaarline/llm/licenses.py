"""Licence texts found by winnowed fingerprints and banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarline.llm.shared import slices, text_or_empty

GRAM, WINNOW = 3, 3
BAND = 4
MIN_IDENTITY = 0.8
# Equal words of a reported part: a run of so many shares a fingerprint.
MIN_RUN = GRAM + WINNOW - 1
# A run ends where the alignment falls so far below its best score.
DROP = 2 * BAND
# Words of the templates that one pass looks for; more templates are looked for in more passes.
PASS_WORDS = 200_000
TEXT_BYTES = 4_000_000
WORD = re.compile(r"[^\W_]+")
NOT_WORD = r"[^\pL\pN]+"

# Notices, opening clauses and, named "text", whole terms as their publishers word them.
TEMPLATES: dict[str, str] = {
    "MIT": "Released under the MIT License.",
    "MIT-terms": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
        "of the Software"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-terms": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-terms": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "BSD-terms": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-terms": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR "
        "A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
        "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def word_hashes(words: Sequence[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in words), "uint64", len(words))


def grams(words: np.ndarray) -> np.ndarray:
    """A hash of every run of ``GRAM`` words."""
    if len(words) < GRAM:
        return np.zeros(0, dtype="uint64")
    mixed = np.zeros(len(words) - GRAM + 1, dtype="uint64")
    for k in range(GRAM):
        mixed = (mixed ^ words[k : len(words) - GRAM + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Which hashes are the least of some ``WINNOW`` neighbours; all of a shorter run."""
    n = len(hashes)
    if n <= WINNOW:
        return np.ones(n, dtype=bool)
    least = np.lib.stride_tricks.sliding_window_view(hashes, WINNOW).min(axis=1)
    chosen = np.zeros(n, dtype=bool)
    for k in range(WINNOW):
        chosen[k : k + len(least)] |= hashes[k : k + len(least)] == least
    return chosen


@dataclass(frozen=True)
class Index:
    """Fingerprints of templates, sorted, with the template and the place of each."""

    names: list[str]
    words: list[np.ndarray]
    fingerprints: np.ndarray
    templates: np.ndarray
    places: np.ndarray
    short: np.ndarray  # fingerprints of templates too short to be sure of a common one


def index_of(templates: dict[str, str]) -> Index:
    names, words, rows, short = [], [], [], []
    for name, text in sorted(templates.items()):
        own = word_hashes([w.lower() for w in WORD.findall(text)])
        hashes = grams(own)
        brief = len(own) < GRAM + WINNOW - 1
        chosen = np.flatnonzero(np.ones(len(hashes), dtype=bool) if brief else winnowed(hashes))
        rows += [(int(hashes[k]), len(names), int(k)) for k in chosen]
        short += [int(h) for h in hashes] if brief else []
        names.append(name)
        words.append(own)
    rows.sort()
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return Index(
        names,
        words,
        np.array(columns[0], dtype="uint64"),
        np.array(columns[1], dtype="int64"),
        np.array(columns[2], dtype="int64"),
        np.unique(np.array(short, dtype="uint64")),
    )


def align(template: np.ndarray, text: np.ndarray, shift: int) -> tuple[int, int, int, int]:
    """Best alignment of the whole template with some run of the text, near one diagonal.

    Place ``q`` of the template meets places ``q + shift - BAND`` to ``q + shift + BAND`` of the
    text. Returns matched words, columns of the alignment, and the run's start and end. A column
    is a match, a change, a word left out or one added; words of the text outside are free.
    """
    width = 2 * BAND + 1
    n = len(text)
    # Cell k of a row stands for j = q + shift - BAND + k words of the text used so far.
    cells: list[tuple[int, int, int] | None] = []
    for k in range(width):
        j = shift - BAND + k
        cells.append((0, 0, j) if 0 <= j <= n else None)
    for q in range(len(template)):
        following: list[tuple[int, int, int] | None] = [None] * width
        for k in range(width):
            j = q + 1 + shift - BAND + k
            if j < 0 or j > n:
                continue
            options = []
            if cells[k] is not None and j > 0:
                score, columns, start = cells[k]
                same = template[q] == text[j - 1]
                options.append((score + (1 if same else -1), columns + 1, start))
            if k + 1 < width and cells[k + 1] is not None:
                score, columns, start = cells[k + 1]
                options.append((score - 1, columns + 1, start))
            if k > 0 and following[k - 1] is not None:
                score, columns, start = following[k - 1]
                options.append((score - 1, columns + 1, start))
            if options:
                following[k] = max(options, key=lambda o: (o[0], -o[1], o[2]))
        cells = following
    found = [(c, len(template) + shift - BAND + k) for k, c in enumerate(cells) if c is not None]
    if not found:
        return 0, 1, 0, 0
    (score, columns, start), end = max(found, key=lambda f: (f[0][0], -f[0][1], -f[1]))
    # score = matches - (columns - matches)
    return (score + columns) // 2, columns, start, end


def matches(index: Index, text: np.ndarray, places: np.ndarray, hashes: np.ndarray) -> list[tuple]:
    """``template, matched, columns, start, end`` of the templates in a text, best first where
    two overlap. ``places`` are those of the text's fingerprints that the index has."""
    diagonals: dict[int, set[int]] = {}
    for p, h in zip(places.tolist(), hashes, strict=True):
        lo, hi = np.searchsorted(index.fingerprints, h, "left"), np.searchsorted(index.fingerprints, h, "right")
        for k in range(lo, hi):
            diagonals.setdefault(int(index.templates[k]), set()).add(p - int(index.places[k]))
    found = []
    for template, shifts in diagonals.items():
        done = None
        words = index.words[template]
        for shift in sorted(shifts):
            if done is not None and shift - done <= BAND // 2:
                continue  # the band of the diagonal before holds this one
            done = shift
            lo = max(shift - BAND, 0)
            matched, columns, start, end = align(words, text[lo : shift + len(words) + BAND], shift - lo)
            if matched >= MIN_IDENTITY * columns:
                found.append((matched, matched / columns, template, columns, start + lo, end + lo))
    kept: list[tuple] = []
    taken: list[tuple[int, int]] = []
    for matched, _, template, columns, start, end in sorted(found, key=lambda f: (-f[0], -f[1], f[2], f[4])):
        if all(end <= a or b <= start for a, b in taken):
            taken.append((start, end))
            kept.append((template, matched, columns, start, end))
    return sorted(kept, key=lambda k: k[3])


def extend(template: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Equal words, words of the template and words of the text of the best alignment, within the
    band, of some beginning of the template with some beginning of the text."""
    best = (0, 0, 0, 0)  # score, equal, template words, text words
    # Cells by the words of the text used: score, equal words.
    cells = {j: (-j, 0) for j in range(min(BAND, len(text)) + 1)}
    for q, word in enumerate(template):
        following: dict[int, tuple[int, int]] = {}
        for j in range(max(q + 1 - BAND, 0), min(q + 1 + BAND, len(text)) + 1):
            options = []
            if j - 1 in cells:
                score, equal = cells[j - 1]
                same = word == text[j - 1]
                options.append((score + 1, equal + 1) if same else (score - 1, equal))
            if j in cells:
                options.append((cells[j][0] - 1, cells[j][1]))
            if j - 1 in following:
                options.append((following[j - 1][0] - 1, following[j - 1][1]))
            if options:
                following[j] = max(options)
                if following[j][0] > best[0]:
                    best = (*following[j], q + 1, j)
        cells = following
        if not cells or max(c[0] for c in cells.values()) < best[0] - DROP:
            break
    return best[1:]


def runs(index: Index, text: np.ndarray, places: np.ndarray, hashes: np.ndarray, whole: list[tuple]) -> list[tuple]:
    """``template, matched, start, end`` of parts of templates in a text, each through a common
    fingerprint and with at least ``MIN_RUN`` equal words.

    Of overlapping parts that with more equal words stays; one inside or beside a whole match
    stays if it has more equal words than that.
    """
    found: list[tuple] = []
    covered: dict[int, list[tuple[int, int, int, int]]] = {}
    for template, _, _, start, end in whole:
        covered.setdefault(template, []).append((0, len(index.words[template]), start, end))
    for p, h in zip(places.tolist(), hashes, strict=True):
        lo, hi = np.searchsorted(index.fingerprints, h, "left"), np.searchsorted(index.fingerprints, h, "right")
        for k in range(lo, hi):
            template, q = int(index.templates[k]), int(index.places[k])
            words, mine = index.words[template], covered.setdefault(template, [])
            if any(a <= q and q + GRAM <= b and c <= p and p + GRAM <= d for a, b, c, d in mine):
                continue
            reach = len(words) + BAND
            after = extend(words[q + GRAM :], text[p + GRAM : p + GRAM + reach])
            before = extend(words[:q][::-1], text[max(p - reach, 0) : p][::-1])
            matched = before[0] + GRAM + after[0]
            span = (q - before[1], q + GRAM + after[1], p - before[2], p + GRAM + after[2])
            mine.append(span)
            if matched >= MIN_RUN:
                found.append((template, matched, span[2], span[3]))
    kept = [(t, n, start, end) for t, n, _, start, end in whole]
    parts = []
    for run in sorted(found, key=lambda f: (-f[1], f[0], f[2])):
        if all(run[3] <= k[2] or k[3] <= run[2] or k[1] < run[1] for k in kept):
            kept.append(run)
            parts.append(run)
    return sorted(parts, key=lambda f: f[2])


def word_spans(text: pa.Array) -> list[tuple[int, int]]:
    """Where the words of one text stand; lower-casing here keeps the number of characters."""
    marked = pc.replace_substring_regex(pc.utf8_lower(text), r"[\pL\pN]", "x")[0].as_py()
    return [m.span() for m in re.finditer("x+", marked)]


def scan_batch(index: Index, texts: pa.Array, parts: list[list[tuple]] | None = None) -> list[list[tuple]]:
    """The matches in each text, with spans in words. The ``runs`` of each are added to ``parts``."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), NOT_WORD, " ")
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(plain))
    numbered = words.flatten().dictionary_encode()
    flat = word_hashes(numbered.dictionary.to_pylist())[numbered.indices.to_numpy()]
    offsets = np.asarray(words.offsets) - words.offsets[0].as_py()
    hashes = grams(flat)
    # Fingerprints are chosen over all texts at once; a run of words in one text has the same
    # least hash there as by itself unless it is at the text's ends, which are added.
    chosen = winnowed(hashes)
    at = np.searchsorted(index.fingerprints, hashes) if len(index.fingerprints) else np.zeros(len(hashes), int)
    known = (at < len(index.fingerprints)) & (
        index.fingerprints[np.minimum(at, max(len(index.fingerprints) - 1, 0))] == hashes
        if len(index.fingerprints)
        else False
    )
    edge = np.zeros(len(hashes), dtype=bool)
    for k in range(GRAM + WINNOW):
        near = offsets + k
        edge[near[near < len(hashes)]] = True
        near = offsets - k
        edge[near[(near >= 0) & (near < len(hashes))]] = True
    hits = np.flatnonzero(known & (chosen | edge | np.isin(hashes, index.short)))
    owner = np.searchsorted(offsets, hits, "right") - 1
    inside = hits + GRAM <= offsets[owner + 1]
    hits, owner = hits[inside], owner[inside]
    out: list[list[tuple]] = [[] for _ in range(len(texts))]
    for k in np.unique(owner):
        mine = hits[owner == k] if len(hits) < 1000 else hits[np.searchsorted(owner, k, "left") : np.searchsorted(owner, k, "right")]
        own = flat[offsets[k] : offsets[k + 1]]
        out[k] = matches(index, own, mine - offsets[k], hashes[mine])
        if parts is not None:
            parts[k] += runs(index, own, mine - offsets[k], hashes[mine], out[k])
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Templates found in each text: ``doc_id, license, matched_words, template_words, coverage,
    span_start, span_end, whole``, a row for each place.

    Words are runs of letters and digits, lower-cased. A text and a template that have a run of
    ``GRAM + WINNOW - 1`` words in common share a fingerprint; shorter templates are looked up
    by all their grams. Every diagonal with a common fingerprint is aligned within a band, and
    places where at least ``MIN_IDENTITY`` of the alignment's columns are equal words are
    reported as ``whole``; of overlapping places the one with more equal words, then the larger
    share, stays. Other common fingerprints are extended both ways to the best run near their
    diagonal; runs of at least ``MIN_RUN`` equal words are reported as parts, if no place with
    as many equal words overlaps them. More than ``BAND`` words put in part a template in two.
    ``coverage`` is the share of the template's words, the span is in characters.

    Null and empty texts have no places. Null and repeated ids keep their rows; rows equal in
    id and text are found alike. Columns other than ``doc_id`` and ``text`` are ignored; no
    documents or no templates give an empty table. There is no shuffle: an index of at most
    ``PASS_WORDS`` template words goes to every task, and more templates are looked for in
    several passes, where overlaps between passes all stay.
    """
    chosen = TEMPLATES if templates is None else templates
    parts: list[dict[str, str]] = [{}]
    total = 0
    for name, text in sorted(chosen.items()):
        size = len(WORD.findall(text))
        if total and total + size > PASS_WORDS:
            parts.append({})
            total = 0
        parts[-1][name] = text
        total += size
    found = [_scan_part(docs, index_of(part)) for part in parts]
    result = found[0]
    for other in found[1:]:
        result = result.unionByName(other)
    return result


def _scan_part(docs: DataFrame, index: Index) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, TEXT_BYTES):
                rows: list[tuple] = []
                ids: list[int] = []
                partial: list[list[tuple]] = [[] for _ in range(len(part))]
                for k, found in enumerate(scan_batch(index, part.column(1), partial)):
                    found = [(t, n, a, b, True) for t, n, _, a, b in found] + [(*run, False) for run in partial[k]]
                    if not found:
                        continue
                    spans = word_spans(part.column(1).slice(k, 1))
                    for template, matched, start, end, whole in found:
                        size = len(index.words[template])
                        rows.append((index.names[template], matched, size, matched / size, spans[start][0], spans[end - 1][1], whole))
                        ids.append(k)
                if rows:
                    types = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    names = ["doc_id", "license", "matched_words", "template_words", "coverage", "span_start", "span_end", "whole"]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(ids)), *columns], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, license string, matched_words bigint, template_words bigint, coverage double, "
        "span_start bigint, span_end bigint, whole boolean"
    )
    return docs.select("doc_id", text_or_empty("text").alias("text")).mapInArrow(search, schema)
