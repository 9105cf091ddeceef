"""License scans: winnowed fingerprints pick candidates, banded alignment confirms them.

Templates are reduced to letters and digits, their K-grams hashed and winnowed
(the smallest hash of each run of WINDOW stays). The inverted index has a row for
each fingerprint and template. Documents are winnowed alike; any run of
K + WINDOW - 1 characters that a template has too shares a fingerprint. Only
fingerprints that the index has leave a document (the index is as large as the
templates, whatever the corpus). Candidates are aligned with their template word
by word in a band around the diagonal of each cluster of shared fingerprints.
What was inserted into a notice or left out of it, however long, parts it into
pieces on different diagonals: alignments that go on where another ended, in the
text and in the template, are chained into one match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .common import small_batches, text_of

K, WINDOW = 8, 3
#: Words to either side of the diagonal that one alignment may use (chains have no such bound), the least words of a piece, and the least share of a template's words.
BAND, PIECE, COVERAGE = 8, 3, 0.7

#: Public licence notices.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software."
    ),
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list "
        "of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
}

LETTERS = bytes(ord(chr(b).lower()) if b < 128 else b for b in range(256))
OTHERS = bytes(b for b in range(256) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
WORDS = re.compile(rb"[A-Za-z0-9]+")


def winnowed(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place among the letters and digits) of a text's fingerprints, ties included."""
    own = text.translate(LETTERS, OTHERS)
    if len(own) < K:
        return np.zeros(0, dtype="u8"), np.zeros(0, dtype=np.int64)
    eight = np.ndarray((len(own) - 7,), "<u8", own, strides=(1,))
    h = eight[: len(own) - K + 1] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h = (h ^ eight[K - 8 :]) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    w = min(WINDOW, len(h))
    least = h[: len(h) - w + 1].copy()
    for i in range(1, w):
        np.minimum(least, h[i : len(h) - w + 1 + i], out=least)
    edge = np.zeros(w - 1, dtype="u8")
    padded = np.concatenate([edge, least, edge])
    most = padded[: len(h)].copy()
    for i in range(1, w):
        np.maximum(most, padded[i : len(h) + i], out=most)
    at = np.nonzero(most == h)[0]
    return h[at], at


def inverted_index(templates: dict[str, str] = TEMPLATES) -> list[tuple[int, str, int]]:
    """(fingerprint as a signed long, template, how many of its fingerprints make a candidate), once each: one, and one more for each 20 words."""
    need = {name: max(1, len(WORDS.findall(text.encode())) // 20) for name, text in templates.items()}
    return sorted({(int(h), name, need[name]) for name, text in templates.items() for h in winnowed(text.encode())[0].view("i8")})


def candidates(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, mark, templates): documents with enough fingerprints of a template. docs: doc_id, mark, text."""
    index = inverted_index(templates)
    asked = np.unique(np.array([h for h, *_ in index], dtype=np.int64))
    seen = np.zeros(1 << 16, dtype=bool)
    seen[asked.view("u8") >> np.uint64(48)] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, found = [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                h = winnowed(text)[0]
                h = h[seen[h >> np.uint64(48)]].view("i8")
                h = np.unique(h[np.isin(h, asked)]) if len(h) else h
                owner += [i] * len(h)
                found.append(h.astype(np.int64))
            if owner:
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), batch.column("mark").take(at), pa.array(np.concatenate(found))], names=["doc_id", "mark", "h"])

    table = docs.sparkSession.createDataFrame(index, "h bigint, template string, need int")  # as large as the templates
    own = docs.mapInArrow(rows, "doc_id bigint, mark bigint, h bigint")
    shared = own.join(F.broadcast(table), "h").groupBy("doc_id", "mark", "template").agg(F.count_distinct("h").alias("n"), F.max("need").alias("need"))
    return shared.filter("n >= need").groupBy("doc_id", "mark").agg(F.collect_set("template").alias("templates"))


#: Words matched, the first own word and the one past the last, the template's first word and the one past the last.
Piece = tuple[int, int, int, int, int]


def aligned(own: list[bytes | None], template: list[bytes], shift: int, band: int = BAND) -> Piece | None:
    """The best alignment in a band.

    The template's word j may stand against own words from j + shift - band to
    j + shift + band. A match counts 2, a mismatch or a gap -1; the ends are free.
    No alignment crosses an own word that is None.
    """
    width = 2 * band + 1
    nothing = (0, 0, -1, -1, -1, -1)  # score, matched, and the places of Piece
    before = [nothing] * width
    best = nothing
    for j, word in enumerate(template):
        row: list[tuple] = []
        for k in range(width):
            i = j + shift - band + k  # own word
            if not 0 <= i < len(own) or own[i] is None:
                row.append(nothing)
                continue
            s, m, a, e, ja, je = before[k]
            if own[i] == word:
                cell = (s + 2, m + 1, i, i + 1, j, j + 1) if a < 0 else (s + 2, m + 1, a, i + 1, ja, j + 1)
            else:
                cell = (s - 1, m, a, e, ja, je)
            if k + 1 < width and before[k + 1][0] - 1 > cell[0]:  # the template's word is left out
                cell = (before[k + 1][0] - 1, *before[k + 1][1:])
            if row and row[-1][0] - 1 > cell[0]:  # own word is left out
                cell = (row[-1][0] - 1, *row[-1][1:])
            if cell[0] <= 0:
                cell = nothing
            row.append(cell)
            if cell[0] > best[0]:
                best = cell
        before = row
    return best[1:] if best[1] else None


def least_piece(words: int) -> int:
    return max(1, min(PIECE, words // 4))


def pieces(own: list[bytes], template: list[bytes], shift: int) -> list[Piece]:
    """The alignments in a band with at least PIECE words, or a quarter of a shorter template's, best first; none shares own words with another."""
    least = least_piece(len(template))
    left: list[bytes | None] = list(own)
    out = []
    while (hit := aligned(left, template, shift)) and hit[0] >= least:
        out.append(hit)
        left[hit[1] : hit[2]] = [None] * (hit[2] - hit[1])
    return out


def chains(found: list[Piece], words: int, least: float) -> list[tuple[int, int, int]]:
    """(matched, first, past) of matches of at least ``least`` words, from pieces of one template: those that nothing can add to first, then chains.

    In a chain each piece starts after the one before it, in the text and in the
    template; words in which they overlap count once. A chain is taken as a whole,
    the one with most words first; what it is made of is in no other.
    """
    out, short = [], least_piece(words)
    taken: list[tuple[int, int]] = []
    free = lambda p: all(p[2] <= a or p[1] >= e for a, e in taken)
    for p in sorted(found, key=lambda p: (-p[0], p[1])):
        if p[0] >= least and p[3] < short and words - p[4] < short and free(p):
            out.append(p[:3])
            taken.append(p[1:3])
    rest = sorted({p for p in found if free(p)}, key=lambda p: (p[1], p[2], p[3]))
    while rest:
        ends: list[tuple[int, int] | None] = [None] * (words + 1)  # by the template's place: most words of a chain that ends there, and its last piece
        score, before = [0] * len(rest), [-1] * len(rest)
        for n, (m, a, _, ja, je) in enumerate(rest):
            score[n] = m
            for place in range(je):
                if ends[place] is not None:
                    gain = m - max(0, place - ja) - max(0, rest[ends[place][1]][2] - a)
                    if gain > 0 and ends[place][0] + gain > score[n]:
                        score[n], before[n] = ends[place][0] + gain, ends[place][1]
            if ends[je] is None or score[n] > ends[je][0]:
                ends[je] = (score[n], n)
        n = max(range(len(rest)), key=lambda i: score[i])
        if score[n] < least:
            break
        used, past, matched = set(), rest[n][2], score[n]
        while n >= 0:
            used.add(n)
            first, n = rest[n][1], before[n]
        out.append((matched, first, past))
        spans = [rest[i][1:3] for i in used]
        rest = [p for i, p in enumerate(rest) if i not in used and all(p[2] <= a or p[1] >= e for a, e in spans)]
    return out


FOUND = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("coverage", T.DoubleType()), T.StructField("n_words", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def alignments(text: Column, names: Column, templates: dict[str, str] = TEMPLATES, least: float = COVERAGE) -> Column:
    """The matches of the named templates: at least ``least`` of a template's words, non-overlapping for each template."""
    known = {}
    for name, t in templates.items():
        raw = t.encode()
        h, at = winnowed(raw)
        starts = _word_starts(raw)
        known[name] = ([w.lower() for w in WORDS.findall(raw)], {int(x): int(np.searchsorted(starts, p, side="right") - 1) for x, p in zip(h, at, strict=True)})

    def of(raw: bytes, picked: list[str]) -> list[dict]:
        spans = list(WORDS.finditer(raw))
        own = [m[0].lower() for m in spans]
        h, at = winnowed(raw)
        starts = _word_starts(raw)
        out = []
        for name in sorted(picked):
            words, places = known[name]
            shifts = sorted((int(np.searchsorted(starts, p, side="right")) - 1 - places[int(x)]) for x, p in zip(h, at, strict=True) if int(x) in places)
            found, last = [], None
            for s in shifts:  # shared fingerprints of one occurrence lie on neighbouring diagonals
                if last is not None and s - last <= BAND // 2:
                    continue
                last = s
                found += pieces(own, words, s)
            past = -1
            for m, a, e in sorted(chains(found, len(words), least * len(words)), key=lambda x: (x[1], -x[0])):
                if a >= past:
                    past = e
                    begin, end = (len(raw[:b].decode("utf-8", "replace")) for b in (spans[a].start(), spans[e - 1].end()))
                    out.append({"license": name, "coverage": m / len(words), "n_words": m, "start": begin, "end": end})
        return out

    kind = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("n_words", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))

    @arrow_udf(FOUND)
    def align(texts: pa.Array, lists: pa.Array) -> pa.Array:
        return pa.array([of(x, n) for x, n in zip(texts.cast(pa.binary()).to_pylist(), lists.to_pylist(), strict=True)], kind)

    return align(text, names)


def _word_starts(raw: bytes) -> np.ndarray:
    """Where each word starts among the letters and digits."""
    size = np.array([m.end() - m.start() for m in WORDS.finditer(raw)], dtype=np.int64)
    return np.cumsum(size) - size


def find_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license, coverage, n_words, start, end): a row for each match, in code points, end exclusive.

    coverage is the share of the template's words that were aligned. Rows that
    share a doc_id are each scanned; documents without a match have no row.
    """
    small_batches(docs.sparkSession)
    own = docs.select("doc_id", F.xxhash64(text_of()).alias("mark"), text_of().alias("text"))
    picked = candidates(own, templates).select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), "templates")
    joined = own.join(picked, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")))
    return joined.select("doc_id", F.explode(alignments(F.col("text"), F.col("templates"), templates)).alias("m")).select("doc_id", "m.*")
