"""License scan of files: headers and licence files against templates, then inheritance from directories.

A file's units are its lines, sentences, sentences of a line, paragraphs and the whole file. Units and templates are
sparse TF-IDF vectors of words and word pairs; the closest template by cosine names a unit's licence, and the unit
with most evidence the file's. A file that is called a licence, or is licence text for the most part, speaks for its
directory; a file without a licence of its own has that of its nearest ancestor directory that has one, found by
joining the ancestors of its directory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from infield.llm.common import MAX_BROADCAST_KEYS, WordHasher, cut, mix, slices, stored, transform_batches

_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
_BSD_TWO = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gnu(name: str, version: str, day: str, thing: str = "program") -> list[str]:
    """The title and the notices of a licence of the GNU family."""
    return [
        f"GNU {name.upper()} Version {version}, {day}",
        f"This work is licensed under the GNU {name}, version {version}.",
        f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.",
    ]


#: Titles, notices and short licences in full, by SPDX identifier; each is a template of its own.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "MIT": [
        "Released under the MIT License.", "The MIT License (MIT)", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: '
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", _BSD_TWO + _BSD_END],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", _BSD_TWO + _BSD_NAMES + _BSD_END],
    "GPL-2.0": _gnu("General Public License", "2", "June 1991"),
    "GPL-3.0": _gnu("General Public License", "3", "29 June 2007"),
    "LGPL-2.1": _gnu("Lesser General Public License", "2.1", "February 1999", "library"),
    "LGPL-3.0": _gnu("Lesser General Public License", "3", "29 June 2007", "library"),
    "AGPL-3.0": _gnu("Affero General Public License", "3", "19 November 2007"),
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0"],
    "EPL-2.0": ["Eclipse Public License - v 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."],
    "ISC": [
        "Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    ],
    "CC0-1.0": ["Licensed under CC0 1.0.", "No rights reserved: dedicated to the public domain under Creative Commons Zero.", "CC0 1.0 Universal"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
}
FILE_NAME = r"(?i)(?:^|/)(?:un)?licen[cs]e[^/]*$|(?:^|/)copying[^/]*$"
LEAST = 0.6  #: cosine of a match
MARGIN = 0.03  #: the next licence must have so much less evidence, as a share; a unit between two versions names none
MOSTLY = 0.8  #: share of a file's words in its licence unit that makes it a licence file
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_PARAGRAPH = re.compile(rb"\n[ \t\r#*/;%-]*(?=\n)")


class Terms:
    """Words and pairs of adjacent words of the templates, as sorted hashes: the vocabulary, as large as the templates."""

    def __init__(self, templates: dict[str, list[str]]):
        self.names = sorted(templates)
        rows = [(i, t) for i, name in enumerate(self.names) for t in (f"SPDX-License-Identifier: {name}", *templates[name])]
        self.owner = np.array([i for i, _ in rows])
        sets = []
        for _, _, _, hashes, at, _ in WordHasher().words(pa.array([t for _, t in rows], pa.string())):
            for a, b in zip(at[:-1], at[1:], strict=True):
                sets.append((np.unique(hashes[a:b]), np.unique(self.pair(hashes[a : b - 1], hashes[a + 1 : b])) if b > a else hashes[:0]))
        self.words = np.unique(np.concatenate([w for w, _ in sets]))
        self.pairs = np.unique(np.concatenate([p for _, p in sets]))
        self.size = len(self.words) + len(self.pairs)
        self.holds = np.zeros((self.size, len(rows)))
        for j, (w, p) in enumerate(sets):
            self.holds[np.searchsorted(self.words, w), j] = 1
            self.holds[len(self.words) + np.searchsorted(self.pairs, p), j] = 1

    @staticmethod
    def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return mix(left * _PAIR + right)

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The term of each word, and of each word with the next one (the last has none); -1 for terms of no template."""
        place = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        word = np.where(self.words[place] == hashes, place, -1)
        both = np.flatnonzero((word[:-1] >= 0) & (word[1:] >= 0))
        made = self.pair(hashes[both], hashes[both + 1])
        place = np.minimum(np.searchsorted(self.pairs, made), len(self.pairs) - 1)
        pair = np.full(len(hashes), -1)
        pair[both] = np.where(self.pairs[place] == made, place + len(self.words), -1)
        return word, pair


def units(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of every unit of the texts that lie in ``data``, each different one once."""
    space = data <= 32
    lines = np.flatnonzero((data == 10) | (data == 13))
    stops = np.flatnonzero(np.isin(data[:-1], np.frombuffer(b".!?", np.uint8)) & space[1:]) + 1
    gaps = np.array([m.start() for m in _PARAGRAPH.finditer(data.tobytes())], np.int64)
    made = []
    for cuts in ([], [gaps], [gaps, stops], [lines], [lines, stops]):
        edges = np.unique(np.searchsorted(starts, np.concatenate([offsets, *cuts])))
        made.append(edges[:-1] * (len(starts) + 1) + edges[1:])
    spans = np.unique(np.concatenate(made))
    return spans // (len(starts) + 1), spans % (len(starts) + 1)


def document_counts(files: DataFrame, terms: Terms) -> tuple[int, np.ndarray]:
    """How many files there are, and how many hold each term: counted in the tasks, added up by term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = WordHasher(), np.zeros(terms.size + 1, np.int64)
        for batch in batches:
            held[-1] += batch.num_rows
            for _, _, _, hashes, at, _ in hasher.words(batch.column(0)):
                row = np.repeat(np.arange(len(at) - 1), np.diff(at))
                word, pair = terms.ids(hashes)
                pair[at[1:][at[1:] > 0] - 1] = -1
                for ids in (word, pair):
                    there = np.flatnonzero(ids >= 0)
                    held[:-1] += np.bincount(np.unique(row[there] * terms.size + ids[there]) % terms.size, minlength=terms.size)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(held[some])], names=["term", "n"])

    rows = files.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    held = np.zeros(terms.size + 1, np.int64)
    for r in rows:
        held[r.term] = r.n
    return int(held[-1]), held[:-1]


class Matcher:
    """The licence of each text: index of its name or -1, cosine, and share of the text's words in the unit."""

    def __init__(self, terms: Terms, files: int, held: np.ndarray):
        self.terms, self.idf = terms, np.log((files + 1) / (held + 1)) + 0.5
        self.other = float(self.idf.mean()) ** 2
        self.square = np.append(self.idf**2, 0.0)
        self.weights = terms.holds * (self.idf**2)[:, None]
        self.norms = np.sqrt(self.weights.sum(axis=0))
        self.first = np.flatnonzero(np.diff(terms.owner, prepend=-1))
        self.hasher = WordHasher()

    def __call__(self, column: pa.Array) -> list[pa.Array]:
        n = len(column)
        name, score, share = np.full(n, -1), np.zeros(n), np.zeros(n)
        best: dict[int, tuple] = {}
        for top, data, offsets, hashes, at, starts in self.hasher.words(column):
            if not len(hashes):
                continue
            word, pair = self.terms.ids(hashes)
            a, b = units(data, offsets, starts)
            total = lambda x: np.concatenate([[0.0], np.cumsum(x)])
            w, p, o = total(self.square[word]), total(self.square[pair]), total(word < 0)
            most, foreign = w[b] - w[a] + p[b - 1] - p[a], (o[b] - o[a]) * self.other
            # A cosine is at most the root of the known terms' share, so no unit that could match is left out.
            near = np.flatnonzero((most > 0) & (most * (1 + 1e-9) >= LEAST**2 * (most + foreign)))
            a, b, foreign = a[near], b[near], foreign[near]
            for i, j in slices(b - a, 20_000):
                found, cosine, evidence = self.match(word, pair, a[i:j], b[i:j], foreign[i:j])
                a_, b_ = a[i:j][found >= 0], b[i:j][found >= 0]
                found, cosine, evidence = found[found >= 0], cosine[found >= 0], evidence[found >= 0]
                row = np.searchsorted(at, a_, "right") - 1
                part = (b_ - a_) / (at[row + 1] - at[row])
                for r, f, c, e, s in zip((top + row).tolist(), found.tolist(), cosine.tolist(), evidence.tolist(), part.tolist(), strict=True):
                    if r not in best or (-e, f, -s) < best[r]:
                        best[r], name[r], score[r], share[r] = (-e, f, -s), f, c, s
        names = pa.array([self.terms.names[i] if i >= 0 else None for i in name.tolist()], pa.string())
        return [names, pa.array(score, mask=name < 0), pa.array(share, mask=name < 0)]

    def match(self, word: np.ndarray, pair: np.ndarray, a: np.ndarray, b: np.ndarray, foreign: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = self.terms.size
        n = b - a
        unit = np.repeat(np.arange(len(a)), n)
        at = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n) + a[unit]
        inner = np.flatnonzero(at < b[unit] - 1)
        keys = np.concatenate([np.where(word[at] >= 0, unit * size + word[at], -1), np.where(pair[at[inner]] >= 0, unit[inner] * size + pair[at[inner]], -1)])
        keys = np.unique(keys[keys >= 0])
        unit, term = keys // size, keys % size
        heads = np.flatnonzero(np.diff(unit, prepend=-1))
        dot = np.add.reduceat(self.weights[term], heads, axis=0)
        norm = np.sqrt(np.add.reduceat(self.square[term], heads) + foreign)
        cosine = dot / (norm[:, None] * self.norms)
        evidence = np.where(cosine >= LEAST, cosine**2 * self.norms, 0.0)
        by_name = np.round(np.maximum.reduceat(evidence, self.first, axis=1), 9)
        found = by_name.argmax(axis=1)
        line = np.arange(len(found))
        best = by_name[line, found].copy()
        by_name[line, found] = 0
        found = np.where((best > 0) & (by_name.max(axis=1) <= best * (1 - MARGIN)), found, -1)
        told = np.round(np.minimum(cosine[line, evidence.argmax(axis=1)], 1.0), 9)
        return found, told, best


def _ancestors(directory: Column) -> Column:
    """The directory itself and all above it, the root '' included."""
    parts = F.split(directory, "/")
    return F.array_union(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")), F.array(F.lit("")))


def scan_licenses(files: DataFrame, templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """``files`` (path, text; all columns but text stay) with license, score, found and from_dir.

    found is 'header' (the file's own), 'inherited' (that of the nearest ancestor directory from_dir that a licence
    file speaks for) or null. A term counts once in a vector and weighs by in how many files it is; a word of no
    template weighs as the vocabulary's mean. A unit's evidence for a licence is its squared cosine, LEAST or more,
    times the template's norm, so that whole licences outdo single sentences; a unit whose two best licences are within
    MARGIN, as with versions that no template has, names none. At the same evidence the name that sorts first counts.
    Of several licence files of a directory the best score counts, then the license that sorts first. Null and empty
    texts have no licence; a null path is the root's. Repeated rows each get their answer. Input columns with these
    names are replaced.
    """
    path = F.coalesce("path", F.lit(""))
    terms = Terms(templates)
    n, held = document_counts(files, terms)
    rest = [c for c in files.columns if c not in ("text", "license", "score", "found", "from_dir")]
    outputs = T.StructType([T.StructField("license", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("_share", T.DoubleType())])
    told = transform_batches(files.select(*rest, "text"), ["text"], outputs, lambda: Matcher(terms, n, held))
    own = stored(told.select(*rest, "license", "score", (F.col("_share") >= MOSTLY).alias("_mostly"), F.regexp_replace(path, r"/?[^/]*$", "").alias("_dir"), F.coalesce(F.rlike(path, F.lit(FILE_NAME)), F.lit(False)).alias("_named")))
    speaking = own.where("license is not null and (_mostly or _named)").groupBy("_dir").agg(F.min_by(F.struct("license", "score"), F.struct(-F.col("score"), F.col("license"))).alias("told"))
    above = own.select("_dir").distinct().select("_dir", F.explode(_ancestors(F.col("_dir"))).alias("from_dir"))
    nearest = cut(above.join(speaking.withColumnRenamed("_dir", "from_dir"), "from_dir").groupBy("_dir").agg(F.max_by(F.struct("from_dir", "told"), F.length("from_dir")).alias("near")))
    few = nearest.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
    out = own.join(F.broadcast(nearest) if few else nearest, "_dir", "left")
    is_own = F.col("license").isNotNull()
    return out.select(
        *rest,
        F.coalesce("license", "near.told.license").alias("license"),
        F.coalesce("score", "near.told.score").alias("score"),
        F.when(is_own, "header").when(F.col("near").isNotNull(), "inherited").alias("found"),
        F.when(~is_own, F.col("near.from_dir")).alias("from_dir"),
    )
