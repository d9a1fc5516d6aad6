"""License scans: headers and licence files against templates by sparse TF-IDF cosine, then inheritance along directories.

A text is compared as a whole, by its blocks (runs of lines that are not blank),
by each line, and by each three lines together, with templates: notices of file
headers, SPDX tags, and texts and openings of licences. Comment markers are in
no term. Terms are words and pairs of words; a term's weight falls with the
share of all documents that hold it anywhere in their whole texts. The
templates' terms are counted one by one, all other words in a sketch of a fixed
size, by the lesser of two counters each, which may count a rare word too often
but none too seldom. Vectors are sparse: an index of the templates' terms gives
the products; words that no template has lengthen a part's vector, rare ones
more, so prose about something else stays far from all templates. A part's
cosine is at most the sum, over its terms, of the largest product that any
template gives, by a lower bound of its length; both come from running sums over
the text, and only parts that may reach the threshold are compared. A document's own licence is that of the
template nearest to one of its parts, at the threshold or above; of equals the
first template counts.

A licence file licenses its directory: a file by its name, or one that as a
whole is like a licence's whole text. Notices in headers license their own file
only. Documents without a licence of their own inherit from the nearest
directory above them that has one: each directory's ancestors are joined with
the licensed directories, the deepest one counts, and documents are joined with
their directory, in salted parts. Of several licence files in a directory the
first by path counts, of rows with one path the first by licence.

Null and empty texts have no licence of their own; a null path is in no
directory and inherits nothing. Repeated rows give repeated rows; an empty
table an empty result; a null id stays null. Bytes that are no UTF-8 count as
replacement characters.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkgrain.llm.common import cut, ensure_importable, map_arrow, texts_of, word_hashes

# Public licence texts, openings and notices.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = """ THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you
use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This
notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."""
#: Whole texts: a file like one of them is a licence file.
WHOLE_TEXTS: tuple[tuple[str, str], ...] = (("MIT", _MIT), ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END), ("BSD-2-Clause", _BSD + _BSD_END), ("ISC", _ISC), ("Zlib", _ZLIB), ("Unlicense", _UNLICENSE))
#: Notices of headers, and openings of the longer texts.
NOTICES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0, to the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
SPDX_NAMES = ("MIT", "Apache-2.0", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "BSD-3-Clause", "BSD-2-Clause", "ISC", "Zlib", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "Unlicense")
#: SPDX tags also name what GPL versions allow.
SPDX_SUFFIXES = {"GPL-3.0": ("", "-only", "-or-later"), "GPL-2.0": ("", "-only", "-or-later"), "LGPL-3.0": ("", "-only", "-or-later"), "AGPL-3.0": ("", "-only", "-or-later")}
SPDX_TAGS = tuple((name, f"SPDX-License-Identifier: {name}{end}") for name in SPDX_NAMES for end in SPDX_SUFFIXES.get(name, ("",)))
TEMPLATES: tuple[tuple[str, str], ...] = (*NOTICES, *SPDX_TAGS, *WHOLE_TEXTS)
FILE_NAMES = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)([.-][^/]*)?$"
_TERM = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_BITS = 20
_CHUNK = 1 << 14
_SALTS = 16


def words_of(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def terms(text: str) -> Counter:
    words = words_of(text)
    return Counter(words) + Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def _places(words: list[str]) -> np.ndarray:
    """The two counters of each word, in two rows of 2^20 each."""
    hashes = word_hashes(words)
    return np.stack([hashes >> np.uint64(64 - _BITS), (hashes & np.uint64((1 << _BITS) - 1)) + np.uint64(1 << _BITS)]).astype(np.int64)


class Vocabulary:
    """The templates' terms: words by name, pairs of words by the places of their words."""

    def __init__(self, terms_: list[str]) -> None:
        self.place = {t: k for k, t in enumerate(terms_)}
        self.size = len(terms_)
        pairs = sorted((self.place[a] * self.size + self.place[b], k) for t, k in self.place.items() if " " in t for a, b in [t.split(" ")])
        self.codes, self.pairs = np.array([c for c, _ in pairs], np.int64), np.array([k for _, k in pairs], np.int64)

    def look(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word its term, and the term of the pair it ends; -1 for none."""
        get = self.place.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        pairs = np.full(len(ids), -1, np.int64)
        both = np.flatnonzero((ids[1:] >= 0) & (ids[:-1] >= 0)) + 1
        if len(both) and len(self.codes):
            codes = ids[both - 1] * self.size + ids[both]
            at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            pairs[both] = np.where(self.codes[at] == codes, self.pairs[at], -1)
        return ids, pairs


@dataclass
class Templates:
    """The templates' unit vectors as an index of their terms, the terms' weights, and the sketch of all words."""

    names: list[str]
    whole: list[bool]
    vocabulary: Vocabulary
    weights: np.ndarray
    index: list[tuple[np.ndarray, np.ndarray]]
    most: np.ndarray
    """The largest weight that a term has in any template's unit vector."""
    n_documents: int
    sketch: np.ndarray

    @property
    def place(self) -> dict[str, int]:
        return self.vocabulary.place

    @staticmethod
    def build(templates: tuple[tuple[str, str], ...], holders: dict[str, int], n_documents: int, sketch: np.ndarray) -> Templates:
        counted = [terms(text) for _, text in templates]
        vocabulary = Vocabulary(sorted({t for c in counted for t in c}))
        place = vocabulary.place
        weights = np.array([math.log((n_documents + 1) / (min(holders.get(t, 0), n_documents) + 1)) + 1 for t in place])
        rows: list[list[tuple[int, float]]] = [[] for _ in place]
        for at, c in enumerate(counted):
            size = math.sqrt(sum((n * weights[place[t]]) ** 2 for t, n in c.items()))
            for t, n in c.items():
                rows[place[t]].append((at, n * weights[place[t]] / size))
        index = [(np.array([at for at, _ in row]), np.array([w for _, w in row])) for row in rows]
        return Templates([name for name, _ in templates], [t in WHOLE_TEXTS for t in templates], vocabulary, weights, index, np.array([w.max() for _, w in index]), n_documents, sketch)

    def strangeness(self, words: list[str]) -> np.ndarray:
        """The weights of words by the sketch."""
        holders = np.minimum(self.sketch[_places(words)].min(0), self.n_documents)
        return np.log((self.n_documents + 1) / (holders + 1.0)) + 1

    def near(self, words: list[str], ids: np.ndarray, pairs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The cosine of a part to every template: its words, their terms, the terms of their pairs, and the words' weights."""
        known = np.concatenate([ids[ids >= 0], pairs[1:][pairs[1:] >= 0]])
        own, counts = np.unique(known, return_counts=True)
        values = counts * self.weights[own]
        size = float(values @ values)
        # A pair of strange words is as strange as its words: it counts once, not thrice.
        strange: dict[str, list[float]] = {}
        for k in np.flatnonzero(ids < 0):
            strange.setdefault(words[k], [0.0, weights[k]])[0] += 1
        size += sum((n * w) ** 2 for n, w in strange.values())
        out = np.zeros(len(self.names))
        for k, value in zip(own, values, strict=True):
            at, weight = self.index[k]
            out[at] += value * weight
        return out / math.sqrt(size) if size else out

    def look(self, text: str, threshold: float) -> tuple[str | None, float, bool]:
        """A text's own licence, its cosine (0: below the threshold), and whether the text as a whole is a licence's."""
        lines = [words_of(line) for line in text.split("\n")]
        words = [w for line in lines for w in line]
        ids, pairs = self.vocabulary.look(words)
        if not (ids >= 0).any():
            return None, 0.0, False
        weights = np.where(ids >= 0, self.weights[ids], self.strangeness(words))
        met = pairs >= 0
        # Running sums: what the terms can give at most, and their squares at least, if none repeats.
        gives = np.concatenate([[0.0], np.cumsum(np.where(ids >= 0, weights * self.most[ids], 0.0))])
        squares = np.concatenate([[0.0], np.cumsum(weights**2)])
        pair_gives = np.concatenate([[0.0], np.cumsum(np.where(met, self.weights[pairs] * self.most[pairs], 0.0))])
        pair_squares = np.concatenate([[0.0], np.cumsum(np.where(met, self.weights[pairs] ** 2, 0.0))])
        first = np.concatenate([[0], np.cumsum([len(line) for line in lines])])
        places = np.array([(0, len(lines)), *_parts(lines)], np.int64)
        starts, ends = first[places[:, 0]], first[places[:, 1]]
        inner = np.minimum(starts + 1, ends)
        most = gives[ends] - gives[starts] + pair_gives[ends] - pair_gives[inner]
        least = squares[ends] - squares[starts] + pair_squares[ends] - pair_squares[inner]
        best, whole = np.zeros(len(self.names)), False
        for k in np.flatnonzero((ends > starts) & (most >= threshold * np.sqrt(least) - 1e-9)):
            part = slice(starts[k], ends[k])
            near = self.near(words[part], ids[part], pairs[part], weights[part])
            best = np.maximum(best, near)
            whole = whole or k == 0 and any(near[t] >= threshold for t, is_whole in enumerate(self.whole) if is_whole)
        top = int(best.argmax())
        score = round(float(best[top]), 9)
        return (self.names[top], score, whole) if score >= threshold else (None, 0.0, False)


def _parts(lines: list[list[str]]) -> Iterator[tuple[int, int]]:
    """Where the lines, the three lines together and the blocks of a text begin and end."""
    start = 0
    for k, line in enumerate(lines):
        if line:
            yield k, k + 1
        if k + 3 <= len(lines):
            yield k, k + 3
        if not line or k + 1 == len(lines):
            end = k if not line else k + 1
            if end - start > 1 and end - start != 3 and (start, end) != (0, len(lines)):
                yield start, end
            start = k + 1


def template_weights(docs: DataFrame, templates: tuple[tuple[str, str], ...], text_col: str) -> Templates:
    """The templates, weighted by how many of all documents hold each term anywhere in their whole text."""
    ensure_importable(docs.sparkSession)
    wanted = sorted({t for _, text in templates for t in terms(text)})
    vocabulary, offset = Vocabulary(wanted), 2 << _BITS
    # Both rows of the sketch, the templates' terms and the number of documents, in whole chunks.
    size = -(-(offset + len(wanted) + 1) // _CHUNK) * _CHUNK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size, np.uint32)
        for batch in batches:
            total[-1] += batch.num_rows
            for start in range(0, batch.num_rows, 500):
                held: list[str] = []
                for raw in texts_of(batch.column(0).slice(start, 500)):
                    words = words_of(raw.decode("utf-8", "replace"))
                    held += set(words)
                    known = np.concatenate(vocabulary.look(words))
                    total[np.unique(known[known >= 0]) + offset] += 1
                total[: 2 << _BITS] += np.bincount(_places(held).ravel(), minlength=2 << _BITS).astype(np.uint32)
        salt = TaskContext.get().partitionId() % 64
        rows = [(k, total[k : k + _CHUNK]) for k in range(0, size, _CHUNK)]
        rows = [(k, part.tobytes()) for k, part in rows if part.any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([salt] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["chunk", "salt", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros(_CHUNK, np.uint64), None
        for batch in batches:
            first = first or (batch.column(0)[0].as_py(), batch.column(1)[0].as_py())
            for raw in batch.column(2).to_pylist():
                total += np.frombuffer(raw, np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([first[0]], pa.int64()), pa.array([first[1]], pa.int64()), pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()])], ["chunk", "salt", "counts"])

    schema = "chunk bigint, salt bigint, counts binary"
    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(count, schema)
    for keys in (["chunk", "salt"], ["chunk"]):
        parts = parts.groupBy(*keys).applyInArrow(add, schema)
    total = np.zeros(size, np.uint32)
    for row in parts.select("chunk", "counts").collect():
        total[row.chunk : row.chunk + _CHUNK] = np.frombuffer(row.counts, np.uint32)
    return Templates.build(templates, {t: int(total[offset + k]) for k, t in enumerate(wanted)}, int(total[-1]), total[:offset].copy())


def scan(docs: DataFrame, templates: Templates, *, threshold: float = 0.6, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path") -> DataFrame:
    """``id_col, path, own_license, own_score, whole_text``: the nearest template, and whether the whole text is like a licence's."""
    rows = docs.select(F.col(id_col), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("_text"))
    kind = rows.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(templates)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.look(raw.decode("utf-8", "replace"), threshold) for raw in texts_of(batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())], [id_col, "path", "own_license", "own_score", "whole_text"])

    return map_arrow(rows, run, f"`{id_col}` {kind}, path string, own_license string, own_score double, whole_text boolean")


def _parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def inherit(scanned: DataFrame) -> DataFrame:
    """Adds ``license`` (own or inherited) and ``inherited_from`` (the directory; null: own or none)."""
    scanned = scanned.withColumn("_dir", _parent(F.col("path")))
    is_file = F.col("own_license").isNotNull() & (F.col("path").rlike(FILE_NAMES) | F.col("whole_text"))
    licensed = scanned.where(is_file & F.col("path").isNotNull()).groupBy("_dir").agg(F.min(F.struct("path", "own_license")).alias("_f"))
    licensed = licensed.select(F.col("_dir").alias("_above"), F.col("_f.own_license").alias("_license"))
    parts = F.split("_dir", "/", -1)
    ancestors = F.concat(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("dir"))), F.array(F.struct(F.lit(0).alias("depth"), F.lit("").alias("dir"))))
    directories = scanned.where("own_license IS NULL AND path IS NOT NULL").select("_dir").distinct()
    above = directories.select("_dir", F.explode(F.array_distinct(ancestors)).alias("_a")).join(licensed, F.col("_a.dir") == F.col("_above"))
    nearest = above.groupBy("_dir").agg(F.max(F.struct("_a.depth", "_above", "_license")).alias("_n")).select("_dir", "_n._above", "_n._license")
    # A directory may hold any share of all documents: they come to it in parts.
    nearest = nearest.withColumnRenamed("_dir", "_key").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    mixed = F.xxhash64("path", scanned.columns[0])
    nowhere = F.concat(F.lit("\0"), mixed.cast("string"))
    salted = scanned.withColumn("_salt", F.pmod(mixed, F.lit(_SALTS)).cast("int")).withColumn("_key", F.coalesce("_dir", nowhere))
    joined = salted.join(nearest, ["_key", "_salt"], "left")
    own = F.col("own_license").isNotNull()
    return joined.select(*(c for c in scanned.columns if c != "_dir"), F.coalesce("own_license", "_license").alias("license"), F.when(~own, F.col("_above")).alias("inherited_from"))


def license_scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, *, threshold: float = 0.6, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path") -> DataFrame:
    """``scan`` and ``inherit`` over one table of documents with paths."""
    weighted = template_weights(docs, templates, text_col)
    return inherit(cut(scan(docs, weighted, threshold=threshold, id_col=id_col, text_col=text_col, path_col=path_col), name="scanned"))
