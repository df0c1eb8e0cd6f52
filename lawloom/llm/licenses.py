"""Licence scan: TF-IDF cosine to templates, then inheritance from ancestor directories.

Segments of a text are every run of at most MAX_LINES neighbouring lines that holds a cue
term, its leading comment block, and the whole text: a header is found however it is
wrapped and whatever follows it. Terms are lower-case words and version numbers. A term
of the templates weighs ln((1 + documents) / (1 + documents that hold it)) + 1, counted
over all documents; any other term of a segment weighs `other_weight`. A document's own
licence is that of the most similar template over its segments, from `min_similarity` on.

The cues of a template are its rarest terms, so many that its other terms alone cannot
reach `min_similarity`: a segment without any of them is not similar, and none is lost.

A licence file is a document with a licence whose file name says so, or whose whole text
is similar to a template. A document without a licence of its own inherits the one of
the nearest directory above it that has a licence file. Directories are joined, not
documents: one row for each directory and ancestor.

Defined results: null or empty texts have no licence; of equally similar templates the
first name wins, of several licence files in a directory the most similar, then the
first name; a null path inherits nothing; repeated rows are each answered, those with
the same id share their best segment; an empty table gives an empty result; only the id,
text and path columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import map_texts, row_key, staged, text_or_empty

TERM_PATTERN = r"[a-z0-9]+(?:\.[0-9]+)*"
FILE_PATTERN = r"(?i)^(licen[cs]e|copying|unlicense)([._-].*)?$"
#: Lines of a segment; the texts of MIT and BSD-3-Clause wrapped at 30 characters have fewer.
MAX_LINES = 64
_COMMENT = re.compile(r"\s*(#|//|/?\*|--|;|%|<!--|\"\"\"|dnl\b|rem\b|$)", re.IGNORECASE)

#: Notices, headers, short texts and openings of licences; an argument of the operator.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR"
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE,"
        " REPRODUCTION, AND DISTRIBUTION 1. Definitions.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met: 1. Redistributions of source code must retain the above copyright"
        " notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must"
        " reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
        " documentation and/or other materials provided with the distribution. 3. Neither the name of the"
        " copyright holder nor the names of its contributors may be used to endorse or promote products derived"
        " from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT"
        " HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE"
        " IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT"
        " SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,"
        " EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
        " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF"
        " LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN"
        " ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
        "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy"
        " of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons,"
        " PO Box 1866, Mountain View, CA 94042, USA.",
        "Creative Commons Attribution 4.0 International Public License By exercising the Licensed Rights (defined"
        " below), You accept and agree to be bound by the terms and conditions of this Creative Commons"
        " Attribution 4.0 International Public License (Public License).",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To"
        " view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/ or send a letter to"
        " Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.",
        "Creative Commons Attribution-NonCommercial 4.0 International Public License By exercising the Licensed"
        " Rights (defined below), You accept and agree to be bound by the terms and conditions of this Creative"
        " Commons Attribution-NonCommercial 4.0 International Public License (Public License).",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or any later"
        " version.",
        "SPDX-License-Identifier: GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License, or"
        " (at your option) any later version. This program is distributed in the hope that it will be useful, but"
        " WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR"
        " PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU"
        " General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."
        " https://fsf.org/ Everyone is permitted to copy and distribute verbatim copies of this license document,"
        " but changing it is not allowed.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files (the Software), to deal in the Software without restriction, including"
        " without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"
        " copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the"
        " following conditions: The above copyright notice and this permission notice shall be included in all"
        " copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY"
        " KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A"
        " PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR"
        " ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING"
        " FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the"
        " MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual or legal entity"
        " that creates, contributes to the creation of, or owns Covered Software.",
    ),
}


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM_PATTERN), F.lit(0))


def term_weights(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """(term, weight) of the templates' terms, with document counts over all documents."""
    spark = docs.sparkSession
    known = F.array(*[F.lit(t) for t in vocabulary])
    held = docs.select(F.array_intersect(terms(text_or_empty("text")), known).alias("held"))
    n_docs = held.count()
    counts = held.select(F.explode("held").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    every = spark.createDataFrame([(t,) for t in vocabulary], "term string")
    weight = F.log((1 + F.lit(n_docs)) / (1 + F.coalesce("df", F.lit(0)))) + 1
    return every.join(counts, "term", "left").select("term", weight.alias("weight"))


class _Template(NamedTuple):
    name: str
    license: str
    weights: dict[str, float]
    norm: float


def _weighted(templates: Mapping[str, Sequence[str]], weights: Mapping[str, float]) -> list[_Template]:
    """Templates in order of their names, with tf times weight of every term."""
    out = []
    for name, texts in sorted(templates.items()):
        for i, text in enumerate(texts):
            own = {t: n * weights[t] for t, n in Counter(_terms_of(text)).items()}
            if own:
                out.append(_Template(f"{name}/{i:03d}", name, own, sum(w * w for w in own.values()) ** 0.5))
    return sorted(out)


def _terms_of(text: str) -> list[str]:
    return re.findall(TERM_PATTERN, text.lower())


def cues(template: _Template, weights: Mapping[str, float], min_similarity: float) -> set[str]:
    """The rarest terms; the others' share of the template's norm is below `min_similarity`."""
    found, rest = set(), template.norm**2
    for term in sorted(template.weights, key=lambda t: (-weights[t], t)):
        if rest < (min_similarity * template.norm) ** 2 * (1 - 1e-6):
            break
        found.add(term)
        rest -= template.weights[term] ** 2
    return found


def _leading_block(lines: list[str]) -> int:
    """End of the comment lines (or else of the paragraph) that a text begins with."""
    end = 0
    while end < len(lines) and _COMMENT.match(lines[end]):
        end += 1
    if not any(line.strip() for line in lines[:end]):
        while end < len(lines) and lines[end].strip():
            end += 1
    return end


class Scorer:
    """The most similar template over the segments of a text."""

    def __init__(self, templates: Mapping[str, Sequence[str]], weights: Mapping[str, float], min_similarity: float, other_weight: float):
        self.templates, self.weights = _weighted(templates, weights), dict(weights)
        self.cues = [cues(t, weights, min_similarity) for t in self.templates]
        self.min_similarity, self.other_weight = min_similarity, other_weight

    def best(self, text: str) -> tuple[str, float, float] | None:
        """(license, similarity, similarity of the whole text); none if no segment can be similar."""
        lines = text.split("\n")
        words = [_terms_of(line) for line in lines]
        held = set().union(*words)
        # the terms of a segment are among those of the text, which bounds its similarity
        near = [
            i for i, t in enumerate(self.templates)
            if sum(t.weights[w] ** 2 for w in held & t.weights.keys()) >= (self.min_similarity * t.norm) ** 2 * (1 - 1e-6)
        ]
        if not near:
            return None
        vocabulary = set().union(*(self.templates[i].weights for i in near))
        of_term = {
            w: self.weights[w] * np.array([self.templates[i].weights.get(w, 0.0) / self.templates[i].norm for i in near])
            for w in held & vocabulary
        }
        weight = {w: self.weights.get(w, self.other_weight) for w in held}
        telling = set().union(*(self.cues[i] for i in near))
        products = np.zeros((len(lines) + 1, len(near)))
        for i, line in enumerate(words):
            products[i + 1] = products[i]
            for w in line:
                if w in of_term:
                    products[i + 1] += of_term[w]
        has_cue = [not telling.isdisjoint(line) for line in words]
        best = np.zeros(len(near))

        def norms(first: int, end: int) -> np.ndarray:
            """Squared norm of the lines from first to each later end."""
            times: dict[str, int] = {}
            square, out = 0.0, []
            for line in words[first:end]:
                for w in line:
                    n = times.get(w, 0)
                    square += weight[w] ** 2 * (2 * n + 1)
                    times[w] = n + 1
                out.append(square)
            return np.array(out)

        def cosines(first: int, end: int) -> np.ndarray:
            norm = np.sqrt(norms(first, end))[:, None]
            return np.divide(products[first + 1 : end + 1] - products[first], norm, out=np.zeros((end - first, len(near))), where=norm > 0)

        next_cue = len(lines) + MAX_LINES
        for first in range(len(lines) - 1, -1, -1):
            next_cue = first if has_cue[first] else next_cue
            # a segment that begins or ends with a line of other terms is less similar than without it
            if next_cue < first + MAX_LINES and not vocabulary.isdisjoint(words[first]):
                best = np.maximum(best, cosines(first, min(len(lines), first + MAX_LINES)).max(axis=0))
        block = _leading_block(lines)
        if block > MAX_LINES:
            best = np.maximum(best, cosines(0, block)[-1])
        whole = cosines(0, len(lines))[-1]
        best = np.round(np.maximum(best, whole), 9)
        at = int(best.argmax())  # the highest similarity, then the first template
        return self.templates[near[at]].license, float(best[at]), round(float(whole.max()), 9)


def best_templates(
    docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, other_weight: float = 1.0, min_similarity: float = 0.7
) -> DataFrame:
    """(row, license, similarity, whole_similarity): the best template of each document that may reach the limit."""
    vocabulary = sorted({t for texts in templates.values() for text in texts for t in _terms_of(text)})
    weights = {row["term"]: row["weight"] for row in term_weights(docs, vocabulary).collect()}  # of the given templates
    scorer = Scorer(templates, weights, min_similarity, other_weight)
    telling = F.array(*[F.lit(t) for t in sorted(set().union(*scorer.cues))]).cast("array<string>")
    found = docs.filter(F.arrays_overlap(terms(text_or_empty("text")), telling))
    named = found.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")

    def score(batches):
        for batch in batches:
            rows = [(k, scorer.best(t.as_py())) for k, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
            rows = [(k, *best) for k, best in rows if best]
            kinds = (pa.string(), pa.string(), pa.float64(), pa.float64())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "license", "similarity", "whole_similarity"])

    scored = map_texts(named, score, "row string, license string, similarity double, whole_similarity double")
    return scored.dropDuplicates(["row"])


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def scan_licenses(
    docs: DataFrame,
    path: str = "path",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    min_similarity: float = 0.7,
    other_weight: float = 1.0,
) -> DataFrame:
    """(doc_id, path, license, similarity, origin, license_dir) for every row.

    origin is own, inherited or none; license_dir is the directory an inherited licence is from.
    """
    base = docs.select("doc_id", "text", F.col(path).alias("path"))
    best = best_templates(base.select("doc_id", "text"), templates, other_weight, min_similarity)
    own = staged(best.filter(F.col("similarity") >= min_similarity), "own-licenses")
    rows = base.select("doc_id", "path", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    placed = staged(
        rows.join(own, F.col("key") == F.col("row"), "left")
        .withColumn("dir", _directory(F.col("path")))
        .withColumn("name", F.regexp_extract("path", r"([^/]*)$", 1))
        .select("doc_id", "path", "dir", "name", "license", "similarity", "whole_similarity"),
        "placed",
    )
    is_file = F.col("name").rlike(FILE_PATTERN) | (F.col("whole_similarity") >= min_similarity)
    files = (
        placed.filter(F.col("license").isNotNull() & F.col("dir").isNotNull() & is_file)
        .groupBy(F.col("dir").alias("license_dir"))
        .agg(
            F.min_by("license", F.struct(-F.col("similarity"), F.col("license"))).alias("dir_license"),
            F.max("similarity").alias("dir_similarity"),
        )
    )
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.size(parts), F.lit(0)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    ancestors = (
        placed.filter(F.col("license").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
        .select(F.col("dir").alias("below"), F.posexplode(above).alias("steps", "ancestor"))
    )
    nearest = (
        ancestors.join(files, F.col("ancestor") == F.col("license_dir"))
        .groupBy("below")
        .agg(F.min_by(F.struct("license_dir", "dir_license", "dir_similarity"), "steps").alias("found"))
    )
    joined = placed.join(nearest, F.col("license").isNull() & (F.col("dir") == F.col("below")), "left")
    inherited = F.col("license").isNull() & F.col("found").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("license", "found.dir_license").alias("license"),
        F.coalesce("similarity", "found.dir_similarity").alias("similarity"),
        F.when(F.col("license").isNotNull(), "own").when(inherited, "inherited").otherwise("none").alias("origin"),
        F.when(inherited, F.col("found.license_dir")).alias("license_dir"),
    )
