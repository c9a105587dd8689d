"""License scan: MinHash bands over overlapping windows retrieve templates, shingle containment verifies them.

A template of T words is looked for in windows of 2S words that begin every S words, S being the smallest power of
two of at least T - 1, so that it lies whole in some window. A window holding three quarters of a template's shingles
and nothing else in common with it has a Jaccard similarity of at least 0.15 with the template (0.2 and more from
eight words on), so the default of 64 one-row bands meets in at least one with probability 0.9999; a whole template
usually lies in several windows. A window that holds fewer template shingles than three quarters of the shortest
template it is made for cannot verify, so only windows with that many are hashed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import native
from millrace.llm.common import stored

SHINGLE = 5
CONTAINMENT = 0.75
BANDS = 64
MIN_STEP = 4

# Bodies of the short licenses and the standard headers of the long ones.
AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)


def _gnu(name: str, version: str) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
        f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        f"{name} for more details."
    )


BODIES = (
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("BSD-2-Clause", REDISTRIBUTION + AS_IS),
    (
        "BSD-3-Clause",
        REDISTRIBUTION + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. " + AS_IS,
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, "
        "OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
        "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("GPL-2.0", _gnu("General Public License", "2")),
    ("GPL-3.0", _gnu("General Public License", "3")),
    ("LGPL-3.0", _gnu("Lesser General Public License", "3")),
    ("AGPL-3.0", _gnu("Affero General Public License", "3")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    # Passages by which the texts of the long licenses are known.
    (
        "Apache-2.0",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
        "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, "
        "publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or "
        "Object form.",
    ),
    (
        "GPL-2.0",
        "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free "
        "software--to make sure the software is free for all its users.",
    ),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    (
        "LGPL-3.0",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU "
        "General Public License, supplemented by the additional permissions listed below.",
    ),
    (
        "AGPL-3.0",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
        "specifically designed to ensure cooperation with the community in the case of network server software.",
    ),
)

# Notices by license.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction.",
    ),
    *BODIES,
)


def shingles(words: Column) -> Column:
    """Runs of five words as text; the whole, if there are fewer words."""
    at = F.sequence(F.lit(1), F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1)))
    return F.transform(at, lambda i: F.array_join(F.slice(words, i, SHINGLE), " "))


def prepared(templates: DataFrame) -> DataFrame:
    """``(license, template, step, shingles)`` of the templates with words; ``template`` is the wording."""
    worded = templates.select(
        F.col("license_id").alias("license"), native.alnum_words(F.col("text")).alias("words")
    ).where(F.size("words") > 0)
    step = F.greatest(F.lit(MIN_STEP), F.pow(F.lit(2), F.ceil(F.log2(F.size("words") - 1)))).cast("int")
    return worded.select(
        "license",
        F.array_join("words", " ").alias("template"),
        F.when(F.size("words") > 1, step).otherwise(MIN_STEP).alias("step"),
        F.array_distinct(shingles(F.col("words"))).alias("shingles"),
    ).distinct()


def bands(shingle_list: Column, n: int) -> Column:
    """MinHash of a list of shingles under each of ``n`` hash functions, as ``(band, value)``."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda b: F.struct(
            b.alias("band"), F.array_min(F.transform(shingle_list, lambda s: F.xxhash64(b, s))).alias("value")
        ),
    )


def license_scan(docs: DataFrame, templates: DataFrame, n_bands: int = BANDS, containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, license, template, n_shingles, n_found, word_start, n_windows)`` for texts with a license.

    One row per row of ``docs(doc_id, text)`` and template: of the window with most of the template's distinct
    shingles (the first such) how many it holds and its first word, counted from 0, and in how many windows at
    least three quarters were found. Null, empty and short texts give no rows (a template of fewer than five words
    is one shingle, found only where that many words are the whole text), nor do templates without words. Repeated
    rows and null ids are judged like any other row; other columns are not read.
    """
    known = stored(prepared(templates), "templates")
    parts = known.select("step", F.explode("shingles").alias("shingle")).select(
        "step", F.xxhash64(F.lit(SHINGLE), F.split("shingle", " ")).alias("hash")
    )
    # One row per step: fewer than there are powers of two.
    facts = known.groupBy("step").agg(
        F.min(F.size("shingles")).alias("least"), F.sum(F.octet_length(F.array_join("shingles", " ")) + 200).alias("size")
    ).collect()
    needed = {row["step"]: max(1, math.ceil(containment * row["least"] - 1e-9)) for row in facts} or {MIN_STEP: 1}
    steps = sorted(needed)
    map_, bits = native.bitmap(parts.select("hash").distinct(), "hash")
    # Windows of a step are only made around the shingles of templates of that step.
    by_step = {s: native.bitmap(parts.where(F.col("step") == s).select("hash").distinct(), "hash") for s in steps}

    def places(h: Column) -> Column:
        at = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.size(h) - 1)).otherwise(F.array().cast("array<int>"))
        return F.filter(at, lambda i: native.marked(F.col("_map"), bits, F.element_at(h, i + 1)))

    def starts_of(at: Column, step: int) -> Column:
        """Numbers of the windows of ``2 * step`` words that hold as many marked shingles as a template needs, whole."""
        fits = F.filter(at, lambda i: i + SHINGLE <= (F.floor(i / step) + 2) * step)
        early = F.filter(at, lambda i: (i >= step) & (i + SHINGLE <= (F.floor(i / step) + 1) * step))
        numbers = F.concat(
            F.transform(fits, lambda i: F.floor(i / step).cast("int")), F.transform(early, lambda i: F.floor(i / step).cast("int") - 1)
        )
        # In order, a number that is there often enough is found again that many places further on.
        ahead = needed[step] - 1
        return native.let(F.array_sort(numbers), lambda g: F.array_distinct(F.filter(g, lambda x, i: F.get(g, i + ahead) == x)))

    def windows_of(words: Column, at: Column, step: int) -> Column:
        return F.transform(
            starts_of(at, step),
            lambda g: F.struct(
                F.lit(step).alias("step"), (g * step).alias("start"), F.slice(words, g * step + 1, 2 * step).alias("words")
            ),
        )

    def places_of(step: int, h: Column, marked: Column) -> Column:
        return F.filter(marked, lambda i: native.marked(F.col(f"_map_{step}"), by_step[step][1], F.element_at(h, i + 1)))

    def windows(words: Column, h: Column, marked: Column) -> Column:
        return F.concat(*[windows_of(words, places_of(s, h, marked), s) for s in steps])

    def scanned(words: Column) -> Column:
        return native.let(_shingle_hashes(words), lambda h: native.let(places(h), lambda marked: windows(words, h, marked)))

    rows = (
        docs.select("doc_id", "text")
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumns({"_map": map_, **{f"_map_{s}": m for s, (m, _) in by_step.items()}})
        .select("_row", "doc_id", native.let(native.alnum_words(F.col("text").cast("string")), scanned).alias("_windows"))
    )
    # The outer form, because the plain one would add a filter below that computes the windows once more.
    window = rows.select("_row", "doc_id", F.explode_outer("_windows").alias("w")).where("w IS NOT NULL").select(
        "_row", "doc_id", F.col("w.step").alias("step"), F.col("w.start").alias("word_start"),
        F.array_distinct(shingles(F.col("w.words"))).alias("held"),
    )
    keyed = window.select("*", F.explode(bands(F.col("held"), n_bands)).alias("b"))
    index = known.select("*", F.explode(bands(F.col("shingles"), n_bands)).alias("t")).select(
        "license", "template", "shingles",
        F.col("step").alias("_step"), F.col("t.band").alias("_band"), F.col("t.value").alias("_value"),
    )
    index = native.broadcast_if_small(index, n_bands * sum(row["size"] for row in facts))
    meets = (F.col("step") == F.col("_step")) & (F.col("b.band") == F.col("_band")) & (F.col("b.value") == F.col("_value"))
    found = F.size(F.array_intersect("held", "shingles"))
    verified = (
        keyed.join(index, meets)
        .select(
            "_row", "doc_id", "license", "template", "word_start",
            F.size("shingles").cast("long").alias("n_shingles"), found.cast("long").alias("n_found"),
        )
        .where(F.col("n_found") >= F.lit(containment) * F.col("n_shingles"))
    )
    return (
        verified.groupBy("_row", "license", "template")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_shingles").alias("n_shingles"),
            F.max(F.struct("n_found", (-F.col("word_start")).alias("back"))).alias("best"),
            F.size(F.collect_set("word_start")).cast("long").alias("n_windows"),
        )
        .select(
            "doc_id", "license", "template", "n_shingles", F.col("best.n_found").alias("n_found"),
            (-F.col("best.back")).cast("long").alias("word_start"), "n_windows",
        )
    )


def _shingle_hashes(words: Column) -> Column:
    """Hashes of all shingles; that of the whole, if there are fewer words."""
    short = F.when(F.size(words) > 0, F.array(F.xxhash64(F.lit(SHINGLE), words))).otherwise(F.array().cast("array<long>"))
    return F.when(F.size(words) >= SHINGLE, native.gram_hashes(words, SHINGLE)).otherwise(short)
