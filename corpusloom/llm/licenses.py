"""Licence scan: sparse TF-IDF cosine of headers and licence files to templates, then inheritance from directories.

DataFrame functions only. A text is cut into units, its lines and the sentences in them; a passage begins at a unit with
a term of a template and goes on over as many units as it takes to hold as many terms as the template, so a notice
wrapped over lines, one within a longer line and a whole licence file all meet their template. Terms weigh by their
number and their inverse document frequency over the corpus; each term that no template has counts once, with the weight
of an unseen term. Texts are split into terms once, into a written table of the template terms in each unit.

A passage can't reach the threshold unless the template's terms in it have that share of its squared norm
(Cauchy-Schwarz). So a document is compared with a template only if all its terms together do, and with any template
only if it holds one of the anchors, the heaviest terms without which that share is out of reach.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, let, lookup_join, written

_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
    'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
    "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
    "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED '
    "TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software "
    "Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it "
    "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
    "GNU {name} for more details. You should have received a copy of the GNU {name} along with this program. If not, see http://www.gnu.org/licenses/."
)
_GNU_FILE = (
    "GNU {caps} Version {version}, {date} Copyright (C) {year} Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim "
    "copies of this license document, but changing it is not allowed."
)
# One-line notices, headers of source files, and licence files (of long ones their beginning).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MIT", _MIT),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
        "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3."),
    ("GPL-3.0", _GNU.format(name="General Public License", version="3")),
    ("GPL-3.0", _GNU_FILE.format(caps="GENERAL PUBLIC LICENSE", version="3", date="29 June 2007", year="2007")),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2."),
    ("GPL-2.0", _GNU.format(name="General Public License", version="2")),
    ("GPL-2.0", _GNU_FILE.format(caps="GENERAL PUBLIC LICENSE", version="2", date="June 1991", year="1989, 1991")),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", _GNU.format(name="Lesser General Public License", version="3")),
    ("LGPL-3.0", _GNU_FILE.format(caps="LESSER GENERAL PUBLIC LICENSE", version="3", date="29 June 2007", year="2007")),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", _GNU.format(name="Affero General Public License", version="3")),
    ("AGPL-3.0", _GNU_FILE.format(caps="AFFERO GENERAL PUBLIC LICENSE", version="3", date="19 November 2007", year="2007")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH '
        "REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that "
        "you wrote the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original "
        "software. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0."),
    ("Proprietary", "All rights reserved."),
)
TERM = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Names of files that speak for their directory.
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)([.-][^/]*)?$"
THRESHOLD = 0.75


#: Between sentences of a line.
SENTENCE_END = r"([.!?])[ \t]+"
#: Terms between which a passage and its units are brought together; no template is longer.
STRETCH = 512


def template_terms(templates=TEMPLATES) -> list[tuple[str, dict[str, int]]]:
    """(licence, number of each term) of the templates."""
    out = []
    for name, text in templates:
        found: dict[str, int] = {}
        for t in re.findall(TERM, text.lower()):
            found[t] = found.get(t, 0) + 1
        out.append((name, found))
    return out


def units(text: Column, vocabulary: Column) -> Column:
    """Structs line, n, known of a text's units that have terms: their line, number of terms, and those of the vocabulary."""
    pieces = F.flatten(F.transform(F.split(F.lower(text), "\n", -1), lambda line, i: F.transform(F.split(F.regexp_replace(line, SENTENCE_END, "$1\x01"), "\x01", -1), lambda p: F.struct(i.alias("line"), F.regexp_extract_all(p, F.lit(TERM), F.lit(0)).alias("terms")))))
    some = F.filter(pieces, lambda u: F.size(u.getField("terms")) > 0)

    def told(found: Column) -> Column:
        held = F.array_intersect(F.flatten(F.transform(found, lambda u: u.getField("terms"))), vocabulary)
        return let(held, lambda h: F.transform(found, lambda u: F.struct(u.getField("line").alias("line"), F.size(u.getField("terms")).alias("n"), F.filter(u.getField("terms"), lambda t: F.array_contains(h, t)).alias("known"))))

    return let(some, told)


def _weights(table: DataFrame, templates) -> tuple[dict[str, float], float]:
    """Squared inverse document frequency of each template term, and that of an unseen term."""
    held = table.select(F.explode(F.array_distinct(F.flatten(F.transform("units", lambda u: u.getField("known"))))).alias("term"))
    counts = {r["term"]: r["n"] for r in held.groupBy("term").agg(F.count("*").alias("n")).collect()}  # one row per template term
    n = table.count()
    weight = lambda df: (math.log((n + 1) / (df + 1)) + 1) ** 2
    return {t: weight(counts.get(t, 0)) for _, found in template_terms(templates) for t in found}, weight(0)


def _anchors(found: dict[str, int], square: dict[str, float], threshold: float) -> set[str]:
    """The heaviest terms of a template without all of which its share of a passage's norm is too small."""
    mass = {t: k * k * square[t] for t, k in found.items()}
    whole = left = sum(mass.values())
    out: set[str] = set()
    for t in sorted(mass, key=lambda t: (-mass[t], t)):
        if left < threshold**2 * whole * (1 - 1e-9):
            break
        out.add(t)
        left -= mass[t]
    return out


def matches(docs: DataFrame, id_col: str, text_col: str, path: Column, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(row, id, path, own, score, line): each document's best passage, a written table; null where none reaches the threshold.

    The highest score holds, then the last licence by name, then the first line.
    """
    spark = docs.sparkSession
    numbered = template_terms(templates)
    vocabulary = F.array(*[F.lit(t) for t in sorted({t for _, found in numbered for t in found})])
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    table = docs.select(F.col(id_col).alias("id"), path.alias("path"), units(text, vocabulary).alias("units"))
    table = written(table.withColumn("row", F.monotonically_increasing_id()), "units", compression="zstd")
    square, unseen = _weights(table, templates)

    # constant tables: terms of templates, and templates
    of = spark.createDataFrame([(i, t, k, square[t], k * k * square[t]) for i, (_, found) in enumerate(numbered) for t, k in found.items()], "tid int, term string, k int, w double, mass double")
    whole = spark.createDataFrame([(i, name, sum(found.values()), sum(k * k * square[t] for t, k in found.items())) for i, (name, found) in enumerate(numbered)], "tid int, licence string, length int, norm double")
    weight = spark.createDataFrame(sorted(square.items()), "term string, w double")
    anchors = F.array(*[F.lit(t) for t in sorted(set().union(*(_anchors(found, square, threshold) for _, found in numbered)))])

    # documents and templates that can reach the threshold
    held = F.array_distinct(F.flatten(F.transform("units", lambda u: u.getField("known"))))
    some = written(table.filter(F.arrays_overlap(held, anchors)).select("row", "units"), "anchored", compression="zstd")
    term = some.select("row", F.explode(held).alias("term")).join(F.broadcast(of), "term")
    shares = term.groupBy("row", "tid").agg(F.sum("mass").alias("share")).join(F.broadcast(whole), "tid")
    pairs = written(shares.filter(F.col("share") >= F.lit(threshold**2 * (1 - 1e-9)) * F.col("norm")).select("row", "tid", "length"), "pairs")

    # units in a row, each with the number of terms before it
    order = Window.partitionBy("row").orderBy("pos")
    unit = some.join(pairs.select("row").distinct(), "row", "left_semi").select("row", F.posexplode("units").alias("pos", "u")).select("row", "pos", "u.line", "u.n", "u.known")
    unit = unit.withColumn("before", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    unit = written(unit.withColumn("stretch", F.floor(F.col("before") / STRETCH).cast("long")), "sequence", compression="zstd")

    # passages: all units that begin before as many terms as the template has
    first = unit.select("row", "pos", "line", "before", F.explode(F.array_distinct("known")).alias("term")).join(F.broadcast(of.select("term", "tid")), "term")
    first = first.select("row", "tid", "pos", "line", "before").distinct().join(pairs, ["row", "tid"])
    reach = F.col("before") + F.col("length")
    spans = F.sequence(F.floor(F.col("before") / STRETCH).cast("long"), F.floor((reach - 1) / STRETCH).cast("long"))
    start = first.select("row", "tid", "pos", "line", "before", reach.alias("reach"), F.explode(spans).alias("stretch"))
    inside = unit.select(F.col("row").alias("u_row"), F.col("stretch").alias("u_stretch"), F.col("pos").alias("u_pos"), F.col("before").alias("u_before"), F.col("n").alias("u_n"), "known")
    within = (F.col("row") == F.col("u_row")) & (F.col("stretch") == F.col("u_stretch")) & (F.col("u_pos") >= F.col("pos")) & (F.col("u_before") < F.col("reach"))
    passage = start.join(inside, within)
    # a template is at most a few hundred terms long, and so is a passage but for its last unit
    total = passage.groupBy("row", "tid", "pos", "line").agg(F.sum("u_n").alias("total"))
    counts = passage.select("row", "tid", "pos", F.explode("known").alias("term")).groupBy("row", "tid", "pos", "term").agg(F.count("*").alias("n"))
    counts = counts.join(F.broadcast(weight), "term").join(F.broadcast(of.select("tid", "term", "k")), ["tid", "term"], "left")
    sums = counts.groupBy("row", "tid", "pos").agg(F.sum(F.col("n") * F.coalesce("k", F.lit(0)) * F.col("w")).alias("dot"), F.sum(F.col("n") * F.col("n") * F.col("w")).alias("known_norm"), F.sum("n").alias("known_n"))
    scored = total.join(sums, ["row", "tid", "pos"]).join(F.broadcast(whole), "tid")
    cosine = F.round(F.col("dot") / (F.sqrt("norm") * F.sqrt(F.col("known_norm") + (F.col("total") - F.col("known_n")) * F.lit(unseen))), 6)
    best = scored.select("row", F.struct(cosine.alias("score"), "licence", (-F.col("line")).alias("back")).alias("m")).filter(F.col("m.score") >= threshold).groupBy(F.col("row").alias("of")).agg(F.max("m").alias("m"))
    found = lookup_join(table.select("row", "id", "path"), written(best, "best"), F.col("row") == F.col("of"))
    out = written(found.select("row", "id", "path", F.col("m.licence").alias("own"), F.col("m.score").alias("score"), (-F.col("m.back")).alias("line")), "licences")
    forget(table, some, pairs, unit)
    return out


def ancestors(directory: Column) -> Column:
    """The directory and all above it, nearest first, each with its distance; the root is the empty path."""
    parts = F.filter(F.split(directory, "/"), lambda p: p != "")
    return let(parts, lambda p: F.transform(F.sequence(F.size(p), F.lit(0), F.lit(-1)), lambda k: F.struct((F.size(p) - k).alias("up"), F.array_join(F.slice(p, F.lit(1), k), "/").alias("above"))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None, declares: Column | None = None, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, path, own, score, line, licence, origin, inherited_from.

    A document's own notice comes first (origin ``own``). Without one it takes the licence of the nearest directory
    above it for which a document speaks (``inherited``): one that ``declares`` (a condition on ``path``; by default
    its file name) and has a notice. Where several speak, the most frequent licence holds, the first by name among
    equals. Otherwise the licence is null (``none``). Null texts are empty; a null path is a file at the root;
    repeated rows are kept, other columns don't matter, and an empty table gives an empty table.
    """
    where = F.coalesce((F.col("path") if path is None else path).cast("string"), F.lit(""))
    found = matches(docs, id_col, text_col, where, templates, threshold).withColumn("dir", F.regexp_replace(F.regexp_replace("path", r"[^/]*$", ""), r"^/+|/+$", ""))
    speaks = F.col("path").rlike(LICENCE_FILE) if declares is None else declares
    said = found.filter(F.col("own").isNotNull() & speaks).groupBy("dir", "own").agg(F.count("*").alias("n"))
    said = said.groupBy(F.col("dir").alias("above_dir")).agg(F.min(F.struct(-F.col("n"), F.col("own"))).getField("own").alias("theirs"))
    # directories inherit, not documents: their number doesn't grow with the files in one of them
    dirs = found.select("dir").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("a"))
    near = dirs.join(said, F.col("a.above") == F.col("above_dir")).groupBy(F.col("dir").alias("of_dir")).agg(F.min(F.struct("a.up", "a.above", "theirs")).alias("near"))
    joined = lookup_join(found, written(near, "directories"), F.col("dir") == F.col("of_dir"))
    return joined.select(
        "id",
        "path",
        "own",
        "score",
        "line",
        F.coalesce("own", "near.theirs").alias("licence"),
        F.when(F.col("own").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(F.col("own").isNull(), F.col("near.above")).alias("inherited_from"),
    )
