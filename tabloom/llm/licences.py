"""Licence texts and notices by the Dice coefficient over word bigrams, in DataFrame operations only.

A template is compared with every stretch of a text that is as long as itself, so line breaks,
paragraphs and whatever stands around a notice do not matter. Sizes prune: a stretch reaches the
threshold only with so many of the template's bigrams, so texts with fewer bigrams, or fewer of the template's, are passed
over before any stretch is looked at.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

THRESHOLD = 0.8
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF'
    " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR"
    " ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH"
    " THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the"
    " documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from"
    " this software without specific prior written permission."
)
_BSD_END = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT'
    " LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
    " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)"
    " ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_GNU = (
    "This {work} is free software{colon} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the"
    " Free Software Foundation{comma} either version {version} of the License, or (at your option) any later version."
)
_GNU_END = (
    " This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
    " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
_VERBATIM = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."


def _gnu(name: str, version: str, work: str = "program") -> str:
    return _GNU.format(work=work, colon=":", name=name, comma=",", version=version)


#: Published licence bodies, and the usual wordings of notices.
TEMPLATES = (
    ("AGPL-3.0", _gnu("Affero General Public License", "3")),
    ("AGPL-3.0", _gnu("Affero General Public License", "3") + _GNU_END.format(name="Affero General Public License")),
    ("AGPL-3.0", f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("BSD", _BSD_HEAD),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TWO + _BSD_END),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_TWO + _BSD_THIRD + _BSD_END),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", _gnu("General Public License", "2")),
    ("GPL-2.0", f"GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. {_VERBATIM}"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _gnu("General Public License", "3")),
    ("GPL-3.0", _gnu("General Public License", "3") + _GNU_END.format(name="General Public License")),
    ("GPL-3.0", f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}"),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("LGPL-2.1", _gnu("Lesser General Public License", "2.1", "library")),
    ("LGPL-3.0", _gnu("Lesser General Public License", "3")),
    ("LGPL-3.0", f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_VERBATIM}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. ' + _AS_IS),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
)
NO_WORD = r"[^\p{L}\p{N}]+"
#: The frame of a stretch in units of the template's length; templates have fewer than 5,000 bigrams.
STRETCH = "0.9999D"


def words(text: Column) -> Column:
    """Normalised words; one empty word where there is none."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), NO_WORD, " ")), " ")


def bigrams(ws: Column) -> Column:
    """Pairs of neighbouring words in order; none of a lone word. ``ws`` is a column of an earlier
    projection, so that it is computed once and not for every pair."""
    n = F.greatest(F.size(ws) - 1, F.lit(0))
    return F.zip_with(F.slice(ws, F.lit(1), n), F.slice(ws, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))


def cover_words(templates: list[list[str]], ratio: float) -> list[str]:
    """Words of which every stretch that reaches the threshold holds at least one.

    Such a stretch shares at least ``ratio`` of a template's distinct bigrams with it; so words, long
    ones first and of these such as few templates have, are taken from each template until fewer than
    that many bigrams are without one of them."""
    cover: set[str] = set()
    common = Counter(w for pairs in templates for w in {w for p in pairs for w in p.split(" ")})
    for pairs in templates:
        halves = {tuple(p.split(" ")) for p in pairs}
        bare = [pair for pair in halves if not cover & set(pair)]
        while len(bare) >= ratio * len(halves) - 1e-9:
            gain = Counter(w for pair in bare for w in set(pair))
            cover.add(max(sorted(gain), key=lambda w: (min(len(w), 9), -common[w], gain[w])))
            bare = [pair for pair in bare if not cover & set(pair)]
    return sorted(cover)


def any_of(ws: list[str]) -> str:
    """A pattern for any of the words; those with the same first sign share a branch, so few are tried."""
    branches: dict[str, list[str]] = {}
    for w in ws:
        branches.setdefault(w[0], []).append(w[1:])
    return "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in branches.items())


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """``template``, ``licence``, ``span`` (bigrams in its text), ``t_size`` (distinct ones), ``pair``: a row
    per distinct bigram, of a fixed few thousand."""
    rows = spark.createDataFrame([(k, *t) for k, t in enumerate(templates)], "template int, licence string, wording string")
    rows = rows.withColumn("ws", words(F.col("wording"))).withColumn("pairs", bigrams(F.col("ws")))
    rows = rows.select("template", "licence", F.size("pairs").alias("span"), F.array_distinct("pairs").alias("pairs"))
    return rows.select("template", "licence", "span", F.size("pairs").alias("t_size"), F.posexplode("pairs").alias("name", "pair"))


def licence_scan(documents: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``licence``, ``dice``, ``start``, ``n_words``: the licences of every document, each with its
    most similar stretch (of equals the longest, then the first), by the number of its first word and its length.

    A stretch has as many bigrams as the template, or fewer at the end of a text; it starts with one of
    the template's bigrams. With s distinct bigrams in common, the coefficient is 2s over the template's
    distinct bigrams plus s plus the stretch's other bigrams. Of licences whose stretches overlap in a
    text only the most similar is kept, of equals the longest, then the first by name.

    Null and empty texts, texts of one word and rows with a null id have none; repeated rows count once;
    of several texts of an id the most similar stretch counts; texts of any length are compared whole;
    other columns are left behind; an empty table gives no rows. The templates are a fixed short list,
    which is broadcast. Texts without any of the templates' cover words cannot reach the threshold.
    """
    known = template_table(documents.sparkSession, templates)
    ratio = threshold / (2 - threshold)  # least share of a template's bigrams at the threshold
    wordings = known.groupBy("template").agg(F.sort_array(F.collect_list("pair")).alias("pairs")).orderBy("template").collect()
    possible = F.lower("text").rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{any_of(cover_words([r['pairs'] for r in wordings], ratio))})(?![\p{{L}}\p{{N}}])")

    own = documents.where("doc_id is not null and text is not null").where(possible)
    split = own.select("doc_id", F.xxhash64("text").alias("mark"), words(F.col("text")).alias("ws"))
    pairs = split.select("doc_id", "mark", bigrams(F.col("ws")).alias("pairs")).select("doc_id", "mark", F.size("pairs").alias("n"), F.posexplode("pairs").alias("pos", "pair"))
    enough = F.col("n") >= F.col("t_size") * ratio
    hits = pairs.join(F.broadcast(known), "pair").where(enough).select("doc_id", "mark", "template", "licence", "span", "t_size", "n", "pos", "name")
    place = ["doc_id", "mark", "template"]
    # Repeated rows of a text would count twice in a stretch.
    hits = hits.dropDuplicates([*place, "pos"]).withColumn("held", F.size(F.collect_set("name").over(Window.partitionBy(*place))))
    hits = hits.where(F.col("held") >= F.col("t_size") * ratio).withColumn("at", F.col("pos") / F.col("span"))
    frame = f"over (partition by doc_id, mark, template order by at range between current row and {STRETCH} following)"
    stretches = hits.withColumn("shared", F.expr(f"size(collect_set(name) {frame})")).withColumn("inside", F.expr(f"count(*) {frame}"))
    length = F.least(F.col("span"), F.col("n") - F.col("pos"))
    dice = 2 * F.col("shared") / (F.col("t_size") + F.col("shared") + length - F.col("inside"))
    found = stretches.withColumn("dice", dice).where(F.col("dice") >= threshold)
    best = found.groupBy("doc_id", "mark", "licence").agg(F.min(F.struct((-F.col("dice")).alias("d"), (-length).alias("less"), F.col("pos").alias("start"))).alias("b"))
    # At most one entry per licence.
    together = best.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("licence", "b.d", "b.less", "b.start")).alias("all"))

    def beaten(x: Column) -> Column:
        def beats(y: Column) -> Column:
            overlap = (y["start"] <= x["start"] - x["less"]) & (x["start"] <= y["start"] - y["less"])
            return overlap & (F.struct(y["d"], y["less"], y["licence"]) < F.struct(x["d"], x["less"], x["licence"]))

        return F.exists("all", beats)

    kept = together.select("doc_id", F.inline(F.filter("all", lambda x: ~beaten(x))))
    kept = kept.groupBy("doc_id", "licence").agg(F.min(F.struct("d", "less", "start")).alias("b"))
    return kept.select("doc_id", "licence", (-F.col("b.d")).alias("dice"), "b.start", (F.lit(1) - F.col("b.less")).alias("n_words"))
