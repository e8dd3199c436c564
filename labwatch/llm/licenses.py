"""Licence scan: Dice coefficient over word bigrams against templates, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices as their licences or common practice word them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "bsd-3-clause": "Released under the BSD 3-Clause License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
# Texts and file headers of licences, which stand over several lines.
BODIES = {
    "apache-2.0": """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See
the License for the specific language governing permissions and limitations under the License.
""",
    "bsd-2-clause": """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE.
""",
    "bsd-3-clause": """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE.
""",
    "gpl-3.0": """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License
for more details.
You should have received a copy of the GNU General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.
""",
    "agpl-3.0": """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public
License for more details.
You should have received a copy of the GNU Affero General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.
""",
    "lgpl-3.0": """
This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
your option) any later version.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public
License for more details.
You should have received a copy of the GNU Lesser General Public License along with this program. If not, see
<https://www.gnu.org/licenses/>.
""",
    "isc": """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
""",
    "mit": """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following
conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
""",
    "mpl-2.0": """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.
""",
}
# Where a line is cut further: after a sentence.
SENTENCE = "(?<=[.!?;:])\\s+"
# Words that say little of a licence; only how many texts are looked at hangs on them.
COMMON = frozenset("a all an and any are as at by for if in is it may not of on or see that the this to under use with you".split())
SEPARATORS = {"line": "\n", "paragraph": "\n\\s*\n"}


def normalised_words(text: str) -> list[str]:
    """The words of a template: what ``_words`` makes of the same text on the cluster."""
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def bigrams(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " ")


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    threshold: float = 0.8,
    unit: str = "line",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, unit_no, license, dice``: every unit of text that is a licence notice, with its best template.

    A unit is a line, a paragraph or the whole ``text``. Lower-cased, with every run of other characters than a-z
    and 0-9 as one blank, it is a set of word bigrams; dice is twice the shared bigrams over both sizes. A template
    of n bigrams can reach the threshold t only with units of ceil(n t / (2 - t)) to floor(n (2 - t) / t) bigrams, so
    others are never compared. Ties between templates go to the smaller name.

    Null and empty texts and units of one word have no bigrams and match nothing; repeated rows give repeated
    results, null keys stay null; other columns of ``docs`` are not read.
    """
    templates = TEMPLATES if templates is None else templates
    forms = {name: grams for name, body in templates.items() if (grams := bigrams(normalised_words(body)))}
    bounds = {
        n: (math.ceil(len(g) * threshold / (2 - threshold) - 1e-9), math.floor(len(g) * (2 - threshold) / threshold + 1e-9))
        for n, g in forms.items()
    }
    least = min((low for low, _ in bounds.values()), default=1)
    most = max((high for _, high in bounds.values()), default=0)

    whole = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    if unit == "text":
        units = whole.select("key", F.lit(0).alias("unit_no"), F.col("text").alias("unit"))
    else:
        units = whole.select("key", F.posexplode(F.split("text", SEPARATORS[unit])).alias("unit_no", "unit"))
    # Each one-row generator keeps the optimizer from repeating the work below it in a filter above it.
    words = units.select("key", "unit_no", F.explode(F.array(_words(F.col("unit")))).alias("words"))
    words = words.where(F.size("words") > max(least, 1))
    pairs = F.transform(
        F.slice("words", 1, F.size("words") - 1), lambda w, i: F.concat(w, F.lit(" "), F.col("words")[i + 1])
    )
    sets = words.select("key", "unit_no", F.explode(F.array(F.array_distinct(pairs))).alias("pairs"))
    sets = sets.where(F.size("pairs").between(max(least, 1), most))
    known = F.array(*[F.lit(g) for g in sorted({g for grams in forms.values() for g in grams})])
    if not forms:
        sets, known = sets.where(F.lit(False)), F.array(F.lit(""))
    hits = sets.select(
        "key", "unit_no", F.size("pairs").alias("n"), F.explode(F.array(F.array_intersect("pairs", known))).alias("hits")
    ).where(F.size("hits") > 0)

    def scored(name: str) -> Column:
        low, high = bounds[name]
        shared = F.size(F.array_intersect("hits", F.array(*[F.lit(g) for g in forms[name]])))
        dice = F.lit(2.0) * shared / (F.col("n") + F.lit(len(forms[name])))
        return F.struct(
            (-F.when(F.col("n").between(low, high), dice).otherwise(F.lit(-1.0))).alias("minus"), F.lit(name).alias("license")
        )

    scores = [scored(name) for name in sorted(forms)] or [
        F.struct(F.lit(1.0).alias("minus"), F.lit("").alias("license"))
    ]
    best = hits.select("key", "unit_no", F.explode(F.array(F.array_min(F.array(*scores)))).alias("best"))
    return best.where(F.col("best.minus") <= F.lit(-threshold)).select(
        F.col("key").alias(key), "unit_no", F.col("best.license").alias("license"), (-F.col("best.minus")).alias("dice")
    )


def telling_words(forms: list[tuple[str, list[str], int, int, bool]]) -> list[str]:
    """Words one of which every text has that shares enough bigrams with any template."""
    told: set[str] = set()
    for _, grams, need, *_ in forms:
        left = [g.split() for g in grams if not told & set(g.split())]
        for word in sorted({w for g in left for w in g}, key=lambda w: (w in COMMON or w.isdigit(), -len(w), w)):
            if len(left) < need:
                break
            told.add(word)
            left = [g for g in left if word not in g]
    return sorted(told)


def _once(df: DataFrame, *kept: str, **made: Column) -> DataFrame:
    """``df`` with columns that the optimizer does not compute again in filters and columns above."""
    fields = F.struct(*[c.alias(n) for n, c in made.items()])
    return df.select(*kept, F.explode(F.array(fields)).alias("_made")).select(*kept, *[f"_made.{n}" for n in made])


def scan_passages(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    bodies: dict[str, str] | None = None,
    threshold: float = 0.8,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, unit_no, license, dice`` of the licence passages that no single line holds; unit_no is the first line.

    Lines are cut further where a sentence ends. A passage is a run of adjacent pieces, at most as long as a template
    allows (its bigrams with repeats, by (2 - t) / t); bigrams go over the pieces' ends, dice is that of
    ``scan_licenses``. Of passages that overlap the best stays, then the earlier, the shorter, the smaller name. A
    passage that is one whole line counts against ``bodies`` only: ``scan_licenses`` has the others.
    """
    templates = TEMPLATES if templates is None else templates
    bodies = BODIES if bodies is None else bodies
    forms, wide = [], (2 - threshold) / threshold
    for notice, texts in ((True, templates), (False, bodies)):
        for name, body in texts.items():
            words = normalised_words(body)
            if grams := bigrams(words):
                need, far = math.ceil(len(grams) / wide - 1e-9), math.floor((len(words) - 1) * wide + 1e-9)
                forms.append((name, grams, need, far, notice))
    whole = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if not forms:
        whole, forms = whole.where(F.lit(False)), [("", ["a b"], 1, 1, False)]
    told = F.lit(f"(?<![a-z0-9])(?:{'|'.join(telling_words(forms))})(?![a-z0-9])")
    looked = whole.where(F.regexp_like(F.lower("text"), told))

    cut = _once(
        looked,
        "key",
        pieces=F.filter(
            F.flatten(
                F.transform(
                    F.split("text", "\n"),
                    lambda line, n: F.transform(
                        F.split(line, SENTENCE), lambda p: F.struct(n.alias("line"), _words(p).alias("words"))
                    ),
                )
            ),
            lambda p: p["words"][0] != "",
        ),
    )
    words = _once(
        cut.where(F.size("pieces") > 0),
        "key",
        lines=F.transform("pieces", lambda p: p["line"]),
        words=F.flatten(F.transform("pieces", lambda p: p["words"])),
        owner=F.flatten(F.transform("pieces", lambda p, n: F.array_repeat(n, F.size(p["words"])))),
    ).where(F.size("words") > 1)
    pairs = _once(
        words,
        "key",
        "lines",
        "owner",
        pairs=F.transform(
            F.slice("words", 1, F.size("words") - 1), lambda w, i: F.concat(w, F.lit(" "), F.col("words")[i + 1])
        ),
        size=F.size("words"),
        begins=F.filter(
            F.sequence(F.lit(0), F.size("words") - 1), lambda i: (i == 0) | (F.get("owner", i) != F.get("owner", i - 1))
        ),
    )
    known = F.array(*[F.lit(g) for g in sorted({g for _, grams, *_ in forms for g in grams})])
    met = _once(pairs, "key", "lines", "owner", "pairs", "size", "begins", hits=F.array_intersect("pairs", known))
    kinds = [
        F.struct(
            F.lit(name).alias("license"),
            F.array(*[F.lit(g) for g in grams]).alias("grams"),
            F.lit(need).alias("need"),
            F.lit(far).alias("far"),
            F.lit(notice).alias("notice"),
        )
        for name, grams, need, far, notice in forms
    ]
    able = _once(
        met,
        "key",
        "lines",
        "owner",
        "pairs",
        "begins",
        able=F.filter(F.array(*kinds), lambda k: F.size(F.array_intersect("hits", k["grams"])) >= k["need"]),
        ends=F.concat(F.slice("begins", 2, F.size("begins")), F.array("size")),
    ).where(F.size("able") > 0)

    def dice(k: Column, begin: Column, end: Column) -> Column:
        own = F.array_distinct(F.slice("pairs", begin + 1, end - begin - 1))
        return F.lit(2.0) * F.size(F.array_intersect(own, k["grams"])) / (F.size(own) + F.size(k["grams"]))

    def runs(k: Column) -> Column:
        # A run whose first piece starts no bigram of the template is worse than the run without it.
        starts = F.filter(
            F.transform("begins", lambda b, n: F.struct(n.alias("n"), b.alias("b"))),
            lambda s: F.arrays_overlap(F.slice("pairs", s["b"] + 1, F.get("ends", s["n"]) - s["b"]), k["grams"]),
        )

        def of_start(s: Column) -> Column:
            ends = F.filter(
                F.slice("ends", s["n"] + 1, k["far"] + 1),
                lambda e: (e - s["b"] - 1 >= k["need"]) & (e - s["b"] - 1 <= k["far"]),
            )
            return F.transform(
                ends,
                lambda e: F.struct(
                    (-dice(k, s["b"], e)).alias("minus"),
                    s["b"].alias("b"),
                    e.alias("e"),
                    k["license"].alias("license"),
                    s["n"].alias("n"),
                    k["notice"].alias("notice"),
                ),
            )

        return F.flatten(F.transform(starts, of_start))

    good = _once(
        able,
        "key",
        "lines",
        "owner",
        good=F.array_sort(F.filter(F.flatten(F.transform("able", runs)), lambda r: r["minus"] <= -threshold)),
    ).where(F.size("good") > 0)
    best = F.aggregate(
        "good",
        F.slice("good", 1, 0),
        lambda kept, r: F.when(
            F.exists(kept, lambda o: (o["b"] < r["e"]) & (r["b"] < o["e"])), kept
        ).otherwise(F.concat(kept, F.array(r))),
    )
    found = good.select("key", "lines", "owner", F.explode(best).alias("run"))
    first, last = F.col("run.n"), F.get("owner", F.col("run.e") - 1)
    line = F.get("lines", first)
    lone = (
        (F.get("lines", last) == line)
        & ((first == 0) | (F.get("lines", first - 1) != line))
        & ((last == F.size("lines") - 1) | (F.get("lines", last + 1) != line))
    )
    return found.where(~(lone & F.col("run.notice"))).select(
        F.col("key").alias(key), line.alias("unit_no"), F.col("run.license").alias("license"), (-F.col("run.minus")).alias("dice")
    )
