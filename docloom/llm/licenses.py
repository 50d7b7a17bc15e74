"""Operator 10, licence scans.

Each document is compared piece by piece: its sentences, its lines, its paragraphs (parted by blank lines), runs of two to ``MOST_PARAGRAPHS``
paragraphs that are no longer than a licence text can be, and its whole text, normalised to lower-case ASCII letters and digits.  A piece matches a licence template if the Dice coefficient of their sets of word
bigrams is 0.8 or more, and no other template's is higher.  That coefficient cannot be reached unless the piece's number of bigrams is between t and
1/t times the template's, with t = 0.8 / 1.2, nor unless a share t of the piece's bigrams occur in some
template; both bounds prune without losing a match.  A match holds at least a share t of the template's bigrams too; so for each
template words are chosen that occur in more than a share 1 - t of its bigrams, and a text with none of these words is passed by.

Templates are names in the phrases that grant them, whole short licences, and the notices that stand for long ones (Apache, GPL, LGPL, AGPL, MPL).  Whole
texts of long licences are not among them; ``scan_licenses`` takes more templates.

Null or empty text: no licence.  Null doc_id and repeated rows: each is reported.  Equal scores: the first licence by name is the best.
Empty table: no rows.  Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import json
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower

THRESHOLD = 0.8

# Names by which licences are granted, and the phrases that grant them.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPLv3"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "BSD License"],
    "CC-BY-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["CC0 1.0 Universal", "CC0 1.0 Universal Public Domain Dedication"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPLv2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPLv3"],
    "ISC": ["ISC License"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPLv3"],
    "MIT": ["MIT License", "MIT license terms"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0"],
    "Unlicense": ["Unlicense"],
}
#: Words that are too frequent to tell texts apart.
FREQUENT = frozenset(
    "a all also an and any are as at be been but by can do for from has have if in into is it its may no not of on or other out shall such that the their this to under was were which will with you your".split()
)
GRANTS = [
    "Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}", "Distributed under the {}", "This work is licensed under {}",
    "This work is licensed under the {}", "This work is licensed under a {}", "This project is licensed under the terms of the {}", "This software is released under the {}",
]
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
    "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
    sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
    The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
    FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
    LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
    THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
    copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
    THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
    CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
    ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain
    a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the
    License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
    governing permissions and limitations under the License.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can
    obtain one at https://mozilla.org/MPL/2.0/.""",
}


TEXTS |= {
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

    1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

    2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or
    other materials provided with the distribution.

    THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
    WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
    DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
    USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
    NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

    Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
    commercial or non-commercial, and by any means.

    In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public
    domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt
    act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
    PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT
    OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

    For more information, please refer to <https://unlicense.org>""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use
    of this software.

    Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to
    the following restrictions:

    1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an
    acknowledgment in the product documentation would be appreciated but is not required.

    2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

    3. This notice may not be removed or altered from any source distribution.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this
    license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit
    third-parties to whom the Software is furnished to do so, all subject to the following:

    The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included
    in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of
    machine-executable object code generated by a source language processor.

    THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
    PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER
    LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific
    prior written permission.

    THIS SOFTWARE IS PROVIDED BY"""
TEXTS["BSD-3-Clause"] = TEXTS["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED BY", _BSD_THIRD)
_GNU_NOTICE = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} Public License as published by the Free Software Foundation,
    either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
    without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} Public License for more details. You should have received
    a copy of the GNU {0} Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
TEXTS |= {k: _GNU_NOTICE.format(*own) for k, own in {"AGPL-3.0": ("Affero General", 3), "GPL-2.0": ("General", 2), "GPL-3.0": ("General", 3), "LGPL-3.0": ("Lesser General", 3)}.items()}

#: Paragraphs of the longest runs that are compared.
MOST_PARAGRAPHS = 8


def normalised(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.translate(str.maketrans(UPPER, LOWER))).strip()


def bigrams(text: str) -> list[str]:
    words = normalised(text).split(" ")
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def templates(more: dict[str, list[str]] | None = None) -> list[dict]:
    """Licence and bigrams of every template of at least three bigrams; ``more`` texts by licence beside the known ones."""
    texts = [(k, g.format(n)) for k, names in NAMES.items() for n in names for g in GRANTS]
    texts += [(k, f"SPDX-License-Identifier: {k}") for k in NAMES] + list(TEXTS.items())
    texts += [(k, t) for k, own in (more or {}).items() for t in own]
    return [{"id": k, "grams": b} for k, b in dict.fromkeys((k, tuple(bigrams(t))) for k, t in texts) if len(b) >= 3]


def share_of(threshold: float) -> tuple[int, int]:
    """t as numerator and denominator: as a float it is rounded, which loses matches at the threshold itself."""
    exact = Fraction(str(threshold))
    return (exact / (2 - exact)).as_integer_ratio()


def telling_words(known: list[dict], threshold: float = THRESHOLD) -> list[str]:
    """Words of which every match of any template has at least one: infrequent and long ones first."""
    chosen: set[str] = set()
    part, whole = share_of(threshold)
    for t in known:
        words = {w for g in t["grams"] for w in g.split(" ")}
        covered: set[str] = set()
        for w in sorted(words, key=lambda w: (w not in chosen, w in FREQUENT, -len(w), w)):
            if whole * len(covered) > (whole - part) * len(t["grams"]):
                break
            own = {g for g in t["grams"] if w in g.split(" ")}
            if not own <= covered:
                chosen.add(w)
                covered |= own
    return sorted(chosen)


def most_words(known: list[dict], threshold: float = THRESHOLD) -> int:
    """Words of the longest run of paragraphs that is compared: with more bigrams no template is near enough."""
    part, whole = share_of(threshold)
    return whole * max(len(t["grams"]) for t in known) // part + 1


def pieces(text: Column, most: int) -> Column:
    """Normalised sentences, lines, paragraphs, runs of paragraphs of together at most ``most`` words, and the whole."""
    low = ascii_lower(F.coalesce(text, F.lit("")))
    lines = F.regexp_replace(low, "[^a-z0-9\n]+", " ")
    sentences = F.regexp_replace(F.regexp_replace(low, "([.!?])[ \t]+", "$1\n"), "[^a-z0-9\n]+", " ")
    flat = lambda x: F.trim(F.regexp_replace(F.replace(x, F.lit("\n"), F.lit(" ")), " +", " "))
    blocks = F.filter(F.transform(F.split(lines, "\n ?\n"), flat), lambda x: x != "")
    single = F.concat(F.split(sentences, "\n"), F.split(lines, "\n"), F.array(F.replace(lines, F.lit("\n"), F.lit(" "))))
    single = F.transform(single, lambda x: F.trim(F.regexp_replace(x, " +", " ")))
    return F.array_distinct(F.concat(single, blocks, _runs(blocks, most)))


def _runs(blocks: Column, most: int) -> Column:
    def from_place(i: Column) -> Column:
        run = lambda k: F.array_join(F.slice(blocks, i + 1, k), " ")
        sizes = F.filter(F.sequence(F.lit(2), F.lit(MOST_PARAGRAPHS)), lambda k: k <= F.size(blocks) - i)
        return F.filter(F.transform(sizes, run), lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) < most)

    return F.when(F.size(blocks) > 1, F.flatten(F.transform(F.sequence(F.lit(0), F.size(blocks) - 2), from_place))).otherwise(F.array().cast("array<string>"))


def scan_licenses(docs: DataFrame, threshold: float = THRESHOLD, more: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id and matches array<struct<score,id>>: the best score of each licence found, by licence; ``more``: further templates by licence."""
    known = templates(more)
    sizes = [len(t["grams"]) for t in known]
    part, whole = share_of(threshold)
    least, most = part * min(sizes), whole * max(sizes)
    union = sorted({g for t in known for g in t["grams"]})
    table = F.from_json(F.lit(json.dumps(known)), "array<struct<id:string,grams:array<string>>>")

    def grams(piece: Column) -> Column:
        words = F.split(piece, " ")
        return F.array_distinct(F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b)))

    def spaces(piece: Column) -> Column:
        return F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))

    # A piece has at most as many distinct bigrams as spaces; one with too many spaces may repeat itself, so only its bigrams tell.
    long_enough = F.filter(F.col("pieces"), lambda x: whole * spaces(x) >= least)
    sets = F.filter(F.transform(long_enough, grams), lambda g: (whole * F.size(g) >= least) & (part * F.size(g) <= most))
    near = F.filter(sets, lambda g: whole * F.size(F.filter(g, lambda x: x.isin(union))) >= part * F.size(g))

    def scored(g: Column) -> Column:
        fitting = F.filter(table, lambda t: (whole * F.size(t["grams"]) >= part * F.size(g)) & (part * F.size(t["grams"]) <= whole * F.size(g)))
        return F.transform(fitting, lambda t: F.struct((2.0 * F.size(F.array_intersect(g, t["grams"])) / (F.size(g) + F.size(t["grams"]))).alias("score"), t["id"].alias("id")))

    scores = F.transform(F.transform(near, scored), lambda ms: F.struct(ms.alias("ms"), F.array_max(F.transform(ms, lambda m: m["score"])).alias("top")))
    found = F.flatten(F.transform(F.filter(scores, lambda x: x["top"] >= threshold), lambda x: F.filter(x["ms"], lambda m: m["score"] == x["top"])))
    best = F.transform(
        F.array_sort(F.array_distinct(F.transform("found", lambda m: m["id"]))),
        lambda k: F.struct(F.array_max(F.transform(F.filter("found", lambda m: m["id"] == k), lambda m: m["score"])).alias("score"), k.alias("id")),
    )
    telling = f"(?<![a-z0-9])(?:{'|'.join(telling_words(known, threshold))})(?![a-z0-9])"
    low = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select("doc_id", F.when(low.rlike(telling), pieces(F.col("text"), most_words(known, threshold))).alias("pieces")).select("doc_id", F.when(F.col("pieces").isNotNull(), found).alias("found"))
    return rows.select("doc_id", F.when(F.size("found") > 0, best).otherwise(F.array().cast("array<struct<score:double,id:string>>")).alias("matches"))


def license_report(docs: DataFrame) -> DataFrame:
    found = scan_licenses(docs)
    top = F.array_max(F.transform("matches", lambda m: m["score"]))
    first = F.get(F.filter("matches", lambda m: m["score"] == top), F.lit(0))
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_licenses"), F.array_join(F.transform("matches", lambda m: m["id"]), ",").alias("licenses"),
        first["id"].alias("best_license"), first["score"].alias("best_score"),
    )


def oracle_sql() -> str:
    """The same report in DuckDB's SQL, over all pairs of pieces and templates that share a bigram."""
    values = ", ".join(f"({i}, '{t['id']}', [{', '.join(repr(g) for g in t['grams'])}])" for i, t in enumerate(templates()))
    return rf"""
WITH t(tid, id, grams) AS (VALUES {values}),
tg AS (SELECT tid, id, len(grams) AS n, unnest(grams) AS g FROM t),
d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents),
l AS (SELECT r, low, regexp_replace(low, '[^a-z0-9\n]+', ' ', 'g') AS lines FROM d),
bl AS (SELECT r, [y for y in [trim(regexp_replace(replace(x, chr(10), ' '), ' +', ' ', 'g')) for x in string_split_regex(lines, '\n ?\n')] if y <> ''] AS b FROM l),
p AS (
    SELECT r, unnest(string_split(regexp_replace(regexp_replace(low, '([.!?])[ \t]+', '\1' || chr(10), 'g'), '[^a-z0-9\n]+', ' ', 'g'), chr(10))) AS s FROM l
    UNION ALL SELECT r, unnest(string_split(lines, chr(10))) FROM l
    UNION ALL SELECT r, unnest(b) FROM bl
    UNION ALL SELECT r, s FROM (SELECT r, array_to_string(b[i:i + k - 1], ' ') AS s FROM (SELECT r, b, unnest(range(1, len(b))) AS i FROM bl), (SELECT unnest(range(2, {MOST_PARAGRAPHS} + 1)) AS k) WHERE i + k - 1 <= len(b)) WHERE len(string_split(s, ' ')) <= {most_words(templates())}
    UNION ALL SELECT r, replace(lines, chr(10), ' ') FROM l),
u AS (SELECT row_number() OVER () AS k, r, string_split(trim(regexp_replace(s, ' +', ' ', 'g')), ' ') AS w FROM (SELECT DISTINCT r, s FROM p)),
g AS (SELECT DISTINCT k, r, w[i] || ' ' || w[i + 1] AS g FROM (SELECT k, r, w, unnest(range(1, len(w))) AS i FROM u)),
c AS (SELECT k, count(*) AS n FROM g GROUP BY k),
m AS (SELECT g.k, g.r, tg.tid, tg.id, any_value(tg.n) AS tn, count(*) AS shared FROM g JOIN tg USING (g) GROUP BY ALL),
v AS (SELECT k, r, id, 2.0::DOUBLE * shared / (c.n + tn) AS score FROM m JOIN c USING (k)),
s AS (SELECT r, id, max(score) AS score FROM (SELECT *, max(score) OVER (PARTITION BY k) AS own FROM v) WHERE score >= {THRESHOLD} AND score = own GROUP BY r, id),
a AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids, max(score) AS top FROM s GROUP BY r),
b AS (SELECT r, min(id) AS best FROM s JOIN a USING (r) WHERE score = top GROUP BY r)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(ids, '') AS licenses, best AS best_license, top AS best_score FROM d LEFT JOIN a USING (r) LEFT JOIN b USING (r)
"""
