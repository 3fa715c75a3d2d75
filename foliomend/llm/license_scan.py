"""Licence scans: Dice coefficient over word bigrams against templates, in DataFrame functions only.

Units are the whole text, each of its lines, and passages, normalised to lower-case words. A passage
is a run of consecutive words, over line ends, that begins and ends with a bigram of the template it
holds once, and has as many distinct bigrams as the template allows, however often these come: what lies
outside such bigrams only lowers the coefficient, and a run that comes back to its first bigram holds no more
than the one that begins there.
A template of b
bigrams can only reach the coefficient t with a unit of t / (2 - t) * b to (2 - t) / t * b distinct
bigrams. A unit has fewer bigrams than words and no fewer than distinct words less one, so most
units are pruned before their bigrams are made, and more templates once their number is known.
Of a template's bigrams t / (2 - t) * b must occur. So out of any more than the others, at least one
does; passages are looked for only in texts with the longer word of one of those with the longest
words, and from bigrams that enough others follow closely. All happens within a row: nothing is shuffled.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short notices and licence texts, by name.
TEMPLATES: list[tuple[str, str]] = [
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("all-rights-reserved", "All rights reserved."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("bsd", "Released under the BSD License."),
    ("bsd-2-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Complete texts with their disclaimers.
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
COMPLETE: list[tuple[str, str]] = [(f"{name}-full", f"{dict(TEMPLATES)[of]} {more}") for name, of, more in (("bsd-2-clause", "bsd-2-clause", _BSD_AS_IS), ("isc", "isc", _ISC_AS_IS), ("mit", "mit-permission", _AS_IS))]

#: Times that the reach of a passage may double: enough for any text.
DOUBLINGS = 30
#: Anything between words, but for line ends.
GAP = r"[^\p{L}\p{N}\n]+"


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def bigrams(text: str) -> list[str]:
    w = words(text)
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:])})


def bounds(n: int, least: float) -> tuple[int, int]:
    """Fewest and most bigrams of a unit that can reach the coefficient with a template of n."""
    return math.ceil(least / (2 - least) * n - 1e-9), math.floor((2 - least) / least * n + 1e-9)


def anchors(grams: list[str], fewest: int) -> list[str]:
    """Words of which at least one occurs wherever `fewest` of the bigrams do."""
    longest = sorted((max(g.split(), key=len) for g in grams), key=lambda w: (-len(w), w))
    return sorted(set(longest[: len(grams) - fewest + 1]))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES + COMPLETE, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, license, dice, line_no, n_units.

    license: the template with the highest coefficient >= least over the whole text (line_no 0), its
    lines (from 1) and its passages (the line they begin on), null if there is none; ties go to whole
    texts and lines before passages, then to the smaller name, then the smaller line.
    n_units: how many line_nos have a unit that matches some template. Null and empty texts match nothing. Templates of
    fewer than two words are ignored. Repeated rows get equal rows, other columns of docs are not
    read, and an empty table gives an empty result. A very long text is held as arrays of its words in
    one row.
    """
    sets = [(name, grams) for name, text in templates if (grams := bigrams(text))]
    none = docs.select(F.col(id_col).alias("doc_id"))
    if not sets:
        return none.select("doc_id", F.lit(None).cast("string").alias("license"), F.lit(None).cast("double").alias("dice"), F.lit(None).cast("int").alias("line_no"), F.lit(0).alias("n_units"))
    table = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(low).alias("low"), F.lit(high).alias("high"), F.array(*map(F.lit, grams)).alias("grams"), F.array(*map(F.lit, anchors(grams, low))).alias("anchors")) for name, grams in sets for low, high in [bounds(len(grams), least)]))
    plain = F.regexp_replace(F.lower(F.col(text_col).cast("string")), GAP, " ")

    def unit(number: Column, parts: Column) -> Column:
        return F.struct(number.cast("int").alias("line_no"), parts.alias("words"), (F.size(parts) - 1).alias("most"), (F.size(F.array_distinct(parts)) - 1).alias("least"))

    lines = F.transform(F.split(F.col("plain"), "\n"), lambda x, i: unit(i + 1, F.split(F.trim(x), " ")))
    whole = unit(F.lit(0), F.split(F.trim(F.regexp_replace(F.col("plain"), r"\s+", " ")), " "))
    possible = lambda u: F.exists(table, lambda t: (u["most"] >= t["low"]) & (u["least"] <= t["high"]))

    def paired(u: Column) -> Column:
        grams = F.array_distinct(F.transform(F.slice(u["words"], 2, F.greatest(u["most"], F.lit(0))), lambda w, i: F.concat(F.get(u["words"], i), F.lit(" "), w)))
        return F.struct(u["line_no"].alias("line_no"), grams.alias("grams"))

    def compared(u: Column) -> Column:
        n = F.size(u["grams"])
        dice = lambda t: 2.0 * F.size(F.array_intersect(u["grams"], t["grams"])) / (n + F.size(t["grams"]))
        return F.transform(F.filter(table, lambda t: n.between(t["low"], t["high"])), lambda t: F.struct((-dice(t)).alias("order"), F.lit(0).alias("passage"), t["name"].alias("name"), u["line_no"].alias("line_no")))

    def passages(t: Column) -> Column:
        """The best match of one template from each of its bigrams on."""
        at = F.filter(F.transform("pairs", lambda g, i: F.when(F.array_contains(t["grams"], g), i)), lambda i: i.isNotNull())
        enough = F.size(F.array_intersect(F.col("pairs"), t["grams"])) >= t["low"]
        starts = lambda hits: F.slice(hits, 1, F.greatest(F.size(hits) - t["low"] + 1, F.lit(0)))
        return F.when(enough, F.flatten(F.transform(F.array(at), lambda hits: F.transform(starts(hits), lambda a: beginning(t, a))))).otherwise(F.array().cast(found_type))

    def beginning(t: Column, a: Column) -> Column:
        """The best of the runs that begin at a."""
        run = F.slice(F.col("pairs"), a + 1, reach(t, a))
        once = F.transform(F.array(run), lambda r: F.slice(F.array_distinct(F.slice(r, 1, F.nullif(F.array_position(F.slice(r, 2, F.size(r)), F.get(r, F.lit(0))), F.lit(0)).cast("int"))), 1, t["high"]))
        free = F.transform(F.array(run), lambda r: F.slice(F.array_distinct(r), 1, t["high"]))
        grams = F.coalesce(F.get(once, F.lit(0)), F.get(free, F.lit(0)))
        own = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(t["grams"], g), i + 1)), lambda m: m.isNotNull())
        dice = F.array_max(F.transform(own, lambda m, k: 2.0 * (k + 1) / (m + F.size(t["grams"]))))
        return F.struct((-dice).alias("order"), F.lit(1).alias("passage"), t["name"].alias("name"), F.get("all", a)["n"].alias("line_no"))

    def reach(t: Column, a: Column) -> Column:
        """Bigrams from a on in which there are more distinct ones than the template allows, or the first one
        comes again, or the text ends: twice as many at each step, so that all steps cost as much as the last."""

        def step(s: Column) -> Column:
            run = F.slice(F.col("pairs"), a + 1, s["n"])
            done = F.transform(F.array(run), lambda r: (F.size(F.array_distinct(r)) > t["high"]) | F.array_contains(F.slice(r, 2, F.size(r)), F.get(r, F.lit(0))))
            return F.struct(s["n"].alias("n"), ((a + s["n"] >= F.size("pairs")) | F.get(done, F.lit(0))).alias("done"))

        grown = lambda s: F.when(s["done"], s).otherwise(F.struct(F.least(2 * s["n"], F.lit(1 << 30)).alias("n"), F.lit(False).alias("done")))
        first = F.struct((t["high"] + 1).alias("n"), F.lit(False).alias("done"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(DOUBLINGS)), first, lambda s, _: F.when(s["done"], s).otherwise(grown(step(s))))["n"]

    found_type = "array<struct<order:double,passage:int,name:string,line_no:int>>"
    anchored = F.array(*map(F.lit, sorted({w for _, grams in sets for w in anchors(grams, bounds(len(grams), least)[0])})))
    split = docs.select(F.col(id_col).alias("doc_id"), plain.alias("plain")).select("doc_id", "plain", whole.alias("whole"))
    units = split.select("doc_id", F.filter(F.concat(F.array(F.col("whole")), lines), possible).alias("units"), F.when(F.arrays_overlap(F.col("whole.words"), anchored), F.col("plain")).alias("plain"))
    # Each word's line, where a passage is possible; the words of all lines are those of the text.
    per_line = F.transform(F.split(F.col("plain"), "\n"), lambda x, i: F.transform(F.filter(F.split(F.trim(x), " "), lambda w: w != ""), lambda w: F.struct(w.alias("w"), (i + 1).alias("n"))))
    units = units.select("doc_id", "units", F.flatten(per_line).alias("all"))
    # The words are bound once: a column would be made anew for each pair.
    paired_up = F.transform(F.array(F.col("all.w")), lambda ws: F.transform(F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: F.concat(F.get(ws, i), F.lit(" "), w)))
    units = units.select("doc_id", "units", "all", F.when(F.col("all").isNotNull(), F.get(paired_up, F.lit(0))).alias("pairs"))
    likely = F.filter(table, lambda t: F.arrays_overlap(F.col("all.w"), t["anchors"]))
    of_passages = F.when(F.col("all").isNotNull(), F.flatten(F.transform(likely, passages))).otherwise(F.array().cast(found_type))
    of_units = F.flatten(F.transform(F.transform(F.col("units"), paired), compared))
    found = units.select("doc_id", F.filter(F.concat(F.coalesce(of_units, F.array().cast(found_type)), of_passages), lambda m: m["order"] <= -least).alias("found"))
    best = found.select("doc_id", F.array_min("found").alias("best"), F.size(F.array_distinct(F.transform("found", lambda m: m["line_no"]))).alias("n"))
    return best.select("doc_id", F.col("best.name").alias("license"), (-F.col("best.order")).alias("dice"), F.col("best.line_no").alias("line_no"), F.when(F.col("n") > 0, F.col("n")).otherwise(0).alias("n_units"))


def oracle(templates: list[tuple[str, str]] = TEMPLATES + COMPLETE, least: float = 0.8) -> str:
    """Whole texts, lines and passages in SQL; passages by the distinct bigrams from each bigram of a template on."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quoted(name)}, {b[0]}, {b[1]}, [{', '.join(map(quoted, grams))}])" for name, text in templates for grams in [bigrams(text)] for b in [bounds(len(grams), least)])
    return rf"""
WITH t(name, low, high, grams) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(lower(text), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS plain FROM documents),
l AS (SELECT r, CAST(i AS INTEGER) AS line_no, string_split(plain, chr(10))[i] AS x FROM d, unnest(range(1, len(string_split(plain, chr(10))) + 1)) n(i)),
u AS (SELECT r, 0 AS line_no, regexp_replace(plain, '\s+', ' ', 'g') AS x FROM d UNION ALL SELECT * FROM l),
w AS (SELECT r, line_no, string_split(trim(x), ' ') AS w FROM u),
g AS (SELECT r, line_no, list_distinct(list_transform(w[2:], lambda v, i: w[i] || ' ' || v)) AS grams FROM w),
m AS (
  SELECT r, line_no, name, 0 AS passage, 2.0::DOUBLE * len(list_intersect(g.grams, t.grams)) / (len(g.grams) + len(t.grams)) AS dice
  FROM g JOIN t ON list_has_any(g.grams, t.grams)
),
wl AS (SELECT r, line_no, i, string_split(trim(x), ' ')[i] AS word FROM l, unnest(range(1, len(string_split(trim(x), ' ')) + 1)) n(i)),
ws AS (SELECT r, line_no, word, row_number() OVER (PARTITION BY r ORDER BY line_no, i) AS p FROM wl WHERE word <> ''),
b AS MATERIALIZED (SELECT r, line_no, p, word || ' ' || lead(word) OVER (PARTITION BY r ORDER BY p) AS gram FROM ws QUALIFY lead(word) OVER (PARTITION BY r ORDER BY p) IS NOT NULL),
v AS MATERIALIZED (SELECT r, gram, p, lag(p) OVER k AS before, lead(p) OVER k AS again FROM b WINDOW k AS (PARTITION BY r, gram ORDER BY p)),
tg AS (SELECT name, low, high, len(grams) AS size, unnest(grams) AS gram FROM t),
h AS MATERIALIZED (SELECT b.r, b.line_no, b.p, v.again, tg.name, low, high, size FROM b JOIN tg USING (gram) JOIN v ON v.r = b.r AND v.p = b.p QUALIFY count(DISTINCT b.gram) OVER (PARTITION BY b.r, tg.name) >= low),
e AS (
  SELECT h.r, h.name, h.p AS a, h.line_no, h.high, h.size, v.p, count(*) OVER x AS n, count(tg.gram) OVER x AS own, tg.gram IS NOT NULL AS ends
  FROM h JOIN v ON v.r = h.r AND v.p >= h.p AND v.p < coalesce(h.again, 1e18) AND (v.before IS NULL OR v.before < h.p)
  LEFT JOIN tg ON tg.name = h.name AND tg.gram = v.gram WINDOW x AS (PARTITION BY h.r, h.name, h.p ORDER BY v.p)
),
a AS (
  SELECT r, line_no, name, 0 AS passage, dice FROM m WHERE dice >= {least}
  UNION ALL SELECT r, line_no, name, 1, max(2.0::DOUBLE * own / (n + size)) FROM e WHERE ends AND n <= high GROUP BY r, line_no, name, a HAVING max(2.0::DOUBLE * own / (n + size)) >= {least}
),
f AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY dice DESC, passage, name, line_no) AS k FROM a),
c AS (SELECT r, count(DISTINCT line_no) AS n FROM a GROUP BY r)
SELECT d.doc_id, f.name AS license, f.dice, f.line_no, CAST(coalesce(c.n, 0) AS INTEGER) AS n_units
FROM d LEFT JOIN f ON f.r = d.r AND f.k = 1 LEFT JOIN c ON c.r = d.r
"""
