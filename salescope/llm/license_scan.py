"""Licence scan: passages against licence templates by Dice over word bigrams.

A text's units are its lines, its paragraphs (parted by lines without words, so
bare comment leaders part them too) and the whole of it. A unit and a template
of a and b distinct bigrams can only reach a Dice of t if a lies between
b * t / (2 - t) and b * (2 - t) / t, and only if they share b * t / (2 - t)
bigrams; so they share one of any set of a template's bigrams that leaves out
fewer than that. Those bounds leave few units to compare.

A notice inside a longer unit is found by windows: as many words as the
template has, standing where a bigram of the text and the same bigram of the
template are aligned. Texts that hold none of the sets above are done with
after one look. Templates are a parameter of fixed size, so they travel in the
plan. DataFrame functions only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import few, once, staged, text_column

#: least Dice of a hit, in hundredths
THRESHOLD = 80

# fixed values: wording of the public licences, parts that several of them share
_BSD_TWO = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AS_IS = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_MIT_AS_IS = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"
_GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."

#: fixed values: (licence, notice or body), wording of the public licences
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", _MIT_GRANT),
    ("MIT", f"{_MIT_GRANT} {_MIT_AS_IS}"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", f"{_APACHE} http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GPL),
    ("GPL-3.0", f"{_GPL} This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("BSD-2-Clause", f"{_BSD_TWO} {_BSD_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD_TWO} {_BSD_NAMES} {_BSD_AS_IS}"),
    ("ISC", _ISC_GRANT),
    ("ISC", f"{_ISC_GRANT} {_ISC_AS_IS}"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)

# what a unit keeps when normalised: ASCII letters in lower case, digits, and all beyond ASCII
_OTHER = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def template_words(text: str) -> list[str]:
    """The words of a text, normalised."""
    return [w for w in re.sub(f"{_OTHER}+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split(" ") if w]


def template_bigrams(text: str) -> list[str]:
    """The distinct bigrams of a template; of a single word, the word."""
    words = template_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])} or set(words))


def anchors(grams: list[str], threshold: int = THRESHOLD) -> list[str]:
    """Bigrams of a template of which everything at the threshold holds one:
    all but as many as a hit may miss. Long ones, as they tend to be rare."""
    least = math.ceil(len(grams) * threshold / (200 - threshold) - 1e-9)
    return sorted(sorted(grams, key=lambda g: (-len(g), g))[:len(grams) - least + 1])


def _words(text: str) -> F.Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(F.regexp_replace(lower, f"{_OTHER}+", " "), " "), lambda w: w != "")


def _pairs(words: str) -> F.Column:
    """The bigrams of a column of words, in order; of a single word, the word."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))
    return F.when(F.size(words) > 1, pairs).otherwise(F.col(words))


def _strings(values: list[str]) -> F.Column:
    return F.array(*[F.lit(v) for v in values])


def scan_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, license, n_units, best_dice, n_passages) of every document and
    licence with a unit or a window at or over the threshold. A unit is given
    to the template it is nearest to, or to all at a tie; ``n_units`` counts
    those distinct units of its rows, 0 where only windows hit. Windows that
    overlap are one passage, given to the template that shares most bigrams
    with one of them, the nearest of those, or all at a tie; ``n_passages``
    counts a licence's passages. ``best_dice`` is the largest value of both,
    to six places.

    Documents without a hit have no row, so null and empty texts have none; a
    unit of one word has that word as its only bigram, and templates of one
    word have no windows; a window at the edge of a text is cut to it; a unit
    that fits two templates of a licence counts once; rows with the same id
    count together, also where the text is the same; a null id is an id; a
    text of any length is one unit and is cut into windows only around its
    anchors; other columns are ignored; an empty table, or no template with a
    word, gives none.
    """
    known = [(name, grams, template_words(text)) for name, text in templates if (grams := template_bigrams(text))]
    if not known:
        return docs.sparkSession.createDataFrame([], "doc_id long, license string, n_units long, best_dice double, n_passages long")
    bounds = [(len(g) * threshold / (200 - threshold), len(g) * (200 - threshold) / threshold) for _, g, _ in known]
    least, most = min(b[0] for b in bounds), max(b[1] for b in bounds)
    every = _strings(sorted({a for _, grams, _ in known for a in anchors(grams, threshold)}))
    text = text_column(docs)
    units = F.array_distinct(F.concat(F.array(text), F.split(text, "\n"), F.split(text, rf"\n{_OTHER}*\n")))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.posexplode(units).alias("place", "unit"))
    rows = once(rows, "words", _words("unit")).filter((F.size("words") >= 1) & (F.size("words") >= int(least)))
    rows = once(rows, "grams", F.array_distinct(_pairs("words"))).filter(
        (F.size("grams") >= least) & ((F.size("grams") <= most) | (F.col("place") == 0)) & F.arrays_overlap("grams", every))
    rows = staged(rows.select("doc_id", "place", F.xxhash64("unit").alias("unit"), "words", "grams").withColumn("row", F.monotonically_increasing_id()), "license-units")
    n = F.size("grams")
    values = []
    for (name, g, _), (low, high) in zip(known, bounds):
        shared = F.size(F.array_intersect("grams", _strings(g)))
        fits = (n >= low) & (n <= high) & (200 * shared >= threshold * (n + len(g)))
        values.append(F.when(fits, F.struct(F.lit(name).alias("license"), (2.0 * shared / (n + len(g))).alias("dice"))))
    fits = once(rows, "fits", F.array_compact(F.array(*values)))
    best = F.filter("fits", lambda x: x["dice"] == F.array_max(F.transform("fits", lambda y: y["dice"])))
    hits = fits.select("doc_id", "unit", F.explode(best).alias("hit")).select("doc_id", "hit.license", "unit", "hit.dice", F.lit(None).cast("string").alias("passage"))
    found = passages(rows.filter("place = 0").select("row", "doc_id", "words"), [(name, g, w) for name, g, w in known if len(w) > 1], threshold)
    both = hits.unionByName(found.select("doc_id", "license", F.lit(None).cast("long").alias("unit"), "dice", F.concat_ws(":", "row", "passage").alias("passage")))
    return both.groupBy("doc_id", "license").agg(
        F.countDistinct("unit").alias("n_units"), F.round(F.max("dice"), 6).alias("best_dice"), F.countDistinct("passage").alias("n_passages"))


def passages(texts: DataFrame, known: list[tuple[str, list[str], list[str]]], threshold: int) -> DataFrame:
    """(row, doc_id, license, dice, passage) of the passages in ``texts`` (row,
    doc_id, words), ``known`` being (licence, bigrams, words) of templates. A
    window is only cut out if, by what it shares, it can reach the threshold."""
    spark = texts.sparkSession
    places = [(t, at, f"{a} {b}") for t, (_, _, w) in enumerate(known) for at, (a, b) in enumerate(zip(w, w[1:]))]
    # one row a template and one a bigram of it, whatever the corpus
    table = F.broadcast(spark.createDataFrame(places, "t int, at int, gram string"))
    sizes = F.broadcast(spark.createDataFrame([(t, name, len(w), len(g)) for t, (name, g, w) in enumerate(known)],
                                              "t int, license string, size int, b int"))
    seen = texts.select("row", F.posexplode(_pairs("words")).alias("pos", "gram"), F.size("words").alias("n"))
    met = staged(seen.join(table, "gram").join(sizes.drop("license"), "t"), "license-met")
    # a window's bigrams lie in the stretch of its template's size that holds its start and in the next one
    start = F.greatest(F.col("pos") - F.col("at"), F.lit(0))
    stop = F.least(F.col("pos") - F.col("at") + F.col("size"), F.col("n"))
    windows = met.select("row", "t", "size", "b", start.alias("start"), stop.alias("stop")).distinct() \
        .select("*", F.explode(F.array(F.expr("start div size"), F.expr("start div size + 1"))).alias("stretch"))
    held = met.select("row", "t", "pos", "gram", F.expr("pos div size").alias("stretch")).distinct()
    enough = windows.join(held, ["row", "t", "stretch"]).filter("pos >= start AND pos < stop - 1") \
        .groupBy("row", "t", "b", "start", "stop").agg(F.countDistinct("gram").alias("shared")) \
        .filter(F.col("shared") * (200 - threshold) >= F.col("b") * threshold)
    of_row = enough.groupBy("row").agg(F.collect_list(F.struct("t", "start", "stop", "b", "shared")).alias("windows"))
    cut = texts.join(few(staged(of_row, "license-windows")), "row").select("row", "doc_id", "words", F.explode("windows").alias("w")) \
        .select("row", "doc_id", "w.*", F.slice("words", F.col("w.start") + 1, F.col("w.stop") - F.col("w.start")).alias("window"))
    cut = once(cut, "n", F.size(F.array_distinct(_pairs("window")))).drop("window") \
        .withColumn("dice", 2.0 * F.col("shared") / (F.col("n") + F.col("b"))).filter(200 * F.col("shared") >= threshold * (F.col("n") + F.col("b")))
    order = Window.partitionBy("row").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parted = cut.withColumn("new", (F.coalesce(before, F.lit(0)) <= F.col("start")).cast("int")) \
        .withColumn("passage", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    score = F.struct("shared", "dice")
    best = parted.withColumn("most", F.max(score).over(Window.partitionBy("row", "passage"))).filter(score == F.col("most"))
    return best.join(sizes.select("t", "license"), "t").select("row", "doc_id", "license", "dice", "passage")
