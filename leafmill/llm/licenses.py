"""Operator 1: licence notices in texts, by the Dice coefficient of word bigrams.

Text is lower-cased and everything but letters, digits and line ends becomes blank. Units of comparison are each line,
each paragraph of several lines, and the whole text if it has several paragraphs. A unit and a template are compared as
sets of word bigrams: dice = 2 * common / (bigrams of the unit + bigrams of the template). A dice of `threshold` needs
sizes within threshold / (2 - threshold) of each other, so units meet only the templates whose bounds hold their size:
an equi-join on the size, the templates being listed under each size in their bounds.

Notices that are no unit of their own (several paragraphs of a longer text, lines of a paragraph, a part of a line) are
passages: stretches of words with the greatest dice, outside the units found for the same template. A text can hold one
only if it has threshold / (2 - threshold) of the template's bigrams, so few texts are searched.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import small_side, with_columns

THRESHOLD = 0.8
#: Most rows of the size table, and of the templates, that are broadcast.
MOST_SIZES, MOST_TEMPLATES = 500_000, 5_000

# Short notices and licence texts as their owners publish them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        'IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
}


def template_table(spark: SparkSession, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    return spark.createDataFrame(list(templates.items()), "license string, template string")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \n]+"), "")


def bigrams(words: str) -> Column:
    """Distinct pairs of neighbouring words of the word array in column `words`."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(words, F.lit(1), n).alias("a"), F.slice(words, F.lit(2), n).alias("b"))
    return F.array_distinct(F.transform(pairs, lambda p: F.concat_ws(" ", p["a"], p["b"])))


def units(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, unit, unit_no, _text): lines, paragraphs of several lines, and the text of several paragraphs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    clean = df.select(F.col(id_col), normalised(text).alias("_clean"))
    clean = clean.withColumn("_parts", F.split("_clean", "\n(?: ?\n)+"))

    def listed(parts: Column, kind: str) -> Column:
        return F.transform(
            parts, lambda t, i: F.struct(F.lit(kind).alias("unit"), i.alias("unit_no"), t.alias("_text"))
        )

    parts = F.concat(
        F.filter(listed(F.split("_clean", "\n"), "line"), lambda u: F.length(F.trim(u["_text"])) > 0),
        F.filter(listed(F.col("_parts"), "paragraph"), lambda u: F.instr(F.trim(u["_text"]), "\n") > 0),
        F.when(F.size("_parts") > 1, listed(F.array("_clean"), "text")).otherwise(listed(F.array().cast("array<string>"), "text")),
    )
    return clean.select(id_col, F.explode(parts).alias("_u")).select(id_col, "_u.*")


def sized(templates: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Templates with their bigrams, and (license, size) for all sizes of units that could reach the threshold."""
    own = templates.select("license", "template").distinct().select(
        "license", F.sha2("template", 256).alias("_template"),
        word_list(normalised(F.col("template"))).alias("_words"),
    )
    own = own.select("license", "_template", bigrams("_words").alias("_want"))
    own = own.where("license is not null and size(_want) > 0")
    n = F.size("_want")
    low, high = F.ceil(n * (threshold / (2 - threshold)) - 1e-9), F.floor(n * ((2 - threshold) / threshold) + 1e-9)
    return own, own.select("license", "_template", F.explode(F.sequence(low.cast("int"), high.cast("int"))).alias("_size"))


_GAP = re.compile("\n(?: ?\n)+")


def _told(words: list[str], want: set) -> float:
    have = set(zip(words, words[1:]))  # noqa: B905
    return 2.0 * len(have & want) / (len(have) + len(want))


def _taken(clean: str, want: set, threshold: float) -> list[tuple[int, int]]:
    """Word ranges, ends exclusive, of the text's units that reach the threshold."""
    parts = _GAP.split(clean)
    out = []
    for pieces, counts in (
        (clean.split("\n"), lambda x: True), (parts, lambda x: "\n" in x.strip(" ")), ([clean], lambda x: len(parts) > 1)
    ):
        at = 0
        for x in pieces:
            words = x.split()
            if counts(x) and len(words) > 1 and _told(words, want) >= threshold:
                out.append((at, at + len(words)))
            at += len(words)
    return out


def passages(clean: str, words: list[str], hits: list[int], want: set, threshold: float) -> list[tuple[int, int, int]]:
    """(first word, common bigrams, bigrams) of the stretches that reach the threshold, the greatest dice first and none over
    another or over a unit that was found. `hits` has the positions of the template's bigrams."""
    pairs, high = list(zip(words, words[1:])), math.floor(len(want) * ((2 - threshold) / threshold) + 1e-9)  # noqa: B905
    blocked: list[tuple[int, int]] = []
    for a, b in sorted(_taken(clean, want, threshold)):
        if blocked and a < blocked[-1][1]:
            blocked[-1] = (blocked[-1][0], max(b, blocked[-1][1]))
        else:
            blocked.append((a, b))

    def best(start: int):
        """The best stretch from here to the next one that is taken, for the heap."""
        k = bisect_left(blocked, (start + 1, 0))
        if k and blocked[k - 1][1] > start:
            return None
        stop = min(len(pairs), blocked[k][0] - 1) if k < len(blocked) else len(pairs)
        seen, common, top = set(), 0, None
        for j in range(start, stop):
            pair = pairs[j]
            if pair in seen:
                continue
            seen.add(pair)
            if len(seen) > high:
                break
            if pair in want:
                common += 1
                dice = 2.0 * common / (len(seen) + len(want))
                if dice >= threshold and (top is None or dice > -top[0]):
                    top = (-dice, start, j + 2, common, len(seen))
                if common == len(want):
                    break
        return top

    heap = [x for x in map(best, hits) if x]
    heapq.heapify(heap)
    out = []
    while heap:
        top = heapq.heappop(heap)
        now = best(top[1])
        if now == top:
            out.append((top[1], top[3], top[4]))
            insort(blocked, (top[1], top[2]))
        elif now:
            heapq.heappush(heap, now)
    return sorted(out)


def _searcher(shared, threshold: float):
    def make():
        templates = [(name, {tuple(x.split(" ")) for x in want}) for name, want in shared.value]
        index: dict = {}
        for k, (_, want) in enumerate(templates):
            for pair in want:
                index.setdefault(pair, []).append(k)
        least = [math.ceil(len(want) * (threshold / (2 - threshold)) - 1e-9) for _, want in templates]

        def search(clean: str) -> list[dict]:
            words = clean.split()
            hits: dict[int, list[int]] = {}
            for i, pair in enumerate(zip(words, words[1:])):  # noqa: B905
                if pair in index:
                    for k in index[pair]:
                        hits.setdefault(k, []).append(i)
            out = []
            for k, at in hits.items():
                name, want = templates[k]
                if len(at) >= least[k] and len({(words[i], words[i + 1]) for i in at}) >= least[k]:
                    for first, common, size in passages(clean, words, at, want, threshold):
                        out.append({"unit_no": first, "license": name, "n_common": common, "n_unit": size, "n_template": len(want)})
            return out

        return lambda texts: [[search(t) for t in texts]]

    return make


def scan_licenses(
    df: DataFrame, templates: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """(id, unit, unit_no, license, n_common, n_unit, n_template, dice): each unit and template that reach the threshold.

    Null, empty and one-word texts and templates have no bigrams and match nothing. Ties stay: a unit gives a row for
    each template. Repeated rows and null ids give their rows each; repeated templates count once. Whole texts
    are cut where they are read; template tables are broadcast after their rows are counted, else Spark shuffles.
    The unit_no of a passage is the number of its first word; for passages, the templates go through the driver.
    """
    own, sizes = sized(templates, threshold)
    cut = units(df, id_col, text_col).withColumn("_words", word_list(F.col("_text")))
    cut = cut.select(id_col, "unit", "unit_no", bigrams("_words").alias("_have"))
    met = cut.withColumn("_size", F.coalesce(F.size("_have"), F.lit(0))).join(small_side(sizes, MOST_SIZES), "_size")
    both = met.join(small_side(own, MOST_TEMPLATES), ["license", "_template"]).select(
        id_col, "unit", F.col("unit_no").cast("long").alias("unit_no"), "license",
        F.size(F.array_intersect("_have", "_want")).cast("long").alias("n_common"),
        F.size("_have").cast("long").alias("n_unit"), F.size("_want").cast("long").alias("n_template"),
    )
    shared = df.sparkSession.sparkContext.broadcast([(r[0], r[1]) for r in own.select("license", "_want").collect()])
    text = normalised(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("_clean")
    fields = "unit_no: long, license: string, n_common: long, n_unit: long, n_template: long"
    found = with_columns(df.select(F.col(id_col), text), "_clean", _searcher(shared, threshold), f"_found array<struct<{fields}>>")
    found = found.select(id_col, F.explode("_found").alias("_p")).select(id_col, F.lit("passage").alias("unit"), "_p.*")
    both = both.unionByName(found)
    dice = F.col("n_common") * 2.0 / (F.col("n_unit") + F.col("n_template"))
    return both.withColumn("dice", dice).where(F.col("dice") >= threshold)
