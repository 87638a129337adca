"""Licence scan: lines, passages and whole texts against licence templates, in DataFrame expressions only.

Texts are normalised (lower case, everything but letters and digits one space) and compared as sets
of word bigrams by the Dice coefficient. A coefficient of t needs sizes within t / (2 - t) of each
other, so a unit of text is compared only with templates inside those bounds. Everything happens in
the document's row: nothing is shuffled, and the templates are constants of the plan.

Any unit that resembles a template has at least 2/3 of the template's bigrams, so a text that has
fewer of them is not looked at again for that template. A passage may begin and end at any word, also
inside lines: it is a window that starts and ends with a bigram of the template. Every such end is
tried with every start, so no window of Dice 0.8 is missed.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import whole_text

# Dice of 4/5; the bounds on sizes that follow are 2/3 and 3/2.
NUM, DEN = 4, 5
NOT_WORD = r"[^\p{L}\p{N}]+"

# Public licence texts and the notices that point to them.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
        "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License."],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
}
TEMPLATES["GPL-2.0"].append(
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.")

# Whole bodies, one file per licence. MIT is above.
for _file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
    TEMPLATES.setdefault(_file.stem, []).append(_file.read_text(encoding="utf-8"))


def plain_words(text: str) -> list[str]:
    """Of a template, in the way of the columns below."""
    import regex

    return regex.sub(NOT_WORD, " ", text.lower()).strip().split(" ")


def plain_bigrams(text: str) -> list[str]:
    words = plain_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def template_rows(templates: dict[str, list[str]]) -> list[tuple[str, int, list[str]]]:
    """(licence, number of the template, bigrams), in order."""
    return [(name, k, plain_bigrams(t)) for name, texts in sorted(templates.items()) for k, t in enumerate(texts)]


def words_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " ")), " ")


def bigrams(text: Column) -> Column:
    words = words_of(text)
    return F.zip_with(words, F.slice(words, 2, 1 << 30), lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def passages(grams: Column, t: Column) -> Column:
    """Windows of a text's bigrams in order that resemble template ``t``, without overlaps: array of
    (a, b, dice), positions of the first and the last bigram. Bigrams of the template count once, others
    each time. Of the windows that end at one bigram the most alike is taken, then the best end for its start."""
    size, none = t["size"], F.expr("cast(array() as array<struct<a:int,b:int,dice:double>>)")

    def dice(own, length, bigrams_in):
        return 2.0 * own / (length - bigrams_in + own + size)

    def at_places(places):
        # at: position, own: which bigram, far: the next place (number in this array) of the same bigram, near: the last one.
        count, back = F.size(places), F.reverse(F.transform(places, lambda p: p["own"]))
        own = F.transform(places, lambda p: p["own"])

        def seen(all_own, reverse, k):
            step = lambda array, from_: F.array_position(F.slice(array, from_, count), F.element_at(all_own, k + 1)).cast("int")
            return F.struct(
                F.element_at(places, k + 1)["at"].alias("at"),
                let(step(all_own, k + 2), lambda s: F.when(s > 0, k + s).otherwise(1 << 30)).alias("far"),
                let(step(reverse, count - k + 1), lambda s: F.when(s > 0, k - s).otherwise(-1)).alias("near"))

        return let(own, lambda o: let(back, lambda r: F.transform(F.sequence(F.lit(0), count - 1), lambda k: seen(o, r, k))))

    need = F.floor((size * NUM + 2 * DEN - NUM - 1) / (2 * DEN - NUM)).cast("int")
    longest = t["longest"]

    def best(places, low, high, order, anchor, other):
        """(k, dice): of windows from place ``low`` to ``high`` that keep one end, the best other end."""
        start = F.struct(F.lit(-1).alias("k"), F.lit(0.0).alias("dice"), F.lit(0).alias("own"))

        def step(s, k):
            p, q = F.element_at(places, k + 1), F.element_at(places, anchor + 1)
            own = s["own"] + F.when(other(p), 1).otherwise(0)
            alike = dice(own, F.abs(q["at"] - p["at"]) + 1, F.abs(anchor - k) + 1)
            return let(alike, lambda d: F.struct(
                F.when(d > s["dice"], k).otherwise(s["k"]).alias("k"), F.greatest(d, s["dice"]).alias("dice"), own.alias("own")))

        return F.aggregate(order(low, high), start, step)

    def search(places):
        def try_end(state, end):
            low = F.greatest(F.lit(0), end - longest + 1)
            near_enough = F.element_at(places, end + 1)["at"] - F.element_at(places, end - need + 2)["at"] - need + 1 <= size - need

            def from_start(left):
                right = best(places, left["k"], end, lambda a, b: F.sequence(a, b), left["k"], lambda p: p["near"] < left["k"])
                return let(right, lambda r: F.struct(
                    left["k"].alias("before"),
                    F.concat(state["found"], F.array(F.struct(
                        F.element_at(places, left["k"] + 1)["at"].alias("a"), F.element_at(places, r["k"] + 1)["at"].alias("b"),
                        r["dice"].alias("dice")))).alias("found")))

            def looked():
                left = best(places, low, end, lambda a, b: F.sequence(b, a, F.lit(-1)), end, lambda p: p["far"] > end)
                return let(left, lambda x: F.when(x["dice"] * DEN >= NUM, from_start(x)).otherwise(state))

            return F.when((end < state["before"]) & (end + 1 >= need), F.when(near_enough, looked()).otherwise(state)).otherwise(state)

        begin = F.struct(F.lit(1 << 30).alias("before"), none.alias("found"))
        return F.aggregate(F.sequence(F.size(places) - 1, F.lit(0), F.lit(-1)), begin, try_end, lambda s: s["found"])

    found = F.transform(grams, lambda g, i: F.struct(i.cast("int").alias("at"), F.array_position(t["grams"], g).cast("int").alias("own")))
    held = F.filter(found, lambda p: p["own"] > 0)
    return let(held, lambda h: F.when(F.size(h) < need, none).otherwise(let(at_places(h), search)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None) -> DataFrame:
    """(doc_id, n_matches, licenses, best, best_dice, best_line), one row per row of ``docs``.

    Units are the lines of a text, numbered from 0, the whole text (-1) if it has several lines, and
    passages, which have the number of the line in which they begin. A passage counts if no line that
    resembles a template holds it, and neither a line it touches nor the whole text resembles a
    template of the same licence. Of passages that share words the most alike counts; another licence's
    stays if at most half of it is shared.
    ``n_matches`` counts different numbers of units that resemble some template, ``licenses`` names all
    licences found, in order; ``best`` is the one of highest Dice coefficient, of ties the first by
    name, then line. A null or empty text has no match; repeated rows are each scanned; a null doc_id
    stays null. Other columns are not read.
    """
    given = templates or TEMPLATES
    rows = template_rows(given)
    held = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(len(grams)).alias("size"), F.split(F.lit("|".join(grams)), "\\|").alias("grams"),
                              F.lit(3 * len(plain_words(given[name][k])) // 2).alias("longest"))
                     for name, k, grams in rows])
    every = sorted({g for _, _, grams in rows for g in grams})
    text = whole_text(text_col)
    in_order = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.array_compact(bigrams(text)).alias("grams"))
    pool = ", ".join(f"'{g}'" for g in every)  # letters, digits and spaces
    shared = in_order.withColumn("shared", F.array_distinct(F.expr(f"filter(grams, g -> g IN ({pool}))")))
    asked = F.filter(held, lambda t: (F.size("shared") * (2 * DEN - NUM) >= t["size"] * NUM)
                     & (F.size(F.array_intersect(t["grams"], F.col("shared"))) * (2 * DEN - NUM) >= t["size"] * NUM))
    asked = shared.select("doc_id", "text", "grams", asked.alias("asked"))
    lines = F.split("text", "\n")
    units = F.transform(lines, lambda line, i: F.struct(i.cast("int").alias("line"), line.alias("t")))
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), F.col("text").alias("t")))).otherwise(
        F.array().cast("array<struct<line:int,t:string>>"))
    sized = F.transform(F.concat(units, whole), lambda u: F.struct(
        u["line"].alias("line"), F.array_compact(F.array_distinct(bigrams(u["t"]))).alias("grams")))
    no_hits = F.expr("cast(array() as array<struct<less:double,name:string,line:int>>)")

    def hits(unit):
        n = F.size(unit["grams"])
        near = F.filter("asked", lambda t: (n * (2 * DEN - NUM) >= t["size"] * NUM) & (t["size"] * (2 * DEN - NUM) >= n * NUM)
                        & (F.size(F.array_intersect(unit["grams"], t["grams"])) * (2 * DEN) >= (n + t["size"]) * NUM))
        return F.transform(near, lambda t: F.struct(
            (-2.0 * F.size(F.array_intersect(unit["grams"], t["grams"])) / (n + t["size"])).alias("less"), t["name"].alias("name"),
            unit["line"].alias("line")))

    some = F.size("asked") > 0
    in_units = asked.withColumn("hits", F.when(some, F.flatten(F.transform(sized, hits))).otherwise(no_hits))
    parts = F.flatten(F.transform("asked", lambda t, k: F.transform(passages(F.col("grams"), t), lambda p: F.struct(
        p["a"].alias("a"), p["b"].alias("b"), p["dice"].alias("dice"), t["name"].alias("name"), k.cast("int").alias("k")))))
    cast_parts = F.expr("cast(array() as array<struct<a:int,b:int,dice:double,name:string,k:int>>)")
    counts = F.transform(lines, lambda line: F.size(F.filter(words_of(line), lambda w: w != "")))
    in_parts = in_units.select(
        "doc_id", "hits", F.when(some, parts).otherwise(cast_parts).alias("parts"),
        F.when(some, counts).otherwise(F.array().cast("array<int>")).alias("counts"))

    def line_of(word):
        begin = F.struct(word.cast("int").alias("rest"), F.lit(0).alias("line"))
        return F.aggregate("counts", begin, lambda s, n: F.when(s["rest"] < 0, s).when(s["rest"] < n, F.struct(
            F.lit(-1).alias("rest"), s["line"].alias("line"))).otherwise(F.struct((s["rest"] - n).alias("rest"), (s["line"] + 1).alias("line"))),
            lambda s: s["line"])

    def beaten(p):
        rank = lambda q: F.struct(-q["dice"], q["a"], q["k"])
        common = lambda q: F.least(p["b"], q["b"]) - F.greatest(p["a"], q["a"]) + 1
        return F.exists("parts", lambda q: (rank(q) < rank(p)) & (common(q) > 0) & (
            (q["name"] == p["name"]) | (common(q) * 2 > p["b"] - p["a"] + 1)))

    placed = F.transform(F.filter("parts", lambda p: ~beaten(p)), lambda p: F.struct(
        (-p["dice"]).alias("less"), p["name"].alias("name"), line_of(p["a"]).alias("line"), line_of(p["b"] + 1).alias("to")))
    fresh = F.filter(placed, lambda p: ~F.exists("hits", lambda h: F.when(h["line"] < 0, h["name"] == p["name"]).otherwise(
        h["line"].between(p["line"], p["to"]) & ((h["name"] == p["name"]) | (p["line"] == p["to"])))))
    found = in_parts.select("doc_id", F.array_sort(F.concat("hits", F.transform(fresh, lambda p: F.struct(
        p["less"].alias("less"), p["name"].alias("name"), p["line"].alias("line"))))).alias("hits"))
    first = F.get("hits", F.lit(0))
    return found.select(
        "doc_id", F.size(F.array_distinct(F.transform("hits", lambda h: h["line"]))).alias("n_matches"),
        F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["name"]))).alias("licenses"),
        first["name"].alias("best"), (-first["less"]).alias("best_dice"), first["line"].alias("best_line"))
