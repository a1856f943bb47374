"""License scans by the Dice coefficient over word bigrams.

Every line of a text, and the whole text, is a unit: lower case, every run of
other characters than a-z and 0-9 one space. A unit matches the template with
the highest Dice coefficient 2 |A n B| / (|A| + |B|) of the sets of word bigrams,
if it reaches ``least``. A coefficient of ``least`` needs
least / (2 - least) * |B| <= |A| <= (2 - least) / least * |B|, so units outside
these bounds of every template are dropped before any intersection, and a unit
meets only the templates whose bounds it fits.

A statement wrapped over lines within a longer text is found by runs of two or
more whole lines, with words in the first and the last one: for every template,
those around a line that holds, or with the next line with words forms, one of
its key bigrams, with as many words as its bounds allow bigrams (and one more).
A run is a match, under the number of its first line, unless the text as a whole
or a line of it matches the same template; of runs that overlap, the one with
the highest coefficient counts (then the first, the shortest, the template
first by name).

A match has at least least / (2 - least) of a template's bigrams, so of any set
of more than the rest of them (``keys_of``) one must occur: texts, lines and
templates without any such bigram in common are passed over. The search for runs
follows the key bigrams found, so its time grows in proportion to the text.

DataFrame functions only; the templates are one constant array that lambdas walk,
so the plan does not grow with their number, and there is no join and no shuffle.

Defined results: a null or empty text matches nothing; of equal coefficients the
template first by name wins; repeated rows are scanned row by row; extra columns
stay (one named like an output is replaced).
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public licence statements, headers and texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations "
        "under the License.",
    "All-Rights-Reserved": "All rights reserved.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may "
        "be used to endorse or promote products derived from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
        "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would "
        "be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution.",
}


def normalised(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def bigrams_of(text: str) -> list[str]:
    words = normalised(text).split()
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def keys_of(bigrams: list[str], least: float) -> list[tuple[str, str]]:
    """Bigrams (longer word, shorter word), those with the longest words, so
    many that a match must have one of them."""
    spare = len(bigrams) - math.ceil(least / (2 - least) * len(bigrams) - 1e-9)
    pairs = sorted((tuple(sorted(b.split(), key=lambda w: (-len(w), w))) for b in bigrams),
                   key=lambda p: (-len(p[0]), -len(p[1]), p))
    return pairs[:spare + 1]


def template_table(grams: dict[str, list[str]], least: float) -> Column:
    """The templates as one constant array, walked by lambdas: name, grams and
    their number n, keys, bounds of the distinct bigrams (low, high), fewest
    common bigrams and the bounds of a run's words (need, most)."""
    # a hair wider than exact, so that rounding prunes nothing
    low, high = least / (2 - least) - 1e-9, (2 - least) / least + 1e-9
    rows = []
    for name, g in sorted(grams.items()):
        pairs = {frozenset(p) for p in keys_of(g, least)}
        rows.append({"name": name, "grams": g, "n": len(g), "keys": [b for b in g if frozenset(b.split()) in pairs],
                     "low": low * len(g), "high": high * len(g), "need": math.ceil(low * len(g)) + 1,
                     "most": int(high * len(g)) + 1})
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<name:string,grams:array<string>,n:int,keys:array<string>,"
                                                "low:double,high:double,need:int,most:int>>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once (a variable of a lambda is, a column used twice is not)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(raw: Column) -> Column:
    """Normalised words of a raw text; none is one empty word."""
    # the C locale's lower case, as the templates: letters beyond a-z are no word characters anyway
    return F.split(F.trim(F.regexp_replace(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                           "[^a-z0-9]+", " ")), " ")


def bigrams_in(words: Column) -> Column:
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat(a, F.lit(" "), b))


def dice_with(a: Column, t: Column) -> Column:
    """Dice coefficient of a set of bigrams and a template."""
    return 2.0 * F.size(F.array_intersect(a, t["grams"])) / (F.size(a) + t["n"])


def best_match(unit: Column, a: Column, templates: Column, least: float) -> Column:
    """Match (unit, license, dice) of a unit's bigrams, or null in its fields."""
    fit = F.filter(templates, lambda t: F.size(a).between(t["low"], t["high"]) & F.arrays_overlap(a, t["keys"]))
    values = F.transform(fit, lambda t: F.struct((-dice_with(a, t)).alias("order"), t["name"].alias("license")))
    return let(F.array_min(F.filter(values, lambda v: v["order"] <= -least)), lambda v: F.struct(
        unit.alias("unit"), v["license"].alias("license"), F.round(-v["order"], 6).alias("dice")))


def runs_of_lines(line: Column, grams: Column, found: Column, templates: Column, least: float) -> Column:
    """Matches (order, i, j, license) of runs of lines i to j with their own
    coefficients, before any choice. ``line`` has the line of every word of the
    text, ``grams`` the bigram that begins at every word but the last, ``found``
    the key bigrams among them. A run begins at most a template's words before
    a key bigram, so the work follows the key bigrams and not the pairs of lines."""
    hits = F.filter(F.transform(grams, lambda b, k: F.struct(k.alias("k"), b.alias("b"))),
                    lambda h: F.array_contains(found, h["b"]))

    def begins(p: Column) -> Column:
        return (p == 0) | (F.get(line, p - 1) != F.get(line, p))

    def ends(p: Column) -> Column:
        return (p == F.size(line) - 1) | (F.get(line, p) != F.get(line, p + 1))

    def of_template(hs: Column, t: Column) -> Column:
        near = F.transform(F.filter(hs, lambda h: F.array_contains(t["keys"], h["b"])), lambda h: F.filter(
            F.sequence(F.greatest(h["k"] - t["most"] + 2, F.lit(0)), h["k"]), begins))
        firsts = F.array_distinct(F.flatten(near))
        # no run from here can match without enough bigrams of the template ahead
        firsts = F.filter(firsts, lambda a: F.size(F.array_intersect(F.slice(grams, a + 1, t["most"] - 1), t["grams"])) >= t["low"])

        def judged(a: Column) -> Column:
            lasts = F.filter(F.sequence(a + t["need"] - 1, F.least(a + t["most"], F.size(line)) - 1),
                             lambda z: (F.get(line, z) > F.get(line, a)) & ends(z))

            def value(z: Column) -> Column:
                own = let(F.array_distinct(F.slice(grams, a + 1, z - a)), lambda g: dice_with(g, t))
                return F.struct((-own).alias("order"), F.get(line, a).alias("i"), F.get(line, z).alias("j"),
                                t["name"].alias("license"))
            return F.filter(F.transform(lasts, value), lambda m: m["order"] <= -least)
        long_enough = F.filter(firsts, lambda a: a + t["need"] <= F.size(line))
        return F.flatten(F.transform(long_enough, judged))
    return let(hits, lambda hs: F.flatten(F.transform(templates, lambda t: of_template(hs, t))))


def chosen_runs(runs: Column, found: Column) -> Column:
    """Runs that count, as matches, besides the matches of lines and of the whole text."""
    new = F.filter(runs, lambda r: ~F.exists(found, lambda m: (m["license"] == r["license"])
                                            & ((m["unit"] < 0) | m["unit"].between(r["i"], r["j"]))))
    kept = F.aggregate(F.array_sort(new), F.filter(new, lambda r: F.lit(False)), lambda acc, r: F.when(
        F.exists(acc, lambda k: (k["i"] <= r["j"]) & (r["i"] <= k["j"])), acc).otherwise(F.concat(acc, F.array(r))))
    return F.transform(kept, lambda r: F.struct(r["i"].alias("unit"), r["license"].alias("license"),
                                                F.round(-r["order"], 6).alias("dice")))


def scan_licenses(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None, least: float = 0.8,
                  keep: list[str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``; all by default) with ``matches``, an array of
    (unit, license, dice) by unit (-1: the whole text, else the number from 0 of
    the line or of the first line of a run), ``licenses`` (distinct names, ascending) and ``n_matches``."""
    made = ["matches", "licenses", "n_matches"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    grams = {k: g for k, v in sorted((TEMPLATES if templates is None else templates).items()) if (g := bigrams_of(v))}
    if not grams:
        none = F.array().cast("array<struct<unit:int,license:string,dice:double>>")
        return docs.select(*keep, none.alias("matches"), F.array().cast("array<string>").alias("licenses"),
                           F.lit(0).alias("n_matches"))
    table = template_table(grams, least)
    keys = F.array_distinct(F.flatten(F.transform(table, lambda t: t["keys"])))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, F.when(F.arrays_overlap(bigrams_in(words_of(body)), keys), body).alias("__text"))

    # lines with words: (i: number in the text, w: words)
    lines = F.transform(F.split("__text", "\n"), lambda x, i: F.struct(i.alias("i"), words_of(x).alias("w")))
    lines = F.filter(lines, lambda u: u["w"][0] != "")

    def of_text(ls: Column) -> Column:
        line = F.flatten(F.transform(ls, lambda u: F.array_repeat(u["i"], F.size(u["w"]))))
        return let(bigrams_in(F.flatten(F.transform(ls, lambda u: u["w"]))), lambda grams:
                   let(F.array_intersect(grams, keys), lambda found:
                       let(F.filter(table, lambda t: F.arrays_overlap(found, t["keys"])), lambda near: F.struct(
                           units_of(ls, grams, near).alias("found"),
                           let(line, lambda li: runs_of_lines(li, grams, found, near, least)).alias("runs")))))

    def units_of(ls: Column, grams: Column, near: Column) -> Column:
        whole = F.when(F.contains("__text", F.lit("\n")), F.array(F.struct(F.lit(-1).alias("i"), F.array_distinct(grams).alias("a"))))
        nothing = F.array().cast("array<struct<i:int,a:array<string>>>")
        each = F.transform(ls, lambda u: F.struct(u["i"].alias("i"), F.array_distinct(bigrams_in(u["w"])).alias("a")))
        units = F.concat(F.coalesce(whole, nothing), F.filter(each, lambda u: F.size(u["a"]) > 0))
        return F.filter(F.transform(units, lambda u: best_match(u["i"], u["a"], near, least)), lambda m: m["license"].isNotNull())
    out = rows.select(*keep, F.when(F.col("__text").isNotNull(), let(lines, of_text)).alias("__seen"))
    found, runs = F.col("__seen.found"), F.col("__seen.runs")
    nothing = F.array().cast("array<struct<unit:int,license:string,dice:double>>")
    wrapped = F.when(F.size(runs) > 0, F.array_sort(F.concat(found, chosen_runs(runs, found))))
    out = out.select(*keep, F.coalesce(wrapped, found, nothing).alias("matches"))
    return out.select(*keep, "matches", F.array_sort(F.array_distinct(F.col("matches.license"))).alias("licenses"),
                      F.size("matches").alias("n_matches"))
