"""License scans: normalised passages against licence templates by the Dice
coefficient over word bigrams.

A document's passages are its whole text, its paragraphs and its lines.
Normalised: lower case, runs of other than letters and digits one space. A
passage of b different bigrams can reach the coefficient t with a template
of n only if b*t/(2-t) <= n <= b*(2-t)/t; those bounds prune the templates of
each passage, and passages no template can match.

A notice that shares its line or paragraph with other words is found in
windows: stretches of consecutive words of the whole text, across lines, of
the sizes that those bounds allow for the template. A window begins and ends
with a bigram of its template, as any other end only lowers the coefficient;
all of them are compared in the texts that hold enough of a template.

DataFrame functions only, row by row: nothing is shuffled and the templates
are literals of the plan.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
ROUNDING = 1e-9  # slack of the size bounds, as 6 * 1.2 is below 7.2 in doubles

# Texts of public licences and of their usual notices.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not
        use this file except in compliance with the License. You may obtain a copy of the License
        at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", """Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without
        modification, are permitted provided that the following conditions are met:"""),
    ("BSD-2-Clause", """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
        AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
        EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
        INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
        LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
        OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Neither the name of the copyright holder nor the names of its contributors
        may be used to endorse or promote products derived from this software without specific
        prior written permission."""),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", """This work is licensed under a Creative Commons Attribution 4.0 International
        License."""),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation,
        either version 3 of the License, or (at your option) any later version."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with
        or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions:"""),
    ("MIT", """The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software."""),
    ("MIT", """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
        FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v.
        2.0. If a copy of the MPL was not distributed with this file, You can obtain one at
        https://mozilla.org/MPL/2.0/."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

GNU = """This {0} is free software: you can redistribute it and/or modify it under the terms of the
    GNU {1} General Public License as published by the Free Software Foundation, either version
    {2} of the License, or (at your option) any later version."""
CC = "This work is licensed under a Creative Commons {} 4.0 International License."

# Other common licences, and siblings of those above that would pass for them.
TEMPLATES_MORE: list[tuple[str, str]] = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", GNU.format("program", "Affero", 3)),
    ("Artistic-2.0", "Licensed under the Artistic License 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", CC.format("Attribution-NoDerivatives")),
    ("CC-BY-NC-4.0", CC.format("Attribution-NonCommercial")),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-ND-4.0", CC.format("Attribution-NonCommercial-NoDerivatives")),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", CC.format("Attribution-NonCommercial-ShareAlike")),
    ("CC-BY-SA-4.0", CC.format("Attribution-ShareAlike")),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal."),
    ("CC0-1.0", """To the extent possible under law, the author(s) have dedicated all copyright and
        related and neighboring rights to this software to the public domain worldwide. This
        software is distributed without any warranty."""),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of
        the Eclipse Public License 2.0"""),
    ("EUPL-1.2", "Licensed under the EUPL, Version 1.2."),
    ("GFDL-1.3", """Permission is granted to copy, distribute and/or modify this document under the
        terms of the GNU Free Documentation License, Version 1.3"""),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", GNU.format("program", "", 2)),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("ISC", "Licensed under the ISC License."),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", GNU.format("library", "Lesser", 2.1)),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", GNU.format("program", "Lesser", 3)),
    ("LGPL-3.0", GNU.format("library", "Lesser", 3)),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no
        event will the authors be held liable for any damages arising from the use of this
        software."""),
    ("Zlib", """Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions:"""),
]
ALL_TEMPLATES = TEMPLATES + TEMPLATES_MORE


def word_pairs(text: str) -> list[str]:
    """Word bigrams of a template, as they follow each other."""
    words = re.sub(r"[^a-z0-9]+", " ", text.lower()).split()
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bigrams(text: str) -> list[str]:
    """Different word bigrams of a template, in order of appearance."""
    return list(dict.fromkeys(word_pairs(text)))


def template_texts(templates: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The templates and each whole licence as well: its parts joined."""
    whole: dict[str, str] = {}
    for name, text in templates:
        if len(text) > 120:
            whole[name] = f"{whole.get(name, '')} {text}"
    long = [(n, t) for n, t in whole.items() if not any(t.strip() == x for _, x in templates)]
    return [*templates, *long]


def template_grams(templates: list[tuple[str, str]] = TEMPLATES
                   ) -> list[tuple[str, list[str]]]:
    """(licence, bigrams) of the templates and of each whole licence."""
    return [(n, bigrams(t)) for n, t in template_texts(templates)]


def _large_enough(b: Column, n: Column, threshold: float) -> Column:
    """A passage of b bigrams is not too small for a template of n: with
    shared <= b, 2 * shared >= threshold * (b + n) can hold."""
    return n * F.lit(threshold) <= b * F.lit(2 - threshold) + F.lit(ROUNDING)


def _small_enough(b: Column, n: Column, threshold: float) -> Column:
    """The same with shared <= n."""
    return b * F.lit(threshold) <= n * F.lit(2 - threshold) + F.lit(ROUNDING)


def least_shared(n: int, threshold: float) -> int:
    """Bigrams that any match shares with a template of n."""
    return math.ceil(threshold * n / (2 - threshold) - ROUNDING)


def telling(grams: list[tuple[str, list[str]]], threshold: float) -> list[str]:
    """Bigrams of which every passage that reaches ``threshold`` with some
    template has one. A match shares at least threshold * n / (2 - threshold)
    of a template's n bigrams, so one of any n - that + 1 of them; the longest
    are taken, as the least common."""
    out: set[str] = set()
    for _, g in grams:
        must = least_shared(len(g), threshold)
        out |= set(sorted(g, key=lambda x: (-len(x), x))[:len(g) - must + 1])
    return sorted(out)


def normalised(text: Column) -> Column:
    """The text in lower case, runs of other than letters and digits one
    space, line breaks left."""
    # a lone space is left as it is: the pattern then skips most of a text
    other = "[^\\p{L}\\p{N}\\n]*"
    return F.regexp_replace(F.lower(text),
                            f" ?[^\\p{{L}}\\p{{N}}\\n ]{other}| {{2,}}{other}", " ")


def on_one_line(clean: Column) -> Column:
    return F.regexp_replace(clean, " ?\\n[ \\n]*", " ")


def passages(clean: Column) -> Column:
    """The whole text, paragraphs and lines of a normalised text, each once."""
    joined = F.transform(F.concat(F.array(clean), F.split(clean, "\\n ?\\n")), on_one_line)
    return F.array_distinct(F.transform(F.concat(joined, F.split(clean, "\\n")),
                                        lambda p: F.trim(p)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pairs_of(words: Column) -> Column:
    """The bigrams of an array of words; a null at the end."""
    return F.zip_with(words, F.slice(words, 2, 1 << 30),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def put(blocks: Column, b: Column, item: Column) -> Column:
    """``blocks``, an array of arrays, with ``item`` added to block ``b``."""
    return F.concat(F.slice(blocks, 1, b), F.array(F.concat(F.get(blocks, b), F.array(item))),
                    F.slice(blocks, b + 2, 1 << 30))


class Templates:
    """The templates as literals of the plan, and what prunes them."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float):
        grams = template_grams(templates)
        self.threshold = threshold
        # the positions of a template's bigrams, repeated ones as well, bound its windows
        most = [int(len(word_pairs(t)) * (2 - threshold) / threshold + ROUNDING)
                for _, t in template_texts(templates)]
        self.literal = F.array(*[
            F.struct(F.lit(name).alias("license"), F.lit(len(g)).alias("n"),
                     F.lit(least_shared(len(g), threshold)).alias("must"),
                     F.lit(span).alias("span"), F.array(*map(F.lit, g)).alias("grams"))
            for (name, g), span in zip(grams, most, strict=True)])
        self.sizes = [len(g) for _, g in grams]
        # no window has more words than a block, so it meets two blocks at most
        self.block = max(most) + 1
        self.known = telling(grams, threshold)
        self.all = sorted({x for _, g in grams for x in g})

    def units(self, clean: Column) -> Column:
        """(passage, words) of the passages that are not too large."""
        # d different words take d - 1 different bigrams at least
        most = max(self.sizes) * (2 - self.threshold) / self.threshold
        return F.filter(F.transform(passages(clean),
                                    lambda p: F.struct(p.alias("passage"),
                                                       F.split(p, " ").alias("words"))),
                        lambda u: F.size(F.array_distinct(u["words"])) - 1 <= most + ROUNDING)

    def dice(self, t: Column, pairs: Column, b: Column) -> Column:
        return F.lit(2.0) * F.size(F.array_intersect(t["grams"], pairs)) / (t["n"] + b)

    def best(self, pairs: Column, b: Column) -> Column:
        """(dice, license) of the best template for a passage, null for none."""
        near = F.filter(self.literal, lambda t: _large_enough(b, t["n"], self.threshold)
                        & _small_enough(b, t["n"], self.threshold))
        scored = F.transform(near, lambda t: F.struct(
            self.dice(t, pairs, b).alias("dice"), t["license"].alias("license")))
        return F.array_max(F.filter(scored, lambda s: s["dice"] >= self.threshold))

    def told(self, clean: Column) -> Column:
        """(passage, words, best) of the passages that match."""
        def scored(u: Column) -> Column:
            return let(F.array_distinct(F.filter(pairs_of(u["words"]), lambda x: x.isNotNull())),
                       lambda p: F.struct(u["passage"].alias("passage"), u["words"].alias("words"),
                                          self.best(p, F.size(p)).alias("best")))

        hits = F.filter(self.units(clean), lambda u: F.exists(pairs_of(u["words"]),
                                                              lambda x: x.isin(self.known)))
        return F.filter(F.transform(hits, scored), lambda m: m["best"].isNotNull())

    def taken(self, told: Column, words: Column) -> Column:
        """(dice, license, first, last word) wherever the words of a matching
        passage stand."""
        def places(m: Column) -> Column:
            n = F.size(m["words"])
            at = F.filter(F.sequence(F.lit(1), F.size(words) - n + 1),
                          lambda i: F.slice(words, i, n) == m["words"])
            return F.transform(at, lambda i: F.struct(
                m["best"]["dice"].alias("dice"), m["best"]["license"].alias("license"),
                i.alias("first"), (i + n - 1).alias("last")))

        return F.flatten(F.transform(told, places))

    def windows(self, pairs: Column, hits: Column, viable: Column) -> Column:
        """(dice, license, -first, -last word) of the best window from each
        place where one of the ``viable`` templates can begin."""
        def of_start(t: Column, at: Column, k: Column) -> Column:
            s = F.element_at(at, k)
            ends = F.filter(F.slice(at, k + t["must"] - 1, t["span"]),
                            lambda e: e - s < t["span"])
            return F.array_max(F.transform(ends, lambda e: let(
                F.array_distinct(F.slice(pairs, s, e - s + 1)),
                lambda g: F.struct(self.dice(t, g, F.size(g)).alias("dice"),
                                   t["license"].alias("license"), (-s).alias("first"),
                                   (-e - 1).alias("last")))))

        def of_template(t: Column) -> Column:
            own = F.filter(hits, lambda i: F.array_contains(t["grams"], F.element_at(pairs, i)))
            return let(own, lambda at: F.transform(
                F.filter(F.transform(at, lambda _, k: k + 1), lambda k:
                         (k + t["must"] - 1 <= F.size(at))
                         & (F.get(at, k + t["must"] - 2) - F.element_at(at, k) < t["span"])),
                lambda k: of_start(t, at, k)))

        return F.filter(F.flatten(F.transform(viable, of_template)),
                        lambda w: w["dice"] >= self.threshold)


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through an array of one, so that they are evaluated once."""
    own = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", own.alias("own")) \
        .select(*df.columns, *[f"own.{n}" for n in columns])


def _scanned(docs: DataFrame, known: Templates) -> DataFrame:
    """The texts that hold a telling bigram, with their words and the passages
    that match. Bigrams of a passage are bigrams of the whole text."""
    held = docs.select("doc_id", F.explode(F.array(normalised(F.col("text")))).alias("clean"))
    held = _once(held, words=F.split(F.trim(on_one_line(F.col("clean"))), " ")) \
        .filter(F.exists(pairs_of(F.col("words")), lambda x: x.isin(known.known)))
    return _once(held, told=known.told(F.col("clean")))


def _windows(held: DataFrame, known: Templates) -> DataFrame:
    """Add ``best``: (dice, license, -first, -last word) of the windows that
    match and are not told by a matching passage: one of the same licence, or
    of as high a coefficient, that shares words with them. Of windows that
    share words the best is taken (ties: the name last in order, then the
    first). Windows and passages are held by blocks of words, so that each is
    compared with those near it alone."""
    words, pairs, hits = F.col("words"), F.col("pairs"), F.col("hits")
    held = _once(held, pairs=pairs_of(words))
    held = _once(held, hits=F.filter(F.sequence(F.lit(1), F.size(pairs) - 1),
                                     lambda i: F.element_at(pairs, i).isin(known.all)))
    held = _once(held, hit_pairs=F.array_distinct(F.transform(
        hits, lambda i: F.element_at(pairs, i))))
    held = _once(held, viable=F.filter(known.literal, lambda t: F.size(
        F.array_intersect(t["grams"], F.col("hit_pairs"))) >= t["must"]))
    held = _once(held, found=known.windows(pairs, hits, F.col("viable")))
    none = F.size("found") == 0
    held = _once(held, taken=F.when(none, F.array()).otherwise(
        known.taken(F.col("told"), words)))

    def block(word: Column) -> Column:
        return F.floor((word - 1) / known.block).cast("int")

    n_blocks = block(F.size(words)) + 1

    # blocks hold numbers of rows, as each step of a fold copies them
    empty = F.array_repeat(F.array().cast("array<int>"), n_blocks)

    def numbers(rows: str) -> Column:
        return F.transform(rows, lambda _, k: k + 1)

    def near(blocks: Column, first: Column, last: Column) -> Column:
        return F.flatten(F.slice(blocks, first + 1, last - first + 1))

    def noted(got: Column, k: Column) -> Column:
        m = F.element_at("taken", k)
        return F.aggregate(F.sequence(block(m["first"]), block(m["last"])), got,
                           lambda g, b: put(g, b, k))

    def is_told(w: Column, k: Column) -> Column:
        m = F.element_at("taken", k)
        return (m["first"] <= -w["last"]) & (m["last"] >= -w["first"]) \
            & ((m["license"] == w["license"]) | (m["dice"] >= w["dice"]))

    held = _once(held, told_at=F.aggregate(numbers("taken"), empty, noted))
    free = F.filter("found", lambda w: ~F.exists(
        near(F.col("told_at"), block(-w["first"]), block(-w["last"])), lambda k: is_told(w, k)))
    held = _once(held, ranked=F.sort_array(free, asc=False))

    # a window stands in the block of its first word; others that share words
    # with it begin in that block or in one beside it
    def join(got: Column, k: Column) -> Column:
        w = F.element_at("ranked", k)
        b = block(-w["first"])

        def meets(i: Column) -> Column:
            g = F.element_at("ranked", i)
            return (g["first"] >= w["last"]) & (g["last"] <= w["first"])

        met = F.exists(near(got, F.greatest(b - 1, F.lit(0)), b + 1), meets)
        return F.when(met, got).otherwise(put(got, b, k))

    best = F.flatten(F.aggregate(numbers("ranked"), empty, join))
    return _once(held, best=F.transform(best, lambda k: F.element_at("ranked", k)))


def _window_rows() -> Column:
    """(passage, license, dice) of the best windows, equal ones once; told
    apart as texts, which Spark hashes."""
    rows = F.array_distinct(F.transform("best", lambda w: F.concat_ws(
        "|", F.round(w["dice"], 6).cast("string"), w["license"],
        F.array_join(F.slice("words", -w["first"], w["first"] - w["last"] + 1), " "))))
    return F.transform(F.transform(rows, lambda r: F.split(r, "\\|", 3)), lambda r: F.struct(
        F.get(r, 2).alias("passage"), F.get(r, 1).alias("license"),
        F.get(r, 0).cast("double").alias("dice")))


def _rows(held: DataFrame, rows: Column) -> DataFrame:
    return held.select("doc_id", F.explode(rows).alias("row")) \
        .select("doc_id", "row.passage", "row.license", "row.dice")


def license_windows(docs: DataFrame, known: Templates) -> DataFrame:
    """The windows that match and are not told by a matching passage."""
    return _rows(_windows(_scanned(docs, known), known), _window_rows())


def license_matches(docs: DataFrame, templates: list[tuple[str, str]] = ALL_TEMPLATES,
                    threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, passage, license, dice): the passages of each document that
    reach ``threshold`` with a template, with the best template (ties: the
    name last in order), and the windows that do where no passage tells it.

    Null, empty and one-word texts have no bigrams and no row; a passage that
    occurs several times in a document counts once; repeated rows give
    repeated results; a null doc_id stays null; an empty table gives an empty
    result. Other columns are not read."""
    known = Templates(templates, threshold)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.col("text").cast("string").alias("text"))
    told = F.transform("told", lambda m: F.struct(
        m["passage"].alias("passage"), m["best"]["license"].alias("license"),
        F.round(m["best"]["dice"], 6).alias("dice")))
    return _rows(_windows(_scanned(src, known), known), F.concat(told, _window_rows()))


def oracle(threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``license_matches`` over documents, windows apart."""
    rows = ", ".join("({}, {}, '{}', [{}])".format(
        k, len(g), name, ", ".join(f"'{x}'" for x in g))
        for k, (name, g) in enumerate(template_grams(ALL_TEMPLATES)))
    return f"""
    WITH t(tid, n, license, grams) AS (VALUES {rows}),
    c AS (SELECT row_number() OVER () AS rid, doc_id,
            regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS clean
          FROM documents WHERE text IS NOT NULL),
    u AS (SELECT rid, doc_id, unnest(list_distinct(list_transform(
            list_concat([clean], regexp_split_to_array(clean, '\\n ?\\n'),
                        string_split(clean, chr(10))),
            lambda p: trim(regexp_replace(p, '[ \\n]+', ' ', 'g'))))) AS passage FROM c),
    w AS (SELECT *, string_split(passage, ' ') AS words FROM u),
    g AS (SELECT rid, doc_id, passage, list_distinct(list_transform(range(1, len(words)),
            lambda i: words[i] || ' ' || words[i + 1])) AS pairs FROM w WHERE len(words) >= 2),
    s AS (SELECT rid, doc_id, passage, license,
            2.0::DOUBLE * len(list_intersect(grams, pairs)) / (n + len(pairs)) AS dice
          FROM g JOIN t ON n * {threshold} <= len(pairs) * (2 - {threshold})
                       AND len(pairs) * {threshold} <= n * (2 - {threshold})),
    r AS (SELECT *, row_number() OVER (PARTITION BY rid, passage
            ORDER BY dice DESC, license DESC) AS k FROM s WHERE dice >= {threshold}::DOUBLE)
    SELECT doc_id, passage, license, round(dice, 6) AS dice FROM r WHERE k = 1"""
