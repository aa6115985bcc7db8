"""Licence scans by Dice coefficient over word bigrams, in SQL functions only.

Texts are compared with licence notices and whole licences, both lower-cased and with all but
letters and digits as spaces, so that comment signs and line breaks don't matter.  What is compared
is a text's lines, its paragraphs, and windows: stretches as long as a template, wherever a bigram
of the template sets one off, so a notice inside a longer line or a licence in a longer text is
found too.  Dice is twice the bigrams in common over all bigrams of both.

Three prunings, none of which loses a match at threshold `t`.  A line or paragraph can only reach it
for a template of m distinct bigrams if it has between m * t / (2 - t) and m * (2 - t) / t of them,
so sizes rule out templates.  A match holds at least t / (2 - t) of the template's bigrams, so a
text without any of a set of words and bigrams that are in more of them than may lack is never cut up;
and windows are only tried about a set of more of the template's bigrams than may lack.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import constant, let, spread, take

#: The usual wordings of public licences' notices, and of short licences as a whole.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("BSD-2-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'),
    ("BSD-3-Clause", 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.'),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under CC BY-NC-ND 4.0."),
)


def normalised(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams(words: list[str]) -> list[str]:
    """Distinct pairs of neighbouring words, in order; a single word is its own pair."""
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))) if len(words) > 1 else words


@dataclass(frozen=True)
class Template:
    """`grams`: distinct bigrams; a line or paragraph must have `least` to `most`; `n_words` is a
    window's length, and `starts` are the bigrams that set one off, with their place."""

    name: str
    grams: tuple[str, ...]
    least: int
    most: int
    n_words: int
    starts: tuple[tuple[str, int], ...]


def templates(source=TEMPLATES, threshold: float = 0.8) -> list[Template]:
    """Starting bigrams are the longest ones, as many as a match may lack and one more."""
    out = []
    for name, text in source:
        words = normalised(text)
        g = bigrams(words)
        ratio = threshold / (2 - threshold)
        rare = sorted(g, key=lambda x: (-len(x), x))[: int(len(g) * (1 - ratio) + 1e-9) + 1]
        starts = tuple((x, i) for i, x in enumerate(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)) if x in set(rare))
        out.append(Template(name, tuple(g), int(len(g) * ratio + 1 - 1e-9), int(len(g) / ratio + 1e-9), len(words), starts))
    return out


def anchors(found: list[Template], threshold: float = 0.8) -> tuple[list[str], list[str]]:
    """Words and bigrams such that a match within the threshold of any template has at least one of
    them: for each template, as many as cover more bigrams than a match may lack.  Words of six
    letters and more come first, which ordinary texts have seldom, by how many bigrams they cover
    that are not covered yet; then words of five; then whole bigrams, as shorter words are in every
    text.  A word also covers words that it is a part of."""
    words: list[str] = []
    pairs: list[str] = []
    covers = lambda word, gram: any(word in w for w in gram.split())
    for t in found:
        may_lack = len(t.grams) * (1 - threshold / (2 - threshold))
        bare = [g for g in t.grams if g not in pairs and not any(covers(c, g) for c in words)]
        while len(t.grams) - len(bare) <= may_lack + 1e-9:
            gain = {w: sum(covers(w, g) for g in bare) for g in bare for w in g.split() if len(w) > 4}
            if gain:
                words.append(min(gain, key=lambda w: (len(w) < 6, -gain[w], -len(w), w)))
                bare = [g for g in bare if not covers(words[-1], g)]
            else:
                pairs.append(max(bare, key=lambda g: (len(g), g)))
                bare.remove(pairs[-1])
    return sorted(w for w in set(words) if not any(v != w and v in w for v in set(words))), sorted(set(pairs))


def _words(unit: Column) -> Column:
    clean = F.trim(F.regexp_replace(F.lower(unit), r"[^a-z0-9]+", " "))
    return F.filter(F.split(clean, " "), lambda w: w != "")


def _pairs(ws: Column) -> Column:
    """Pairs of neighbouring words, by place."""
    return F.zip_with(F.slice(ws, F.lit(1), F.size(ws) - 1), F.slice(ws, F.lit(2), F.size(ws) - 1), lambda a, b: F.concat(a, F.lit(" "), b))


def _grams(ws: Column) -> Column:
    return F.when(F.size(ws) < 2, ws).otherwise(F.array_distinct(_pairs(ws)))


#: A window's number is its template's times this, and its first word's place.
PLACES = 1 << 40


def _windows(ws: Column, found: list[Template]) -> Column:
    """Numbers of the windows of a text's words: where a starting bigram is, the window begins as
    far before it as the template does, or with the text."""
    entries: dict[str, list[dict]] = {}
    for k, t in enumerate(found):
        for gram, at in t.starts:
            entries.setdefault(gram, []).append({"k": k, "at": at})
    table = constant(entries, "map<string,array<struct<k:bigint,at:bigint>>>")

    def of(pairs: Column) -> Column:
        places = F.filter(F.transform(pairs, lambda p, i: F.when(p.isin(list(entries)), i)), lambda i: i.isNotNull())
        number = lambda i: F.transform(table[F.get(pairs, i)], lambda e: e["k"] * PLACES + F.greatest(i.cast("long") - e["at"], F.lit(0).cast("long")))
        return F.array_distinct(F.flatten(F.transform(places, number)))

    return F.when(F.size(ws) < 2, F.array().cast("array<long>")).otherwise(let(_pairs(ws), of))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, source=TEMPLATES) -> DataFrame:
    """(id, licence, dice, n_units, n_windows, licences): the licence that any part of the whole
    text is closest to (ties to the name that sorts first), its Dice coefficient (6 digits), how
    many lines and paragraphs (of several lines) and how many windows match a template, and the
    names of all that do.

    Texts without a match, null and empty ones have a null licence, dice 0 and no units.  Repeated
    rows and null ids are scanned like any other; an empty table gives no rows; further columns, of
    whatever names, are not looked at."""
    found = templates(source, threshold)
    rows = spread(take(docs, id_col, text_col)).toDF("id", "text")
    wide = max(t.most for t in found)
    words, pairs = anchors(found, threshold)
    some = lambda t: F.exists(constant(words, "array<string>"), lambda w: F.contains(t, w))
    spaced = "|".join(p.replace(" ", "[^a-z0-9]+") for p in pairs)
    may = let(F.lower(F.coalesce("text", F.lit(""))), lambda t: some(t) | t.rlike(spaced) if pairs else some(t))
    table = constant([{"name": t.name, "grams": t.grams, "least": t.least, "most": t.most, "n_words": t.n_words} for t in found], "array<struct<name:string,grams:array<string>,least:int,most:int,n_words:int>>")
    hit = "struct<minus:double,name:string>"

    def score(g: Column, t: Column) -> Column:
        dice = F.lit(2.0) * F.size(F.array_intersect(g, t["grams"])) / (F.size(g) + F.size(t["grams"]))
        return F.struct((-F.round(dice, 6)).alias("minus"), t["name"].alias("name"))

    near_enough = lambda scores: F.filter(scores, lambda s: s["minus"] <= -threshold)

    def compare(g: Column) -> Column:
        near = F.filter(table, lambda t: (F.size(g) >= t["least"]) & (F.size(g) <= t["most"]))
        return F.array_min(near_enough(F.transform(near, lambda t: score(g, t))))

    paragraphs = F.filter(F.split("text", r"\n[\x20\x09\r]*\n"), lambda p: F.contains(p, F.lit("\n")))
    # a unit of more bigrams than the longest template allows is never compared
    units = F.filter(F.transform(F.concat(F.split("text", "\n"), paragraphs), lambda u: let(_words(u), _grams)), lambda g: (F.size(g) >= 1) & (F.size(g) <= wide))
    best = F.filter(F.transform(units, compare), lambda s: s.isNotNull())

    def in_windows(ws: Column) -> Column:
        def at(n: Column) -> Column:
            t = F.get(table, F.floor(n / PLACES).cast("int"))
            return let(t, lambda t: score(_grams(F.slice(ws, (n % PLACES).cast("int") + 1, t["n_words"])), t))

        return near_enough(F.transform(_windows(ws, found), at))

    none = F.array().cast(f"array<{hit}>")
    both = F.struct(best.cast(f"array<{hit}>").alias("units"), let(_words(F.col("text")), in_windows).cast(f"array<{hit}>").alias("windows"))
    rows = rows.select("id", F.when(may, both).otherwise(F.struct(none.alias("units"), none.alias("windows"))).alias("h"))
    rows = rows.select("id", "h", F.concat("h.units", "h.windows").alias("hits"))
    top = F.array_min("hits")
    return rows.select(
        F.col("id").alias(id_col),
        top["name"].alias("licence"),
        F.coalesce(-top["minus"], F.lit(0.0)).alias("dice"),
        F.size("h.units").cast("long").alias("n_units"),
        F.size("h.windows").cast("long").alias("n_windows"),
        F.array_sort(F.array_distinct(F.transform("hits", lambda s: s["name"]))).alias("licences"),
    )
