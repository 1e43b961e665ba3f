"""Licences, by the Dice coefficient over word bigrams between passages and templates: DataFrame functions only.

A text's lines, its paragraphs and the text itself are the passages. A passage of n distinct bigrams can reach the
coefficient t with a template of m only if n lies between m t / (2 - t) and m (2 - t) / t; templates out of these bounds
are not compared. The bigrams that are left are looked up in one table of all templates' bigrams, and counted.

A licence that stands amid other text, over whatever lines and paragraphs, is a run of words. Where a text has so many of
a longer template's bigrams as a match must share, the run is looked for that has the most of them for its length: a
bigram of the template counts 2 - t, any other -t, and the run of the greatest sum is found in one pass. It is looked
for three times, over all bigrams of the template and over the first and the last occurrence of each, and the run's
coefficient is then taken as a passage's is.

Texts that hold none of a few words, of which every match must have one, are passed over before any of this.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable
from functools import cache, reduce
from importlib import resources
from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlark.llm.common import checkpointed, small, words_of

THRESHOLD = 0.8

#: Templates of fewer bigrams are compared with lines, paragraphs and whole texts alone: any sentence may hold a short one.
RUN_BIGRAMS = 10

#: Templates of which a match has more bigrams than this are looked for only in texts that are long enough.
LONG = 200

# The notices and first paragraphs that usually stand for licences.
NOTICES = {
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-2.1-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MIT notice": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Proprietary notice": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
}



@cache
def all_templates() -> dict[str, str]:
    """The notices, and the full texts in the folder licenses."""
    texts = {f.name.removesuffix(".txt"): f.read_text(encoding="utf-8") for f in resources.files(__package__).joinpath("licenses").iterdir() if f.name.endswith(".txt")}
    return NOTICES | {f"{name} full text": body for name, body in texts.items()}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTED = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def template_bigrams(text: str) -> list[str]:
    words = [w.decode() for w in words_of(text.encode())]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def bounds(m: int, threshold: float) -> tuple[int, int]:
    """Least and greatest number of bigrams of a passage that can reach the threshold with a template of m."""
    return ceil(m * threshold / (2 - threshold) - 1e-9), floor(m * (2 - threshold) / threshold + 1e-9)


def fewest_shared(m: int, threshold: float) -> int:
    """Of a template's m bigrams, so many are in every passage that reaches the threshold."""
    return ceil(threshold * (bounds(m, threshold)[0] + m) / 2 - 1e-9)


def cover(templates: Iterable[list[str]], threshold: float) -> list[str]:
    """Some words of which every text that reaches the threshold with one of the templates has one at least.

    The bigrams of a template that have none of the words are fewer than a match shares. Each word is the one that brings
    the templates nearest to that; a long word counts for more, since it is rarer elsewhere.
    """
    left = [({(*p.split(" "),) for p in pairs}, fewest_shared(len(pairs), threshold)) for pairs in templates]
    out: list[str] = []
    while left:
        gain: Counter[str] = Counter()
        for pairs, shared in left:
            over = len(pairs) - shared + 1
            for w, n in Counter(w for p in pairs for w in set(p)).items():
                gain[w] += min(1.0, n / over) * max(0.1, len(w) - 4) ** 2
        best = max(gain, key=lambda w: (gain[w], w))
        out.append(best)
        left = [({p for p in pairs if best not in p}, shared) for pairs, shared in left]
        left = [(pairs, shared) for pairs, shared in left if len(pairs) >= shared]
    return out


class Templates:
    """The templates' bigrams, numbered by name, with their bounds."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        known = [(name, template_bigrams(body)) for name, body in sorted(templates.items())]
        known = [(name, pairs) for name, pairs in known if pairs]
        self.names = [name for name, _ in known]
        self.pairs = [pairs for _, pairs in known]
        self.sizes = [len(pairs) for pairs in self.pairs]
        self.least, self.most = [bounds(m, threshold)[0] for m in self.sizes], [bounds(m, threshold)[1] for m in self.sizes]
        self.shared = [fewest_shared(m, threshold) for m in self.sizes]

    def table(self, spark: SparkSession, runs: bool) -> DataFrame:
        """(pair, place): the templates that have the bigram; runs: only those that runs are looked for of."""
        rows = [{"pair": p, "place": i} for i, pairs in enumerate(self.pairs) if not runs or len(pairs) >= RUN_BIGRAMS for p in pairs]
        one = spark.range(0, 1, 1, 1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), "array<struct<pair:string,place:int>>")).alias("x"))
        return F.broadcast(one.select("x.pair", "x.place"))

    def of(self, numbers: list[int], place: str | Column) -> Column:
        """The template's entry in a list."""
        return F.get(F.array(*map(F.lit, numbers)), place)

    def dice(self, shared: Column, n: Column, place: str) -> Column:
        return F.lit(2.0) * shared / (n + self.of(self.sizes, place))

    def maybe(self, words: Column, size: Column) -> Column:
        """Whether a text of these words and of so many bytes may match: it has a word of the cover, and is long enough for
        the templates that it covers."""
        short = [p for p, least in zip(self.pairs, self.least, strict=True) if least <= LONG]
        long = [p for p, least in zip(self.pairs, self.least, strict=True) if least > LONG]
        least = min((n for n in self.least if n > LONG), default=0)
        has = lambda some: F.arrays_overlap(words, F.array(*map(F.lit, sorted(cover(some, self.threshold)))).cast("array<string>"))
        # a bigram more is a word more, of two bytes with what parts it from the next
        return has(short) | ((size >= 2 * least) & has(long))


def _ordered(passage: Column) -> Column:
    """A passage's bigrams, one after the other."""
    words = F.filter(F.split(passage, "[ \n]"), lambda w: w != "")
    # zip_with pads the shorter array by null, and a null makes the last pair null
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda p: p.isNotNull())


def _passages(near: DataFrame, known: Templates) -> DataFrame:
    """(row, pos, c, dice, place) of the passages that reach the threshold with a template; c counts shared bigrams."""
    nothing = F.array().cast("array<string>")
    passages = F.concat(
        F.split("clean", "\n"),
        F.when(F.col("clean").rlike(r"\n *\n"), F.split("clean", r"\n *\n")).otherwise(nothing),
        F.when(F.instr("clean", "\n") > 0, F.array("clean")).otherwise(nothing),
    )
    each = near.select("row", F.posexplode(passages).alias("pos", "passage")).select("row", "pos", F.array_distinct(_ordered(F.col("passage"))).alias("pairs"))
    sized = each.withColumn("n", F.size("pairs")).filter(F.col("n").between(min(known.least, default=1), max(known.most, default=0)))
    hits = (
        sized.select("row", "pos", "n", F.explode("pairs").alias("pair"))
        .join(known.table(near.sparkSession, False), "pair")
        .filter(F.col("n").between(known.of(known.least, "place"), known.of(known.most, "place")))
    )
    counted = hits.groupBy("row", "pos", "n", "place").agg(F.count(F.lit(1)).alias("c"))
    return counted.select("row", "pos", "c", known.dice(F.col("c"), F.col("n"), "place").alias("dice"), "place").filter(F.col("dice") >= known.threshold)


def _runs(near: DataFrame, known: Templates) -> DataFrame:
    """(row, c, dice, place) of the best runs that reach the threshold with a longer template."""
    table = known.table(near.sparkSession, True)
    tokens = lambda rows: rows.select("row", F.posexplode(_ordered(F.col("clean"))).alias("at", "pair"))
    whole = near.select("row", F.explode(F.array_distinct(_ordered(F.col("clean")))).alias("pair"))
    shared = whole.join(table, "pair").groupBy("row", "place").agg(F.count(F.lit(1)).alias("c"))
    fit = checkpointed(shared.filter(F.col("c") >= known.of(known.shared, "place")).select("row", "place"))
    held = near.join(small(checkpointed(fit.select("row").distinct())), "row", "left_semi")
    hits = checkpointed(tokens(held).join(table, "pair").join(small(fit), ["row", "place"]))
    ends = lambda which: hits.groupBy("row", "place", "pair").agg(which("at").alias("at"))
    kinds = [hits.select("row", "place", "at"), *[ends(f).select("row", "place", "at") for f in (F.min, F.max)]]
    marked = reduce(DataFrame.union, [k.select("row", "place", F.lit(i).alias("kind"), F.col("at").cast("long")) for i, k in enumerate(kinds)])
    along = Window.partitionBy("row", "place", "kind").orderBy("at")
    t = round(1000 * known.threshold)
    # the sum over a run from one hit to another is a difference of what has summed up by each
    summed = marked.withColumn("nth", F.row_number().over(along).cast("long")).withColumn("before", 2000 * (F.col("nth") - 1) - t * F.col("at"))
    low = summed.withColumn("low", F.min(F.struct("before", "at")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    total = 2000 * F.col("nth") - t * F.col("at") - F.col("low.before") - t
    best = low.groupBy("row", "place", "kind").agg(F.max(F.struct(total.alias("total"), (-F.col("low.at")).alias("start"), (-F.col("at")).alias("end"))).alias("run"))
    runs = checkpointed(best.select("row", "place", "kind", (-F.col("run.start")).alias("start"), (-F.col("run.end")).alias("end")))
    inside = F.col("at").between(F.col("start"), F.col("end"))
    keys = ["row", "place", "kind"]
    sizes = tokens(held).join(small(runs), "row").filter(inside).groupBy(*keys).agg(F.count_distinct("pair").alias("n"))
    counts = hits.join(small(runs), ["row", "place"]).filter(inside).groupBy(*keys).agg(F.count_distinct("pair").alias("c"))
    return sizes.join(counts, keys).select("row", "c", known.dice(F.col("c"), F.col("n"), "place").alias("dice"), "place").filter(F.col("dice") >= known.threshold)


def scan_licenses(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of docs: doc_id, license, dice, n_passages.

    Of the templates with which a passage or a run of words reaches the threshold, license is the one that shares most
    bigrams with it, so that a licence is not taken for a shorter one that it contains; then the one of the greatest
    coefficient, then the first by name. dice is its coefficient. Both are null if none reaches the threshold. n_passages counts passages that reach
    it with any template: lines, paragraphs between empty lines if there are several, and the whole if it has several
    lines. Null and empty texts have none; repeated rows get a row each; an empty table gives none. Without templates
    nothing is found. Columns besides the two that are named are not read.
    """
    known = Templates(all_templates() if templates is None else templates, threshold)
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # a column of its own, so that it is made once
    split = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("body")).withColumn("words", F.split(F.lower("body"), _PARTED))
    clean = F.when(known.maybe(F.col("words"), F.octet_length("body")), F.regexp_replace(F.translate("body", _UPPER, _LOWER), _BETWEEN, " "))
    scanned = checkpointed(split.select("doc_id", F.monotonically_increasing_id().alias("row"), clean.alias("clean")))
    near = scanned.filter("clean IS NOT NULL").select("row", "clean")
    passages = checkpointed(_passages(near, known))
    runs = _runs(near, known)
    both = passages.unionByName(runs.withColumn("pos", F.lit(None).cast("int")))
    best = F.max(F.struct("c", "dice", (-F.col("place")).alias("place"))).alias("top")
    found = checkpointed(both.groupBy("row").agg(best, F.count_distinct("pos").alias("n_passages")))
    names = F.array(*map(F.lit, known.names)).cast("array<string>")
    return scanned.select("row", "doc_id").join(small(found), "row", "left").select(
        "doc_id", F.get(names, -F.col("top.place")).alias("license"), F.col("top.dice").alias("dice"), F.coalesce("n_passages", F.lit(0)).cast("long").alias("n_passages")
    )


def sql(threshold: float = THRESHOLD) -> str:
    known = Templates(all_templates(), threshold)
    rows = ", ".join(f"({place}, '{name}', {known.shared[place]}, [{', '.join(repr(p) for p in pairs)}])" for place, (name, pairs) in enumerate(zip(known.names, known.pairs, strict=True)))
    t = round(1000 * threshold)
    return rf"""
WITH template(place, name, least, pairs) AS (VALUES {rows}),
clean AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_BETWEEN}', ' ', 'g') AS c FROM documents),
passage AS (
  SELECT r, unnest(string_split(c, chr(10))) AS p FROM clean
  UNION ALL SELECT r, unnest(regexp_split_to_array(c, '
 *
')) FROM clean WHERE regexp_matches(c, '
 *
')
  UNION ALL SELECT r, c FROM clean WHERE contains(c, chr(10))),
worded AS (SELECT row_number() OVER () AS k, r, list_filter(regexp_split_to_array(p, '[ 
]'), lambda w: w <> '') AS w FROM passage),
paired AS (
  SELECT k, r, list_distinct(list_transform(generate_series(1, len(w) - 1), lambda x: w[x] || ' ' || w[x + 1])) AS pairs FROM worded WHERE len(w) > 1),
entry AS (SELECT place, unnest(pairs) AS pair FROM template),
size AS (SELECT place, name, least, len(pairs) AS m FROM template),
counted AS (
  SELECT k, r, n, place, count(*) AS c FROM (SELECT k, r, len(pairs) AS n, unnest(pairs) AS pair FROM paired) JOIN entry USING (pair) GROUP BY ALL),
reached AS (SELECT k, r, place, c, 2.0::DOUBLE * c / (n + m) AS dice FROM counted JOIN size USING (place)),
listed AS (SELECT r, list_filter(regexp_split_to_array(c, '[ 
]'), lambda w: w <> '') AS w FROM clean),
token AS MATERIALIZED (
  SELECT r, i, w[i + 1] || ' ' || w[i + 2] AS pair FROM (SELECT r, w, unnest(generate_series(0, len(w) - 2)) AS i FROM listed WHERE len(w) > 1)),
hit AS MATERIALIZED (SELECT r, place, i, pair FROM token JOIN entry USING (pair) JOIN size USING (place) WHERE m >= {RUN_BIGRAMS}),
fit AS (SELECT r, place FROM hit JOIN size USING (place) GROUP BY r, place, least HAVING count(DISTINCT pair) >= least),
marked AS (
  SELECT r, place, 0 AS kind, i FROM hit JOIN fit USING (r, place)
  UNION ALL SELECT r, place, 1, min(i) FROM hit JOIN fit USING (r, place) GROUP BY r, place, pair
  UNION ALL SELECT r, place, 2, max(i) FROM hit JOIN fit USING (r, place) GROUP BY r, place, pair),
numbered AS (SELECT *, row_number() OVER (PARTITION BY r, place, kind ORDER BY i) AS nth FROM marked),
summed AS (
  SELECT *, min((2000 * (nth - 1) - {t} * i)::HUGEINT * 4294967296 + i) OVER (PARTITION BY r, place, kind ORDER BY i ROWS UNBOUNDED PRECEDING) AS low FROM numbered),
started AS (SELECT r, place, kind, nth, i, (low & 4294967295)::BIGINT AS s, (low >> 32)::BIGINT AS before FROM (SELECT r, place, kind, nth, i, low FROM summed)),
run AS (
  SELECT r, place, kind, s, i AS e FROM started
  QUALIFY row_number() OVER (PARTITION BY r, place, kind ORDER BY 2000 * nth - {t} * i - before DESC, s, i) = 1),
inside AS (
  SELECT run.r, run.place, kind, (SELECT count(DISTINCT pair) FROM token WHERE token.r = run.r AND i BETWEEN s AND e) AS n,
    (SELECT count(DISTINCT pair) FROM hit WHERE hit.r = run.r AND hit.place = run.place AND i BETWEEN s AND e) AS c FROM run),
every AS (
  SELECT k, r, place, c, dice FROM reached WHERE dice >= {threshold}
  UNION ALL SELECT NULL, r, place, c, 2.0::DOUBLE * c / (n + m) AS d FROM inside JOIN size USING (place) WHERE d >= {threshold}),
best AS (
  SELECT r, count(DISTINCT k) AS n, arg_max(name, struct_pack(c := c, d := dice, p := -place)) AS license, arg_max(dice, struct_pack(c := c, d := dice, p := -place)) AS dice
  FROM every JOIN size USING (place) GROUP BY r)
SELECT doc_id, license, dice, CAST(coalesce(n, 0) AS BIGINT) AS n_passages FROM clean LEFT JOIN best USING (r)
"""
