"""Licence scan: Dice coefficient over word bigrams against licence templates.

A text is normalised to one sequence of lower-case words of letters and digits
(dots inside version numbers stay), over line breaks, sentence ends and comment
marks. Its passages are runs of that sequence, each stood for by its set of word
bigrams (64-bit hashes). The Dice coefficient 2 * |A and B| / (|A| + |B|) with a
template B can reach the threshold t only if |A| lies between |B| * t / (2 - t)
and |B| * (2 - t) / t, so for a template with P bigrams, repeats included, the
passages are those of at least |B| * t / (2 - t) and at most P * (2 - t) / t
bigrams. The best of them begins and ends with bigrams of the template, as others
only lower the coefficient there. All such passages are tried; for templates of
more than ``LONG`` bigrams, those from the beginning of a run of the template's
bigrams to the end of one, as the rest of a run only raises the coefficient (or
leaves it, where bigrams repeat). Of passages that overlap, the best counts.

Two filters leave texts alone that can't match: a match shares at least
t / (2 - t) of the template's bigrams, so it holds one of a few anchor words of
the template, and the whole text has that many of the template's bigrams.

The templates are a parameter: short notices and full licence texts, a list that
travels with the plan.

Edge cases: a null, empty or wordless text has no passage and no licence; a
text of one word has no bigram and matches nothing; equal scores go to the
template whose name is smaller. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Well-known licence notices, as their publishers word them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "ARR": "All rights reserved.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
#: Full licence texts, named after their files.
TEMPLATES |= {f"{p.stem}-full": p.read_text() for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
THRESHOLD = 0.8
#: Templates of more bigrams have passages between run ends only, and as anchors the words in most bigrams.
LONG = 64


def words_of(segment: Column) -> Column:
    clean = F.regexp_replace(F.lower(segment), r"[^\p{L}\p{N}.]+|\.(?!\p{N})|(?<!\p{N})\.", " ")
    return F.filter(F.split(clean, " +"), lambda w: w != "")


def pairs_of(words: Column) -> Column:
    """The hashes of a text's word bigrams in order, repeats included."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)), lambda a, b: F.xxhash64(a, b))
    return F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<bigint>"))


def bigrams_of(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(F.size(words) > 1, pairs).otherwise(F.array().cast("array<string>")))


def template_bigrams(spark, templates: Mapping[str, str]) -> dict[str, list[str]]:
    """Normalised by the same expressions as the texts."""
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string")
    rows = rows.select("name", bigrams_of(words_of(F.col("text"))).alias("grams")).collect()  # the short template list
    return {r["name"]: sorted(r["grams"]) for r in rows if r["grams"]}


def template_pairs(spark, templates: Mapping[str, str]) -> dict[str, list[int]]:
    """The same bigrams as hashes in order, repeats included."""
    rows = spark.createDataFrame(sorted(templates.items()), "name string, text string")
    rows = rows.select("name", pairs_of(words_of(F.col("text"))).alias("pairs")).collect()  # the short template list
    return {r["name"]: r["pairs"] for r in rows if r["pairs"]}


def size_bounds(n: int, t: float) -> tuple[float, float]:
    return n * t / (2 - t), n * (2 - t) / t


def anchors(grams: list[str], t: float) -> list[str]:
    """Words of a template of which every matching segment has at least one.

    A match shares at least t / (2 - t) of the template's bigrams. Without the
    anchors a segment lacks every bigram that touches one, and what is left is
    less than that share. Long words come first, as they are rare in other texts;
    in long templates, words of six letters or more that touch the most bigrams.
    """
    touched: dict[str, int] = {}
    for g in grams:
        for w in set(g.split(" ")):
            touched[w] = touched.get(w, 0) + 1
    words = sorted(touched, key=lambda w: (len(w) < 6, -touched[w], w) if len(grams) > LONG else (-len(w), w))
    out: list[str] = []
    for w in words:
        out.append(w)
        left = sum(not any(x in out for x in g.split(" ")) for g in grams)
        if left < len(grams) * t / (2 - t) - 1e-9:
            break
    return out


def _longs(values) -> str:
    """A constant array in SQL, as one literal."""
    return f"cast(split('{','.join(map(str, values))}', ',') as array<bigint>)"


def _passages(name: str, pairs: list[int], threshold: float) -> str:
    """SQL for the matching passages of the bigrams ``gs`` (of which ``hs`` are in some template) with one template."""
    own, quoted = sorted(set(pairs)), name.replace("\\", "\\\\").replace("'", "\\'")
    n, known = len(own), _longs(own)
    lo, hi = math.ceil(size_bounds(n, threshold)[0] - 1e-9), math.floor(size_bounds(len(pairs), threshold)[1] + 1e-9)
    start, end = (" and (s = 0 or not hit[s - 1])", " and (e = size(gs) - 1 or not hit[e + 1])") if n > LONG else ("", "")
    score = (
        f"transform(array(slice(gs, s + 1, e - s + 1)), p -> 2.0D * size(array_intersect(p, {known}))"
        f" / (size(array_distinct(p)) + {n}))[0]"
    )
    best = (
        f"array_max(transform(filter(sequence(s + {lo} - 1, least(s + {hi}, size(gs)) - 1), e -> hit[e]{end}),"
        f" e -> struct({score} as score, -e as back, s as s)))"
    )
    starts = f"filter(sequence(0, size(gs) - {lo}), s -> hit[s]{start})"
    found = f"filter(transform({starts}, s -> {best}), w -> w.score >= {threshold!r}D)"
    none = "cast(array() as array<struct<score: double, back: int, s: int>>)"
    last = "element_at(acc, -1)"
    apart = (
        f"aggregate({found}, {none}, (acc, w) -> case when size(acc) = 0 or w.s > -{last}.back then concat(acc, array(w))"
        f" when w.score > {last}.score then concat(slice(acc, 1, size(acc) - 1), array(w)) else acc end)"
    )
    rows = f"transform({apart}, w -> struct(w.score as score, '{quoted}' as name, xxhash64(slice(gs, w.s + 1, 1 - w.back - w.s)) as passage))"
    flagged = f"transform(array(transform(gs, g -> array_contains({known}, g))), hit -> {rows})[0]"
    return f"case when size(array_intersect(hs, {known})) >= {lo} then {flagged} else {_NONE} end"


_NONE = "cast(array() as array<struct<score: double, name: string, passage: bigint>>)"


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row for each row of ``docs``: id, n_matches, license, score, licenses.

    ``n_matches`` counts distinct matching passages, ``license`` and ``score``
    are the best match, ``licenses`` all matched templates in order of name.
    """
    spark = docs.sparkSession
    grams, pairs = template_bigrams(spark, templates), template_pairs(spark, templates)
    empty = F.array().cast("array<bigint>")

    # a bigram of a text takes two characters at least; long templates are tried on texts of that length only
    by_length: dict[int, set[str]] = {}
    for g in grams.values():
        least = 2 * math.ceil(size_bounds(len(g), threshold)[0]) if len(g) > LONG else 0
        by_length.setdefault(least, set()).update(anchors(g, threshold))

    def may_match(lowered: Column) -> Column:
        out, tried = F.lit(False), set()
        for least, words in sorted(by_length.items()):
            new = sorted(words - tried)
            tried |= words
            if new:
                out = out | ((F.length(lowered) >= least) & F.exists(F.array(*[F.lit(w) for w in new]), lambda w: F.contains(lowered, w)))
        return out

    text = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    low = docs.select(F.col(id_col).alias("id"), text.alias("low"))
    split = low.select("id", F.when(may_match(F.col("low")), words_of(F.col("low"))).otherwise(F.array().cast("array<string>")).alias("words"))
    cut = split.select("id", F.when(F.size("words") > 1, pairs_of(F.col("words"))).otherwise(empty).alias("pairs"))
    every = _longs(sorted({x for p in pairs.values() for x in p}))
    each = ", ".join(_passages(name, pairs[name], threshold) for name in sorted(pairs))
    # one-element arrays bind a value to a name, so that it is worked out once a text
    matches = f"transform(array(pairs), gs -> transform(array(array_intersect(gs, {every})), hs -> case when size(hs) > 0 then flatten(array({each})) else {_NONE} end)[0])[0]"
    flat = cut.select("id", F.expr(matches).alias("flat"))

    n_matches = F.size(F.array_distinct(F.transform("flat", lambda m: m["passage"]))).cast("long")
    best = F.array_min(F.transform("flat", lambda m: F.struct((-m["score"]).alias("minus"), m["name"].alias("name"))))
    names = F.array_sort(F.array_distinct(F.transform("flat", lambda m: m["name"])))
    out = flat.select("id", n_matches.alias("n_matches"), best.alias("best"), names.alias("names"))
    return out.select(
        F.col("id").alias(id_col),
        "n_matches",
        F.col("best.name").alias("license"),
        (-F.col("best.minus")).alias("score"),
        F.when(F.size("names") > 0, F.concat_ws(",", "names")).alias("licenses"),
    )
