"""Licence scan by the Dice coefficient over word bigrams, in DataFrame
functions only.

Each line of a text, and the whole text, is a unit.  Units and templates are
normalised alike: lower case, everything but letters and digits a space.  The
score of a unit against a template is twice the number of shared distinct word
bigrams over the sum of both numbers.  A score of ``threshold`` needs sizes
within ``threshold / (2 - threshold)`` of each other, so templates out of
these bounds are pruned by size before any bigram is compared, and units that
no template admits are dropped before their bigrams are made.

Windows find what no unit shows: a notice wrapped over lines or within a line
of prose, and whole licence texts.  A window of a template is as long as the
template, and is laid where an anchor of the text meets the same bigram in the
template.  The anchors of a template are more of its bigrams than a score of
``threshold`` may miss (those that fewest templates hold first), so every
stretch that reaches the score holds one.  Of the windows laid at one anchor
the best counts.  Texts without an anchor word are dropped before their bigrams
are made.  Edits before all anchors shift a window; a stretch so shifted that
it falls under the score is not found.

Scale: one pass without a shuffle; templates are a small constant, given as
literals.  A text with many lines is a few arrays in one row; the work on
windows is anchors in the text times template length.

Defined results: null, empty and one-word units match nothing; ties go to the
template first by name; repeated rows stay; null ids stay; an empty table gives
none; other columns, whatever their names, are not read.  Very long texts are
scanned whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import settled
from orderloom.llm.license_texts import FULL_TEXTS

THRESHOLD = 0.8

# Short notices by which a text names its licence: fixed public wordings.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License."],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License."],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
        "License."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version."],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


def normalised_words(text: str) -> list[str]:
    """What ``words_column`` does, for the templates."""
    return re.sub(r"[^\w]|_", " ", text.lower()).split()


def bigrams_of(words: list[str]) -> list[str]:
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def words_column(text: Column) -> Column:
    spaced = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def template_rows(templates: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
    """``(licence, bigrams)`` in a fixed order."""
    return [(name, bigrams_of(normalised_words(t))) for name in sorted(templates) for t in templates[name]]


def window_templates(templates: dict[str, list[str]]) -> list[tuple[str, list[str]]]:
    """``(licence, bigrams in order, repeats kept)`` of the notices and the
    whole texts, in a fixed order."""
    out = []
    for name in sorted({*templates, *FULL_TEXTS}):
        for text in dict.fromkeys(templates.get(name, []) + FULL_TEXTS.get(name, [])):
            words = normalised_words(text)
            out.append((name, [f"{a} {b}" for a, b in zip(words, words[1:])]))
    return [(name, grams) for name, grams in out if grams]


def mark(gram: str) -> str:
    """The word by which a bigram is looked for first: its longer one."""
    return max(gram.split(), key=lambda w: (len(w), w))


def anchors(rows: list[tuple[str, list[str]]], threshold: float) -> list[str]:
    """Bigrams of which a window that reaches ``threshold`` against any
    template holds at least one."""
    common = Counter(g for _, grams in rows for g in set(grams))
    out = set()
    for _, grams in rows:
        own = sorted(set(grams), key=lambda g: (common[g], -len(mark(g)), g))
        shared = math.ceil(threshold / (2 - threshold) * len(own) - 1e-9)
        out.update(own[:len(own) - shared + 1])
    return sorted(out)


def with_windows(df: DataFrame, words: str, templates: dict[str, list[str]], threshold: float) -> DataFrame:
    """``df`` with ``windows``: ``(start, license, dice)`` of the matching windows
    of the word array ``words``, by start (the first word is 1)."""
    rows = window_templates(templates)
    known = anchors(rows, threshold)
    marks = F.array(*map(F.lit, sorted({mark(g) for g in known})))
    size = F.size(words)
    none = F.array().cast("array<string>")
    grams = F.when((size > 1) & F.arrays_overlap(words, marks), F.transform(
        F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))),
        lambda i: F.concat_ws(" ", F.get(words, i - 1), F.get(words, i)))).otherwise(none)
    df = settled(df, _grams=grams)
    df = settled(df, _met=F.array_intersect("_grams", F.array(*map(F.lit, known))))
    places = F.when(F.size("_met") > 0, F.filter(
        F.transform("_grams", lambda g, i: F.struct((i + 1).alias("i"), g.alias("g"))),
        lambda x: F.array_contains(F.col("_met"), x["g"]))).otherwise(
            F.array().cast("array<struct<i:int,g:string>>"))
    df = settled(df, _places=places)

    def best(x: Column) -> Column:
        tried = []
        for order, (name, ordered) in enumerate(rows):
            at = F.array_position(F.array(*map(F.lit, ordered)), x["g"]).cast("int")
            start = F.greatest(F.lit(1), x["i"] - at + 1)
            window = F.array_distinct(F.slice("_grams", start, F.lit(len(ordered))))
            own = sorted(set(ordered))
            shared = F.size(F.array_intersect(window, F.array(*map(F.lit, own))))
            tried.append(F.when(at > 0, F.struct(
                (2.0 * shared / (F.size(window) + len(own))).alias("dice"), F.lit(-order).alias("order"),
                start.alias("start"), F.lit(name).alias("license"))))
        return F.array_max(F.array(*tried))

    df = settled(df, _tried=F.transform("_places", best))
    found = F.filter("_tried", lambda b: F.coalesce(b["dice"] >= threshold, F.lit(False)))
    windows = F.array_sort(F.array_distinct(F.transform(found, lambda b: F.struct(
        b["start"].alias("start"), b["license"].alias("license"), b["dice"].alias("dice")))))
    return settled(df, windows=windows).drop("_grams", "_met", "_places", "_tried")


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES,
                  threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
                  ) -> DataFrame:
    """``(id, n_lines, matches, windows)`` of every row: ``matches`` holds
    ``(line_no, license, dice)`` of each unit's best template, with line -1 for
    the whole text (given only where the text has several lines), ``windows``
    ``(start, license, dice)`` of stretches of words, lines disregarded."""
    rows = [(name, grams) for name, grams in template_rows(templates) if grams]
    least = threshold / (2 - threshold) * min(len(g) for _, g in rows)
    most = (2 - threshold) / threshold * max(len(g) for _, g in rows)
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    units = F.transform(lines, lambda x, i: F.struct(i.alias("line_no"), x.alias("unit")))
    units = F.when(F.size(lines) > 1, F.array_append(
        units, F.struct(F.lit(-1).alias("line_no"), text.alias("unit")))).otherwise(units)
    df = settled(docs.select(F.col(id_col).alias("id"), F.col(text_col)),
                 n_lines=F.size(lines).cast("long"), units=units, _words=words_column(text)).drop(text_col)
    df = with_windows(df, "_words", templates, threshold).drop("_words")

    # Size bounds: a unit of n words, d of them distinct, has d - 1 to n - 1
    # distinct bigrams.
    df = settled(df.withColumnRenamed("units", "all"), units=F.filter(
        F.transform("all", lambda u: F.struct(u["line_no"].alias("line_no"),
                                              words_column(u["unit"]).alias("words"))),
        lambda u: (F.size(u["words"]) - 1 >= least)
        & (F.size(F.array_distinct(u["words"])) - 1 <= most))).drop("all")
    known = F.array(*[F.lit(g) for g in sorted({g for _, grams in rows for g in grams})])
    df = settled(df.withColumnRenamed("units", "all"), units=F.filter(
        F.transform("all", lambda u: F.struct(u["line_no"].alias("line_no"), F.array_distinct(
            F.transform(F.sequence(F.lit(1), F.size(u["words"]) - 1), lambda i: F.concat_ws(
                " ", F.get(u["words"], i - 1), F.get(u["words"], i)))).alias("bigrams"))),
        lambda u: F.arrays_overlap(u["bigrams"], known))).drop("all")

    def best(u: Column) -> Column:
        n = F.size(u["bigrams"])
        tried = []
        for order, (name, grams) in enumerate(rows):
            fits = ((n >= threshold / (2 - threshold) * len(grams))
                    & (n <= (2 - threshold) / threshold * len(grams)))
            shared = F.size(F.array_intersect(u["bigrams"], F.array(*map(F.lit, grams))))
            tried.append(F.when(fits, F.struct(
                (2.0 * shared / (n + len(grams))).alias("dice"), F.lit(-order).alias("order"),
                F.lit(name).alias("license"))))
        return F.array_max(F.array(*tried))

    scored = F.transform("units", lambda u: F.struct(u["line_no"].alias("line_no"), best(u).alias("b")))
    df = settled(df, scored=scored)
    matches = F.transform(
        F.filter("scored", lambda m: F.coalesce(m["b"]["dice"] >= threshold, F.lit(False))),
        lambda m: F.struct(m["line_no"].alias("line_no"), m["b"]["license"].alias("license"),
                           m["b"]["dice"].alias("dice")))
    return df.select(F.col("id").alias(id_col), "n_lines", matches.alias("matches"), "windows")
