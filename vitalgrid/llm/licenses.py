"""License scans: sparse TF-IDF cosine to templates, then inheritance down the directories.

Windows of a text as long as a template, around words that mention licensing, are
compared with template notices. An upper bound of the cosine, from the weights of
template words alone, leaves few windows whose other words are looked up. A file with a notice of its own has that license;
others take the one of the nearest directory above that holds a licence file.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import stored, table, whole
from vitalgrid.llm.rules import once

# Usual short notices by license, and the paragraphs by which full texts are told apart.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "ISC": ["Licensed under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "you may not use this file except in compliance with the Apache License", "Apache License Version 2.0, January 2004"],
    "GPL-1.0": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 1", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.0": ["you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL-2.1": ["This work is licensed under the GNU Lesser General Public License, version 2.1.", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3.", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0": ["This work is licensed under the GNU Affero General Public License, version 3.", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "Artistic-1.0": ["Licensed under the Artistic License", "The Artistic License Preamble"],
    "MPL-1.1": ["subject to the Mozilla Public License Version 1.1", "Mozilla Public License Version 1.1"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Mozilla Public License Version 2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License v 2.0"],
    "EUPL-1.2": ["Licensed under the EUPL, Version 1.2", "European Union Public Licence v. 1.2"],
    "Unlicense": ["This is free and unencumbered software released into the public domain", "Released under the Unlicense"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0", "Boost Software License Version 1.0 August 17th, 2003"],
    "Zlib": ["Licensed under the zlib License", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0 Universal", "Creative Commons Legal Code CC0 1.0 Universal"],
    "BSD-style": ["BSD-style license", "Licensed under a BSD-style license"],
    "proprietary": ["All rights reserved."],
}
for number in (2, 3):
    TEMPLATES[f"GPL-{number}.0"] += [text.format(number) for text in ("Distributed under the GNU GPL v{}", "Licensed under the GPLv{}", "GPLv{} licensed")]
SPDX = [name for name in TEMPLATES if name not in ("proprietary", "BSD-style")]  # named so on identifier lines
# Notices that are also part of other licenses' texts: they stand where no other notice is found.
PART_OF_OTHERS = {"BSD-2-Clause": 1, "BSD-style": 2, "proprietary": 3}
CUE = r"licen[sc]|gpl|copyright|rights reserved|public domain|redistribut|spdx|free of charge|endorse or promote|cc0"
CUE_TOKEN = r"licen[sc]|gpl|copyright|redistribut|spdx|cc0|^(promote|reserved|domain|charge)$"
TOKEN = r"[a-z0-9]+(?:[-.][a-z0-9]+)*"
LEAST_COSINE = 0.6
SLACK = 1e-9  # against rounding where a bound is compared


def notices() -> list[tuple[str, list[str]]]:
    texts = [(name, text) for name, own in TEMPLATES.items() for text in own] + [(name, f"SPDX-License-Identifier: {name}") for name in SPDX]
    return [(name, re.findall(TOKEN, text.lower())) for name, text in texts]


REACH = max(len(words) for _, words in notices()) - 1  # words to each side of a licensing word


def passages(docs: DataFrame) -> DataFrame:
    """doc_id, passage: the surroundings of each licensing word in whole texts, with whatever else docs has but text.

    A passage is the lower-cased words before the licensing one, a line feed, then
    that word and those after it: as far to each side as a template may reach.
    """
    rows = docs.withColumn("_text", F.lower(whole())).drop("text").filter(F.col("_text").rlike(CUE))
    rows = once(rows, "_words", F.regexp_extract_all("_text", F.lit(TOKEN), F.lit(0))).drop("_text")
    w = F.col("_words")

    def around(word: Column, i: Column) -> Column:
        before = F.slice(w, F.greatest(i - REACH, F.lit(0)) + 1, F.least(i, F.lit(REACH)))
        return F.when(word.rlike(CUE_TOKEN), F.concat(F.array_join(before, " "), F.lit("\n"), F.array_join(F.slice(w, i + 1, REACH + 1), " ")))

    return rows.withColumn("passage", F.explode(F.filter(F.transform(w, around), lambda x: x.isNotNull()))).drop("_words")


def reference(idf: DataFrame) -> tuple[Column, Column, Column]:
    """The place of each word of the templates, their squared weights, and the templates with their own products, as constants.

    All of it is as large as the templates are, whatever the corpus holds.
    """
    templates = notices()
    vocabulary = sorted({t for _, ws in templates for t in ws})
    known = {r.word: r.idf for r in idf.filter(F.col("word").isin(vocabulary)).collect()}
    rows = []
    for number, (name, ws) in enumerate(templates):
        times = Counter(ws)
        scale = math.sqrt(sum((n * known[t]) ** 2 for t, n in times.items()))
        rows.append({"template": number, "license": name, "length": len(ws), "scale": scale, "products": [times[t] * known[t] ** 2 for t in vocabulary]})
    constant = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    return (
        constant({t: i + 1 for i, t in enumerate(vocabulary)}, "map<string, int>"),
        constant([known[t] ** 2 for t in vocabulary], "array<double>"),
        constant(rows, "array<struct<template int, license string, length int, scale double, products array<double>>>"),
    )


def candidates(distinct: DataFrame, constants: tuple[Column, Column, Column]) -> DataFrame:
    """id, template, license, scale, dot, start, length, words of the windows that may come near enough to a template.

    A window is a run of a template's length around the passage's licensing word;
    passages shorter than a template are one window. Its product with a template
    needs the weights of template words only. Its length is at least that of its
    template words, once each time they stand there, with 1 for any other word,
    which no word weighs less than: product over that length is never less than
    the cosine, so no match is lost.
    """
    halves = F.split("passage", "\n")
    rows = distinct.select(
        "id",
        F.size(F.filter(F.split(halves[0], " "), lambda x: x != "")).alias("cue"),
        F.split(F.trim(F.translate("passage", "\n", " ")), " ").alias("words"),
    )
    places, squares, templates = constants
    rows = once(rows, "known", F.transform("words", lambda w: F.coalesce(F.try_element_at(places, w), F.lit(0))))
    known = F.col("known")

    def total(run: Column, values: Column, other: float) -> Column:
        return F.aggregate(run, F.lit(0.0), lambda a, k: a + F.when(k > 0, F.get(values, k - 1)).otherwise(F.lit(other)))

    def length(t: Column) -> Column:
        return F.least(t["length"], F.size("words"))

    # The whole passage gives no window less than this.
    hits = F.filter(templates, lambda t: total(known, t["products"], 0.0) >= (LEAST_COSINE - SLACK) * t["scale"] * F.sqrt(length(t).cast("double")))
    rows = rows.select("id", "cue", "words", "known", F.explode(hits).alias("t")).select("*", length(F.col("t")).alias("length"))
    last = F.greatest(F.least("cue", F.size("words") - F.col("length")), F.lit(0))
    first = F.least(F.greatest(F.col("cue") - F.col("length") + 1, F.lit(0)), last)
    rows = rows.select("id", "words", "known", "t", "length", F.explode(F.sequence(first, last)).alias("start"))
    rows = once(rows, "run", F.slice("known", F.col("start") + 1, F.col("length"))).select(
        "id", "words", "t", "length", "start", total(F.col("run"), F.col("t.products"), 0.0).alias("dot"), total(F.col("run"), squares, 1.0).alias("least")
    )
    near = rows.filter(F.col("dot") >= (LEAST_COSINE - SLACK) * F.col("t.scale") * F.sqrt("least"))
    near = near.select("id", "t.template", "t.license", "t.scale", "dot", "start", "length", F.slice("words", F.col("start") + 1, F.col("length")).alias("words"))
    return near.filter(F.array_join("words", " ").rlike(CUE))


def matches(found: DataFrame) -> DataFrame:
    """passage, license, cosine, place of the distinct passages that come near enough to a template.

    Document frequencies of all words are counted over all passages found and the
    templates; the words of windows that may be near enough get theirs by a join.
    Of the matches of a passage that with the least ``place`` in
    ``PART_OF_OTHERS``, then the nearest, then that of the first template counts.
    """
    spark = found.sparkSession
    templates = notices()
    distinct = stored(found.groupBy("passage").agg(F.count(F.lit(1)).alias("times")).withColumn("id", F.monotonically_increasing_id()))
    words = distinct.select("times", F.explode(F.array_distinct(F.split(F.trim(F.translate("passage", "\n", " ")), " "))).alias("word"))
    own = spark.createDataFrame([(1, t) for _, words_ in templates for t in set(words_)], "times bigint, word string")
    total = (distinct.agg(F.sum("times")).first()[0] or 0) + len(templates)
    idf = stored(words.union(own).groupBy("word").agg((F.log((1 + total) / (1 + F.sum("times"))) + 1).alias("idf")))

    near = stored(candidates(distinct, reference(idf)))
    key = ["id", "start", "length"]
    tokens = near.dropDuplicates(key).select(*key, F.explode("words").alias("word")).groupBy(*key, "word").agg(F.count(F.lit(1)).alias("tf"))
    weight = F.col("tf") * F.col("idf")
    norms = tokens.join(idf, "word").groupBy(*key).agg(F.sqrt(F.sum(weight * weight)).alias("norm"))
    near = near.join(norms, key).withColumn("cosine", F.round(F.col("dot") / F.col("norm") / F.col("scale"), 9)).filter(F.col("cosine") >= LEAST_COSINE)
    best = F.min(F.struct(place(F.col("license")).alias("place"), (-F.col("cosine")).alias("far"), "template", "license")).alias("best")
    chosen = near.groupBy("id").agg(best)
    return distinct.join(chosen, "id").select("passage", "best.license", (-F.col("best.far")).alias("cosine"), "best.place")


def place(license: Column) -> Column:
    """0, or how far a license stands back where there are others."""
    out = F.lit(0)
    for name, number in PART_OF_OTHERS.items():
        out = F.when(license == name, number).otherwise(out)
    return out


def above(path: Column) -> Column:
    """The directory of a path, '' at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame) -> DataFrame:
    """doc_id, path, license, cosine, origin of every row of files (doc_id, path, text).

    ``origin``: ``own`` (the best notice in the whole text, those of
    ``PART_OF_OTHERS`` last; of equal ones the first by name), ``inherited`` from the nearest directory at or above the
    file's whose licence file (LICENSE, LICENCE, COPYING, any ending) has one, or
    ``none``. Several licence files of a directory: the best notice, then the
    first by name. A null path inherits nothing; a null text has no notice; rows
    that repeat a doc_id are told apart by path and share notices only if both
    agree; an empty table gives no rows.
    """
    files = files.select("doc_id", "path", "text")
    found = stored(passages(files))
    best = F.min(F.struct("place", (-F.col("cosine")).alias("far"), "license")).alias("best")
    notice = (
        found.join(matches(found).withColumnRenamed("passage", "_passage"), F.col("passage") == F.col("_passage"))
        .groupBy("doc_id", "path").agg(best)
        .select(F.col("doc_id").alias("_id"), F.col("path").alias("_path"), F.col("best.license").alias("own"), (-F.col("best.far")).alias("cosine"), "best.place")
    )
    notice = stored(notice)
    rows = files.select("doc_id", "path").join(notice, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("path").eqNullSafe(F.col("_path")), "left")
    rows = rows.select("doc_id", "path", above(F.col("path")).alias("dir"), "own", "cosine")
    holders = (
        notice.filter(F.col("_path").rlike(r"(?i)(^|/)(licen[sc]e|copying)(\.[^/]*)?$"))
        .groupBy(above(F.col("_path")).alias("holder"))
        .agg(F.min(F.struct("place", (-F.col("cosine")).alias("far"), F.col("own").alias("license"))).alias("held"))
        .select("holder", F.col("held.license").alias("license"))
    )
    # Each directory once: its ancestors, itself included, joined to those that hold a licence.
    dirs = files.select(above(F.col("path")).alias("dir")).filter("dir is not null").distinct()
    parts = F.split("dir", "/")
    lines = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))).alias("up")).distinct()
    nearest = (
        lines.join(holders, F.col("up") == F.col("holder"))
        .groupBy("dir").agg(F.max(F.struct(F.length("up").alias("depth"), "license")).alias("near"))
        .select(F.col("dir").alias("_dir"), F.col("near.license").alias("inherited"))
    )
    return rows.join(nearest, F.col("dir") == F.col("_dir"), "left").select(
        "doc_id", "path", F.coalesce("own", "inherited").alias("license"), "cosine",
        F.when(F.col("own").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
    )


def documents_as_files(docs: DataFrame) -> DataFrame:
    """Documents laid out as files: block / shelf / name.

    The first document of each shelf of 64 is its LICENSE file, the first of each
    block of 4096 lies in the block's folder instead.
    """
    i = F.col("doc_id")
    block, shelf = (F.concat(F.lit(x), F.floor(i / n).cast("string")) for x, n in (("b", 4096), ("s", 64)))
    name = F.when(i % 64 == 0, "LICENSE").otherwise(F.concat(i.cast("string"), F.lit(".txt")))
    path = F.when(i % 4096 == 0, F.concat_ws("/", block, name)).when(i.isNotNull(), F.concat_ws("/", block, shelf, name))
    return docs.select("doc_id", path.alias("path"), "text")


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan(documents_as_files(table(spark, folder, "documents"))).select("doc_id", "path", "license", "origin")


QUERIES = {"op10_license_scan": op10_license_scan}

SQL: dict[str, str] = {}
