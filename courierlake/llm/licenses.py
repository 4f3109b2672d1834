"""Operator 9: licences found by TF-IDF cosine to templates, and inherited from the nearest directory above.

Every sentence of a text, within its line and over wrapped lines, every run of 2 to 8 lines, and the text as a whole,
is a sparse TF-IDF vector; document frequencies of all terms are counted over all documents. A sentence at cosine `least` or more to a template is a header that names its
licence. A file whose whole text is that near to a template, or that is named like one (LICENSE, COPYING, ...) and
holds such a sentence, is a licence file: its licence holds for all files below its directory that name none
themselves, the nearest directory first.

Only texts with a key term are split: a template's key terms are its heaviest, so many that a vector without any of
them can't reach `least` with what remains. The templates are a parameter; their terms and weights are literals of the
plan. Everything else is joins and aggregates with a map-side part.

Defined results: null or empty text names nothing; a null path has no directory and inherits nothing; of equal cosines
the first licence by name counts; rows that repeat an id share the result; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, workspace

#: Usual notices of licences, as they stand in headers and licence files.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "You may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated this work to the public domain, CC0 1.0"),
    ("proprietary", "All rights reserved"),
]
FILE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"
RUN = 8  # lines
TERM = r"[a-z0-9]+(?:\.[0-9]+)*"


def plain_terms(text: str) -> Counter:
    return Counter(re.findall(TERM, text.lower()))


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


class Weights:
    """Template vectors and idf of their terms from document frequencies."""

    def __init__(self, templates: list[tuple[str, str]], docs: int, found: dict[str, int]):
        self.docs = docs
        vectors = [(name, plain_terms(text)) for name, text in templates]
        self.idf = {t: math.log((docs + 1) / (found.get(t, 0) + 1)) + 1 for _, v in vectors for t in v}
        self.norms = [math.sqrt(sum((n * self.idf[t]) ** 2 for t, n in v.items())) for _, v in vectors]
        self.postings = [(t, i, name, n * self.idf[t] / self.norms[i])
                         for i, (name, v) in enumerate(vectors) for t, n in v.items()]

    def key_terms(self, least: float) -> set[str]:
        keys: set[str] = set()
        by_template: dict[int, list[tuple[float, str]]] = {}
        for t, i, _, w in self.postings:
            by_template.setdefault(i, []).append((w, t))
        for parts in by_template.values():
            rest = 1.0
            for w, t in sorted(parts, reverse=True):
                if rest < least**2 * (1 - 1e-9):
                    break
                keys.add(t)
                rest -= w * w
        return keys


def frequencies(files: DataFrame) -> DataFrame:
    """(term, df): the number of documents that hold each term."""
    held = F.array_distinct(terms(F.coalesce("text", F.lit(""))))
    return files.select(F.explode(held).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def weigh(files: DataFrame, templates: list[tuple[str, str]], found: DataFrame) -> Weights:
    vocabulary = sorted({t for _, text in templates for t in plain_terms(text)})
    counts = found.filter(F.col("term").isin(vocabulary)).collect()  # the vocabulary at most
    return Weights(templates, files.count(), {r["term"]: r["df"] for r in counts})


def parts(text: Column) -> Column:
    """The whole text, sentences within lines, sentences over lines of one paragraph, and runs of lines."""
    lines = F.filter(F.split(text, r"\n"), lambda x: F.trim(x) != "")
    runs = F.flatten(F.transform(F.sequence(F.lit(2), F.lit(RUN)), lambda k: F.when(F.size(lines) >= k, F.transform(
        F.sequence(F.lit(1), F.size(lines) - k + 1), lambda i: F.array_join(F.slice(lines, i, k), " ")))
        .otherwise(F.array().cast("array<string>"))))
    wrapped = F.filter(F.split(text, r"\n[\x20\t\r]*\n|(?<=[.!?;])\s+"), lambda x: F.contains(x, F.lit("\n")))
    return F.concat(F.array(text), F.split(text, r"\n|(?<=[.!?;])\s+"),
                    F.when(F.contains(text, F.lit("\n")), F.concat(wrapped, runs))
                    .otherwise(F.array().cast("array<string>")))


def cosines(files: DataFrame, weights: Weights, found: DataFrame, least: float, folder: str) -> DataFrame:
    """(id, part, license, cosine) of sentences (part from 0) and whole texts (part -1) near a template."""
    spark = files.sparkSession
    keys = "|".join(re.escape(t) for t in sorted(weights.key_terms(least)))
    likely = files.select("id", "text").filter(F.lower("text").rlike(rf"(?<![a-z0-9])(?:{keys})(?![a-z0-9])"))
    part = F.posexplode(parts(F.col("text"))).alias("part", "said")
    rows = likely.withColumn("row", F.monotonically_increasing_id()).select("row", "id", part)
    said = settle(rows.select("row", "id", (F.col("part") - 1).alias("part"), terms(F.col("said")).alias("terms"))
                  .filter(F.arrays_overlap("terms", F.array(*(F.lit(t) for t in sorted(weights.key_terms(least)))))),
                  folder, "parts")
    counted = said.select("row", "id", "part", F.explode("terms").alias("term")).groupBy(
        "row", "id", "part", "term").agg(F.count("*").alias("tf"))
    idf = F.log(F.lit(weights.docs + 1.0) / (F.col("df") + 1)) + 1
    weighed = settle(counted.join(found, "term").select("row", "id", "part", "term", (F.col("tf") * idf).alias("w")),
                     folder, "weighed")
    norm = weighed.groupBy("row", "part").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    postings = spark.createDataFrame(weights.postings, "term string, template int, license string, weight double")
    dots = weighed.join(postings, "term").groupBy("row", "id", "part", "template", "license").agg(
        F.sum(F.col("w") * F.col("weight")).alias("dot"))
    near = dots.join(norm, ["row", "part"]).withColumn("cosine", F.least(F.lit(1.0), F.col("dot") / F.col("norm")))
    return near.filter(F.col("cosine") >= least).select("id", "part", "license", "cosine")


def directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan(files: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = 0.8) -> DataFrame:
    """files: id, path, text. id, path, license, cosine, origin (header, file, inherited or null), declared_by.

    `licenses` lists all licences that the file itself names.
    """
    folder = workspace(files.sparkSession)
    found = settle(frequencies(files), folder, "frequencies")
    weights = weigh(files, templates or TEMPLATES, found)
    near = settle(cosines(files, weights, found, least, folder), folder, "near")
    own = near.groupBy("id").agg(
        F.min_by("license", F.struct(-F.col("cosine"), "license")).alias("own"), F.max("cosine").alias("own_cosine"),
        (F.min("part") < 0).alias("whole"), F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"))
    named = settle(files.select("id", "path").join(own, "id", "left").withColumn(
        "is_file", F.col("own").isNotNull() & (F.coalesce("whole", F.lit(False))
                                               | F.coalesce(F.col("path").rlike(FILE_NAMES), F.lit(False)))),
        folder, "named")
    rules = named.filter("is_file and path is not null").groupBy(directory(F.col("path")).alias("dir")).agg(
        F.min(F.struct((-F.col("own_cosine")).alias("far"), "own", "path")).alias("rule"))
    # Each directory once, with all directories above it; depth bounds the rows.
    steps = F.split("at", "/")
    above = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(
        F.slice(steps, 1, n), "/")))
    places = named.filter("path is not null").select(directory(F.col("path")).alias("at")).distinct()
    ruled = places.select("at", F.explode(F.array_distinct(above)).alias("dir")).join(rules, "dir").groupBy("at").agg(
        F.max_by("rule", F.length("dir")).alias("rule"))
    full = named.join(ruled, directory(F.col("path")) == F.col("at"), "left")
    mine = F.col("own").isNotNull()
    return full.select(
        "id", "path", F.when(mine, F.col("own")).otherwise(F.col("rule.own")).alias("license"),
        F.when(mine, F.col("own_cosine")).otherwise(-F.col("rule.far")).alias("cosine"),
        F.when(F.col("is_file"), "file").when(mine, "header").when(F.col("rule").isNotNull(), "inherited").alias("origin"),
        F.when(mine, F.col("path")).otherwise(F.col("rule.path")).alias("declared_by"), "licenses")
