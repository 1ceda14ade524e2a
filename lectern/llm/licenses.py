"""Licence scan: TF-IDF cosine of headers and licence files to templates, then inheritance by directory.

Everything is DataFrame functions.  A template of L words is compared with
every run of L consecutive words of a file's whole text, over line ends (a
text of fewer words is one run), as sparse vectors of term counts times
inverse document frequency, counted over all files for every term.  So a
notice is found wherever it stands, wrapped, after a comment sign or inside a
sentence, and nothing outside of it weighs.  Only runs that hold an anchor are
looked at: anchors are the heaviest terms of a template, as many as it takes
that a run without them can't reach the threshold (Cauchy-Schwarz), so none is
lost.  Each run belongs to its first anchor, which brings at most 2 L - 1 words
with it whatever the length of the text.

A file's own licence is its best run's.  A file without one inherits from the
nearest directory above it that has a licence file with a licence, through
joins of directory paths; each distinct directory is resolved once.

Defined cases: a null or empty text has no licence of its own, nor has a file
whose id is null; a null path inherits nothing; equal scores go to the first
licence by name; repeated rows are rows; of several licence files in a
directory the best score counts; a very long text is read whole, and costs in
proportion to its words.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import Scratch

THRESHOLD = 0.7
WORD = "[a-z0-9]+"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)([.-][^/]*)?$"

# Short public notices by SPDX name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
]


def words(text: F.Column) -> F.Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def template_terms(templates: list[tuple[str, str]]) -> list[Counter]:
    """Term counts of each template (the same words as :func:`words`)."""
    import re

    return [Counter(re.findall(WORD, text.lower())) for _, text in templates]


def vocabulary(files: DataFrame) -> DataFrame:
    """(term, df): how many files hold each term; the empty term stands for the files themselves."""
    held = F.array_append(F.array_distinct(words(F.coalesce("text", F.lit("")))), F.lit(""))
    return files.select(F.explode(held).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def anchors(vector: dict[str, float], threshold: float) -> list[str]:
    """The heaviest terms, such that the others alone stay under the threshold."""
    norm = sum(w * w for w in vector.values())
    out, rest = [], norm
    for term in sorted(vector, key=lambda t: (-vector[t], t)):
        if rest < threshold * threshold * norm * 0.999:
            break
        out.append(term)
        rest -= vector[term] ** 2
    return out


def _total(items, value) -> F.Column:
    return F.aggregate(items, F.lit(0.0), lambda total, x: total + value(x))


def anchored(files: DataFrame, shapes: DataFrame, anchors_: list[str], longest: int, threshold: float) -> DataFrame:
    """(file, template, at, print, length, last, part): the words under all runs whose first anchor is at ``at``.

    The runs start at the words 0 to ``last`` of ``part``; parts that hold too
    little of the template's weight for any run are left out.
    """
    def around(w):
        at = F.filter(F.transform(w, lambda x, i: F.when(x.isin(anchors_), i)), lambda i: i.isNotNull())
        return F.transform(at, lambda i: F.struct(
            i.alias("at"), F.size(w).alias("n"), F.least(i, F.lit(longest - 1)).alias("c"),
            F.slice(w, F.greatest(i - longest + 1, F.lit(0)) + 1, F.least(i, F.lit(longest - 1)) + longest).alias("near")))

    held = files.where(F.col("file").isNotNull() & F.lower("text").rlike(rf"(?<![a-z0-9])(?:{'|'.join(anchors_)})(?![a-z0-9])"))
    # the outer transform binds the words, so they are taken once a text
    near = held.select("file", F.explode(F.flatten(F.transform(F.array(words(F.col("text"))), around))).alias("a"))
    near = near.select("file", "a.at", "a.n", "a.c", "a.near", F.get(F.col("a.near"), F.col("a.c")).alias("anchor"))
    near = near.join(shapes.withColumn("anchor", F.explode("anchors")), "anchor")
    first = F.greatest(F.col("c") - F.col("length") + 1, F.lit(0))
    before = F.slice("near", F.col("first") + 1, F.col("c") - F.col("first"))
    earlier = F.array_max(F.transform(before, lambda x, i: F.when(F.array_contains("anchors", x), i + 1)))
    end = F.least(F.col("c"), F.greatest(F.col("n") - F.col("length"), F.lit(0)) - (F.col("at") - F.col("c")))
    spans = (near.withColumn("first", first).withColumn("first", F.col("first") + F.coalesce(earlier, F.lit(0))).withColumn("end", end)
             .where(F.col("first") <= F.col("end"))
             .withColumn("part", F.slice("near", F.col("first") + 1, F.col("end") + F.col("length") - F.col("first"))))
    covered = _total("weights", lambda e: F.when(F.array_contains("part", e["term"]), e["weight"] * e["weight"]).otherwise(0.0))
    return (spans.where(covered >= threshold * threshold * 0.999)
            .select("file", "template", "at", F.xxhash64("part").alias("print"), "length", (F.col("end") - F.col("first")).alias("last"), "part").distinct())


def best_cosine(threshold: float) -> F.Column:
    """The best cosine of a run of ``length`` words of ``part`` (null under the threshold); ``idfs``, ``weights``: maps by term."""
    terms = F.transform("part", lambda x: F.struct(x.alias("t"), F.element_at("idfs", x).alias("i"),
                                                   F.coalesce(F.element_at("weights", x), F.lit(0.0)).alias("w")))

    def cosine(run):
        dot = _total(run, lambda x: x["i"] * x["w"])
        least = _total(run, lambda x: x["i"] * x["i"])  # the squared norm, if no word came twice
        norm = _total(run, lambda x: x["i"] * x["i"] * F.size(F.filter(run, lambda y: y["t"] == x["t"])))
        return F.when(dot >= threshold * 0.999 * F.sqrt(least), dot / F.sqrt(norm))

    runs = lambda v: F.transform(F.sequence(F.lit(0), F.col("last")), lambda s: F.slice(v, s + 1, F.col("length")))
    return F.array_max(F.flatten(F.transform(F.array(terms), lambda v: F.transform(runs(v), cosine))))


def own_licences(files: DataFrame, templates: list[tuple[str, str]], threshold: float, scratch: Scratch) -> DataFrame:
    """(file, licence, score) of the files (file, text) with a run of words like a template."""
    spark = files.sparkSession
    counted = template_terms(templates)
    terms = sorted(set().union(*counted))
    df = scratch.keep(vocabulary(files), "vocabulary")
    found = {r["term"]: r["df"] for r in df.where(F.col("term").isin([*terms, ""])).collect()}  # a row per template term
    n = found.get("", 0)
    vectors = [{t: c * math.log(1 + (1 + n) / (1 + found.get(t, 0))) for t, c in terms_.items()} for terms_ in counted]
    rows = []
    for k, v in enumerate(vectors):
        norm = math.sqrt(sum(x * x for x in v.values()))
        rows.append((k, templates[k][0], sum(counted[k].values()), anchors(v, threshold), [(t, x / norm) for t, x in v.items()]))
    shapes = spark.createDataFrame(rows, "template int, licence string, length int, anchors array<string>, weights array<struct<term string, weight double>>")
    every = sorted(set().union(*(r[3] for r in rows)))
    parts = scratch.keep(anchored(files, shapes, every, max(r[2] for r in rows), threshold), "parts")
    key = ["file", "template", "at", "print"]
    said = parts.select(*key, F.explode(F.array_distinct("part")).alias("term"))
    # only the terms of parts are wanted: small as a rule, so that the planner broadcasts them
    known = df.join(said.select("term").distinct(), "term").select("term", F.log(1 + F.lit(1.0 + n) / (1 + F.col("df"))).alias("idf"))
    idfs = said.join(known, "term").groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("term", "idf"))).alias("idfs"))
    told = parts.join(idfs, key).join(shapes.select("template", "licence", F.map_from_entries("weights").alias("weights")), "template")
    scored = told.select("file", "licence", F.round(best_cosine(threshold), 6).alias("score")).where(F.col("score") >= threshold)
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("licence").alias("l"))).alias("b")
    return scored.groupBy("file").agg(best).select("file", F.col("b.l").alias("licence"), (-F.col("b.s")).alias("score"))


def inherited(files: DataFrame) -> DataFrame:
    """(directory, inherited, from_directory) of the directories with a licence at or above them; ``files``: path, licence, score."""
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    placed = files.where("path is not null").select("path", "licence", "score", directory.alias("directory"))
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("licence").alias("l"))).alias("b")
    declared = placed.where(F.col("licence").isNotNull() & F.col("path").rlike(LICENCE_FILE)).groupBy("directory").agg(best)
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("above")))
    # depth 0 is the top, "", which is also the one step of a path without directories
    steps = placed.select("directory").distinct().select("directory", F.explode(F.array_distinct(above)).alias("a")).select("directory", "a.depth", "a.above")
    found = steps.join(declared.select(F.col("directory").alias("above"), F.col("b.l").alias("licence")), "above")
    return (found.groupBy("directory").agg(F.max(F.struct("depth", "licence", "above")).alias("n"))
            .select("directory", F.col("n.licence").alias("inherited"), F.col("n.above").alias("from_directory")))


def scan(files: DataFrame, id_col: str, path_col: str, text_col: str, *, templates: list[tuple[str, str]] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per row: file, path, own (licence), score, inherited, from_directory and licence (own, else inherited).

    Rows are told apart by their id; rows that share one share the best run of words.
    """
    scratch = Scratch(files.sparkSession, "licences")
    narrow = files.select(F.col(id_col).alias("file"), F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    own = scratch.keep(own_licences(narrow, TEMPLATES if templates is None else templates, threshold, scratch), "own")
    placed = scratch.keep(narrow.select("file", "path").join(own, "file", "left"), "files")
    from_above = inherited(placed)
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    return (placed.withColumn("directory", directory).join(from_above, "directory", "left")
            .select("file", "path", F.col("licence").alias("own"), "score",
                    F.when(F.col("licence").isNull(), F.col("inherited")).alias("inherited"),
                    F.when(F.col("licence").isNull(), F.col("from_directory")).alias("from_directory"),
                    F.coalesce("licence", "inherited").alias("licence")))


def file_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as a tree of files: <thousands>/<hundreds>/<source>/<id>.txt.

    Every tenth document is a licence file of its hundred's directory, and
    every hundredth one of its thousand's.
    """
    id_ = F.col("doc_id")
    thousand, hundred = F.floor(id_ / 1000).cast("string"), F.floor(id_ / 100).cast("string")
    licence = F.concat(F.lit("LICENSE."), id_.cast("string"))
    path = (F.when(id_ % 100 == 0, F.concat_ws("/", thousand, licence))
            .when(id_ % 10 == 0, F.concat_ws("/", thousand, hundred, licence))
            .otherwise(F.concat_ws("/", thousand, hundred, F.coalesce("source", F.lit("none")), F.concat(id_.cast("string"), F.lit(".txt")))))
    return docs.select("doc_id", F.when(id_.isNotNull(), path).alias("path"), "text")
