"""License scan: TF-IDF cosine of licence passages to templates, then inheritance down the directories.

Passages are the lines of a text, wherever they stand, that hold a cue of a licence notice; its headers,
runs of lines with a cue or legal wording that have at most `GAP` other lines between them; and the whole
text of a licence file. Templates are one-sentence notices, and the titles, standard headers and whole
texts in the folder `licences`. Equal passages are scored once, however many files hold them. Terms are
weighted by tf * idf, with document frequencies over the single lines and licence files of all files and
the templates (a header repeats its lines, so it is not counted again); the sparse product joins passage
terms to template terms (a table of fixed size) and sums. The best template above `least` is the passage's licence; the best passage is the
file's. A file without one takes the licence of the nearest directory upwards whose licence file has
one: each distinct directory is joined by path to its ancestors, then files to their directory.

Defined results: a null text counts as empty; a null path has no directory and inherits nothing; ties
go to the higher score, then the smaller licence name, then the smaller path. Repeated rows get equal
results. An empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from importlib.resources import files as files_of

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlflow.llm.shared import bind, pinned, rows_of, text_of

# Cues of a notice, names of licence files, and notices of common licences.
CUE = r"(?i)licen[sc]|copyright|spdx|copyleft|public domain|all rights reserved|redistribut|permission is"
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)([.\-_][^/]*)?$"
#: Wording that holds a header together, and lines that name a holder of rights and tell no licence.
LEGAL = (
    r"(?i)warrant|merchantab|particular purpose|noninfringement|in no event|liabl|liabilit|damages|as is|"
    r"distributed|at your option|following conditions|free software|source code form|hereby granted|mozilla"
)
HOLDER = r"(?i)(copyright|\(c\)|©)\W*((\(c\)|©|copyright)\W*)*\d{4}"
GAP = 3
NOTICES = {
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT license",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Released under the Apache License 2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "Released under the GNU GPL version 3",
        "SPDX-License-Identifier: GPL-3.0",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "Released under the GNU GPL version 2",
        "SPDX-License-Identifier: GPL-2.0",
    ),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0"),
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0"),
    "MPL-2.0": ("Subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "Licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0-1.0": ("Released into the public domain under CC0 1.0", "Creative Commons CC0 1.0 Universal"),
}


def _stored() -> list[tuple[str, str]]:
    """Licence and text of the files of `licences`, named <licence>.<title, header or text>.txt."""
    stored = sorted((f for f in files_of("crawlflow.llm").joinpath("licences").iterdir()), key=lambda f: f.name)
    return [(re.sub(r"\.(title|header|text)\d*\.txt$", "", f.name), f.read_text("utf-8")) for f in stored]


TEMPLATES = {name: list(texts) for name, texts in NOTICES.items()}
for _name, _text in _stored():
    TEMPLATES.setdefault(_name, []).append(_text)


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))


def _headers(lines: Column) -> Column:
    """Runs of at least two lines with a cue or legal wording, at most GAP other lines between two of them."""

    def joined(told: Column) -> Column:
        def strong_near(i: Column, ways: int) -> Column:
            steps = (F.coalesce(F.get(told, i + ways * k)["strong"], F.lit(False)) for k in range(1, GAP + 1))
            near = F.lit(False)
            for step in steps:
                near = near | step
            return near

        def kept(x: Column, i: Column) -> Column:
            # A form feed stands for a line of no header.
            return F.when(x["strong"] | strong_near(i, -1) & strong_near(i, 1), x["line"]).otherwise(F.lit("\f"))

        return F.split(F.array_join(F.transform(told, kept), "\n"), "(\n?\f\n?)+", -1)

    def flagged(line: Column) -> Column:
        text = F.when(line.rlike(HOLDER), "").otherwise(F.translate(line, "\f", " "))
        return F.struct(text.alias("line"), (text.rlike(CUE) | text.rlike(LEGAL)).alias("strong"))

    runs = F.transform(bind(F.transform(lines, flagged), joined), lambda run: F.trim(run))
    return F.filter(runs, lambda run: run.contains("\n") & run.rlike(CUE))


def _passages(text: Column, is_file: Column) -> Column:
    """Structs (passage, header)."""
    lines = F.transform(F.split(text, "\n", -1), lambda line: F.trim(line))
    cued = F.filter(lines, lambda line: line.rlike(CUE))
    own = F.array_distinct(F.when(is_file & (F.trim(text) != ""), F.array_append(cued, F.trim(text))).otherwise(cued))
    headers = F.when(text.rlike(CUE), F.array_except(_headers(lines), own)).otherwise(F.array().cast("array<string>"))
    named = lambda of, header: F.transform(of, lambda x: F.struct(x.alias("passage"), F.lit(header).alias("header")))
    return F.concat(named(own, False), named(headers, True))


def _weights(counted: DataFrame, idf: DataFrame, key: str, unseen: float) -> DataFrame:
    """key, term and the weight scaled to a unit vector, from key, term, tf; `unseen`: idf of terms without one."""
    weighted = counted.join(idf, "term", "left").select(key, "term", (F.col("tf") * F.coalesce("idf", F.lit(unseen))).alias("w"))
    norms = weighted.groupBy(key).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norms, key).select(key, "term", (F.col("w") / F.col("norm")).alias("w"))


def scored_passages(spark: SparkSession, found: DataFrame, least: float) -> DataFrame:
    """pid, license, score of the distinct passages in `found` (pid, passage, n) that resemble a template.

    `n` is how often a passage counts in the document frequencies, 0 for what is a header only.
    Terms carry the digest of their passage: a whole licence file may be one passage, and its text
    beside each of its terms would grow with the square of its length.
    """
    rows = [
        {"template": f"{name}#{i}", "license": name, "text": text}
        for name, texts in TEMPLATES.items()
        for i, text in enumerate(texts)
    ]
    templates = rows_of(spark, rows, "template string, license string, text string")
    terms_of = lambda df, key, *more: (
        df.select(key, *more, F.explode(_terms(F.col("text"))).alias("term")).groupBy(key, *more, "term").agg(F.count("*").alias("tf"))
    )
    of_passages = pinned(terms_of(found.select("pid", "n", F.col("passage").alias("text")), "pid", "n"))
    of_templates = pinned(terms_of(templates, "template"))
    total = (found.agg(F.sum("n")).first()[0] or 0) + len(rows)
    seen = of_passages.filter("n > 0").select("term", "n").unionByName(of_templates.select("term", F.lit(1).cast("long").alias("n")))
    idf = pinned(
        seen.groupBy("term").agg((F.log((1 + F.lit(total)) / (1 + F.sum("n"))) + 1).alias("idf"))
    )
    unseen = math.log(1 + total) + 1
    right = _weights(of_templates, idf, "template", unseen).select("template", "term", F.col("w").alias("v"))
    products = _weights(of_passages, idf, "pid", unseen).join(F.broadcast(right), "term")
    cosine = products.groupBy("pid", "template").agg(F.round(F.sum(F.col("w") * F.col("v")), 6).alias("score"))
    named = cosine.withColumn("license", F.substring_index("template", "#", 1)).filter(F.col("score") >= least)
    best = named.groupBy("pid").agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("b"))
    return pinned(best.select("pid", F.col("b.license").alias("license"), (-F.col("b.minus")).alias("score")))


def directory(path: Column) -> Column:
    """The folder of a path; null at the top."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", ""))


def scan(files: DataFrame, least: float = 0.7) -> DataFrame:
    """id, path, license, score, origin (own, inherited, none) and from_path of files (id, path, text)."""
    spark = files.sparkSession
    text = text_of(F.col("text"))
    is_file = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    passages = pinned(
        files.select("id", "path", is_file.alias("is_file"), F.explode(_passages(text, is_file)).alias("p"))
        .select("id", "path", "is_file", "p.*")
        .withColumn("pid", F.sha2("passage", 256))
    )
    found = passages.groupBy("pid").agg(F.min("passage").alias("passage"), F.count_if(~F.col("header")).alias("n"))
    hits = passages.drop("passage", "header").join(scored_passages(spark, found, least), "pid")
    own = pinned(
        hits.groupBy(F.col("id").alias("of_id"), F.col("path").alias("of_path"), "is_file")
        .agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("b"))
        .select("of_id", "of_path", "is_file", F.col("b.license").alias("license"), (-F.col("b.minus")).alias("score"))
    )
    granting = (
        own.filter("is_file and of_path is not null")
        .groupBy(F.coalesce(directory(F.col("of_path")), F.lit("")).alias("dir"))
        .agg(F.min(F.struct((-F.col("score")).alias("minus"), "license", "of_path")).alias("g"))
    )
    granting = pinned(granting)
    folders = files.filter("path is not null").select(F.coalesce(directory(F.col("path")), F.lit("")).alias("folder")).distinct()
    parts = F.split("folder", "/", -1)
    upward = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    nearest = pinned(
        folders.select("folder", F.explode(F.array_distinct(upward)).alias("dir"))
        .join(granting, "dir")
        .groupBy("folder")
        .agg(F.max(F.struct(F.length("dir").alias("near"), "g")).alias("m"))
        .select("folder", F.col("m.g.license").alias("up_license"), (-F.col("m.g.minus")).alias("up_score"), F.col("m.g.of_path").alias("up_path"))
    )
    narrow = files.select("id", "path", F.coalesce(directory(F.col("path")), F.lit("")).alias("in_folder"))
    with_own = narrow.join(
        own.drop("is_file"), F.col("id").eqNullSafe(F.col("of_id")) & F.col("path").eqNullSafe(F.col("of_path")), "left"
    )
    joined = with_own.join(nearest, (F.col("in_folder") == F.col("folder")) & F.col("path").isNotNull(), "left")
    mine, above = F.col("license").isNotNull(), F.col("up_license").isNotNull()
    return joined.select(
        "id",
        "path",
        F.coalesce("license", "up_license").alias("license"),
        F.when(mine, F.col("score")).otherwise(F.col("up_score")).alias("score"),
        F.when(mine, "own").when(above, "inherited").otherwise("none").alias("origin"),
        F.when(mine, F.col("path")).otherwise(F.col("up_path")).alias("from_path"),
    )
