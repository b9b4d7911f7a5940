"""Licence detection by sparse TF-IDF cosine, in native expressions only.

Files are compared with licence templates (whole licence texts and the notices that stand
in file headers) as sparse vectors of terms: every line, every run of terms as long as a
template, and the whole file. A line or run similar to a template is a header, so a notice
may be wrapped, set in comment signs or part of a longer line. A file that is similar as a
whole to a licence text, or to a notice if it has the name of a licence file, is a licence
file and speaks for its directory. Files without a header inherit from the licence file of the nearest ancestor directory: their ancestor
paths are joined with the directories that have one, and the longest match wins.

The templates are few and fixed by the caller, so their term weights are broadcast. A text
can only reach the threshold if the template's terms it has make up enough of the
template's weight (Cauchy-Schwarz), so all other files and runs are passed over exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemill.operators.joins import own_exchange
from tablemill.session import staged
from tablemill.spec import col

SIMILAR = 0.8
# Templates of fewer terms are notices. Runs as long as a notice begin at every term; for
# longer templates at the first and last of the starts that hold most of its weight, in
# every stretch of the text that holds enough of it.
NOTICE = 80
# Names of licence files, before an ending.
FILE_NAMES = ("copying", "copyright", "licence", "license", "notice", "unlicense")
# A bare reservation of rights names no licence: it counts where nothing else does.
BARE = "Proprietary"
_FREE = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
    "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version"
)
_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
_CC = "This work is licensed under a Creative Commons {} 4.0 International License"
# Public licence notices and their SPDX identifiers.
NOTICES = {
    "AGPL-3.0": (_FREE.format(what="program", name=_AGPL, version="3"),),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0",),
    # The sentence is the same in the licences of two and of three clauses.
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted",),
    "BSD-3-Clause": ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",),
    "CC-BY-4.0": (_CC.format("Attribution"), "Licensed under CC BY 4.0"),
    "CC-BY-NC-4.0": (_CC.format("Attribution-NonCommercial"), "Licensed under CC BY-NC 4.0"),
    "CC-BY-SA-4.0": (_CC.format("Attribution-ShareAlike"), "Licensed under CC BY-SA 4.0"),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        *(_FREE.format(what=w, name=_GPL, version="2") for w in ("program", "file")),
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        *(_FREE.format(what=w, name=_GPL, version="3") for w in ("program", "file")),
    ),
    "LGPL-2.0": (_FREE.format(what="library", name="Library General Public License", version="2"),),
    "LGPL-2.1": (
        "Licensed under the GNU Lesser General Public License, version 2.1",
        _FREE.format(what="library", name=_LGPL, version="2.1"),
    ),
    "LGPL-3.0": (
        "Licensed under the GNU Lesser General Public License, version 3",
        _FREE.format(what="library", name=_LGPL, version="3"),
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    BARE: ("All rights reserved",),
}
# Fixed value: section 13 of the AGPL, where it differs most from the GPL.
AFFERO_13 = """13. Remote Network Interaction; Use with the GNU General Public License.

Notwithstanding any other provision of this License, if you modify the Program, your modified version must
prominently offer all users interacting with it remotely through a computer network (if your version supports such
interaction) an opportunity to receive the Corresponding Source of your version by providing access to the
Corresponding Source from a network server at no charge, through some standard or customary means of facilitating
copying of software. This Corresponding Source shall include the Corresponding Source for any work covered by
version 3 of the GNU General Public License that is incorporated pursuant to the following paragraph.

Notwithstanding any other provision of this License, you have permission to link or combine any covered work with a
work licensed under version 3 of the GNU General Public License into a single combined work, and to convey the
resulting work. The terms of this License will continue to apply to the part which is the covered work, but the work
with which it is combined will remain governed by version 3 of the GNU General Public License.

"""
TEXTS = Path(__file__).parent / "license_texts"


def affero(gpl: str) -> str:
    """The GPL text under the name of the AGPL and with its section 13. The preambles differ
    in two more paragraphs, which are not at hand."""
    def renamed(text: str) -> str:
        return text.replace("GNU General", "GNU Affero General").replace("GNU GENERAL", "GNU AFFERO GENERAL")

    before, rest = gpl.split("13. Use with", 1)
    return renamed(before) + AFFERO_13 + "14. Revised" + renamed(rest.split("14. Revised", 1)[1])


def _public_templates() -> dict[str, tuple[str, ...]]:
    """Notices and whole texts per licence; the files are read by the driver alone."""
    texts = {p.stem: (p.read_text(),) for p in sorted(TEXTS.glob("*.txt"))}
    texts["AGPL-3.0"] = (affero(texts["GPL-3.0"][0]),)
    return {name: NOTICES.get(name, ()) + texts.get(name, ()) for name in sorted({*NOTICES, *texts})}


TEMPLATES = _public_templates()

SPLIT = r"[^\p{L}\p{N}.]+"


def terms(text: Column) -> Column:
    """Lower-case runs of letters, digits and inner dots."""
    parts = F.transform(F.split(F.lower(text), SPLIT, -1), lambda t: F.regexp_replace(t, r"^\.+|\.+$", ""))
    return F.filter(parts, lambda t: t != "")


def template_table(spark, templates: dict[str, str | Sequence[str]]) -> DataFrame:
    """``template`` (a number), ``license``, ``term``, ``tf`` of the templates."""
    each = [(name, t) for name, texts in sorted(templates.items()) for t in ([texts] if isinstance(texts, str) else texts)]
    rows = spark.createDataFrame([(i, *x) for i, x in enumerate(each)], "template int, license string, text string")
    return (
        rows.select("template", "license", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    )


def term_weights(known: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """Inverse document frequency of the templates' terms over all files (rows ``known``,
    the terms of the vocabulary a file has), and that of a term that is in no template
    (counted as if one file had it)."""
    counted = known.select(F.explode(F.concat(F.array(F.lit("")), "known")).alias("term")).groupBy("term").count().collect()
    found = {r["term"]: r["count"] for r in counted}
    n = found.get("", 0)
    idf = {t: math.log((1 + n) / (1 + found.get(t, 0))) + 1 for t in vocabulary}
    return idf, math.log((1 + n) / 2) + 1


def needed_terms(weights: dict[int, dict[str, float]], idf: dict[str, float], similar: float) -> list[tuple[int, str, float, float]]:
    """``template``, ``term``, ``share``, ``need``: a text of that cosine to the template
    has listed terms whose shares sum up to ``need``. The most frequent terms are not
    listed but counted as if every text had them."""
    rows = []
    for template, vector in weights.items():
        total = sum(w * w for w in vector.values())
        free, listed = 0.0, []
        for term, w in sorted(vector.items(), key=lambda x: (idf[x[0]], x[0])):
            share = w * w / total
            if not listed and free + share <= similar * similar / 2:
                free += share
            else:
                listed.append((template, term, share))
        rows.extend((*x, similar * similar - free - 1e-6) for x in listed)
    return rows


def best_templates(
    texts: DataFrame, weights: dict[int, dict[str, float]], names: dict[int, str], notices: set[int], unknown: float,
    idf: dict[str, float], similar: float,
) -> DataFrame:
    """``key``, ``notice``, ``license``, ``cosine`` of rows ``key``, ``t`` (terms) that reach
    the threshold: the most similar notice and the most similar whole text, ties by name,
    a bare reservation last."""
    spark = texts.sparkSession
    entries = [
        (template, names[template], template in notices, term, w / math.sqrt(sum(x * x for x in vector.values())))
        for template, vector in sorted(weights.items()) for term, w in sorted(vector.items())
    ]
    table = spark.createDataFrame(entries, "template int, license string, notice boolean, term string, w double")
    frequency = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    counted = texts.select("key", F.explode("t").alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))
    # Both tables are as small as the templates.
    weighed = counted.join(F.broadcast(frequency), "term", "left").select(
        "key", "term", (F.col("tf") * F.coalesce("idf", F.lit(unknown))).alias("x")
    )
    norms = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = (
        weighed.join(F.broadcast(table), "term").groupBy("key", "template", "license", "notice")
        .agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    )
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    return (
        dots.join(norms, "key").select("key", "notice", "license", cosine.alias("cosine")).where(F.col("cosine") >= similar)
        .groupBy("key", "notice").agg(_best()).select("key", "notice", "best.license", (-F.col("best.c")).alias("cosine"))
    )


def _best(*before: str) -> Column:
    order = [*before, (F.col("license") == BARE).alias("bare"), (-F.col("cosine")).alias("c"), "license"]
    return F.min(F.struct(*order)).alias("best")


def similar_runs(texts: DataFrame, candidates: DataFrame, needed: DataFrame) -> DataFrame:
    """``key``, ``start``, ``n``: runs as long as a template that have enough of its weight.

    Of ``texts`` (``key``, ``t``) only files that have enough of it somewhere come in here
    (``candidates``: ``key``, ``template``, ``n``, ``notice``), each for its templates. A
    term counts once in a run: the runs in which an occurrence is the first of its term
    begin behind the occurrence before. So each adds its share to one range of starts, and a
    running sum over the ends of these ranges gives the share of every start. All steps
    work within one file and template.
    """
    one = ["key", "template"]
    placed = (
        texts.select("key", F.posexplode("t").alias("pos", "term")).join(F.broadcast(needed), "term")
        .join(own_exchange(candidates), one)
    )
    before = F.lag("pos", 1, -1).over(Window.partitionBy(*one, "term").orderBy("pos"))
    first = F.greatest(F.col("before") + 1, F.col("pos") - F.col("n") + 1)
    ends = F.array(
        F.struct(first.alias("start"), F.col("share").alias("d")),
        F.struct((F.col("pos") + 1).alias("start"), (-F.col("share")).alias("d")),
    )
    running = Window.partitionBy(*one).orderBy("start")
    shares = (
        placed.withColumn("before", before).select(*one, "n", "notice", "need", F.explode(ends).alias("e"))
        .groupBy(*one, "n", "notice", "need", "e.start").agg(F.sum("e.d").alias("d"))
        .withColumn("share", F.sum("d").over(running)).withColumn("last", F.lead("start").over(running) - 1)
        .where("share >= need")
    )
    every = shares.where("notice").select("key", "n", F.explode(F.sequence("start", "last")).alias("start"))
    long = shares.where("not notice").withColumn("new", (F.lag("last").over(running) + 1 != F.col("start")).cast("int"))
    # Sums of the same shares in another order differ in their last digits.
    held = F.round("share", 9)
    best = (
        long.withColumn("stretch", F.sum(F.coalesce("new", F.lit(0))).over(running))
        .groupBy(*one, "n", "stretch")
        .agg(F.min(F.struct(-held, "start")).alias("a"), F.max(F.struct(held, "last")).alias("b"))
        .select("key", "n", F.explode(F.array("a.start", "b.last")).alias("start"))
    )
    return every.unionByName(best).select("key", "start", "n").distinct()


def scan_licenses(
    files: DataFrame,
    id_column: str = "doc_id",
    path_column: str = "path",
    text_column: str = "text",
    templates: dict[str, str | Sequence[str]] | None = None,
    similar: float = SIMILAR,
) -> DataFrame:
    """Per file row: id, ``license``, ``cosine``, ``origin`` (``header``, ``file``,
    ``inherited`` or null) and ``source_dir`` of an inherited licence.

    A licence file takes its own licence: a file similar as a whole to a template that is
    no notice (``NOTICE``), or to any if its name is one of ``FILE_NAMES``. Of several in a directory the most similar
    counts, then the first by name. Of several headers
    whole licence texts come before notices, then the most similar counts; a bare
    reservation of rights only counts where nothing else is found. A null text is empty,
    a null path has no ancestors. Rows that repeat id and text have equal results each.
    Other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    path = F.rtrim(F.coalesce(col(path_column), F.lit("")), F.lit("/"))
    rows = files.select(
        col(id_column).alias("id"), path.alias("path"), col(text_column).alias("text"),
        F.xxhash64(col(id_column), col(path_column), col(text_column)).alias("key"),
    )
    # Everything before the last slash; the top directory is the empty path.
    directory = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", ""))
    if not templates:
        return rows.select(F.col("id").alias(id_column), *_nothing())
    spark = files.sparkSession
    table = template_table(spark, templates).collect()
    vocabulary = sorted({r["term"] for r in table})
    if not vocabulary:
        return rows.select(F.col("id").alias(id_column), *_nothing())
    # No term has a blank.
    vocabulary_array = F.split(F.lit(" ".join(vocabulary)), " ")
    known = staged(
        rows.select("key", F.array_intersect(terms(F.coalesce("text", F.lit(""))), vocabulary_array).alias("known")), "known"
    )
    idf, unknown = term_weights(known, vocabulary)
    weights: dict[int, dict[str, float]] = {}
    names: dict[int, str] = {}
    lengths: dict[int, int] = {}
    for r in table:
        weights.setdefault(r["template"], {})[r["term"]] = r["tf"] * idf[r["term"]]
        names[r["template"]] = r["license"]
        lengths[r["template"]] = lengths.get(r["template"], 0) + r["tf"]
    # As small as the templates, as are their lengths.
    needed = spark.createDataFrame(
        needed_terms(weights, idf, similar), "template int, term string, share double, need double"
    )
    notices = {i for i, n in lengths.items() if n < NOTICE}
    sizes = spark.createDataFrame(
        [(i, n, i in notices) for i, n in sorted(lengths.items())], "template int, n int, notice boolean"
    )
    candidates = staged(
        known.select("key", F.explode("known").alias("term")).join(F.broadcast(needed), "term")
        .groupBy("key", "template", "need").agg(F.sum("share").alias("share")).where("share >= need")
        .join(F.broadcast(sizes), "template").select("key", "template", "n", "notice"),
        "candidates",
    )
    named = F.regexp_extract(F.lower(F.regexp_extract("path", r"[^/]*$", 0)), r"^[a-z]+", 0).isin(*FILE_NAMES)
    by_line = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: terms(x))
    texts = staged(
        rows.join(own_exchange(candidates.select("key").distinct()), "key", "left_semi").dropDuplicates(["key"])
        .select("key", named.alias("named"), by_line.alias("lines")),
        "candidate_texts",
    )
    whole = texts.select("key", F.flatten("lines").alias("t"))
    # Lines and runs of equal terms have equal results: a notice that a third of all files
    # carry is compared once.
    lines = texts.select("key", F.explode("lines").alias("t")).where(F.size("t") > 0)
    lines = staged(lines.select("key", F.xxhash64("t").alias("piece"), "t").distinct(), "notices")
    run = F.slice("t", F.col("start") + 1, F.col("n"))
    runs = staged(
        similar_runs(whole, candidates, needed).join(own_exchange(whole), "key")
        .select("key", "start", "n", F.xxhash64(run).alias("piece")),
        "runs",
    )
    run_texts = (
        runs.groupBy("piece").agg(F.min(F.struct("key", "start", "n")).alias("at")).select("piece", "at.*")
        .join(own_exchange(whole), "key").select("piece", run.alias("t"))
    )
    distinct = lines.select("piece", "t").unionByName(run_texts).groupBy("piece").agg(F.first("t").alias("t"))
    distinct = distinct.select(F.col("piece").alias("key"), "t")
    pieces = lines.select("key", "piece").unionByName(runs.select("key", "piece")).distinct()
    of_piece = best_templates(distinct, weights, names, notices, unknown, idf, similar)
    headers = (
        pieces.join(own_exchange(of_piece.withColumnRenamed("key", "piece")), "piece")
        .groupBy("key").agg(_best("notice")).select("key", "best.license", (-F.col("best.c")).alias("cosine"))
    )
    of_file = (
        best_templates(whole, weights, names, notices, unknown, idf, similar)
        .join(own_exchange(texts.select("key", "named")), "key").where("not notice or named")
    )
    found = staged(
        headers.select("key", "license", "cosine", F.lit("header").alias("origin"))
        .unionByName(of_file.select("key", "license", "cosine", F.lit("file").alias("origin")))
        .groupBy("key").agg(_best("origin"))
        .select("key", "best.license", (-F.col("best.c")).alias("cosine"), "best.origin"),
        "licences",
    )
    marked = rows.select("key", "id", directory.alias("dir")).join(own_exchange(found), "key", "left")
    speaking = (
        marked.where("origin = 'file' and dir is not null").groupBy("dir")
        .agg(_best())
        .select(F.col("dir").alias("up"), F.col("best.license").alias("inherited"))
    )
    # Directories, not files, are joined with their ancestors: one row per directory and level.
    depth = F.size(F.split("dir", "/", -1))
    up = F.transform(F.sequence(F.lit(1), depth), lambda i: F.array_join(F.slice(F.split("dir", "/", -1), F.lit(1), i), "/"))
    nearest = (
        marked.where("dir is not null").select("dir").distinct().select("dir", F.explode(up).alias("up"))
        .join(own_exchange(speaking), "up")
        .groupBy("dir").agg(F.max(F.struct(F.length("up").alias("n"), "up", "inherited")).alias("near"))
        .select("dir", F.col("near.up").alias("source_dir"), "near.inherited")
    )
    final = marked.join(own_exchange(nearest), "dir", "left")
    own = F.col("license").isNotNull()
    return final.select(
        F.col("id").alias(id_column),
        F.coalesce("license", "inherited").alias("license"),
        F.when(own, F.col("cosine")).alias("cosine"),
        F.when(own, F.col("origin")).when(F.col("inherited").isNotNull(), "inherited").alias("origin"),
        F.when(~own, F.col("source_dir")).alias("source_dir"),
    )


def _nothing() -> list[Column]:
    text = F.lit(None).cast("string")
    return [text.alias("license"), F.lit(None).cast("double").alias("cosine"), text.alias("origin"), text.alias("source_dir")]
