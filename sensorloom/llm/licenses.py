"""License scans: TF-IDF cosine of notices and licence files to templates, inherited along directories."""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices by which licences are recognised.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]

SPLIT = r"[^\p{L}\p{N}]+"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)[^/]*$"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPLIT), lambda w: w != "")


def _template_terms(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def document_frequency(lines: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of lines, and for each template term the number of lines that have it.

    Counted over all lines; the result has one row per term of the templates."""
    found = F.array_intersect(terms(F.col("line")), F.lit(vocabulary))
    counts = lines.select(F.explode(F.concat(found, F.array(F.lit("")))).alias("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()
    df = {r["term"]: r["n"] for r in counts}
    return df.pop("", 0), df


def template_weights(templates: list[tuple[str, str]], n: int, df: dict[str, int], least: float):
    """idf of each term, of unknown terms, the unit vectors of the templates, and the anchor terms.

    A line of cosine ``least`` to a template shares terms that hold ``least``
    squared of the template's squared length.  The commonest terms of a template
    that together hold less than that are no anchors; so every line with enough
    cosine has at least one anchor."""
    idf = {t: math.log((n + 1) / (df.get(t, 0) + 1)) + 1 for _, text in templates for t in _template_terms(text)}
    vectors, anchors = [], set()
    for at, (_, text) in enumerate(templates):
        weights = {t: k * idf[t] for t, k in Counter(_template_terms(text)).items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        held = 0.0
        for t, w in sorted(weights.items(), key=lambda x: (-df.get(x[0], 0), x[0])):
            vectors.append((at, t, w / length))
            held += (w / length) ** 2
            if held >= least * least * 0.999999:
                anchors.add(t)
    return idf, math.log(n + 1) + 1, vectors, sorted(anchors)


def best_templates(blocks: DataFrame, templates, idf, unknown, vectors, least: float) -> DataFrame:
    """(file_id, pos, license, cosine) of the blocks (file_id, pos, words) near a template."""
    spark = blocks.sparkSession
    # the tables below have a row for each term of the fixed templates
    weights = F.broadcast(spark.createDataFrame(list(idf.items()), "term string, idf double"))
    vector = F.broadcast(spark.createDataFrame([(a, templates[a][0], t, w) for a, t, w in vectors],
                                               "template int, license string, term string, w double"))
    counts = blocks.select("file_id", "pos", F.explode("words").alias("term")).groupBy("file_id", "pos", "term") \
        .agg(F.count(F.lit(1)).alias("tf"))
    counts = counts.join(weights, "term", "left").withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    length = counts.groupBy("file_id", "pos").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length"))
    dots = counts.join(vector, "term").groupBy("file_id", "pos", "template", "license").agg(F.sum(F.col("x") * F.col("w")).alias("dot"))
    near = dots.join(length, ["file_id", "pos"]).withColumn("cosine", F.round(F.col("dot") / F.col("length"), 6)) \
        .where(F.col("cosine") >= least)
    return near.groupBy("file_id", "pos").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")) \
        .select("file_id", "pos", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))


def scan_licenses(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = 0.7) -> DataFrame:
    """Licence of every file: file_id, path, license, found (notice, file, inherited), cosine, license_dir.

    ``files`` has file_id, path and text.  Every line is compared with the
    templates by the cosine of TF-IDF vectors, with document frequencies over
    all lines; the best line with a cosine of ``least`` or more is the notice of
    its file.  A file that as a whole is that near to a template, or that is
    named as a licence file and has a notice, licenses its directory.  Files
    without a notice inherit from the nearest directory above them with such a
    file (of several, the nearest to its template, then the least name).

    Null or empty texts have no notice; null paths inherit nothing.  Rows with
    a null file_id are skipped in the scan and come out without a notice; rows
    that repeat a file_id share the best notice.  An empty table gives no rows.
    """
    vocabulary = sorted({t for _, text in templates for t in _template_terms(text)})
    lines = files.where(F.col("file_id").isNotNull()).select("file_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    n, df = document_frequency(lines, vocabulary)
    idf, unknown, vectors, anchors = template_weights(templates, n, df, least)
    anchored = lines.select("file_id", "pos", terms(F.col("line")).alias("words")).where(F.arrays_overlap("words", F.lit(anchors)))
    notices = best_templates(anchored, templates, idf, unknown, vectors, least)
    notice = notices.groupBy("file_id").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("b")) \
        .select("file_id", F.col("b.license").alias("license"), (-F.col("b.c")).alias("cosine"))
    whole = files.join(anchored.select("file_id").distinct(), "file_id", "left_semi").select(
        "file_id", F.lit(-1).alias("pos"), terms(F.col("text")).alias("words"))
    as_file = best_templates(whole, templates, idf, unknown, vectors, least).select(
        "file_id", F.col("license").alias("file_license"), F.col("cosine").alias("file_cosine"))
    own = notice.join(as_file, "file_id", "full")

    paths = files.select("file_id", "path")
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    known = paths.join(own, "file_id", "left").withColumn("dir", folder)
    licensing = known.where(F.col("file_license").isNotNull() | (F.col("path").rlike(LICENSE_FILE) & F.col("license").isNotNull()))
    of_dir = licensing.where("dir is not null").groupBy(F.col("dir").alias("license_dir")).agg(F.min(F.struct(
        (-F.coalesce("file_cosine", "cosine")).alias("c"), F.coalesce("file_license", "license").alias("license"))).alias("b")) \
        .select("license_dir", F.col("b.license").alias("dir_license"), (-F.col("b.c")).alias("dir_cosine"))
    # directories, not files, look for the nearest one above: one row for each directory and level
    parts = F.split("dir", "/")
    above = known.where("license is null and file_license is null and dir is not null").select("dir").distinct() \
        .withColumn("depth", F.explode(F.sequence(F.lit(0), F.size(parts)))) \
        .select("dir", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("license_dir"))
    nearest = above.join(of_dir, "license_dir").groupBy("dir").agg(F.max(F.struct(
        "depth", "license_dir", "dir_license", "dir_cosine")).alias("n")).select("dir", "n.license_dir", "n.dir_license", "n.dir_cosine")
    out = known.join(nearest, "dir", "left")
    inherits = F.col("license").isNull() & F.col("file_license").isNull()
    found = F.when(F.col("file_license").isNotNull(), "file").when(F.col("license").isNotNull(), "notice") \
        .when(F.col("dir_license").isNotNull(), "inherited")
    return out.select(
        "file_id", "path", F.coalesce("file_license", "license", F.when(inherits, F.col("dir_license"))).alias("license"),
        found.alias("found"), F.coalesce("file_cosine", "cosine", F.when(inherits, F.col("dir_cosine"))).alias("cosine"),
        F.when(inherits, F.col("license_dir")).alias("license_dir"))
