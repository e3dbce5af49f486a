"""License scan (operator 8), DataFrame functions only.

Texts are cut into segments at line ends and sentence marks. A segment and a
license template are TF-IDF vectors over their terms; document frequencies are
counted over all segments of the corpus, and a term of no template has that of
a term seen nowhere. The best template with a cosine of ``min_cosine`` or more
is the segment's license.

An SPDX header is read as such, before texts are cut: the first identifier of its
expression that is listed (in any case, with or without ``-only``, ``-or-later``
or ``+``) is a license found with cosine 1. Headers take no part in the search
for templates, so one with other identifiers only gives no license.

A segment that has no anchor term cannot reach that cosine: anchors are all
template terms but those lightest ones whose share of a template's length stays
below it. So only segments with an anchor are turned into vectors.

A file whose license segments hold half of its words or more is a license file
of its directory. Files without a license of their own inherit that of the
nearest directory above them that has a license file (found per directory, by
joins on path prefixes).

Defined results: null and empty texts have no license of their own; a null path
lies in the root directory; equal cosines go to the template listed first, and
equal license files of a directory to the smaller path; repeated rows get equal
results; an empty table gives an empty result. Only path, text and the columns
in ``keep`` are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.materialize import write_and_reread
from .tables import settled
from .words import lower_ascii

# License notices by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Released under the BSD License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]

_ID = r"[a-z0-9]++(?:[.+-]++[a-z0-9]++)*+\+?+"
#: The tag of an SPDX header; its expression, if there is one, is the group.
HEADER = rf"(?i)SPDX-License-Identifier(?:[ \t]*+:[ \t]*+(\(*+{_ID}\)*+(?:[ \t]++(?:AND|OR|WITH)[ \t]++\(*+{_ID}\)*+)*+)?+)?+"
SEGMENT_END = r"\n|[.!?;:][ \t]+"
_MARKS = "".join(chr(i) for i in [*range(1, 48), *range(58, 65), *range(91, 97), *range(123, 128)])


def terms(segment: Column) -> Column:
    """Runs of letters and digits (beyond ASCII: of anything), A-Z in lower case."""
    return F.filter(F.split(F.translate(lower_ascii(segment), _MARKS, " " * len(_MARKS)), " "), lambda t: t != "")


def template_terms(text: str) -> Counter:
    return Counter(re.findall("[a-z0-9]+", text.lower()))


def anchor_terms(templates: list[Counter], idf: dict[str, float], min_cosine: float) -> list[str]:
    """The template terms without the lightest ones, so that no template reaches the cosine by those alone."""
    whole = [sum((n * idf[t]) ** 2 for t, n in c.items()) for c in templates]
    light, held = set(), [0.0] * len(templates)
    for t in sorted(idf, key=lambda t: (idf[t], t)):
        new = [h + (c[t] * idf[t]) ** 2 for h, c in zip(held, templates, strict=True)]
        if any(h >= (0.999 * min_cosine) ** 2 * w for h, w in zip(new, whole, strict=True)):
            break
        light.add(t)
        held = new
    return sorted(set(idf) - light)


def declared(files: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """(path, version, segment_no, n_terms, template, cosine) of the SPDX headers with a listed identifier.
    Segment numbers are negative, as headers are no segments."""
    names = F.array(*[F.lit(spdx.lower()) for spdx, _ in templates])
    headers = files.where(F.col("text").rlike(HEADER)).select(
        "path", "version", F.posexplode(F.regexp_extract_all("text", F.lit(HEADER), F.lit(1))).alias("nth", "expression"))
    ids = F.transform(F.regexp_extract_all(F.lower("expression"), F.lit(_ID), F.lit(0)), lambda x: F.regexp_replace(x, r"(-only|-or-later|\+)$", ""))
    first = F.get(F.filter(ids, lambda x: F.array_contains(names, x)), F.lit(0))
    tag = len(template_terms("SPDX-License-Identifier"))
    return headers.select("path", "version", (-1 - F.col("nth")).alias("segment_no"), (F.size(terms(F.col("expression"))) + tag).alias("n_terms"),
                          (F.array_position(names, first) - 1).cast("int").alias("template"), F.lit(1.0).alias("cosine")).where("template >= 0")


def licensed_segments(files: DataFrame, templates: list[tuple[str, str]], min_cosine: float) -> DataFrame:
    """(path, version, segment_no, n_terms, template, cosine): the best template of each segment that reaches one,
    and the SPDX headers with a listed identifier. ``files``: path, version, text."""
    spark = files.sparkSession
    bags = [template_terms(t) for _, t in templates]
    vocabulary = sorted(set().union(*bags))
    plain = F.when(F.col("text").rlike(HEADER), F.regexp_replace("text", HEADER, "")).otherwise(F.col("text"))
    segments = files.select("path", "version", F.posexplode(F.split(plain, SEGMENT_END, -1)).alias("segment_no", "segment"))
    segments = segments.select("path", "version", "segment_no", terms(F.col("segment")).alias("terms")).where(F.size("terms") > 0)

    listed = F.array(*[F.lit(t) for t in vocabulary])
    seen = segments.select(F.explode(F.concat(F.array_intersect("terms", listed), F.array(F.lit("")))).alias("term"))
    df = {r["term"]: r["n"] for r in seen.groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per template term
    total = df.pop("", 0)
    idf = {t: math.log((total + 1) / (df.get(t, 0) + 1)) + 1 for t in vocabulary}
    unseen = math.log(total + 1) + 1
    anchors = anchor_terms(bags, idf, min_cosine)

    likely = segments.where(F.arrays_overlap("terms", F.array(*[F.lit(t) for t in anchors])))
    counts = likely.select("path", "version", "segment_no", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))
    counts = counts.groupBy("path", "version", "segment_no", "n_terms", "term").agg(F.count(F.lit(1)).alias("n"))
    weights = F.create_map(*[x for t in vocabulary for x in (F.lit(t), F.lit(idf[t]))])
    weighed = counts.withColumn("weight", F.col("n") * F.coalesce(F.try_element_at(weights, F.col("term")), F.lit(unseen)))
    norms = [math.sqrt(sum((n * idf[t]) ** 2 for t, n in b.items())) for b in bags]
    dots = []
    for b, norm in zip(bags, norms, strict=True):
        mine = F.create_map(*[x for t, n in b.items() for x in (F.lit(t), F.lit(n * idf[t] / norm))])
        dots.append(F.coalesce(F.sum(F.col("weight") * F.try_element_at(mine, F.col("term"))), F.lit(0.0)))
    sums = weighed.groupBy("path", "version", "segment_no", "n_terms").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"), F.array(*dots).alias("dots"))
    found = sums.select("path", "version", "segment_no", "n_terms", "norm", F.array_max(F.transform(
        "dots", lambda d, i: F.struct(F.round(d / F.col("norm"), 6).alias("cosine"), (-i).alias("minus")))).alias("best"))
    found = found.where(F.col("best.cosine") >= min_cosine).select(
        "path", "version", "segment_no", "n_terms", (-F.col("best.minus")).alias("template"), F.col("best.cosine").alias("cosine"))
    return settled(found.unionAll(declared(files, templates)), "license_segments")


def scan(files: DataFrame, path: Column, text: Column, templates: list[tuple[str, str]] = TEMPLATES, min_cosine: float = 0.6,
         **keep: Column) -> DataFrame:
    """One row per file: path, the columns in ``keep``, license, how (``own``, ``inherited`` or null), cosine and
    inherited_from (a directory)."""
    spark = files.sparkSession
    src = files.select(F.coalesce(path, F.lit("")).alias("path"), *[c.alias(n) for n, c in keep.items()], text.alias("text"), F.xxhash64(text).alias("version"))
    found = licensed_segments(src, templates, min_cosine)
    names = F.array(*[F.lit(t) for t, _ in templates])
    own = found.groupBy("path", "version").agg(
        F.max(F.struct("cosine", (-F.col("template")).alias("minus"))).alias("best"), F.sum("n_terms").alias("license_terms"))
    own = own.select(F.col("path").alias("__path"), F.col("version").alias("__version"), F.get(names, -F.col("best.minus")).alias("license"),
                     F.col("best.cosine").alias("cosine"), "license_terms")
    own = settled(own, "license_own")

    n_terms = F.aggregate(F.transform(F.split(F.coalesce("text", F.lit("")), SEGMENT_END, -1), lambda s: F.size(terms(s))), F.lit(0), lambda a, n: a + n)
    directory = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.lit(""))
    sized = src.join(own, (F.col("path") == F.col("__path")) & (F.col("version") == F.col("__version")), "left").select(
        "path", *keep, directory.alias("directory"), "license", "cosine",
        (F.col("license_terms") * 2 >= F.when(F.col("license").isNotNull(), n_terms)).alias("is_license_file"))
    sized = write_and_reread(spark, sized, "license_files")

    best = F.min(F.struct((-F.col("cosine")).alias("minus"), "path", "license"))
    given = sized.where("is_license_file").groupBy("directory").agg(best.alias("best")).select(F.col("directory").alias("above"), F.col("best.license").alias("given"))
    given = settled(given, "license_given")
    steps = F.split("directory", "/")
    ancestors = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/")))
    nearest = sized.select("directory").distinct().select("directory", F.explode(F.array_distinct(ancestors)).alias("ancestor"))
    nearest = nearest.join(given, F.col("ancestor") == F.col("above")).groupBy("directory").agg(
        F.max_by(F.struct("above", "given"), F.length("above")).alias("nearest"))
    nearest = settled(nearest.select(F.col("directory").alias("__directory"), "nearest.above", "nearest.given"), "license_nearest")

    out = sized.join(nearest, F.col("directory") == F.col("__directory"), "left")
    has = F.col("license").isNotNull()
    return out.select(
        "path", *keep, F.coalesce("license", "given").alias("license"),
        F.when(has, F.lit("own")).when(F.col("given").isNotNull(), F.lit("inherited")).alias("how"), "cosine",
        F.when(~has, F.col("above")).alias("inherited_from"))
