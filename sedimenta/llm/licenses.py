"""License scans, with DataFrame functions only.

Templates and texts are reduced to lower-case words of letters and digits and cut into shingles of five words,
or of as many as a shorter template has. Only
shingles that some template has can count for containment, so the others are dropped first, by membership in the set
of all template shingles. What is left of a text is laid in overlapping windows, of a length for each class of
template sizes, so that an occurrence lies whole in some window. MinHash bands of window and template retrieve
candidates, and a candidate is a match if the window holds at least ``containment`` of the template's shingles.

A window that holds an occurrence shares at least a known part of the shingles, and the number of bands is taken from
that part: the chance to miss one is below ``MISS``. Templates are a parameter of the job, so their table is small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import col

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
SLACK = 1.25  # an occurrence may be so much longer than its template

# Statements and paragraphs of common licenses, by SPDX identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
     "of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
     "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted"),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def templates(spark: SparkSession, texts: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """``template`` (a number), ``license`` and ``text``."""
    return spark.createDataFrame([(k, *t) for k, t in enumerate(texts)], "template int, license string, text string")


def scanned(
    df: DataFrame, known: DataFrame, text: str = "text", key: str = "doc_id", containment: float = CONTAINMENT
) -> DataFrame:
    """One row per text and license found in it: ``key``, ``license``, ``containment`` (the highest of its templates)
    and ``first_word``, the number of the text's word where the first matching window's first shared shingle begins.

    ``known`` has ``template``, ``license`` and ``text``; a template of fewer than five words is one shingle, which is
    looked for in all texts, and one without words matches nothing. Null texts are empty. Rows that repeat key and text give one row.
    """
    spark = df.sparkSession
    found = known.select("template", "license", _words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(SHINGLE))
    patterns = found.withColumn("length", length).withColumn(
        "shingles", F.array_distinct(_shingles(F.col("words"), F.col("length")))
    )
    rows = patterns.select("template", "license", "length", "shingles").collect()  # the parameter, as it was given
    if not rows:
        return df.select(col(key), F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).alias("first_word")).limit(0)
    wanted = {n: sorted({h for row in rows if row.length == n for h in row.shingles}) for n in {r.length for r in rows}}
    classes = {row.template: 1 << math.ceil(math.log2(max(2.0, SLACK * len(row.shingles)))) for row in rows}
    # at the least, the shared part of the shingles in a window that is as long as it can be
    part = min(containment * len(row.shingles) / (2 * classes[row.template] + len(row.shingles)) for row in rows)
    bands = math.ceil(math.log(MISS) / math.log(1 - part))

    hits = _hits(df, text, key, wanted)
    widths = sorted(set(classes.values()))
    windows = F.flatten(F.array(*(
        F.array(*(
            F.struct(F.lit(w).alias("width"), (F.floor(F.col("place") / w) - back).alias("window")) for back in (0, 1)
        )) for w in widths
    )))
    laid = hits.select("id", "content", "place", "shingle", F.explode(windows).alias("w"))
    # a window of twice the width begins at each multiple of the width
    sets = laid.groupBy("id", "content", F.col("w.width").alias("width"), F.col("w.window").alias("window")).agg(
        F.collect_set("shingle").alias("shingles"), F.min("place").alias("first_word")
    )
    signed = sets.withColumn("band", F.explode(_bands(F.col("shingles"), bands)))
    table = spark.createDataFrame(
        [(r.template, r.license, r.shingles, classes[r.template]) for r in rows],
        "template int, license string, wanted array<bigint>, width int",
    )
    table = table.withColumn("band", F.explode(_bands(F.col("wanted"), bands)))
    near = signed.join(F.broadcast(table), ["width", "band"])
    share = F.size(F.array_intersect("shingles", "wanted")) / F.size("wanted")
    found = near.withColumn("containment", share).filter(F.col("containment") >= containment)
    best = found.groupBy("id", "content", "license").agg(
        F.max("containment").alias("containment"), F.min("first_word").alias("first_word")
    )
    return best.select(F.col("id").alias(key), "license", "containment", "first_word")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _shingles(found: Column, length: Column) -> Column:
    """A hash for each ``length`` words; fewer words have none."""
    starts = F.slice(found, F.lit(1), F.greatest(F.size(found) - (length - 1), F.lit(0)))
    return F.transform(starts, lambda _, i: F.xxhash64(F.slice(found, i + 1, length)))


def _hits(df: DataFrame, text: str, key: str, wanted: dict[int, list[int]]) -> DataFrame:
    """The shingles of each text that some template has: ``id``, ``content`` (a hash), ``place`` and ``shingle``.

    ``wanted`` has the templates' shingles by their number of words.
    """
    rows = df.select(col(key).alias("id"), F.xxhash64(col(text)).alias("content"), _words(col(text)).alias("words"))

    def hits(length: int) -> Column:
        def hit(h: Column, i: Column) -> Column:
            return F.when(h.isin(wanted[length]), F.struct(i.alias("place"), h.alias("shingle")))

        return F.filter(F.transform(_shingles(F.col("words"), F.lit(length)), hit), lambda x: x.isNotNull())

    places = F.concat(*map(hits, sorted(wanted)))
    return rows.select("id", "content", F.explode(places).alias("hit")).select("id", "content", "hit.place", "hit.shingle")


def _bands(shingles: Column, bands: int) -> Column:
    """The least hash of the shingles under each of ``bands`` orders, with the number of the order."""
    orders = F.sequence(F.lit(1), F.lit(bands))
    return F.transform(
        orders, lambda k: F.struct(k.alias("k"), F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, k))).alias("least"))
    )


