"""License scans: MinHash bands over overlapping text windows. DataFrame operations only.

For each template of T words, texts are cut into windows of T + T/4 words, T/4 words apart, so
that any passage of T words lies whole in one window. Windows and templates are sets of word
shingles; :data:`BANDS` bands of :data:`ROWS` MinHash values retrieve templates. A window that
holds 80 % of a template's shingles has a Jaccard of at least 0.8 / (1.25 + 0.2) = 0.55 with
it, and 24 bands of 2 rows meet with a probability of 1 - (1 - 0.55^2)^24 = 0.9998; a whole
copy (Jaccard 0.8) practically always. Retrieved templates are verified by exact shingle
containment.

Windows without any shingle of any template cannot match, so only windows around shingles of
templates are built; that test is exact and covers whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.common import evaluate_once

WIDTH = 3
BANDS = 24
ROWS = 2
CONTAINED = 0.8
MOST_SHINGLES = 50_000   # bound of the template set, which is part of the plan

# Public license notices.
TEMPLATES = {
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                  "except in compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                  "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                  "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met: Redistributions of source code must retain the above "
           "copyright notice, this list of conditions and the following disclaimer.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
               "General Public License as published by the Free Software Foundation, either version 3 of the "
               "License, or (at your option) any later version.",
    "mit-short": "Released under the MIT License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
           "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
           "and/or sell copies of the Software.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
               "the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits, lower-cased."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def with_shingles(df: DataFrame, text: str, width: int = WIDTH) -> DataFrame:
    """Add ``_n`` (words) and ``_s`` (hash of the shingle at each word; short texts: one)."""
    keep = [c for c in df.columns if c != text]
    split = evaluate_once(df.select(*keep, words(F.col(text)).alias("_w")))
    starts = F.sequence(F.lit(0), F.greatest(F.size("_w") - width, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col("_w"), i + j) for j in range(width)]))
    return evaluate_once(split.select(*keep, F.size("_w").alias("_n"), F.when(F.size("_w") > 0, hashes).alias("_s")))


def with_bands(df: DataFrame, shingles: str) -> DataFrame:
    """One row per band of a shingle array column: adds ``band`` and ``key``."""
    keep = df.columns
    seeds = F.sequence(F.lit(0), F.lit(BANDS * ROWS - 1))
    mins = F.transform(seeds, lambda seed: F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, seed))))
    signed = evaluate_once(df.select(*keep, mins.alias("_m")))
    key = lambda b: F.xxhash64(*[F.get(F.col("_m"), b * ROWS + r) for r in range(ROWS)])
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(b.alias("band"), key(b).alias("key")))
    return signed.select(*keep, F.inline(bands))


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None,
                  contained: float = CONTAINED) -> DataFrame:
    """Templates found in each document.

    Returns one row per document and template found: doc_id, license, containment (largest
    share of the template's shingles in a window), first_word (start of the first best
    window), n_windows.

    Edge cases: null or empty text has no match; rows of equal doc_id (also null) are one
    document; equal templates under two names are both reported; templates without words are
    ignored; other columns are ignored; no templates or an empty table give an empty result.
    """
    spark: SparkSession = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    tdf = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    rows = [(r[0], r[1], sorted(set(r[2]))) for r in with_shingles(tdf, "text").filter("_n > 0").collect()]
    known = sorted({h for r in rows for h in r[2]})
    if len(known) > MOST_SHINGLES:
        raise ValueError(f"{len(known)} template shingles; the bound is {MOST_SHINGLES}")
    if not rows:
        known = [0]
    spec = spark.createDataFrame(rows, "license string, t_words int, t_set array<long>")
    spec = spec.withColumn("stride", F.greatest(F.floor(F.col("t_words") / 4), F.lit(1)).cast("int")) \
        .withColumn("span", (F.greatest(F.col("t_words") - WIDTH + 1, F.lit(1)) + F.col("stride")).cast("int"))
    t_bands = with_bands(spec.select("license", "t_set", "span"), "t_set")

    shingled = with_shingles(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text")
    is_known = lambda h: h.isin(known)
    near = evaluate_once(shingled.filter(F.exists("_s", is_known)).select(
        "doc_id", "_s", F.filter(F.sequence(F.lit(0), F.size("_s") - 1),
                                 lambda i: is_known(F.get(F.col("_s"), i))).alias("_hits")))
    shapes = sorted({(max(t - WIDTH + 1, 1) + max(t // 4, 1), max(t // 4, 1)) for _, t, _ in rows}) or [(1, 1)]
    shape = F.explode(F.array(*[F.struct(F.lit(a).alias("span"), F.lit(b).alias("stride")) for a, b in shapes]))
    cover = F.array_distinct(F.flatten(F.transform("_hits", lambda p: F.sequence(
        F.greatest(F.ceil((p - F.col("span") + 1) / F.col("stride")), F.lit(0)).cast("int"),
        F.floor(p / F.col("stride")).cast("int")))))
    windows = evaluate_once(
        near.select("doc_id", "_s", "_hits", shape.alias("z")).select("doc_id", "_s", "_hits", "z.span", "z.stride")
        .select("doc_id", "_s", "span", "stride", F.explode(cover).alias("w"))
        .select("doc_id", "span", (F.col("w") * F.col("stride")).alias("first_word"),
                F.array_distinct(F.slice("_s", F.col("w") * F.col("stride") + 1, F.col("span"))).alias("win")))
    # the template side is at most BANDS rows of MOST_SHINGLES hashes, checked above, whatever the
    # corpus; it has to be a broadcast, because Spark does not know its size and would deal the
    # windows, one row and one copy of the window for each band
    found = (with_bands(windows, "win").join(F.broadcast(t_bands), ["span", "band", "key"])
             .withColumn("containment", F.size(F.array_intersect("win", "t_set")) / F.size("t_set"))
             .filter(F.col("containment") >= contained)
             .select("doc_id", "license", "first_word", "containment").distinct())
    best = F.max("containment")
    return (found.groupBy("doc_id", "license")
            .agg(best.alias("containment"),
                 F.max(F.struct("containment", (-F.col("first_word")).alias("w"))).alias("_b"),
                 F.count(F.lit(1)).alias("n_windows"))
            .select("doc_id", "license", "containment", (-F.col("_b.w")).cast("long").alias("first_word"), "n_windows"))
