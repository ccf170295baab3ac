"""License scans: lines and whole texts compared to licence templates by Dice's coefficient over word bigrams.

A text is compared line by line and, if it has several lines, as a whole. On request (`window`) every run of 2 to `window` lines
is compared too, which finds notices that are wrapped, in comments for instance; the query doesn't ask for it. Normalised: lower case, runs of anything but
a-z and 0-9 are one blank. Dice is 2 * common / (own + template's), over distinct bigrams. A template is a candidate only
if its number of bigrams allows the threshold: min / max >= t / (2 - t). Null, empty and one-word texts match nothing;
rows are found again by their id and a hash of their text, so rows that share an id, or have none, get what is in their own
text; other columns aren't read; an empty table gives no rows. Ties between templates go to the one listed first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

THRESHOLD = 0.8
#: Common licence notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
)


def normalised(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))


def bigrams(words: Column) -> Column:
    """The distinct pairs of adjacent words."""
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def template_rows(templates=TEMPLATES) -> list[tuple[int, str, int, str]]:
    import re

    out = []
    for i, (name, text) in enumerate(templates):
        words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
        own = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        out += [(i, name, len(own), b) for b in own]
    return out


def _windows(lines: Column, k: int) -> Column:
    """All runs of k lines, but for the one that is the whole text."""
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(lines) - k + 1, F.lit(1))), lambda i: F.size(lines) > k)
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(lines, i, F.lit(k))))


def compare(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES, window: int = 1) -> DataFrame:
    """doc_id, key (of the text), unit (line from 1, 0: whole text; after the lines, windows by length and first line), template, license, dice: all comparisons at or above the threshold.

    Templates are a constant table, so their broadcast has a fixed size. Units outside the sizes of all templates are
    dropped before their bigrams are dealt out; the rest meets only templates whose size bound holds and that share a
    bigram. Texts aren't shuffled.
    """
    spark: SparkSession = docs.sparkSession
    rows = template_rows(templates)
    ratio = threshold / (2 - threshold) * (1 - 1e-9)  # a little less, so that rounding prunes nothing
    least, most = min(r[2] for r in rows) * ratio, max(r[2] for r in rows) / ratio
    wanted = F.broadcast(spark.createDataFrame(rows, "template int, license string, n_template int, bigram string"))
    text = C.text_of()
    lines = F.split(text, "\n")
    units = F.when(F.size(lines) > 1, F.concat(F.array(text), lines)).otherwise(F.concat(F.array(F.lit("")), lines))
    if window > 1:
        units = F.concat(units, *[_windows(lines, k) for k in range(2, window + 1)])
    # n bigrams take over 2 n characters and n words; n distinct ones can't have over n + 1 distinct words
    words = F.transform(units, lambda u: F.when(F.length(u) > 2 * least, F.split(normalised(u), " ")))
    own = F.transform(words, lambda w: F.when((F.size(w) > least) & (F.size(F.array_distinct(w)) <= most + 1), bigrams(w)))
    # all that is made of a text is made once, before its units are rows; a filter above would make it again
    per_text = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("key"), own.alias("units"))
    each = per_text.select("row_no", "doc_id", "key", F.posexplode("units").alias("unit", "own")).withColumn("n_own", F.size("own"))
    each = each.where((F.col("n_own") >= least) & (F.col("n_own") <= most))
    dealt = each.select("row_no", "doc_id", "key", "unit", "n_own", F.explode("own").alias("bigram"))
    met = dealt.join(wanted, "bigram").where(F.least("n_own", "n_template") >= ratio * F.greatest("n_own", "n_template"))
    scored = met.groupBy("row_no", "doc_id", "key", "unit", "n_own", "template", "license", "n_template").agg(F.count(F.lit(1)).alias("common"))
    scored = scored.withColumn("dice", F.lit(2.0) * F.col("common") / (F.col("n_own") + F.col("n_template")))
    return scored.where(F.col("dice") >= threshold).select("doc_id", "key", "unit", "template", "license", "dice")


def license_scan(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES, window: int = 1) -> DataFrame:
    """doc_id, n_units (lines, windows of them, or the whole text, that match), license, dice (of the best match, null if none), licenses (all, comma-joined): a row per document."""
    hits = C.spool(compare(docs, threshold, templates, window), "licenses")
    best = F.max(F.struct("dice", (-F.col("template")).alias("neg"), "license")).alias("b")
    per = hits.groupBy("doc_id", "key").agg(F.count_distinct("unit").alias("n_units"), best, F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"))
    per = per.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "n_units", F.col("b.license").alias("license"), F.col("b.dice").alias("dice"), "licenses")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), C.text_key().alias("key"))
    out = ids.join(per, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    return out.select("doc_id", F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"), "license", "dice", "licenses")
