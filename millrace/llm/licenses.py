"""License scans: MinHash bands over overlapping windows find templates, containment verifies; built-in functions only."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Workspace, columns

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
# Templates are retrieved by parts of at most this many shingles.
PART = 8
# Chance that a window with a part at the least containment shares no band with it.
MISS = 1e-4
MAX_TEMPLATE_SHINGLES = 100_000

# License notices (fixed values).
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)


def words_of_template(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).split()


def _scale(shingles: int) -> int:
    """Step of the windows (half their length) for a part of so many shingles: a power of two, at least their number."""
    return 1 << max(0, math.ceil(math.log2(shingles)))


def bands_for() -> int:
    """Bands of one hash that leave a chance of ``MISS`` for the least similar window that matters.

    A part of m shingles with m > step / 2 lies whole in a window of 2 * step; with a share of
    ``CONTAINMENT`` of it left, its Jaccard similarity to the window is at least
    CONTAINMENT * m / (2 * step + (1 - CONTAINMENT) * m).
    """
    least = CONTAINMENT * 0.5 / (2 + (1 - CONTAINMENT) * 0.5)
    return math.ceil(math.log(MISS) / math.log(1 - least))


def _shingles(words: Column) -> Column:
    """Hashes of all runs of five words, in order; of the whole text if it has fewer."""
    last = F.greatest(F.size(words) - SHINGLE_WORDS, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE_WORDS)]))


def _run(values: Column, start: Column, length: int) -> Column:
    """Up to ``length`` values from ``start`` on. slice() would copy the whole list for every run."""
    return F.array_compact(F.transform(F.sequence(F.lit(0), F.lit(length - 1)), lambda k: F.get(values, start + k)))


def _band_values(shingles: Column, bands: int) -> Column:
    """The smallest value of each band's hash over the shingles."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, b))))


def _template_table(spark, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """template, license, shingles (array) of each template with words."""
    rows = [(i, name, words) for i, (name, text) in enumerate(templates) if (words := words_of_template(text))]
    total = sum(max(1, len(words) - SHINGLE_WORDS + 1) for _, _, words in rows)
    if total > MAX_TEMPLATE_SHINGLES:
        raise ValueError(f"{total} template shingles; scan in runs of at most {MAX_TEMPLATE_SHINGLES}")
    table = spark.createDataFrame(rows, "template int, license string, words array<string>")
    return table.select("template", "license", _shingles(F.col("words")).alias("shingles"))


def scan_licenses(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document and license found: doc_id, license, containment, n_matches.

    Words are runs of a-z and 0-9 after lower-casing. ``containment`` is the largest share of a
    template's distinct five-word shingles (one shingle if it has fewer words) within one place of the
    text, at least ``CONTAINMENT``; ``n_matches`` the number of the license's templates found. Null and empty texts match nothing, rows with a null id are reported under
    null and, like rows that repeat an id, together with it. Without templates the result is empty.

    Texts that share no shingle with any template, which cannot contain one, get no windows.
    """
    spark = docs.sparkSession
    bands = bands_for()
    table = _template_table(spark, templates)
    # One small row per template, of a number checked above.
    known = sorted({s for r in table.select("shingles").collect() for s in r["shingles"]})
    longest = max((len(words_of_template(t)) for _, t in templates), default=0)
    parts = table.select("template", "license", F.col("shingles").alias("whole"), F.posexplode(
        F.transform(F.sequence(F.lit(0), F.floor((F.size("shingles") - 1) / PART).cast("int")), lambda i: F.slice("shingles", i * PART + 1, PART))
    ).alias("part", "own"))
    n = F.size("own")
    steps = sorted({_scale(m) for m in range(1, PART + 1)})
    step = F.element_at(F.array(*[F.lit(_scale(m)) for m in range(1, PART + 1)]), n)
    keys = parts.select("template", "part", step.alias("step"), F.posexplode(_band_values(F.col("own"), bands)).alias("band", "value"))

    source = columns(docs, doc_id=id_col, text=text_col).where("text is not null")
    words = F.split(F.btrim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " ")), " ")
    # Through explode() each list is made once; a plain alias is put in place, and evaluated, wherever it is used.
    texts = source.select("doc_id", F.explode(F.array(words)).alias("words")).where("words[0] != ''")
    texts = texts.select("doc_id", F.explode(F.array(_shingles(F.col("words")))).alias("shingles"))
    listed = F.lit(known).cast("array<bigint>") if known else F.array().cast("array<bigint>")
    near = Workspace(spark, "licenses").stage(
        texts.where(F.arrays_overlap("shingles", listed)).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "shingles",
            F.filter(F.sequence(F.lit(0), F.size("shingles") - 1), lambda i: F.array_contains(listed, F.get("shingles", i))).alias("hits"),
        )
    )
    reach = longest + 2 * max(steps)

    def windows(step: int) -> Column:
        """Start, the window and its surroundings, of windows at multiples of the step that hold a known shingle."""
        own = lambda at: _run(F.col("shingles"), at, 2 * step)
        last = lambda hit: F.floor(hit / step).cast("int") * step
        both = F.flatten(F.transform("hits", lambda hit: F.array(last(hit), last(hit) - step)))
        starts = F.filter(F.array_distinct(both), lambda at: at >= 0)
        around = lambda at: _run(F.col("shingles"), F.greatest(at - reach, F.lit(0)), 2 * reach)
        return F.transform(starts, lambda at: F.struct(F.lit(step).alias("step"), at.alias("start"), own(at).alias("window"), around(at).alias("near")))

    cut = near.select("row", "doc_id", F.explode(F.concat(*[windows(s) for s in steps])).alias("w"))
    probes = cut.select("row", "doc_id", "w.step", "w.start", "w.near", F.posexplode(_band_values(F.col("w.window"), bands)).alias("band", "value"))
    found = probes.join(F.broadcast(keys), ["step", "band", "value"]).dropDuplicates(["row", "start", "template"])
    wholes = table.select("template", "license", F.array_distinct("shingles").alias("whole"))
    share = F.size(F.array_intersect("near", "whole")) / F.size("whole")
    matched = found.join(F.broadcast(wholes), "template").withColumn("share", share).where(F.col("share") >= CONTAINMENT)
    return matched.groupBy("doc_id", "license").agg(
        F.max("share").alias("containment"), F.count_distinct("template").cast("long").alias("n_matches"),
    )
