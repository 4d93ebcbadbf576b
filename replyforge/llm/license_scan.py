"""Licence scan by MinHash bands over overlapping windows, as DataFrame and SQL expressions only.

Texts are cut into lower-case words (runs of letters and digits) and five-word shingles. A template of ``m`` shingles
is searched in windows of ``m + s - 1`` shingles that start at every ``s``-th shingle, ``s = max(1, m // 8)``; so an
unbroken copy of it lies whole inside one window, wherever it starts. A window's signature has ``BANDS`` bands of one row: the minimum of the shingle hashes,
hashed anew with the band's number. A window that contains 80 % of a template has a Jaccard similarity of at least 0.6 with
it, so the chance that no band collides is at most ``0.4 ** 8`` (7 in 10,000); a whole copy misses with less than
``0.12 ** 8``. What the bands retrieve is verified exactly: the share of the template's distinct shingles that the
window holds has to reach ``similarity``.

A band key is the hash of one shingle. So a window can only collide with a template when it holds a shingle that is
one of the template's keys: signatures are computed for the windows around such shingles, and every other window is
known not to collide. Templates are taken in blocks of at most ``BLOCK`` templates and ``BLOCK_SHINGLES`` shingles (or one
template), so a plan holds, and a broadcast sends, a bounded number of them however many there are; each block is one
more pass. Containment is always that of the whole template.

Null, empty and shorter texts have no shingles and match nothing. Templates of fewer than five words are refused.
Rows that repeat a key get the same result: what any of them holds.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyforge.llm.quality_rules import let

WORDS = 5
BANDS = 8
BLOCK = 200
BLOCK_SHINGLES = 200_000

#: Lines, notices and passages of common licences, in several wordings. Relatives (GPL, LGPL and AGPL; versions; the
#: Creative Commons family) share most of their words, so theirs are cut where less than ``similarity`` is shared: a
#: word between "GNU" and "General", or another version, leaves at most 0.79 of them.
_NAMED = [
    ("apache-2.0", "the Apache License, Version 2.0"),
    ("apache-2.0", "the Apache License 2.0"),
    ("mit", "the MIT License"),
    ("isc", "the ISC License"),
    ("mpl-2.0", "the Mozilla Public License, version 2.0"),
    ("mpl-2.0", "the Mozilla Public License 2.0"),
    ("gpl-3.0", "the GNU General Public License v3.0"),
    ("gpl-2.0", "the GNU General Public License v2.0"),
    ("lgpl-3.0", "the GNU Lesser General Public License v3.0"),
    ("lgpl-2.1", "the GNU Lesser General Public License v2.1"),
    ("agpl-3.0", "the GNU Affero General Public License v3.0"),
    ("cc-by-4.0", "CC BY 4.0"),
    ("cc-by-sa-4.0", "CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "CC BY-NC 4.0"),
    ("cc-by-4.0", "a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa-4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc-4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"),
]
_HEADER = "under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License"
_SPDX = ["apache-2.0", "gpl-3.0", "gpl-2.0", "lgpl-3.0", "lgpl-2.1", "agpl-3.0", "mpl-2.0", "cc-by-4.0", "cc-by-sa-4.0", "cc-by-nc-4.0"]
TEMPLATES = [
    *[(name, f"{start} under {what}") for name, what in _NAMED for start in ("licensed", "released", "distributed", "available")],
    *[(name, f"SPDX-License-Identifier: {name}") for name in _SPDX],
    ("cc0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    # Four shingles each, so that another version at the end leaves three.
    ("gpl-3.0", "under the GNU General Public License, version 3"),
    ("gpl-2.0", "under the GNU General Public License, version 2"),
    ("lgpl-3.0", "the GNU Lesser General Public License, version 3"),
    ("lgpl-2.1", "the GNU Lesser General Public License, version 2.1"),
    ("agpl-3.0", "the GNU Affero General Public License, version 3"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("cc0-1.0", "has waived all copyright and related or neighboring rights to this work"),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ),
    ("gpl-3.0", _HEADER.format("General Public License", "3")),
    ("gpl-2.0", _HEADER.format("General Public License", "2")),
    ("lgpl-3.0", _HEADER.format("Lesser General Public License", "3")),
    ("lgpl-2.1", _HEADER.format("Lesser General Public License", "2.1")),
    ("agpl-3.0", _HEADER.format("Affero General Public License", "3")),
    (
        "gpl-3.0",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for "
        "most software and other practical works are designed",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """One 64-bit hash for each run of five words."""
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.transform(
            F.slice(h, 1, F.greatest(F.size(h) - (WORDS - 1), F.lit(0))),
            lambda _, i: F.xxhash64(*[F.get(h, i + k) for k in range(WORDS)]),
        ),
    )


def band(hashes: str, number: int) -> Column:
    """The hashes hashed anew for a band."""
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(number)))


def step_of(m: int) -> int:
    return max(1, m // 8)


def template_keys(spark, templates) -> list[dict]:
    """The templates with their distinct shingle hashes and band keys; one small Spark job."""
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    hashed = spark.createDataFrame(rows, "template int, license string, body string").select(
        "template", "license", shingle_hashes(words_of(F.col("body"))).alias("hashes")
    ).withColumn("banded", F.array(*[band("hashes", b) for b in range(BANDS)]))
    found = []
    for row in hashed.collect():
        own = row["hashes"]
        if not own:
            raise ValueError(f"template {row['template']} ({row['license']}) has fewer than {WORDS} words")
        # Per band the smallest value, and the shingle that has it.
        least = [min(zip(values, own, strict=True)) for values in row["banded"]]
        found.append({"license": row["license"], "template": row["template"], "m": len(own), "own": sorted(set(own)), "least": least})
    return found


def in_blocks(templates: list[dict]) -> list[list[dict]]:
    """Templates in blocks of bounded size."""
    blocks, size = [], 0
    for template in templates:
        if not blocks or len(blocks[-1]) == BLOCK or size + template["m"] > BLOCK_SHINGLES:
            blocks.append([])
            size = 0
        blocks[-1].append(template)
        size += template["m"]
    return blocks


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: list[tuple[str, str]] | None = None,
    similarity: float = 0.8,
) -> DataFrame:
    """Verified matches: one row per key and licence with the best ``containment`` of one of its templates."""
    spark = docs.sparkSession
    known = template_keys(spark, TEMPLATES if templates is None else templates)
    base = docs.select(F.col(f"`{key}`").alias("key"), shingle_hashes(words_of(F.col(f"`{text}`"))).alias("hashes"))
    found = [_search(base, block, similarity) for block in in_blocks(known)]
    if not found:
        raise ValueError("no templates")
    return (
        reduce(DataFrame.unionAll, found)
        .groupBy(F.col("key").alias(key), "license")
        .agg(F.max("containment").alias("containment"))
    )


def _search(base: DataFrame, pieces: list[dict], similarity: float) -> DataFrame:
    spark = base.sparkSession
    keys = {m: sorted({h for p in pieces if p["m"] == m for _, h in p["least"]}) for m in {p["m"] for p in pieces}}
    literal = F.array(*[F.lit(k) for k in sorted({k for own in keys.values() for k in own})])
    near = base.where(F.arrays_overlap("hashes", literal))

    def starts(m: int) -> Column:
        """First shingles of the windows of size class ``m`` that hold a key of the class."""
        s = step_of(m)
        own = F.array(*[F.lit(k) for k in keys[m]])
        at = F.filter(
            F.transform("hashes", lambda h, i: F.when(F.array_contains(own, h), i)), lambda i: i.isNotNull()
        )
        first = lambda i: F.greatest(F.ceil((i - (m + s - 2)) / F.lit(s)).cast("int"), F.lit(0))
        return F.transform(
            F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(first(i), F.floor(i / F.lit(s)).cast("int"))))),
            lambda q: F.struct(F.lit(m).alias("m"), (q * s).alias("start"), F.lit(m + s - 1).alias("width")),
        )

    windows = near.select("key", "hashes", F.explode(F.concat(*[starts(m) for m in sorted(keys)])).alias("w")).select(
        "key", F.col("w.m").alias("m"), F.slice("hashes", F.col("w.start") + 1, F.col("w.width")).alias("window")
    )
    signed = windows.withColumn(
        "bands",
        F.array(
            *[
                F.struct(F.lit(b).alias("band"), F.array_min(band("window", b)).alias("k"))
                for b in range(BANDS)
            ]
        ),
    )
    rows = [
        (p["license"], p["m"], p["own"], [(b, k) for b, (k, _) in enumerate(p["least"])])
        for p in pieces
    ]
    table = spark.createDataFrame(
        rows, "license string, m int, own array<bigint>, keys array<struct<band:int,k:bigint>>"
    ).select("license", "m", "own", F.explode("keys").alias("b"))
    return (
        signed.select("key", "m", "window", F.explode("bands").alias("b"))
        .join(F.broadcast(table), ["m", "b"])
        .withColumn("containment", F.size(F.array_intersect("window", "own")) / F.size("own"))
        .where(F.col("containment") >= similarity)
        .select("key", "license", "containment")
    )
