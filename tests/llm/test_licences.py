"""The registered licence list: what it finds, and that relatives are told apart."""

import pytest

from replyforge.llm import license_scan, queries
from tests.llm.conftest import sentence

NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by "
    "the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)
LINES = [
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
     " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
     " provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("apache-2.0", "Distributed under the Apache License 2.0."),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "This project is licensed under the MIT license."),
    ("mit", "Released under the MIT License."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", NOTICE.format("General Public License", "3")),
    ("gpl-2.0", NOTICE.format("General Public License", "2")),
    ("lgpl-3.0", NOTICE.format("Lesser General Public License", "3")),
    ("lgpl-2.1", NOTICE.format("Lesser General Public License", "2.1")),
    ("agpl-3.0", NOTICE.format("Affero General Public License", "3")),
]


def test_the_registered_list(spark):
    rows = [(i, sentence(i, 30) + "\n" + text + "\n" + sentence(i + 50, 30)) for i, (_, text) in enumerate(LINES)]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["license"]) for r in found) == [(i, name) for i, (name, _) in enumerate(LINES)]


def test_each_template_names_one_licence(spark):
    rows = list(enumerate(t for _, t in license_scan.TEMPLATES))
    found = {}
    for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        found.setdefault(r["doc_id"], set()).add(r["license"])
    assert found == {i: {name} for i, (name, _) in enumerate(license_scan.TEMPLATES)}


def test_misses_of_edited_short_templates(spark):
    """Templates of five to nine shingles with one shingle lost; what the bands miss stays near the promised bound."""
    words = lambda i, m: [f"t{i}w{k}" for k in range(m + 4)]
    sizes = {i: 5 + i % 5 for i in range(800)}
    templates = [(f"l{i}", " ".join(words(i, m))) for i, m in sizes.items()]
    rows = [(i, " ".join([*words(i, m)[:-1], "other"])) for i, m in sizes.items()]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=templates, similarity=0.79)
    assert {(r["doc_id"], r["license"]) for r in found.collect()} <= {(i, f"l{i}") for i in sizes}
    assert len(rows) - found.count() <= 4  # 0.4 ** 8 of 800 would be one


@pytest.mark.parametrize("n", [37, 300])
def test_long_templates_are_judged_whole(spark, n):
    """A part of a template is not the template; 85 % of it in one place is."""
    words = [f"w{i}" for i in range(n)]
    around = sentence(1, 20).split()
    texts = {
        "tail": [*around, *words[-5:]],
        "half": [*around, *words[: n // 2], *around],
        "most": [*around, *words[: n * 9 // 10], *around],
        "whole": [*around, *words, *around],
        "cut": [*words[: n // 2], "x", *words[n // 2 :]],
        "apart": [*words[: n // 2], *[f"y{i}" for i in range(2 * n)], *words[n // 2 :]],
    }
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts.values())], "doc_id long, text string")
    found = {list(texts)[r["doc_id"]]: r["containment"] for r in license_scan.scan(docs, templates=[("long", " ".join(words))]).collect()}
    shingles = n - 4
    want = {"most": (n * 9 // 10 - 4) / shingles, "whole": 1.0, "cut": (shingles - 4) / shingles}
    assert found == pytest.approx(want)


def test_rows_without_a_key(spark):
    rows = [(None, "x Released under the MIT License. y"), (None, "nothing"), (1, "Licensed under CC BY 4.0."), (2, None)]
    found = queries.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, 1, "mit", 1.0), (None, 1, "mit", 1.0), (1, 1, "cc-by-4.0", 1.0), (2, 0, "", 0.0)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
