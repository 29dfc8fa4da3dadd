"""Headers, whole files and negations against the templates, and scores against a direct computation."""

from __future__ import annotations

import math
import re
from collections import Counter

from conftest import prose
from pyspark.sql import functions as F

from ledgerlift.llm import licenses
from ledgerlift.llm.license_texts import TEXTS, forms

GPL_HEADER = """# -*- coding: utf-8 -*-
# Copyright 2019 Somebody
#
# This program is free software: you can redistribute it and/or
# modify it under the terms of the GNU General Public License as
# published by the Free Software Foundation, either version 3 of
# the License, or (at your option) any later version.

import os
"""
APACHE_HEADER = """/*
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 */
package some.thing;
"""
FILES = {
    1: ("a/gpl.py", GPL_HEADER + prose(1, 30)),
    2: ("a/apache.java", APACHE_HEADER + prose(2, 30)),
    3: ("mit/LICENSE", "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + re.sub(r"\s+", " ", dict(TEXTS)["MIT"])),
    4: ("mit/deep/er/file.c", prose(4, 8)),
    5: ("isc/COPYING", "\n".join(re.findall(r".{1,60}(?:\s|$)", re.sub(r"\s+", " ", dict(TEXTS)["ISC"])))),
    6: ("none/a.txt", "We are not released under the MIT License.\n" + prose(6, 8)),
    7: ("none/b.txt", prose(7, 20)),
    8: ("spdx/a.rs", "// SPDX-License-Identifier: BSD-3-Clause\n" + prose(8, 9)),
    9: ("line/a.txt", prose(9, 5) + "\nAll of it. Licensed under CC BY-SA 4.0. No more.\n" + prose(10, 5)),
    10: ("bsd/notice.txt", dict(TEXTS)["BSD-3-Clause"]),
    11: ("null/a.txt", None),
    12: ("null/b.txt", ""),
    13: (None, "Released under the ISC License"),
}
WANTED = {1: "GPL-3.0", 2: "Apache-2.0", 3: "MIT", 5: "ISC", 8: "BSD-3-Clause", 9: "CC-BY-SA-4.0", 10: "BSD-3-Clause", 13: "ISC"}


def table(spark):
    return spark.createDataFrame([(k, p, t, 1, "x") for k, (p, t) in FILES.items()], "doc_id long, at string, text string, n int, line string")


def test_headers_files_and_negations(spark):
    got = {r["id"]: r for r in licenses.scan(table(spark), F.col("at")).collect()}
    assert {k: r["own"] for k, r in got.items() if r["own"]} == WANTED
    assert got[4]["license"] == "MIT" and got[4]["from_path"] == "mit/LICENSE"
    assert got[6]["license"] is None and got[7]["license"] is None and got[11]["license"] is None


def test_no_match_is_lost_by_the_gate(spark):
    """Scores of all units, without a gate, computed directly."""
    rows = {k: t or "" for k, (_, t) in FILES.items()}
    terms = {k: re.findall(licenses.TERM, t.lower()) for k, t in rows.items()}
    df = Counter(x for t in terms.values() for x in set(t))

    def vector(text: str) -> dict[str, float]:
        made = {x: n * max(math.log((len(rows) + 1) / (df[x] + 1)), 0.01) for x, n in Counter(re.findall(licenses.TERM, text.lower())).items()}
        norm = math.sqrt(sum(w * w for w in made.values()))
        return {x: w / norm for x, w in made.items()}

    model = [(name, vector(text)) for name, text in forms()]
    wanted = {}
    for key, text in rows.items():
        for unit in {u for u in re.split(licenses.UNIT_END, text) if re.search(licenses.TERM, u.lower())}:
            x = vector(unit)
            score, name = min((-round(sum(w * x.get(t, 0) for t, w in y.items()), 9), name) for name, y in model)
            if -score >= 0.6:
                wanted[key, unit] = (name, round(-score, 6))
    docs = table(spark)
    rare = licenses.rarities(docs, "text")
    model = licenses.templates(spark, rare, len(rows))
    found = licenses.candidates(docs, F.col("at"), "doc_id", "text", model, 0.6).select("id", F.explode("found").alias("text"))
    found = found.withColumn("line", licenses.digest(F.col("text")))
    best = licenses.nearest(found.select("line", "text").distinct(), model, rare, len(rows), 0.6)
    got = {(r["id"], r["text"]): (r["best"]["name"], round(-r["best"]["minus"], 6)) for r in found.join(best, "line").collect()}
    assert len(wanted) > 8 and {k: got.get(k) for k in wanted} == wanted


def test_long_file_of_units(spark):
    docs = spark.createDataFrame([(1, "a/b", "the license file. " * 60_000), (2, "a/c", "x\n" * 200_000 + "Released under the MIT License")], "doc_id long, at string, text string")
    got = {r["id"]: r["own"] for r in licenses.scan(docs, F.col("at")).collect()}
    assert got[2] == "MIT"
