from __future__ import annotations

import random
import re

import pytest

from lakegate.llm import license_scan
from tests.llm.helpers import awkward, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def places(words):
    out = []
    for phrase, label in PHRASES.items():
        want = phrase.split()
        out += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return out


def scanned(spark, rows):
    return license_scan.digest(license_scan.scan(documents(spark, rows))).collect()


def test_base_columns_equal_brute_force(spark):
    rng = random.Random(4)
    bits = ["under the", "MIT", "license", "Apache License,", "Version 2.0", "CC-BY-NC", "cc by", "nc", "licensed under the", "élan"]
    rows = awkward([(100 + i, " ".join(rng.choices(bits, k=rng.randint(1, 60)))) for i in range(80)])
    rows += [(300, "under the mit license " * 500), (301, "cc by nc by nc cc by nc"), (302, "UNDER_THE-MIT\nLICENSEé"),
             (303, "under the mİt license"), (304, "Åunder the mit license")]
    got = {}
    for r in scanned(spark, rows):
        got.setdefault(r.doc_id, []).append(r)
    for key, text in rows:
        words = words_of(text)
        found = places(words)
        starts = [i for i, _ in found]
        want = (
            len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in found})),
        )
        r = got[key][0]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert sum(map(len, got.values())) == len(rows)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MIT License.", "mit"),
        ("Licensed under the Apache License, Version 2.0.", "apache-2"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("distributed under the terms of the GNU Lesser General Public License v2.1", "lgpl-2.1"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("licensed under CC BY-NC-SA 4.0", "cc-by-nc,cc-by-nc-sa"),
        ("SPDX-License-Identifier: GPL-3.0", "gpl-3"),
        ("License: BSD 3-Clause", "bsd-3"),
        ("available under the Mozilla Public Licence 2.0", "mpl-2"),
        ("All rights reserved.", "proprietary"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"),
        ("the licence plate of a car by the sea", ""),
    ],
)
def test_labels(spark, text, labels):
    assert scanned(spark, [(1, text)])[0].labels == labels


def test_contained_detections_go(spark):
    """The longer and stronger of overlapping signatures stays, the parts of it go; apart, both stay."""
    text = "licensed under the gnu general public license version 3 and more words here apache license"
    (row,) = license_scan.scan(documents(spark, [(1, text)])).collect()
    assert [(d.label, d.start, d.end) for d in row.detections] == [("gpl-3", 0, 9), ("apache", 13, 15)]


def test_many_rules_and_native_plan(spark):
    assert len(license_scan.RULES) > 300
    plan = license_scan.scan(documents(spark, [(1, prose(1, 5))]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert scanned(spark, []) == []
