"""The prefilters of the license rules drop no text that a rule matches."""

import random
import re
from re import _constants as c
from re import _parser

import pytest

from tidemark.llm import licenses

GATE = licenses.gate()
PATTERNS = [(r[1], r[2], r[5]) for r in licenses.rule_list()]


def samples(parsed):
    """Texts that a pattern matches, each alternative taken at least once."""
    parts = []
    for op, arg in parsed:
        if op is c.LITERAL:
            parts.append([chr(arg)])
        elif op is c.IN:
            kind, value = arg[0]
            parts.append([{c.LITERAL: lambda v: chr(v), c.RANGE: lambda v: chr(v[0]), c.CATEGORY: lambda v: {c.CATEGORY_DIGIT: "1", c.CATEGORY_SPACE: "\n      ", c.CATEGORY_WORD: "u"}[v]}[kind](value)])
        elif op is c.ANY:
            parts.append(["x"])
        elif op is c.BRANCH:
            parts.append([t for one in arg[1] for t in samples(one)])
        elif op is c.SUBPATTERN:
            parts.append(samples(arg[3]))
        elif op is c.MAX_REPEAT:
            parts.append([t * max(1, arg[0]) for t in samples(arg[2])] + [""] * (arg[0] == 0))
        else:
            assert op in (c.ASSERT_NOT, c.AT), op
    first = [p[0] for p in parts]
    return ["".join(first)] + ["".join([*first[:i], t, *first[i + 1 :]]) for i, p in enumerate(parts) for t in p[1:]]


def test_every_alternative_passes_its_filters():
    seen = 0
    for label, keywords, pattern in PATTERNS:
        for text in samples(_parser.parse(pattern)):
            if keywords == "spdx" and "spdx" not in pattern:  # one side of an expression, behind an identifier
                text = f"spdx-license-identifier: {text}"
            if re.search(pattern, text):
                seen += 1
                assert any(g in text for g in GATE) and any(k in text for k in keywords.split("|")), (label, text)
    assert seen > 3000


def test_rules_are_plain_and_many():
    rules = licenses.rule_list()
    assert len(rules) > 400 and len({r[5] for r in rules}) > 400 and len(licenses.SIGNATURES) > 120
    assert not any(" " in k for r in rules for k in r[2].split("|"))  # words of a text may be wrapped anywhere
    assert not any("[" in x and " " in x.split("[", 1)[1].split("]")[0] for x in (r[4] for r in licenses.SIGNATURES))


MIT = """Permission is hereby granted, free of charge, to any person obtaining
 * a copy of this software and associated documentation files (the "Software"),
 * to deal in the Software without restriction, including without limitation the
 * rights to use, copy, modify, merge, publish, distribute, sublicense, and/or
 * sell copies of the Software."""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


@pytest.mark.parametrize(
    ("label", "text"),
    [
        ("apache", "licensed under\n# the apache\n# license"),
        ("cc-by", "Creative Commons Attribution 4.0 terms"),
        ("cc-by-sa", "creative commons attribution share alike"),
        ("mit", MIT),
        ("gpl", GPL),
        ("bsd-3-clause", "Neither the name of the\n// Regents nor the names of its\n// contributors may be used to endorse or promote\n// products derived"),
        ("cc-by-nc-sa", "see https://creativecommons.org/licenses/by-nc-sa/4.0/"),
        ("apache", '"license": "Apache-2.0",'),
        ("unlicense", "This is free and unencumbered\n software released into the public domain."),
        ("proprietary", "Unauthorized copying of this file, via any medium, is strictly prohibited"),
    ],
)
def test_wording_of_licenses(spark, label, text):
    row = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert label in row["labels"], row
    for d in row["detections"]:
        assert 0 <= d["start"] < d["end"] <= len(text)


def test_plain_prose_has_no_license(spark):
    text = "The train left at noon, and nobody who stood there thought of papers, rights or courts; they waved until it was gone behind the hill."
    row = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["labels"] == [] and row["score"] == 0


@pytest.mark.parametrize(
    ("label", "text"),
    [
        ("cc-by", "available under Creative Commons Attribution 4.0"),
        ("mit", "the X11 License"),
        ("mit", "the Expat License"),
        ("lgpl", "GNU Library General Public License"),
        ("ncsa", "NCSA Open Source License"),
        ("wtfpl", "do what the fuck you want to public license"),
        ("apache", "under the Apache\n        License"),
        ("public-domain", "placed in the public\n        domain"),
    ],
)
def test_forms_that_were_left_out(spark, label, text):
    row = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert label in [d["label"] for d in row["detections"]]


def plainly(text):
    """Labels and score of all rules by the re module alone: every match of every rule, without those
    in another one of the same or a higher priority."""
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    found = [(m.start(), m.end(), r[3], r[0], r[1], r[4]) for r in licenses.rule_list() if any(k in low for k in r[2].split("|")) for m in re.finditer(r[5], low, re.ASCII)]
    order = sorted(found, key=lambda d: (d[0], -d[1], -d[2], d[3]))
    kept = [d for i, d in enumerate(order) if not any(e[1] >= d[1] and e[2] >= d[2] for e in order[:i])]
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = {label for p, label in licenses.PHRASES if any(words[i : i + len(p.split())] == p.split() for i in range(len(words)))}
    return sorted(base | {d[4] for d in kept}), max([d[5] for d in kept] + [0.5] * bool(base) + [0.0]), sorted((d[0], d[1], d[4]) for d in kept)


BITS = (
    "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause", "BSD 3-Clause License", "BSD-2-Clause", "GPLv3", "GNU LGPL v2.1", "Apache 2.0", "MIT-Lizenz", "sous licence Creative Commons",
    "bajo licencia Creative Commons Atribución", "Alle Rechte vorbehalten", "tous droits réservés", "the vim license plate", "the artistic license he took", "CC-BY 4.0", "all rights reserved.",
    "Released under the MIT License,", "the GNU General Public License, version 2 or later", "under the terms of the", "Apache License, Version 2.0", "license: ISC", "public domain", "nothing", "copyright (c) 2020 x", "\n * ", "-",
)


def test_all_rules_against_the_plain_version(spark):
    rng = random.Random(7)
    texts = [*BITS, MIT, GPL, "", None, *["".join(rng.choice(BITS) + rng.choice([" ", "\n", ". "]) for _ in range(rng.randint(2, 12))) for _ in range(60)]]
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        labels, score, places = plainly(texts[r["doc_id"]])
        assert (r["labels"], r["score"]) == (labels, score), texts[r["doc_id"]]
        assert [(d["start"], d["end"], d["label"]) for d in r["detections"] or []] == places


@pytest.mark.parametrize(
    "text,labels",
    [
        ("SPDX-License-Identifier: (MIT OR Apache-2.0)", ["apache", "mit"]), ("// SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note", ["gpl"]), ("spdx-license-identifier: MIT AND (BSD-3-Clause OR ISC)", ["bsd", "isc", "mit"]),
        ("BSD 3-Clause License", ["bsd"]), ("BSD-2-Clause", ["bsd"]), ("GPLv3", ["gpl"]), ("GNU LGPL v2.1", ["lgpl"]), ("Apache 2.0", ["apache"]), ("MIT-Lizenz", ["mit"]),
        ("sous licence Creative Commons", ["creative-commons"]), ("bajo licencia Creative Commons Atribución", ["creative-commons"]), ("Alle Rechte vorbehalten", ["reserved"]), ("tous droits réservés", ["reserved"]),
        ("todos los derechos reservados", ["reserved"]), ("licencia pública general de GNU", ["gpl"]), ("the vim license plate", []), ("the artistic license he took", []), ("a car with apache horses 2", []), ("gplot 3", []),
    ],
)
def test_names_that_scans_meet_most(text, labels):
    assert [x for x in plainly(text)[0]] == labels
