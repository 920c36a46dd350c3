"""Licences as they are distributed, and the rules against all chains of sentences."""

import itertools
import random
import textwrap

import pytest
from pyspark.sql import functions as F

from lexiloom.llm import licences

S = licences.SENTENCES
MIT = f"MIT License\n\nCopyright (c) 2020 A. Person\n\n{S['mit-grant']}\n\n{S['mit-notice']}.\n\n{S['as-is']}. IN NO EVENT SHALL THE AUTHORS BE LIABLE.\n"
APACHE = (
    "Copyright 2020 A. Person\n\n" + S["apache-header"] + ".\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
    + S["apache-required"] + ".\n" + S["apache-limits"] + ".\n"
)
BSD = "".join([S["bsd-grant"], "\n\n1. ", S["bsd-source"], ".\n\n2. ", S["bsd-binary"], ".\n\n"])


def wrapped(text, mark="", width=70):
    """Lines of a width, each behind a comment mark."""
    lines = [w for line in text.split("\n") for w in (textwrap.wrap(line, width) or [""])]
    return "\n".join(mark + line for line in lines)


@pytest.mark.parametrize("mark", ["", "# ", "// ", " * ", ";; ", "-- ", "> ", "REM "])
@pytest.mark.parametrize("width", [40, 72, 10_000])
@pytest.mark.parametrize(
    "text, want",
    [(MIT, "MIT"), (APACHE, "Apache-2.0"), (S["gpl-free"] + ".\n\n" + S["gpl-hope"] + ".", "GPL-3.0"), (BSD, "BSD-2-Clause")],
    ids=["mit", "apache", "gpl", "bsd"],
)
def test_distributed_texts(text, want, mark, width):
    if mark == "REM " and width < 100:
        pytest.skip("a comment word inside a sentence is not taken away")
    _, _, found = licences.scan("def f(): pass\n" + wrapped(text, mark, width) + "\nimport os")
    assert {f[0] for f in found} == {want}


@pytest.mark.parametrize(
    "text, want",
    [
        ("This file is licensed under the MIT License, see LICENSE.", ["MIT"]),
        ("Hello there. Released under the MIT License. Bye.", ["MIT"]),
        ("/* SPDX-License-Identifier: GPL-2.0-only */", ["GPL-2.0"]),
        ("The code and the images are distributed under the terms of the BSD 3-Clause License.", ["BSD-3-Clause"]),
        ("Available under CC BY-SA 4.0", ["CC-BY-SA-4.0"]),
        ("(a) Licensed under the Apache License, Version 2.0 (the \"License\").", ["Apache-2.0"]),
        ("This file is not licensed under the MIT License.", []),
        ("Licensed under the MIT License or later on something else", []),
        ("We talk about software that you may copy", []),
    ],
)
def test_notices(text, want):
    assert [f[0] for f in licences.scan(text)[2]] == want


def test_every_known_sentence_is_found_as_itself():
    for text, name in [*licences.notices().items(), *((t, n) for n, t in S.items())]:
        n, ids, _ = licences.scan(f"Before it.\n{text}\nAfter it.")
        assert n == 1, text
        assert ids == name or licences.normalised(text) in {licences.normalised(t) for t in S.values()}
    assert {n for _, rule in licences.RULES for n in rule} <= set(S) | set(licences.notices().values())


def brute(known, rules):
    """Every chain of every rule tried, leftmost start and first end from there."""
    out = []
    for licence, rule in rules:
        chains = [
            c
            for c in itertools.combinations(range(len(known)), len(rule))
            if [known[i][0] for i in c] == list(rule) and all(known[b][1] - known[a][2] <= licences.GAP + 1 for a, b in zip(c, c[1:]))
        ]
        after = -1
        while usable := [c for c in chains if c[0] > after]:
            c = min(usable, key=lambda c: (c[0], c[-1]))
            out.append((licence, known[c[0]][3], known[c[-1]][4]))
            after = c[-1]
    return sorted(out, key=lambda m: (m[1], m[2], m[0]))


def test_rules_equal_all_chains(monkeypatch):
    rules = (("X", ("a",)), ("Y", ("a", "b")), ("Z", ("a", "b", "c")), ("W", ("b", "b", "a", "c")))
    monkeypatch.setattr(licences, "RULES", rules)
    rng = random.Random(8)
    for _ in range(1500):
        known, at = [], 0
        for k in range(rng.randrange(10)):
            at += rng.randrange(1, 5)
            known.append((rng.choice("abc"), at, at + rng.randrange(2), 10 * k, 10 * k + 5))
            at = known[-1][2]
        assert licences.matches(known) == brute(known, rules), known


def test_cases(spark):
    """Null, empty, repeated and very long texts, clashing columns, an empty table."""
    rows = [(1, None, "x"), (2, "", "x"), (3, MIT, "x"), (3, MIT, "x"), (4, "some words of a text. " * 50_000 + "\n" + MIT, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, licences string")
    out = table.select("doc_id", licences.licences(F.col("text")).alias("found")).select("doc_id", "found.*").collect()
    assert sorted((r.doc_id, r.licences) for r in out) == [(1, ""), (2, ""), (3, "MIT"), (3, "MIT"), (4, "MIT")]
    assert table.limit(0).select(licences.licences(F.col("text"))).count() == 0
