"""License scan against brute force: every rule on every text, every pair of intervals."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm import licenses

RULES = licenses.signature_rules()


def brute_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(doc_id, text):
    words = brute_words(text)
    joined = " " + " ".join(words) + " "
    found = []
    for i, rule in enumerate(RULES):
        for m in re.finditer(rf"(?<= )(?:{rule.pattern})(?= )", joined):
            first = joined.count(" ", 0, m.start()) - 1
            found.append((i, first, first + len(m.group().split(" "))))
    kept = []
    for i, f, e in found:
        inside = any((j, -(y - x)) < (i, -(e - f)) and x <= f and e <= y for j, x, y in found)
        if RULES[i].base or not inside:
            kept.append((i, f, e))
    base = [(i, f) for i, f, _ in kept if RULES[i].base]
    # Base places by their definition, without rules.
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    plain = [(i, label) for label, p in phrases.items() for i in range(len(words)) if words[i : i + len(p)] == p]
    assert sorted(f for _, f in base) == sorted(i for i, _ in plain)
    best = {}
    for i, _, _ in kept:
        best[RULES[i].label] = max(best.get(RULES[i].label, 0), RULES[i].weight)
    rest = 1.0
    for label in sorted(best):
        rest *= 1 - best[label]
    starts = [i for i, _ in plain]
    return (
        doc_id, len(words), len(plain), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in plain})), ",".join(sorted(best)), round(1 - rest, 9),
    )


SNIPPETS = [
    "SPDX-License-Identifier: GPL-2.0-or-later", "Licensed under the MIT License", "All Rights Reserved.", "CC-BY-SA 4.0",
    "GNU Lesser General Public License, version 2.1 or (at your option) any later version", "cc by", "mit", "general public license",
    "https://creativecommons.org/licenses/by-nc-nd/3.0/", "Apache License, Version 2.0", "apache-2.0", "GPLv3", "3-Clause BSD",
    "Creative Commons Attribution-NonCommercial 4.0 International Public License", "No part of this book may be reproduced",
    "© 2021 Someone", "public domain", "the", "by", "license", "version 2", "Ünïcode™", "\x00\x7f", "cc", "all rights",
]


def mixed(seed, n):
    chance = random.Random(seed)
    marks = [" ", " ", "\n", ", ", "-", ". ", "/", ""]
    return ["".join(chance.choice(SNIPPETS) + chance.choice(marks) for _ in range(chance.randrange(14))) for _ in range(n)]


def test_equals_brute_force(spark, make_documents, odd_rows):
    rows = odd_rows[:4] + odd_rows[5:] + list(enumerate(mixed(1, 120), start=100)) + list(enumerate(SNIPPETS, start=900))
    got = licenses.summary(licenses.scan(make_documents(rows))).collect()
    got = [(*tuple(r)[:7], round(r.score, 9)) for r in got]
    assert sorted(got, key=repr) == sorted((brute(*r) for r in rows), key=repr)


def test_spans_give_the_source_text(spark, make_documents):
    text = "Ünïcode 😀: GNU General Public License; v2. (CC-BY-4.0) 😀"
    found = licenses.scan(make_documents([(1, text)])).first().found
    assert {(d.label, text[d.start : d.end]) for d in found} >= {
        ("gpl-2.0", "GNU General Public License; v2"), ("gpl", "General Public License"), ("cc-by-4.0", "CC-BY-4.0"), ("cc-by", "CC-BY"),
    }
    assert [d.first_word for d in found] == sorted(d.first_word for d in found)


def test_very_long_text_and_many_places(spark, make_documents):
    text = ("cc by " * 20_000 + "word " * 300_000) + "all rights reserved"
    got = licenses.summary(licenses.scan(make_documents([(1, text)]))).first()
    assert (got.n_words, got.n_base, got.first_word, got.last_word) == (340_003, 20_001, 0, 340_000)
    assert got.base_labels == "cc-by,reserved"


def test_empty_table(spark, make_documents):
    assert licenses.summary(licenses.scan(make_documents([]))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(1, 5), st.integers(0, 3)), max_size=25))
def test_containment_equals_all_pairs(items):
    starts, sizes, ranks = (np.array([x[i] for x in items], np.int64) for i in range(3))
    got = licenses.contained(starts, starts + sizes, ranks)
    seen = []
    for i, (s, n, r) in enumerate(items):
        better = [(x, m, q) for j, (x, m, q) in enumerate(items) if (q, -m, j) < (r, -n, i) and x <= s and s + n <= x + m]
        seen.append(bool(better))
    assert got.tolist() == seen


@pytest.mark.parametrize("seed", range(4))
def test_keywords_hold_back_no_match(seed):
    gated, all_rules = licenses.Scanner(RULES), licenses.Scanner(RULES, gated=False)
    for text in mixed(seed, 60) + [r.pattern for r in RULES]:
        assert gated.detections(text.encode())[:2] == all_rules.detections(text.encode())[:2]


def test_hundreds_of_rules_in_order():
    assert len(RULES) > 400
    assert len({(r.label, r.pattern, r.base) for r in RULES}) == len(RULES)
    assert [r.base for r in RULES] == [False] * (len(RULES) - 3) + [True] * 3
    assert all(0 < r.weight < 1 and r.keys and "," not in r.label for r in RULES)
