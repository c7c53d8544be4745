"""Collocations against a brute-force count of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from wayfare.llm.phrases import collocations


def brute(rows, least, longest=5, percent=100, best=2_000):
    totals, counts = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), f in found.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                if 100 * f >= percent * found[lang, words[i : i + m]]:
                    gone.add((lang, words[i : i + m]))
    out = {}
    for (lang, words), a in found.items():
        if (lang, words) not in gone:
            cuts = []
            for k in range(1, len(words)):
                left, right = counts[lang, words[:k]], counts[lang, words[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return {
        (lang, i, p.decode(), -a, left, right, totals[lang], -s)
        for lang, rows in out.items()
        for i, (s, a, p, left, right) in enumerate(sorted(rows)[:best], start=1)
    }


def rows_of(spark, rows, **options):
    df = spark.createDataFrame([(i, t, x, "own") for i, (t, x) in enumerate(rows)], "doc_id long, text string, lang string, n string")
    got = [tuple(r) for r in collocations(df, **options).collect()]
    assert len(set(got)) == len(got)
    return set(got)


def invented(seed, texts=80, words=14):
    chance = random.Random(seed)
    names = [f"W{i}é" if i % 3 else f"v{i}" for i in range(words)]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "! "]
    rows = []
    for _ in range(texts):
        text = "".join(chance.choice(names[: 1 + chance.randrange(words)]) + chance.choice(marks) for _ in range(chance.randrange(60)))
        rows.append((text, chance.choice(["en", "de", None, "und"])))
    return rows + [("the whole passage repeats here, always", "en")] * 30 + [("a a a a a a a", "de")] * 20


@pytest.mark.parametrize("budget", [500_000, 40, 2])
def test_equals_brute_force_for_every_budget_of_groups(spark, budget):
    rows = invented(3)
    assert rows_of(spark, rows, least=8, budget=budget) == brute(rows, 8)


@pytest.mark.parametrize(("least", "longest", "percent", "best"), [(3, 3, 100, 7), (5, 5, 80, 2_000), (8, 2, 100, 3)])
def test_other_parameters(spark, least, longest, percent, best):
    rows = invented(5, texts=60)
    options = dict(least=least, longest=longest, percent=percent, best=best)
    assert rows_of(spark, rows, **options) == brute(rows, **options)


def test_odd_rows(spark, odd_rows):
    rows = [(t, None) for _, t in odd_rows]
    assert rows_of(spark, rows, least=2, best=20_000) == brute(rows, 2, best=20_000)


def test_nothing_to_find(spark):
    assert rows_of(spark, []) == set()
    assert rows_of(spark, [(None, None), ("", "en"), ("only once here", "en")], least=2) == set()


def test_ties_go_by_the_bytes_of_the_phrase(spark):
    rows = [(f"{w} x{w}", "en") for w in ("b", "é", "ｚ", "😀", "B") for _ in range(3)]
    assert rows_of(spark, rows, least=3, best=3) == brute(rows, 3, best=3)


def test_products_beyond_64_bits(spark):
    counts = [[5_000_000_000_000, 40_000_000_000_000, 3, 7]]
    a, n, left, right = counts[0]
    big = "decimal(20,0)"
    df = spark.createDataFrame(counts, "a long, n long, l long, r long")
    got = df.selectExpr(f"(cast(a as {big}) * cast(n as {big}) * 1000) div (cast(l as {big}) * cast(r as {big}) * 1000000000000) as x")
    assert got.first()[0] == 1000 * a * n // (left * right * 10**12)
