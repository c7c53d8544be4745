"""The search of benchmark items looks only where a passage can reach an item, and misses none."""

from __future__ import annotations

import random

import numpy as np

from wayfare.llm import decontaminate
from wayfare.llm.words import hash_words


def built(items=300):
    chance = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    return decontaminate.Index.build([(n, " ".join(chance.choices(words, k=30))) for n in range(items)])


def query_of(index, text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return sorted({t for t in index.lookup(hash_words(raw, np.array([0, len(raw)]), signs=True).hashes).tolist() if t >= 0})


def brute(index, query):
    scores = [sum(i[p.index(n)] for p, i in ((index.postings[t], index.impacts[t]) for t in query) if n in p) for n in range(len(index.ids))]
    return {n: round(s, 9) for n, s in enumerate(scores) if s >= 1}


def test_only_ranges_in_reach_are_searched(monkeypatch):
    index, searched = built(), []

    def watched(self, number, query, plain=decontaminate.Index._retrieve_in):
        searched.append(number)
        return plain(self, number, query)

    monkeypatch.setattr(decontaminate.Index, "_retrieve_in", watched)
    raw = np.frombuffer(index.texts[17].encode(), np.uint8)
    found = index.search(hash_words(raw, np.array([0, len(raw)]), signs=True))
    assert {n: round(s, 9) for _, n, s in found} == brute(index, query_of(index, index.texts[17]))
    assert 17 // 5 in searched and len(searched) < 16


def test_ranges_miss_no_item():
    index, chance = built(), random.Random(7)
    for n in chance.sample(range(300), 25):
        query = query_of(index, " ".join([index.texts[n], index.texts[n - 1][:60]]))
        assert {i: round(s, 9) for i, s in index.retrieve(query)} == brute(index, query)
