from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from wayfare.llm import words as W


def split(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))


@pytest.mark.parametrize("segment", [48, 1 << 20])
def test_shingles_match_plain_words(monkeypatch, segment):
    monkeypatch.setattr(W, "_SEGMENT", segment)
    rng, seen = random.Random(3), {}
    for turn in range(60):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice("aAbB é \n\t") for _ in range(rng.choice([0, 1, 3, 50, 200]))) for _ in range(rng.randint(0, 9))]
        array = pa.array(texts, pa.string()).slice(1 if texts and turn % 2 else 0)
        for row, until, chunk in W.word_chunks(array):
            hashes, bounds = chunk.shingles(3)
            for i in range(row, until):
                own = split(array[i].as_py() or "")
                expected = [tuple(own[k : k + 3]) for k in range(len(own) - 2)] or ([tuple(own)] if own else [])
                found = hashes[bounds[i - row] : bounds[i - row + 1]].tolist()
                assert len(found) == len(expected)
                for sequence, h in zip(expected, found):
                    assert seen.setdefault(sequence, h) == h
    assert len(set(seen.values())) == len(seen)


def test_prefixes_and_signs():
    _, _, chunk = next(W.word_chunks(pa.array(["stupidly, stupid!"]), signs=True, prefixes=(6,)))
    assert len(chunk.hashes) == 4
    assert chunk.prefixes[6][0] == chunk.prefixes[6][2] != chunk.hashes[0]
