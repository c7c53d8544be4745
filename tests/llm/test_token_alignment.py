"""Token alignment against a brute-force version that links tokens one by one."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfare.llm import token_alignment as ta


@pytest.fixture(scope="module")
def both():
    return ta.tokenizers(ta.A_FILE, ta.B_FILE)


def brute_groups(both, text):
    """Groups of (A ids, B ids) by walking along both token lists, or none."""
    if not text:
        return []
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = both.b.encode(text)
    whole = b" " + text.encode()
    if b"".join(both.a_bytes[i] for i in a) != whole or b"".join(both.b_bytes[i] for i in b) != whole:
        return []
    groups, i, j = [], 0, 0
    while i < len(a):
        left, right = [a[i]], [b[j]]
        x, y = len(both.a_bytes[a[i]]), len(both.b_bytes[b[j]])
        while x != y:
            if x < y:
                i += 1
                left.append(a[i])
                x += len(both.a_bytes[a[i]])
            else:
                j += 1
                right.append(b[j])
                y += len(both.b_bytes[b[j]])
        groups.append((left, right))
        i, j = i + 1, j + 1
    return groups


def brute(both, rows):
    found = [(doc_id, brute_groups(both, text)) for doc_id, text in rows]
    links = [Counter((x, y) for left, right in groups for x in left for y in right) for _, groups in found]
    documents = Counter(pair for doc in links for pair in doc)
    highest = {}
    for (x, _), n in documents.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for (doc_id, groups), doc in zip(found, links):
        written = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        best = sum(n for (x, y), n in doc.items() if documents[x, y] == highest[x])
        total = sum(n * documents[p] for p, n in doc.items())
        sizes = [sum(len(g[k]) for g in groups) for k in (0, 1)]
        sha = hashlib.sha256(written.encode()).hexdigest() if groups else ""
        out.append((doc_id, *sizes, len(groups), sum(doc.values()), best, total, sha))
    return sorted(out, key=repr)


TEXTS = [
    "The quick brown fox, élan vital; naïve  résumé!",
    "über größe und maß: 12345 67 8.90 don't we'll",
    "newline\nand tab\tand  spaces   \n\n end ",
    "日本語のテキスト 😀👩‍👩‍👧 mixed \x00 nul",
    "<s> </s> <unk> <|endoftext|> <0x0A>",
    "▁ already a marked space",
    "xabababababababababababab",
    " leading and trailing ",
    "same same same same",
    "thninatnd erthoneat onenti",
]


@pytest.mark.parametrize("hot", [300_000, 40, 0])
def test_equals_brute_force(spark, both, make_documents, odd_rows, hot):
    rows = [(100 + i, t) for i, t in enumerate(TEXTS * 2)] + odd_rows
    chance = random.Random(4)
    words = " ".join(TEXTS).split(" ")
    rows += [(200 + i, " ".join(chance.choices(words, k=chance.randrange(30)))) for i in range(40)]
    got = ta.align_documents(make_documents(rows).repartition(5), hot=hot)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(both, rows)


def test_no_rows_and_no_tokens(spark, make_documents):
    assert ta.align_documents(make_documents([])).collect() == []
    got = ta.align_documents(make_documents([(1, None), (2, ""), (2, "")])).collect()
    assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 2)]


def test_slices_hold_the_same_pairs(both, monkeypatch):
    texts = [*TEXTS, "x" + "abé" * 3_000, "".join(random.Random(1).choices("aéb日 ", k=4_000))]
    texts = [t for t in texts if brute_groups(both, t)]
    a, b = both.encode(texts)
    whole = ta.align(both, a, b)
    monkeypatch.setattr(ta, "_PAIRS_AT_ONCE", 50)
    sliced = ta.align(both, a, b)
    assert len(whole.slices) == 1 and len(sliced.slices) > 3
    together = sorted(t for s in sliced.slices for t in zip(*map(np.ndarray.tolist, s)))
    assert together == sorted(zip(*map(np.ndarray.tolist, whole.slices[0])))
    assert all(np.array_equal(x, y) for x, y in zip(whole.same, sliced.same))
    assert whole.sha256 == sliced.sha256


def test_identity_map_holds_same_bytes_only(both):
    known = np.flatnonzero(both.same >= 0)
    assert len(known) > 5_000
    assert all(both.a_bytes[i] == both.b_bytes[both.same[i]] for i in known)
    assert both.same[both.a.token_to_id("<|endoftext|>")] == -1


ALPHABET = st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\r　'.,0123abcéß日😀́‍"))


@settings(max_examples=300, deadline=None)
@given(st.text(ALPHABET, max_size=60))
def test_both_encoders_of_a_agree(text):
    both = ta.tokenizers(ta.A_FILE, ta.B_FILE)
    assert both.a_fast.encode_ordinary(" " + text) == both.a.encode(" " + text, add_special_tokens=False).ids


def test_long_runs_encode(both):
    for text in (" " * 300_000, "a" * 300_000, "\n" * 150_000, "ab " * 60_000, "é" * 190_000):
        a, b = both.encode([text])
        assert both.spells(a[0], b[0], text)
