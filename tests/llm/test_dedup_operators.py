from __future__ import annotations

import random
import re

import pytest
import xxhash

from wayfare.llm import decontaminate
from wayfare.llm import jaccard_join as J
from wayfare.llm import line_dedup as D
from wayfare.llm.components import connected_components


def shingle_set(text: str | None, n: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if 0 < len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute_components(rows, n, num, den):
    """(doc_id, size, component) of each row, by comparing all pairs."""
    sets = [(r[0], shingle_set(r[1], n)) for r in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is not None and j is not None and a and b and den * len(a & b) >= num * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def near_copies(seed: int) -> list[tuple[int, str]]:
    """Chains and groups of near copies of several lengths, with exact copies and a common line."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    rows, base = [], []
    for length in (2, 8, 30, 80, 200):
        base = [word() for _ in range(length)]
        for _ in range(14):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(len(text))] = word()
            rows.append((len(rows), " ".join(text) + (" the same common closing line here" if rng.random() < 0.5 else "")))
            if rng.random() < 0.3:
                base = text
    return rows + [(len(rows) + i, rows[3 * i][1].upper()) for i in range(10)]


@pytest.mark.parametrize(("words", "num"), [(3, 90), (5, 80), (2, 50)])
def test_components_equal_brute_force(make_documents, words, num):
    rows = near_copies(words)
    got = J.near_duplicates(make_documents(rows), words, num, 100).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows, words, num, 100)


def test_odd_rows(make_documents, odd_rows):
    got = J.near_duplicates(make_documents(odd_rows), 5, 80, 100).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(odd_rows, 5, 80, 100)
    assert J.near_duplicates(make_documents([])).collect() == []


def test_keep_one_each(make_documents, odd_rows):
    documents = make_documents(odd_rows)
    kept = J.keep_one_each(documents)
    assert kept.columns == documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i in (1, 2, 3, 4, 5, 6, 8, 8, None, 9))


def test_rows_that_count_cells_survive_large_gaps():
    import numpy as np
    import pyarrow as pa

    cells = np.zeros(3 * J._CHUNK, np.uint16)
    cells[[0, 1, 256, 700, J._CHUNK - 1, J._CHUNK + 5000, 3 * J._CHUNK - 1]] = [1, 300, 2, 3, 4, 5, 6]
    rows = list(zip(*J._cell_rows(cells)))
    batch = pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())], names=["row", "gaps", "counts"])
    levels = {r: np.frombuffer(v, np.uint8) for r, v in zip(*[c.to_pylist() for c in next(J._levels([batch])).columns])}
    got = np.concatenate([levels.get(i, np.zeros(J._CHUNK, np.uint8)) for i in range(3)])
    assert np.array_equal(got, np.round(4 * np.log2(1 + np.minimum(cells, 255).astype(float))).astype(np.uint8))


def test_connected_components(spark):
    links = [(i + 1, i) for i in range(40)] + [(100, 300), (300, 200), (200, 100), (7, 7)] + [(500, 501 + i) for i in range(50)]
    got = dict(connected_components(spark.createDataFrame(links, "a long, b long")).select("id", "component").collect())
    expected = {i: 0 for i in range(41)} | {i: 100 for i in (100, 200, 300)} | {i: 500 for i in range(500, 551)}
    assert got == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_lines(rows, gram=D.GRAM_WORDS, window=D.WINDOW_WORDS, run=D.RUN_WORDS):
    """Words deleted from each (id, text), by comparing from first occurrences, with plain loops."""
    texts = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is None, r[0] or 0))
    lines = {r: [x.strip() for x in r[1].split("\n") if x.strip()] for r in texts}
    first, prints = {}, {}
    for r in texts:
        own, count = lines[r], [len(x.split()) for x in lines[r]]
        grams = {}
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                if sum(count[a:b]) >= gram:
                    hashes = b"".join(xxhash.xxh3_64_intdigest(x.encode()).to_bytes(8, "little") for x in own[a:b])
                    grams[a] = (xxhash.xxh3_64_intdigest(hashes), tuple(own[a:b]))
                    break
        windows = [(a, b) for a in range(len(grams)) for b in [next((b for b in range(a + 1, len(grams) + 1) if sum(count[a:b]) >= window), None)] if b]
        windows = windows or [(0, len(grams))] * bool(grams)
        chosen = {min(range(a, b), key=lambda k: (grams[k][0], -k)) for a, b in windows}
        prints[r] = [(grams[k][1], k) for k in sorted(chosen)]
        for g, k in prints[r]:
            first.setdefault(g, (r, k))
    out = {}
    for r in texts:
        gone, own = set(), lines[r]
        for g, k in prints[r]:
            other, m = first[g]
            if (other, m) == (r, k):
                continue
            a, b, c = k, m, k
            while a and b and own[a - 1] == lines[other][b - 1]:
                a, b = a - 1, b - 1
            while c < len(own) and m + c - k < len(lines[other]) and own[c] == lines[other][m + c - k]:
                c += 1
            if sum(len(x.split()) for x in own[a:c]) >= run:
                gone.update(range(a, c))
        out[r] = sum(len(own[k].split()) for k in gone)
    return out


def test_line_dedup_equals_brute_force(make_documents):
    rng = random.Random(7)
    line = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    passage = [line(n) for n in (9, 15, 12, 20, 8)]
    long_line, common = line(55), line(12)
    rows = []
    for i in range(40):
        own = [line(rng.choice([1, 5, 12, 25])) for _ in range(rng.randrange(1, 7))] + [common]
        if i % 3 == 0:
            own[1:1] = passage[: rng.randrange(2, 6)]
        if i % 4 == 0:
            own.insert(rng.randrange(len(own)), "  " + long_line + " ")
        if i % 7 == 0:
            own += ["", own[0], passage[0], passage[1], passage[2], ""]
        rows.append((i, "\n".join(own)))
    rows += [(100, rows[5][1]), (101, rows[5][1]), (102, "\n".join(["x " * 25] * 6))]
    expected = brute_lines(rows)
    got = {(r.doc_id, t): r._words_deleted for (_, t), r in zip(sorted(rows), sorted(D.delete_repeated_lines(make_documents(rows)).collect(), key=lambda r: r.doc_id))}
    assert got == expected
    assert sum(v > 0 for v in expected.values()) > 15
    # A passage of over 50 words in one line, or over several, goes from all but its first document.
    texts = {r.doc_id: r.text for r in D.delete_repeated_lines(make_documents(rows)).collect()}
    assert sum(long_line in t for t in texts.values()) == 1
    assert all(common in t for i, t in texts.items() if i < 40 and i % 7)


def brute_runs(rows, run=D.RUN_WORDS):
    """Words deleted from each document: those of lines in any run of ``run`` words that stands earlier, comparing all runs."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        own = [x.strip() for x in t.split("\n") if x.strip()]
        gone, count = set(), [len(x.split()) for x in own]
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                if sum(count[a:b]) >= run:
                    if tuple(own[a:b]) in seen:
                        gone.update(range(a, b))
                    seen.add(tuple(own[a:b]))
        out[i] = sum(count[k] for k in gone)
    return out


def test_line_dedup_finds_runs_whose_first_lines_stand_elsewhere(make_documents):
    rng = random.Random(8)
    line = lambda n: " ".join(f"v{rng.randrange(50_000)}" for _ in range(n))
    f, y, g, tail = line(35), line(18), line(45), line(9)
    alone = [(1, f), (2, f"{line(30)}\n{f}\n{y}\n{line(30)}"), (3, f"{line(31)}\n{f}\n{y}\n{line(33)}")]
    # A whole run stands first without the line that follows it in two later documents.
    alone += [(4, g), (5, f"{g}\n{tail}"), (6, f"{g}\n{tail}\n{line(20)}"), (7, f"{line(9)}\n{f}")]
    got = {r.doc_id: r._words_deleted for r in D.delete_repeated_lines(make_documents(alone), every_run=True).collect()}
    assert got == {1: 0, 2: 0, 3: 53, 4: 0, 5: 45, 6: 54, 7: 0} == brute_runs(alone)
    # Short lines in the same order, beginning and ending anywhere.
    shared = [line(rng.choice([1, 3, 7, 12, 19, 34])) for _ in range(30)]
    rows = []
    for i in range(60):
        a, b = rng.randrange(24), rng.randrange(24)
        rows.append((i, "\n".join([line(8), *shared[a : a + rng.randrange(1, 8)], line(5), *shared[b : b + rng.randrange(1, 8)], line(8)])))
    expected = brute_runs(rows)
    assert {r.doc_id: r._words_deleted for r in D.delete_repeated_lines(make_documents(rows + rows[:9]), every_run=True).collect()} == expected
    assert sum(v > 0 for v in expected.values()) > 20
    assert sum(brute_lines(rows).values()) < sum(expected.values())


def test_line_dedup_odd_rows(make_documents, odd_rows):
    documents = make_documents(odd_rows)
    done = D.delete_repeated_lines(documents).collect()
    assert len(done) == len(odd_rows)
    assert {(r.doc_id, r.text) for r in done} == set(odd_rows)
    assert {r.row for r in done} == {"own"}
    kept = D.dedup_documents(make_documents([(1, "a b " * 30), (2, "a b " * 30), (3, ""), (4, None), (5, "c")], extra=False))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4, 5]
    assert D.dedup_documents(make_documents([])).collect() == []


def test_cut_takes_blank_lines_inside_a_run():
    assert D.cut("a\n\nb\n\nc", [(0, 2)]) == ("\nc", 3, 2)


def test_rows_without_an_id_take_part(spark, make_documents):
    """A null id neither saves a copy nor a leak; of equal rows one stays; texts without words all stay."""
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(None, text), (4, text + " end"), (3, text), (3, text), (None, other), (None, other), (None, None), (8, ""), (8, "")]
    kept = J.keep_one_each(make_documents(rows))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(3, text), (None, other), (None, None), (8, ""), (8, "")], key=repr
    )
    assert kept.columns == make_documents(rows).columns
    benchmark = spark.createDataFrame([(1, other)], "item_id long, text string")
    left = decontaminate.clean_documents(make_documents(rows), benchmark)
    assert sorted((r.text or "" for r in left.collect())) == sorted(["", "", "", text, text, text, text + " end"])
