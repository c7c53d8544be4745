from __future__ import annotations

import numpy as np
import pytest

from wayfare.llm import neighbour_search as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k):
    out = []
    for q, a in queries:
        scored = [(-float(N.cosine(np.array(a, float), np.array([b], float))[0]), v) for v, b in rows if v != q and len(a) == len(b)]
        out += [(q, r + 1, v, -s) for r, (s, v) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize(("block", "group"), [(64, 16), (8192, 1024)])
def test_matches_brute_force(spark, block, group):
    rng = np.random.default_rng(5)
    data = rng.standard_normal((400, 24)).astype(np.float32)
    data[50:120] = data[50]  # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    found = N.search(df, df.where("vec_id % 10 = 0"), block_rows=block, query_rows=group)
    got = sorted(tuple(r) for r in found.collect())
    expected = brute(rows, [r for r in rows if r[0] % 10 == 0], 5)
    hits = len({g[:3:2] for g in got} & {e[:3:2] for e in expected})
    assert hits / len(expected) >= 0.99
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert np.allclose([g[3] for g in got], [e[3] for e in expected], atol=1e-3)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, []),
            (8, [0.0, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (1, [3.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = sorted(tuple(r) for r in N.search(df, df.where("vec_id in (0, 2, 3, 4)")).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 1, 1.0), (0, 3, 8, 0.0)]
    assert N.search(df.limit(0), df.limit(0)).collect() == []


def test_error_bound_holds():
    rng = np.random.default_rng(1)
    unit = rng.standard_normal((2000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    codes, scalars = N.encode(unit, 256)
    assert codes.shape == (2000, 32)
    estimates, wrong = N.estimate(codes, scalars, unit[:50], 256, N.MARGIN)
    assert (np.abs(estimates - unit[:50] @ unit.T) <= wrong).mean() > 0.999
