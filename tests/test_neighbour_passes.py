"""Neighbour reports do no work that decides nothing: no cut that no group reaches, no second shuffle for hot keys."""

from __future__ import annotations

import pytest

from wayfare.functions.ranking import none_is_cut
from wayfare.operators import neighbours, ratings

COUNTS = "person_id long, place_id long, region_id long, category_id long, visits long"
VISITS = [(1, 10, 0, 100, 3), (1, 11, 0, 101, 1), (1, 12, 1, 100, 2), (2, 10, 0, 100, 4), (2, 12, 1, 100, 1), (None, 10, 0, 100, 9)]
SETS = [("s0", 0), ("s01", 0), ("s01", 1), ("s2", 2)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rated(spark, top_n):
    counts, sets = spark.createDataFrame(VISITS, COUNTS), spark.createDataFrame(SETS, "region_set string, region_id long")
    return [f(counts, sets, top_n) for f in (ratings.region_place_ratings, ratings.region_category_ratings)]


@pytest.mark.parametrize("top_n", [1, 2, 3, 9])
def test_ratings_are_the_same_with_and_without_a_cut(spark, monkeypatch, top_n):
    got = [sorted(map(tuple, r.collect())) for r in rated(spark, top_n)]
    for module in ("wayfare.functions.ranking", "wayfare.operators.ratings"):
        monkeypatch.setattr(f"{module}.none_is_cut", lambda *_: False)
    assert got == [sorted(map(tuple, r.collect())) for r in rated(spark, top_n)]
    assert got[0] and got[1] and not any(row[1] is None for rows in got for row in rows)


def test_a_cut_that_no_person_reaches_is_not_looked_for(spark):
    for found in rated(spark, 3):
        assert "Window" not in plan_of(found)
    for found in rated(spark, 1):
        assert "Window" in plan_of(found)


def test_groups_are_counted_up_to_the_cut(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "a long, b long")
    assert [none_is_cut(rows, ["a"], n) for n in (1, 2, 3)] == [False, True, True]
    assert none_is_cut(rows.where("a > 9"), ["a"], 1)
    with pytest.raises(ValueError):
        none_is_cut(rows, ["a"], 0)


def test_estimates_shuffle_each_side_once(spark):
    near = spark.createDataFrame([("s", 1, 2, 0.5), ("s", 1, 3, 0.25)], "region_set string, target_id long, person_id long, similarity double")
    places = spark.createDataFrame([("s", 2, 10, 4), ("s", 3, 10, 1), ("s", 3, 11, 2)], "region_set string, person_id long, place_id long, rating long")
    found = neighbours.estimated_ratings(places, near)
    # Neighbours, their ratings, and the estimates.
    assert plan_of(found).count("Exchange hashpartitioning") == 3
    assert {r.place_id: r.estimated_rating for r in found.collect()} == pytest.approx({10: 3.0, 11: 2.0})
