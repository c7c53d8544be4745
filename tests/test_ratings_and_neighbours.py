"""Ratings, rating vectors, similarities and estimates."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from wayfare.operators import neighbours, ratings, region_sets

VISIT = "person_id long, place_id long, category_id long, region_id long"
RATED = "region_set string, person_id long, {} long, rating long"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def vector(*entries):
    if not entries:
        return F.expr("cast(array() as array<struct<index: int, value: double>>)")
    return F.array(*[F.struct(F.lit(i).alias("index"), F.lit(float(v)).alias("value")) for i, v in entries])


@pytest.mark.parametrize("entries,norm", [([], 0), ([(0, 1)], 1), ([(0, 3), (1, 4)], 5), ([(0, -3), (1, -4)], 5)])
def test_vector_norm(spark, entries, norm):
    assert spark.range(1).select(ratings.vector_norm(vector(*entries)).alias("n")).first().n == norm


def test_ratings_keep_ties(spark):
    visits = [(1, 10, 100, 0)] * 3 + [(1, 11, 100, 0)] * 2 + [(1, 12, 101, 0)] * 2 + [(1, 13, 101, 0), (2, 13, 101, 0)]
    got = ratings.ratings(spark.createDataFrame(visits, VISIT), "place_id", 2)
    assert got.columns == ["person_id", "place_id", "rating"]
    assert rows(got) == [(1, 10, 3), (1, 11, 2), (1, 12, 2), (2, 13, 1)]


def test_rating_vectors(spark):
    rated = spark.createDataFrame([(1, 12, 2), (1, 3, 5), (2, 7, 1)], "person_id long, place_id long, rating long")
    got = {r.person_id: [tuple(e) for e in r.rating_vector] for r in ratings.rating_vectors(rated, "place_id").collect()}
    assert got == {1: [(3, 5.0), (12, 2.0)], 2: [(7, 1.0)]}
    assert ratings.vector_size(rated, "place_id").first().size == 13
    assert ratings.vector_size(rated.limit(0), "place_id").first().size is None
    for bad in (2**31, -1):
        wrong = rated.union(spark.createDataFrame([(3, bad, 1)], rated.schema))
        with pytest.raises(Exception, match="does not fit a vector index"):
            ratings.vector_size(wrong, "place_id").collect()


def test_region_ratings_equal_each_slice(tables, facts):
    sets = region_sets.all_region_sets(tables.places())
    counts = ratings.visit_counts(facts[7])
    places = ratings.region_place_ratings(counts, sets, 3)
    categories = ratings.region_category_ratings(counts, sets, 2)
    for key in ("region2", "region0_region1"):
        regions = [r.region_id for r in sets.where(F.col("region_set") == key).collect()]
        part = facts[7].where(F.col("region_id").isin(regions))
        for together, entity, n in ((places, "place_id", 3), (categories, "category_id", 2)):
            got = together.where(F.col("region_set") == key).select("person_id", entity, "rating")
            assert rows(got) == rows(ratings.ratings(part, entity, n))


PLACES = [(1, 10, 2), (1, 11, 1), (2, 10, 4), (2, 11, 2), (2, 12, 5), (3, 12, 1), (4, 11, 3), (5, 13, 1), (6, 10, 9)]
CATEGORIES = [(1, 100, 3), (2, 100, 6), (2, 101, 5), (3, 101, 1), (4, 100, 3), (5, 101, 1), (7, 100, 1)]


def tables_of(spark, sets=("s",)):
    def rated(found, entity):
        return spark.createDataFrame([(s, *r) for s in sets for r in found], RATED.format(entity))

    return rated(PLACES, "place_id"), rated(CATEGORIES, "category_id")


def by_hand(person, place_weight=0.25, category_weight=0.75):
    def cosines(found):
        vectors = {}
        for p, e, r in found:
            vectors.setdefault(p, {})[e] = r
        mine = vectors[person]
        length = lambda v: math.sqrt(sum(x * x for x in v.values()))
        return {
            p: sum(x * v.get(e, 0) for e, x in mine.items()) / (length(mine) * length(v))
            for p, v in vectors.items()
            if p != person
        }

    by_place, by_category = cosines(PLACES), cosines(CATEGORIES)
    total = {
        p: by_place.get(p, 0) * place_weight + by_category.get(p, 0) * category_weight
        for p in by_place.keys() | by_category.keys()
    }
    return {p: s for p, s in total.items() if s > 0}


@pytest.mark.parametrize("limit", [500_000, 0])
def test_similar_persons(spark, monkeypatch, limit):
    """Both ways of joining, with few targets broadcast and with a shuffle."""
    monkeypatch.setattr(neighbours, "MAX_BROADCAST_TARGET_ROWS", limit)
    asked = spark.createDataFrame(
        [("s", 1), ("s", 3), ("t", 1), ("s", 6), ("s", 7), ("s", 99)], "region_set string, person_id long"
    )
    found = neighbours.similar_persons(*tables_of(spark, ("s", "t")), asked, 0.25, 0.75, 100)
    got = {}
    for r in found.collect():
        got.setdefault((r.region_set, r.target_id), {})[r.person_id] = r.similarity
    # 6 has no category ratings and 7 no place ratings, so neither can be served.
    assert set(got) == {("s", 1), ("s", 3), ("t", 1)}
    for (_, target), similar in got.items():
        assert similar == pytest.approx(by_hand(target))
    assert {6, 7} <= set(got[("s", 1)])


@pytest.mark.parametrize("k", [1, 2])
def test_estimates(spark, k):
    asked = spark.createDataFrame([("s", 1)], "region_set string, person_id long")
    found = neighbours.knn_recommend(*tables_of(spark), asked, 0.25, 0.75, k)
    nearest = sorted(by_hand(1).items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
    sums = {}
    for person, similarity in nearest:
        for p, place, rating in PLACES:
            if p == person:
                weighted, weights = sums.get(place, (0, 0))
                sums[place] = (weighted + rating * similarity, weights + similarity)
    got = {r.place_id: r.estimated_rating for r in found.collect()}
    assert got == pytest.approx({place: a / b for place, (a, b) in sums.items()})


@pytest.mark.parametrize("weights,k", [((0.5, 0.6), 1), ((0.0, 1.0), 1), ((0.5, 0.5), 0)])
def test_bad_arguments(spark, weights, k):
    asked = spark.createDataFrame([("s", 1)], "region_set string, person_id long")
    with pytest.raises(ValueError):
        neighbours.similar_persons(*tables_of(spark), asked, *weights, k)


def test_nothing_that_grows_with_targets_times_persons_is_shuffled(spark):
    asked = spark.createDataFrame([("s", 1)], "region_set string, person_id long")
    found = neighbours.similarities(*tables_of(spark), asked)
    plan = found._jdf.queryExecution().executedPlan().toString()
    shuffles = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "Exchange hashpart" in line]
    assert shuffles
    assert not [s for s in shuffles if "target_id#" in s and "person_id#" in s]
