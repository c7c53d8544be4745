"""Duplicate places against brute force, with copies, itself and missing names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from wayfare.functions.geo import distance_m
from wayfare.functions.text import name_distance
from wayfare.operators import dedup

PLACE = "region_id long, id long, name string, latitude double, longitude double"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def golden(spark):
    confirmed = [(0, 1, "Cornerhouse at Lakeside", 48.200000, 11.500000)]
    places = [
        (0, 101, "kornerhouse lakeside", 48.200000, 11.500000),
        (0, 102, "Cornerhouse at Lakeside", 48.199800, 11.500650),
        (0, 103, "Upper Mill Station", 48.136400, 11.557000),
    ]
    return spark.createDataFrame(places, PLACE), spark.createDataFrame(confirmed, PLACE)


def test_golden_example(spark):
    places, confirmed = golden(spark)
    for form in (dedup.drop_duplicate_places, dedup.dedup_pairs):
        kept = form(places, confirmed, 60, 5)
        assert kept.columns == places.columns
        assert [r.id for r in kept.collect()] == [103]
    marked = dedup.mark_duplicate_places(places, confirmed, 60, 5)
    got = {r.id: (r.duplicate_of, r.duplicate_distance) for r in marked.collect()}
    assert got[101] == (1, 0.0)
    assert got[102] == (1, pytest.approx(53.06, abs=0.01))
    assert got[103] == (None, None)


def random_places(spark, n, first_id, seed):
    rng = random.Random(seed)
    names = ["red gear", "Red Gear", "red gears", "blue bolt", "small gizmo", "a", None]
    # Few positions and names, so that many places are copies of each other.
    found = [
        (rng.randint(0, 2), first_id + i, rng.choice(names), 55 + rng.randint(0, 3) * 0.0006, 37 + rng.randint(0, 2) * 0.001)
        for i in range(n)
    ]
    return spark.createDataFrame(found, PLACE)


def test_forms_equal_brute_force(spark):
    places = random_places(spark, 120, 0, 1)
    # Some confirmed places are candidates too, some of them moved or renamed.
    confirmed = places.where("id % 7 = 0 and region_id <> 2").unionByName(
        random_places(spark, 20, 60, 2).where("region_id <> 2")
    )
    confirmed = confirmed.dropDuplicates(["id"]).cache()
    pairs = places.alias("c").join(confirmed.alias("f"), F.expr("c.region_id = f.region_id and c.id <> f.id"))
    apart = distance_m(*[F.col(c) for c in ("c.latitude", "c.longitude", "f.latitude", "f.longitude")])
    edits = name_distance(F.col("c.name"), F.col("f.name"))
    columns = [f"c.{c}" for c in places.columns]

    different = pairs.where((apart > 80) | (edits > 3)).select(*columns)
    key = lambda r: tuple("" if v is None else v for v in r)
    got = sorted((tuple(r) for r in dedup.dedup_pairs(places, confirmed, 80, 3).collect()), key=key)
    assert got == sorted((tuple(r) for r in different.collect()), key=key)

    alike = pairs.where((apart <= 80) & (edits <= 3)).select("c.id", apart.alias("d"), F.col("f.id").alias("of"))
    nearest = {r.id: (r.m.of, r.m.d) for r in alike.groupBy("id").agg(F.min(F.struct("d", "of")).alias("m")).collect()}
    marked = dedup.mark_duplicate_places(places, confirmed, 80, 3).collect()
    assert len(marked) == 120
    assert {r.id: (r.duplicate_of, r.duplicate_distance) for r in marked if r.duplicate_of is not None} == nearest
    kept = {r.id for r in dedup.drop_duplicate_places(places, confirmed, 80, 3).collect()}
    assert kept == {r.id for r in places.collect()} - set(nearest)
    # A region without confirmed places keeps all in one form and loses all in the other.
    assert {r.id for r in places.where("region_id = 2").collect()} <= kept
    assert not [r for r in got if r[0] == 2]


def test_bad_limits(spark):
    places, confirmed = golden(spark)
    with pytest.raises(ValueError):
        dedup.mark_duplicate_places(places, confirmed, -1, 5)
    with pytest.raises(ValueError):
        dedup.dedup_pairs(places, confirmed, 10, -5)
