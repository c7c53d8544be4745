"""Distances, names, grid, ranking and skew helpers."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from wayfare.runtime import materialize
from wayfare.functions import geo, ranking, skew, text, times


def one(spark, **columns):
    """The values of some expressions, by name."""
    return spark.range(1).select(*[c.alias(name) for name, c in columns.items()]).first()


def metres(lat_a, lon_a, lat_b, lon_b):
    return geo.distance_m(*[F.lit(v).cast("double") for v in (lat_a, lon_a, lat_b, lon_b)])


def test_distance(spark):
    a, b = (55.612652, 37.591753), (55.611152, 37.603366)
    row = one(
        spark,
        zero=metres(*a, *a),
        there=metres(*a, *b),
        back=metres(*b, *a),
        antipode=metres(0, 0, 0, 180),
        near_antipode=metres(12.3456789, 45.678, -12.3456789, -134.322),
        missing=metres(None, 0, 0, 0),
    )
    assert row.zero == 0
    assert abs(row.there - 745) <= 5
    assert row.there == row.back
    assert row.antipode == pytest.approx(math.pi * geo.EARTH_RADIUS_M)
    assert not math.isnan(row.near_antipode)
    assert row.missing is None


def test_levenshtein(spark):
    pairs = [("sitting", "kitten", 3), ("", "kitten", 6), ("sitting", "", 7), ("", "", 0), ("sitting", "sitting", 0)]
    pairs += [("Sitting", "sITTING", 0), (None, "kitten", None), ("sitting", None, None)]
    df = spark.createDataFrame(pairs, "a string, b string, expected int")
    for row in df.withColumn("got", text.name_distance(F.col("a"), F.col("b"))).collect():
        assert row.got == row.expected
    bounded = df.withColumn("alike", text.names_alike(F.col("a"), F.col("b"), 5))
    for row in bounded.collect():
        assert row.alike == (None if row.expected is None else row.expected <= 5)


def test_interval_truncates_to_milliseconds(spark):
    df = spark.sql(
        "select timestamp'2024-01-01 00:00:00.000999' a, timestamp'2024-01-08 00:00:00.000000' b,"
        " timestamp'2024-01-08 00:00:00.001000' c"
    )
    row = df.select(
        times.within_days(F.col("a"), F.col("b"), 7).alias("ab"),
        times.within_days(F.col("c"), F.col("a"), 7).alias("ca"),
    ).first()
    assert row.ab is True
    assert row.ca is False


@pytest.mark.parametrize(
    "centre,spread,radius",
    [
        ((0.0, 10.0), 0.02, 100),
        ((55.0, 37.0), 0.02, 250),
        ((-70.0, -20.0), 0.5, 20_000),
        ((85.0, 100.0), 1.0, 30_000),
        ((10.0, 180.0), 0.05, 900),
        ((-60.0, -180.0), 1.0, 30_000),
        ((89.99, 0.0), 0.02, 1_000),
        ((-90.0, 0.0), 1.0, 50_000),
        ((0.0, 0.0), 90.0, 5_000_000),
        ((0.0, 0.0), 90.0, 12_000_000),
    ],
)
def test_grid_finds_every_near_pair_once(spark, centre, spread, radius):
    rng = random.Random(7)

    def points(n):
        for i in range(n):
            lat = max(-90.0, min(90.0, centre[0] + rng.uniform(-spread, spread)))
            # Near a pole longitude says little, so it is drawn from the whole circle.
            lon = rng.uniform(-180, 180) if abs(centre[0]) > 89 else centre[1] + rng.uniform(-spread, spread) * 2
            yield i, lat, (lon + 180) % 360 - 180

    a = spark.createDataFrame(list(points(150)), "a long, latitude double, longitude double")
    b = spark.createDataFrame(list(points(150)), "b long, that_latitude double, that_longitude double")
    apart = geo.distance_m(*[F.col(c) for c in ("latitude", "longitude", "that_latitude", "that_longitude")])
    grid = geo.Grid(radius)
    found = (
        a.withColumn("cell", grid.cell("latitude", "longitude"))
        .join(b.withColumn("cell", F.explode(grid.cells_in_reach("that_latitude", "that_longitude"))), "cell")
        .where(apart <= radius)
    )
    expected = sorted((r.a, r.b) for r in a.join(b, apart <= radius).collect())
    assert expected, "the points must have near pairs"
    assert sorted((r.a, r.b) for r in found.collect()) == expected


def test_grid_narrows_the_search(spark):
    points = [(i, 55 + (i % 100) * 0.001, 37 + (i // 100) * 0.001) for i in range(2_000)]
    df = spark.createDataFrame(points, "id long, latitude double, longitude double")
    grid = geo.Grid(100)
    left = df.withColumn("cell", grid.cell("latitude", "longitude"))
    right = df.select(F.explode(grid.cells_in_reach("latitude", "longitude")).alias("cell"))
    assert left.join(right, "cell").count() < 2_000 * 20


def test_top_n_with_ties_equals_rank(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 5), i, rng.choice([1, 1, 1, 2, 2, 3, 7])) for i in range(400)] + [(9, 1000, 4)]
    df = spark.createDataFrame(rows, "g long, id long, v long")
    df.createOrReplaceTempView("ranked_rows")
    for n in (1, 3, 50, 1000):
        expected = spark.sql(
            f"""select g, id, v, sum(v) over (partition by g) total from
            (select *, rank() over (partition by g order by v desc) r from ranked_rows) where r <= {n}"""
        )
        got = ranking.top_n_with_ties(df, ["g"], "v", n, total="total").select("g", "id", "v", "total")
        assert sorted(got.collect()) == sorted(expected.collect())
    with pytest.raises(ValueError):
        ranking.top_n_with_ties(df, ["g"], "v", 0)


def test_top_k_is_the_same_for_small_and_large_k(spark, monkeypatch):
    rng = random.Random(5)
    scores = [0.1, 0.5, 0.5, 1 / 3, 2 / 3, 1.0, 11.99, -3.5, -0.1, 9e9]
    rows = [(g, (i - 100) * 70_001, rng.choice(scores)) for g in range(3) for i in range(200)]
    rows += [(0, 2**61 + i, 0.5) for i in range(50)] + [(7, 1, 0.2)] + [(8, 5, 1.5)] * 4
    df = spark.createDataFrame(rows, "g long, id long, score double")
    for k in (1, 60, 150, 1_500):
        expected = []
        for g in {r[0] for r in rows}:
            expected += sorted((r for r in rows if r[0] == g), key=lambda r: (-round(r[2], 9), r[1]))[:k]
        small = ranking.top_k(df, ["g"], "score", "id", k)
        found = [small]
        for at_once, brackets, broadcast in ((50_000, 1_024, 500_000), (5, 4, 500_000), (30, 64, 0))[:: 2 if k != 60 else 1]:
            with monkeypatch.context() as patch:
                patch.setattr(ranking, "SMALL_K", 0)
                patch.setattr(ranking, "_SORTED_AT_ONCE", at_once)
                patch.setattr(ranking, "_BRACKETS", brackets)
                patch.setattr(ranking, "_MOST_BROADCAST", broadcast)
                found.append(ranking.top_k(df, ["g"], "score", "id", k))
        for got in found:
            assert sorted(tuple(r) for r in got.select("g", "id", "score").collect()) == sorted(expected)


def test_large_k_takes_two_passes(spark, monkeypatch):
    """One pass over all rows, one over those in the bracket of the k-th key."""
    df = spark.range(300_000).select(F.lit(1).alias("g"), "id", F.rand(3).alias("score"))
    df = ranking.materialize(df)
    written = []
    monkeypatch.setattr(ranking, "materialize", lambda d: written.append(d.count()) or materialize(d))
    got = ranking.top_k(df, ["g"], "score", "id", 100_000)
    least = got.agg(F.min("score")).first()[0]
    assert got.count() == 100_000 == df.where(F.col("score") >= least).count()
    assert written[0] == 300_000 and max(written[1:]) < 1_000


@pytest.mark.parametrize("k", [1_000, 1_001])
def test_top_k_around_the_switch(spark, k):
    """Scores above 1, negative ids and scores, nulls: the limit of the window changes nothing."""
    df = spark.range(1_200).select(
        (F.col("id") - 600).alias("id"), F.lit(1).alias("g"), F.when(F.col("id") > 0, (F.col("id") - 200) / 100).alias("score")
    )
    got = sorted(r.id for r in ranking.top_k(df, ["g"], "score", "id", k).collect())
    assert got == list(range(600 - k, 600))


def test_scores_that_cannot_be_ranked_raise(spark):
    for score in (float("nan"), 1e10):
        df = spark.createDataFrame([(1, 1, score)], "g long, id long, score double")
        with pytest.raises(Exception, match="cannot be ranked"):
            ranking.top_k(df, ["g"], "score", "id", 1).collect()


def test_scores_that_differ_by_rounding_noise_are_equal(spark):
    row = one(
        spark,
        a=ranking.comparable(F.lit(0.1) + F.lit(0.2)),
        b=ranking.comparable(F.lit(0.3)),
        c=ranking.comparable(F.lit(0.0000000125)),
        d=ranking.comparable(F.lit(0.0000000125) - F.lit(1e-17)),
    )
    assert row.a == row.b
    assert row.c == row.d


@pytest.mark.parametrize("pairs_per_part", [1, 7, 1_000_000])
@pytest.mark.parametrize("right_rows", [40, 400])
def test_salted_join_equals_join(spark, pairs_per_part, right_rows):
    left = spark.createDataFrame([(i % 3 if i % 2 else 0, i) for i in range(200)], "k long, l long")
    right = spark.createDataFrame([(i % 4, i) for i in range(right_rows)], "k long, r long")
    got = skew.salted_join(left, right, ["k"], ["l"], pairs_per_part).select("k", "l", "r")
    assert sorted(got.collect()) == sorted(left.join(right, "k").select("k", "l", "r").collect())
