"""Matching visits with places, checks and profiles."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wayfare.functions import skew
from wayfare.functions.geo import distance_m
from wayfare.operators import place_visits as P
from wayfare.operators import profiles

VISIT = "person_id long, region_id long, timestamp timestamp, latitude double, longitude double"
PLACE = "id long, region_id long, category_id long, latitude double, longitude double"
NOON = dt.datetime(2024, 1, 10, 12)


@pytest.mark.parametrize("limit", [100_000, 0])
def test_equals_plain_region_join(tables, monkeypatch, limit):
    """With places that are broadcast, and with more of them by a shuffle."""
    monkeypatch.setattr(P, "MAX_BROADCAST_PLACES", limit)
    visits, places = tables.location_visits(), tables.places()
    apart = distance_m(*[F.col(c) for c in ("v.latitude", "v.longitude", "p.latitude", "p.longitude")])
    plain = (
        visits.alias("v")
        .join(places.alias("p"), F.col("v.region_id") == F.col("p.region_id"))
        .where(apart <= 100)
        .select("event_id", F.col("p.id").alias("place_id"))
    )
    got = P.match_places(visits, places).select("event_id", "place_id")
    assert sorted(got.collect()) == sorted(plain.collect())


def test_last_days_include_the_limit_and_count_from_the_latest_visit(spark):
    rows = [(1, 0, NOON, 1.0, 1.0), (2, 0, NOON - dt.timedelta(days=7), 1.0, 1.0)]
    rows += [(3, 1, NOON - dt.timedelta(days=7, microseconds=1), 1.0, 1.0)]
    recent = P.recent_visits(spark.createDataFrame(rows, VISIT), 7)
    assert sorted(r.person_id for r in recent.collect()) == [1, 2]
    with pytest.raises(ValueError):
        P.recent_visits(recent, 0)


def test_empty_visits_give_no_facts(spark):
    visits = spark.createDataFrame([], VISIT)
    places = spark.createDataFrame([(1, 0, 0, 1.0, 1.0)], PLACE)
    assert P.place_visits(visits, places, 7).count() == 0


def test_other_regions_and_missing_coordinates_do_not_match(spark):
    rows = [(1, 0, NOON, 1.0, 1.0), (2, 1, NOON, 1.0, 1.0), (3, 0, NOON, None, 1.0), (4, 0, NOON, 1.0, None)]
    places = spark.createDataFrame([(10, 0, 5, 1.0, 1.0), (11, 0, 6, 1.0, 1.0005), (12, 0, 6, None, None)], PLACE)
    facts = P.place_visits(spark.createDataFrame(rows, VISIT), places, 7)
    assert facts.columns == ["person_id", "timestamp", "place_id", "region_id", "category_id"]
    assert sorted((r.person_id, r.place_id, r.category_id) for r in facts.collect()) == [(1, 10, 5), (1, 11, 6)]


def test_coordinates_out_of_range(spark):
    visits = spark.createDataFrame([(1, 0, NOON, 91.0, 1.0), (2, 0, NOON, 1.0, 1.0)], VISIT)
    places = spark.createDataFrame([(10, 0, 5, 1.0, 1.0)], PLACE)
    assert [r.person_id for r in P.invalid_locations(visits).collect()] == [1]
    assert P.place_visits(visits, places, 7, on_invalid="drop").count() == 1
    with pytest.raises(Exception, match="coordinates out of range"):
        P.place_visits(visits, places, 7).collect()
    with pytest.raises(ValueError):
        P.valid_locations(visits, "ignore")


def test_time_filter_and_columns_reach_the_scan(spark, tables, tmp_path):
    from wayfare.sources import tables as S

    path = str(tmp_path / "visits")
    S.write_location_visits(tables.location_visits(), path)
    recent = P.recent_visits(S.load_location_visits(spark, path), 7).select("person_id")
    plan = recent._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    scan = plan.split("PartitionFilters: [")[1].split("\n")[0]
    assert "year_month" in scan
    assert "GreaterThanOrEqual(timestamp" in plan
    assert "ReadSchema: struct<person_id:bigint,timestamp:timestamp>" in plan


def test_a_hot_city_is_spread_over_tasks(spark, monkeypatch):
    """Most visits are in one cell: the shuffled form equals the broadcast one, and no task gets most of them."""
    rows = [(i, 0, NOON, 1.0 + (i % 7) * 1e-5, 1.0) for i in range(4_000)] + [(i, i % 3, NOON, 1.0 + i * 0.01, 1.0) for i in range(300)]
    visits = spark.createDataFrame(rows, VISIT)
    places = [(10 + i, 0, 5, 1.0, 1.0 + i * 1e-5) for i in range(10)] + [(50 + i, i % 3, 6, 1.0 + i * 0.01, 1.0) for i in range(200)]
    places = spark.createDataFrame(places, PLACE)
    pairs = lambda df: sorted((r.person_id, r.region_id, r.place_id) for r in df.collect())
    expected = pairs(P.match_places(visits, places))
    monkeypatch.setattr(P, "MAX_BROADCAST_PLACES", 0)
    monkeypatch.setattr(P, "COMPARED_PER_PART", 500)
    monkeypatch.setattr(skew, "shuffle_partitions", lambda _: 8)
    found = P.match_places(visits, places)
    assert pairs(found) == expected and len(expected) > 40_000
    per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == 8 and max(per_task) < 2 * sum(per_task) / 8


def test_bounding_box(spark):
    visits = spark.createDataFrame(
        [(1, 0, NOON, 1.0, 1.0), (2, 0, NOON, 3.0, 1.0), (3, 0, NOON, 3.0, -1.0)], VISIT
    )
    regions = spark.createDataFrame(
        [(0, "r", 0.0, 2.0, 0.0, 2.0)],
        "id long, name string, min_latitude double, max_latitude double, min_longitude double, max_longitude double",
    )
    bad = profiles.bounding_box_violations(visits, regions)
    assert sorted((r.person_id, r.latitude_off, r.longitude_off) for r in bad.collect()) == [
        (2, True, False),
        (3, True, True),
    ]
    with pytest.raises(ValueError, match="region 0: 2 latitudes, 1 longitudes"):
        profiles.assert_inside_bounding_boxes(visits, regions)
    profiles.assert_inside_bounding_boxes(visits.where("person_id = 1"), regions)
