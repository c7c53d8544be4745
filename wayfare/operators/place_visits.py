"""From raw location visits to "person visited place" facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.geo import Grid, distance_m, is_valid_location
from wayfare.functions.skew import salted_join
from wayfare.functions.times import days_before, year_month

# Fixed value: a person within this distance of a place visits it.
MATCH_RADIUS_M = 100.0
# Nine cells each, at about 100 bytes, are some 90 MB.
MAX_BROADCAST_PLACES = 100_000
# Visits times places of a cell that one task compares.
COMPARED_PER_PART = 2_000_000


def recent_visits(visits: DataFrame, last_days: int) -> DataFrame:
    """Visits not older than ``last_days`` before the latest visit of the whole table.

    The cut is a scalar subquery: Spark runs it once and hands its value to the Parquet
    scan as a pushed filter. When the table is partitioned by ``year_month``, the latest
    visit is looked up in the last month alone, and months before the cut are skipped.
    """
    if last_days <= 0:
        raise ValueError(f"last_days must be positive: {last_days}")
    newest = visits
    if "year_month" in visits.columns:
        newest = visits.where(F.col("year_month") == visits.agg(F.max("year_month")).scalar())
    since = newest.agg(days_before(F.max("timestamp"), last_days).alias("since")).scalar()
    recent = visits.where(F.col("timestamp") >= since)
    if "year_month" in visits.columns:
        # The same subquery again: two different ones would be merged into a struct, which
        # the scan does not take as a filter.
        recent = recent.where(F.col("year_month") >= year_month(since))
    return recent


def _location_is_valid() -> Column:
    return is_valid_location(F.col("latitude"), F.col("longitude"))


def invalid_locations(df: DataFrame) -> DataFrame:
    """Rows whose coordinates are missing or out of range."""
    return df.where(~_location_is_valid())


def valid_locations(df: DataFrame, on_invalid: str = "fail") -> DataFrame:
    """Rows with usable coordinates.

    Missing coordinates never match anything and are dropped. Out-of-range ones fail the
    job, or are dropped too with ``on_invalid="drop"``.
    """
    if on_invalid not in ("fail", "drop"):
        raise ValueError(f"on_invalid must be 'fail' or 'drop': {on_invalid}")
    present = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if on_invalid == "drop":
        return present.where(_location_is_valid())
    message = F.format_string("coordinates out of range: %s, %s", F.col("latitude"), F.col("longitude"))
    return present.where(F.when(_location_is_valid(), True).otherwise(F.raise_error(message).cast("boolean")))


def match_places(visits: DataFrame, places: DataFrame, radius_m: float = MATCH_RADIUS_M) -> DataFrame:
    """Join visits with the places of their region within ``radius_m`` (limit included).

    A grid turns the distance join into an equi-join: each visit has one cell, each place
    is listed in the up to nine cells around it, and the exact distance decides. Visits
    are neither copied nor aggregated beforehand. A counted, small number of places is
    broadcast, so that the visits stay where they were read, whatever their skew. With
    more places both sides are shuffled by cell. A cell of a hot city is cut into parts by
    its counted visits times places, so that no task compares more than a part.
    """
    grid = Grid(radius_m)
    here = visits.withColumn("_cell", grid.cell("latitude", "longitude"))
    there = places.select(
        "region_id",
        F.col("id").alias("place_id"),
        "category_id",
        F.col("latitude").alias("_place_latitude"),
        F.col("longitude").alias("_place_longitude"),
        F.explode(grid.cells_in_reach("latitude", "longitude")).alias("_cell"),
    )
    cell = ["region_id", "_cell"]
    if places.limit(MAX_BROADCAST_PLACES + 1).count() <= MAX_BROADCAST_PLACES:
        met = here.join(F.broadcast(there), cell)
    else:
        met = salted_join(here, there, cell, [c for c in here.columns if c not in cell], COMPARED_PER_PART)
    apart = distance_m(F.col("latitude"), F.col("longitude"), F.col("_place_latitude"), F.col("_place_longitude"))
    return met.where(apart <= radius_m)


def place_visits(
    visits: DataFrame,
    places: DataFrame,
    last_days: int,
    radius_m: float = MATCH_RADIUS_M,
    on_invalid: str = "fail",
) -> DataFrame:
    """``(person_id, timestamp, place_id, region_id, category_id)`` of the last days.

    A visit near several places gives a row for each.
    """
    usable_visits = valid_locations(recent_visits(visits, last_days), on_invalid)
    matched = match_places(usable_visits, valid_locations(places, on_invalid), radius_m)
    return matched.select("person_id", "timestamp", "place_id", "region_id", "category_id")
