"""Duplicate places: close to a confirmed place and named like it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.geo import Grid, distance_m
from wayfare.functions.skew import salted_join
from wayfare.functions.text import name_distance, names_alike
from wayfare.operators.place_visits import valid_locations

# Fixed values
MAX_PLACE_DISTANCE_M = 100.0
MAX_NAME_DIFFERENCE = 5

_SPOT = ["region_id", "latitude", "longitude", "_name"]


def _with_spot(places: DataFrame) -> DataFrame:
    """Add the case-free name; places with the same spot are copies of each other."""
    return places.withColumn("_name", F.lower("name"))


def _check(max_distance_m: float, max_name_difference: int) -> None:
    if max_distance_m < 0 or max_name_difference < 0:
        raise ValueError(f"limits must not be negative: {max_distance_m}, {max_name_difference}")


def _near_spots(spots: DataFrame, confirmed_spots: DataFrame, max_distance_m: float) -> DataFrame:
    """Spots joined with the confirmed spots of their region within the distance.

    The confirmed spot's columns get the prefix ``that_``; ``distance`` is added.
    """
    grid = Grid(max_distance_m)
    here = spots.withColumn("_cell", grid.cell("latitude", "longitude"))
    there = confirmed_spots.select(
        "region_id", *[F.col(c).alias(f"that_{c}") for c in confirmed_spots.columns if c != "region_id"]
    ).withColumn("_cell", F.explode(grid.cells_in_reach("that_latitude", "that_longitude")))
    apart = distance_m(F.col("latitude"), F.col("longitude"), F.col("that_latitude"), F.col("that_longitude"))
    return (
        salted_join(here, there, ["region_id", "_cell"], ["latitude", "longitude", "_name"])
        .withColumn("distance", apart)
        .where(F.col("distance") <= max_distance_m)
        .drop("_cell")
    )


def mark_duplicate_places(
    places: DataFrame,
    confirmed: DataFrame,
    max_distance_m: float = MAX_PLACE_DISTANCE_M,
    max_name_difference: int = MAX_NAME_DIFFERENCE,
    on_invalid: str = "fail",
) -> DataFrame:
    """All places, with ``duplicate_of`` and ``duplicate_distance`` of the nearest match.

    Both are null for a place that matches no confirmed place but itself. Equal distances
    go by the confirmed place's id.

    Copies (same region, position and name) are compared once for all: however many a
    spot has, it meets each confirmed spot once. Two confirmed places are kept per spot,
    because one may be the very place that is looked at.
    """
    _check(max_distance_m, max_name_difference)
    candidates = _with_spot(valid_locations(places, on_invalid))
    spots = candidates.select(*_SPOT).where(F.col("_name").isNotNull()).distinct()
    by_id = Window.partitionBy(*_SPOT).orderBy("id")
    references = (
        _with_spot(valid_locations(confirmed, on_invalid))
        .select(*_SPOT, "id")
        .withColumn("_row", F.row_number().over(by_id))
        .where(F.col("_row") <= 2)
        .drop("_row")
    )
    alike = names_alike(F.col("_name"), F.col("that__name"), max_name_difference)
    matches = _near_spots(spots, references, max_distance_m).where(alike)
    nearest = Window.partitionBy(*_SPOT).orderBy("distance", "that_id")
    match = F.struct("distance", F.col("that_id").alias("id"))
    best_two = (
        matches.withColumn("_row", F.row_number().over(nearest))
        .where(F.col("_row") <= 2)
        .groupBy(*_SPOT)
        .agg(F.min(match).alias("_first"), F.max(match).alias("_second"))
    )
    chosen = F.when(F.col("_first.id") != F.col("id"), F.col("_first")).when(
        F.col("_second.id") != F.col("id"), F.col("_second")
    )
    return (
        candidates.join(best_two, _SPOT, "left")
        .withColumn("_match", chosen)
        .select(
            *places.columns,
            F.col("_match.id").alias("duplicate_of"),
            F.col("_match.distance").alias("duplicate_distance"),
        )
    )


def drop_duplicate_places(
    places: DataFrame,
    confirmed: DataFrame,
    max_distance_m: float = MAX_PLACE_DISTANCE_M,
    max_name_difference: int = MAX_NAME_DIFFERENCE,
    on_invalid: str = "fail",
) -> DataFrame:
    """The places that duplicate no confirmed place."""
    marked = mark_duplicate_places(places, confirmed, max_distance_m, max_name_difference, on_invalid)
    return marked.where(F.col("duplicate_of").isNull()).select(*places.columns)


def dedup_pair_counts(
    places: DataFrame,
    confirmed: DataFrame,
    max_distance_m: float = MAX_PLACE_DISTANCE_M,
    max_name_difference: int = MAX_NAME_DIFFERENCE,
    on_invalid: str = "fail",
) -> DataFrame:
    """Places that differ from at least one confirmed place of their region.

    ``different_places`` says from how many: those further away or named differently, the
    place itself left out. Nearly all pairs of a region differ, so the pairs are not
    formed. Their number is that of the confirmed places in the region, less those that
    are near and alike, which the grid finds.
    """
    _check(max_distance_m, max_name_difference)
    candidates = _with_spot(valid_locations(places, on_invalid))
    references = _with_spot(valid_locations(confirmed, on_invalid)).select(*_SPOT, "id")
    in_region = references.groupBy("region_id").agg(F.count(F.lit(1)).alias("_in_region"))

    # A missing name is neither alike nor different, so it is no reason to keep a pair.
    def not_different(name, that_name):
        return F.coalesce(name_distance(name, that_name) <= max_name_difference, F.lit(True))

    reference_spots = references.groupBy(*_SPOT).agg(F.count(F.lit(1)).alias("n"))
    alike = (
        _near_spots(candidates.select(*_SPOT).distinct(), reference_spots, max_distance_m)
        .where(not_different(F.col("_name"), F.col("that__name")))
        .groupBy(*_SPOT)
        .agg(F.sum("that_n").alias("_alike"))
    )
    alike = alike.withColumnsRenamed({c: f"_spot_{c}" for c in _SPOT})
    same_spot = [
        F.col(c).eqNullSafe(F.col(f"_spot_{c}")) if c == "_name" else F.col(c) == F.col(f"_spot_{c}") for c in _SPOT
    ]
    itself = references.select(
        "region_id", "id", *[F.col(c).alias(f"that_{c}") for c in _SPOT if c != "region_id"], F.lit(1).alias("_itself")
    )
    apart = distance_m(F.col("latitude"), F.col("longitude"), F.col("that_latitude"), F.col("that_longitude"))
    itself_alike = (apart <= max_distance_m) & not_different(F.col("_name"), F.col("that__name"))
    zero = F.lit(0).cast("long")
    different = (
        F.col("_in_region")
        - F.coalesce("_alike", zero)
        - F.when(F.col("_itself").isNotNull() & ~itself_alike, 1).otherwise(zero)
    )
    return (
        candidates.join(in_region, "region_id")
        .join(alike, same_spot, "left")
        .join(itself, ["region_id", "id"], "left")
        .withColumn("different_places", different)
        .where(F.col("different_places") > 0)
        .select(*[F.col(c) for c in places.columns], "different_places")
    )


def dedup_pairs(
    places: DataFrame,
    confirmed: DataFrame,
    max_distance_m: float = MAX_PLACE_DISTANCE_M,
    max_name_difference: int = MAX_NAME_DIFFERENCE,
    on_invalid: str = "fail",
) -> DataFrame:
    """The places once per confirmed place they differ from, as the pair join returns them.

    A duplicate of one confirmed place survives when it differs from another, and a region
    without confirmed places loses all rows. ``drop_duplicate_places`` is what to use.
    """
    counted = dedup_pair_counts(places, confirmed, max_distance_m, max_name_difference, on_invalid)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("different_places")))
    return counted.withColumn("_copy", copies).select(*places.columns)
