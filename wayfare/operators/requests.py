"""Requests: which person asks for which region, and what they get."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.ranking import top_k
from wayfare.sources.tables import region_set_key


def resolve_requests(requests: DataFrame, persons: DataFrame) -> DataFrame:
    """``(person_id, home_region_id, target_region_id, region_set)`` of known persons.

    A request without a region asks for the home region. The region set is that of home
    and target.
    """
    homes = persons.select(F.col("id").alias("person_id"), "home_region_id")
    target = F.coalesce("region_id", "home_region_id")
    return requests.join(homes, "person_id").select(
        "person_id",
        "home_region_id",
        target.alias("target_region_id"),
        region_set_key(F.array(F.col("home_region_id"), target)).alias("region_set"),
    )


def rejected_requests(requests: DataFrame, persons: DataFrame) -> DataFrame:
    """Requests of unknown persons, with the reason."""
    known = persons.select(F.col("id").alias("person_id"))
    return requests.join(known, "person_id", "left_anti").withColumn("reason", F.lit("unknown person"))


def requests_outside_graph(resolved: DataFrame, graph: DataFrame) -> DataFrame:
    """Resolved requests whose person is no vertex of the region set's graph."""
    asked = resolved.select("region_set", "person_id").distinct()
    ends = graph.select("region_set", F.explode(F.array("source_id", "target_id")).alias("person_id"))
    # Cut to the persons asked for before anything is made distinct.
    present = ends.join(asked, ["region_set", "person_id"], "left_semi").distinct()
    missing = resolved.join(present, ["region_set", "person_id"], "left_anti")
    return missing.withColumn("reason", F.lit("person not in graph"))


def requests_without_ratings(resolved: DataFrame, place_ratings: DataFrame, category_ratings: DataFrame) -> DataFrame:
    """Resolved requests whose person lacks place or category ratings in the region set."""
    keys = ["region_set", "person_id"]
    both = place_ratings.select(*keys).join(category_ratings.select(*keys), keys, "left_semi")
    return resolved.join(both, keys, "left_anti").withColumn("reason", F.lit("person without ratings"))


def recommended_places(
    recommendations: DataFrame,
    places: DataFrame,
    resolved: DataFrame,
    score: str,
    n: int = 10,
    place: str = "id",
    place_columns: Sequence[str] | None = None,
) -> DataFrame:
    """The ``n`` best recommended places inside each request's target region.

    Joining with the places of the target region also drops persons and categories from a
    walk's result. Place columns come with each row; equal scores go by place id.
    """
    wanted = resolved.select("region_set", "person_id", "target_region_id").distinct()
    ranked = recommendations.join(wanted, ["region_set", "person_id"]).select(
        "person_id",
        "region_set",
        F.col(place).alias("id"),
        F.col("target_region_id").alias("region_id"),
        score,
    )
    # Rank on ids alone; the wide place columns join the few rows that remain.
    ids = places.select("id", "region_id")
    best = top_k(ranked.join(ids, ["id", "region_id"]), ["region_set", "person_id"], score, "id", n)
    return with_place_columns(best, places, place_columns)


def with_place_columns(best: DataFrame, places: DataFrame, place_columns: Sequence[str] | None = None) -> DataFrame:
    """Add the columns of the places, ``(id, region_id)``, to the few rows that were chosen."""
    details = places.select("id", "region_id", *(place_columns or [c for c in places.columns if c not in ("id", "region_id")]))
    return best.join(details, ["id", "region_id"])
