"""Region sets: every single region and every unordered pair of regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.sources.tables import region_set_key


def region_ids(places: DataFrame) -> DataFrame:
    return places.select("region_id").where(F.col("region_id").isNotNull()).distinct()


def all_region_sets(places: DataFrame) -> DataFrame:
    """``(region_set, region_id)``: the regions of each set, n singles and n(n-1)/2 pairs.

    The ids of a dimension of n regions travel in one array, so that the pairs come from
    two explodes and not from a join without keys.
    """
    ids = region_ids(places).agg(F.array_sort(F.collect_set("region_id")).alias("ids"))
    first = ids.select("ids", F.explode("ids").alias("a"))
    pairs = first.select("a", F.explode(F.filter("ids", lambda b: b >= F.col("a"))).alias("b"))
    return _members(pairs.select(F.array("a", "b").alias("regions")))


def requested_region_sets(requests: DataFrame) -> DataFrame:
    """The region sets that resolved requests need, in the same form."""
    pairs = requests.select(F.array_sort(F.array("home_region_id", "target_region_id")).alias("regions"))
    return _members(pairs.distinct())


def region_sets_with(region_sets: DataFrame, regions: Sequence[int]) -> DataFrame:
    """Those sets that hold one of the given regions, with all their regions."""
    held = region_sets.where(F.col("region_id").isin(list(regions))) if regions else region_sets.where("false")
    return region_sets.join(held.select("region_set").distinct(), "region_set", "left_semi")


def facts_of(facts: DataFrame, region_sets: DataFrame) -> DataFrame:
    """Rows whose region is in one of the sets."""
    return facts.join(region_sets.select("region_id").distinct(), "region_id", "left_semi")


def _members(sets: DataFrame) -> DataFrame:
    return sets.select(
        region_set_key(F.col("regions")).alias("region_set"),
        F.explode(F.array_distinct("regions")).alias("region_id"),
    )


def expand_to_region_sets(df: DataFrame, region_sets: DataFrame) -> DataFrame:
    """Copy each row to every set that holds its region, under the key ``region_set``.

    Meant for rows that are aggregated already: each row is copied once per region.
    """
    return df.join(region_sets, "region_id")


def region_pairs_of_sets(region_sets: DataFrame) -> DataFrame:
    """``(region_set, region_id, that_region_id)``: ordered pairs of regions inside a set."""
    that = region_sets.select("region_set", F.col("region_id").alias("that_region_id"))
    return region_sets.join(that, "region_set")
