"""Graphs of region sets in factors: each count stored once, cuts per set, edges derived at read.

An edge of n regions' graphs would be stored n times, once per set that holds its regions.
Here a count lies under its own regions, however many sets there are. What differs between
sets is which counts a source keeps and their total: one row per source and set. A set's
edges are a join of the two, and the balance weights are chosen at that time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.ranking import cuts_in_sets
from wayfare.operators import edges as E
from wayfare.operators.graph import BETA_CATEGORY_PLACE, BETA_PLACE_PLACE, check_betas
from wayfare.operators.ratings import timed_visit_counts
from wayfare.operators.region_sets import expand_to_region_sets, region_pairs_of_sets
from wayfare.runtime import materialize

# Counts of these kinds lie in one region or pair of regions; the last one adds up over a set.
_KINDS = ("place_place", "category_place", "person_place", "person_category")
_SUMMED = "person_category"


@dataclass(frozen=True)
class FactoredGraph:
    """``counts``: (kind, region_id, that_region_id, source_id, target_id, visits), each once.

    ``cuts``: (region_set, kind, source_id, lowest, total): the least count that a source
    keeps in a set, and the sum of those it keeps.
    """

    counts: DataFrame
    cuts: DataFrame


def factored_graph(place_visits: DataFrame, region_sets: DataFrame) -> FactoredGraph:
    """Counts of all visits, and the cuts of the given region sets."""
    visits = materialize(timed_visit_counts(place_visits))
    tops = dict(zip(_KINDS, (E.TOP_SIMILAR_PLACES, E.TOP_PLACES_PER_CATEGORY, E.TOP_PLACES_PER_PERSON, E.TOP_CATEGORIES_PER_PERSON)))

    def in_region(source: str, target: str) -> DataFrame:
        ends = [F.col(source).alias("source_id"), F.col(target).alias("target_id")]
        return visits.groupBy("region_id", *ends).agg(F.sum("visits").alias("visits")).withColumn("that_region_id", F.col("region_id"))

    pairs = E.covisits(place_visits, E.SIMILARITY_DAYS, visits).groupBy("place_id", "region_id", "that_place_id", "that_region_id")
    pairs = pairs.agg(F.sum("visit_pairs").alias("visits")).withColumnsRenamed({"place_id": "source_id", "that_place_id": "target_id"})
    of_kind = {
        "place_place": pairs,
        "category_place": in_region("category_id", "place_id"),
        "person_place": in_region("person_id", "place_id"),
        "person_category": in_region("person_id", "category_id"),
    }
    columns = ["region_id", "that_region_id", "source_id", "target_id", "visits"]
    counts = None
    for kind, counted in of_kind.items():
        mine = counted.select(F.lit(kind).alias("kind"), *columns)
        counts = mine if counts is None else counts.unionByName(mine)
    counts = materialize(counts)
    cuts = None
    for kind in _KINDS:
        mine = counts.where(F.col("kind") == kind)
        if kind == _SUMMED:
            per_set = _summed_in_sets(mine, region_sets)
            found = cuts_in_sets(per_set, None, ["region_set"], ["source_id"], "visits", tops[kind], "total")
        else:
            of_sets = region_pairs_of_sets(region_sets)
            found = cuts_in_sets(mine, of_sets, ["region_id", "that_region_id"], ["source_id"], "visits", tops[kind], "total")
        found = found.select("region_set", F.lit(kind).alias("kind"), "source_id", F.col("_lowest").alias("lowest"), "total")
        cuts = found if cuts is None else cuts.unionByName(found)
    cuts = materialize(cuts)
    # Counts that no set keeps are not stored; summed ones may still add up.
    least = cuts.where(F.col("kind") != _SUMMED).groupBy("kind", "source_id").agg(F.min("lowest").alias("_least"))
    kept = counts.join(least, ["kind", "source_id"], "left").where((F.col("kind") == _SUMMED) | (F.col("visits") >= F.col("_least")))
    return FactoredGraph(kept.drop("_least"), cuts)


def _summed_in_sets(counts: DataFrame, region_sets: DataFrame) -> DataFrame:
    expanded = expand_to_region_sets(counts, region_sets)
    return expanded.groupBy("region_set", "source_id", "target_id").agg(F.sum("visits").alias("visits"))


def derived_graphs(
    factored: FactoredGraph, region_sets: DataFrame, beta_person_place: float, beta_person_category: float
) -> DataFrame:
    """``(region_set, source_id, target_id, balanced_weight)`` of the given sets, from their factors."""
    check_betas(beta_person_place, beta_person_category)
    betas = dict(zip(_KINDS, (BETA_PLACE_PLACE, BETA_CATEGORY_PLACE, beta_person_place, beta_person_category)))
    cuts = factored.cuts.join(region_sets.select("region_set").distinct(), "region_set", "left_semi")
    single = cuts.where(F.col("kind") != _SUMMED).join(region_pairs_of_sets(region_sets), "region_set")
    kept = factored.counts.where(F.col("kind") != _SUMMED).join(single, ["kind", "source_id", "region_id", "that_region_id"])
    columns = ["region_set", "kind", "source_id", "target_id", "visits", "lowest", "total"]
    summed = _summed_in_sets(factored.counts.where(F.col("kind") == _SUMMED), region_sets)
    summed = summed.withColumn("kind", F.lit(_SUMMED)).join(cuts, ["region_set", "kind", "source_id"])
    beta = F.coalesce(*[F.when(F.col("kind") == kind, F.lit(value)) for kind, value in betas.items()])
    return (
        kept.select(*columns)
        .unionByName(summed.select(*columns))
        .where(F.col("visits") >= F.col("lowest"))
        .select("region_set", "source_id", "target_id", (F.col("visits") / F.col("total") * beta).alias("balanced_weight"))
    )


def regions_of(region_sets: DataFrame) -> tuple[list[str], Sequence[int]]:
    """Names and regions of sets: at most n (n + 1) / 2 names of n regions reach the driver."""
    rows = region_sets.select("region_set", "region_id").distinct().collect()
    return sorted({r.region_set for r in rows}), sorted({r.region_id for r in rows})
