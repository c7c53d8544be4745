"""Whole jobs over stored tables: facts, graphs and ratings, recommendations, deduplication.

A data folder holds ``persons``, ``places``, ``categories`` and ``location_visits``; the
jobs add their own tables beside them. Each builder handles all region sets in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.operators import dedup, factored_graph, graph, neighbours, place_visits, ratings, region_sets, requests, walk
from wayfare.runtime import materialize, use_utc
from wayfare.sources import schemas, tables

# Persons whose existence is looked up one by one in the stored tables.
FEW_PERSONS = 64


def build_place_visits(spark: SparkSession, data_dir: str, last_days: int, on_invalid: str = "fail") -> None:
    """Match the location visits of the last days with places and store the facts."""
    use_utc(spark)
    visits = tables.load_location_visits(spark, f"{data_dir}/location_visits")
    places = tables.load_places(spark, f"{data_dir}/places")
    facts = place_visits.place_visits(visits, places, last_days, on_invalid=on_invalid)
    tables.write_place_visits(facts, f"{data_dir}/{tables.PLACE_VISITS_TABLE}")


def _facts_and_sets(
    spark: SparkSession, data_dir: str, regions: Sequence[int] | None
) -> tuple[DataFrame, DataFrame, list[str] | None]:
    """Stored facts, the region sets to build, and their names where not all are built.

    The sets to build are those that hold one of ``regions``; there are at most
    n (n + 1) / 2 for n regions, and facts of regions outside of them are left out.
    """
    facts = tables.load_place_visits(spark, f"{data_dir}/{tables.PLACE_VISITS_TABLE}")
    sets = region_sets.all_region_sets(tables.load_places(spark, f"{data_dir}/places"))
    if regions is None:
        return facts, sets, None
    sets = materialize(region_sets.region_sets_with(sets, regions))
    names = sorted(r.region_set for r in sets.select("region_set").distinct().collect())
    return region_sets.facts_of(facts, sets), sets, names


def _store(df: DataFrame, data_dir: str, table: str, names: list[str] | None) -> None:
    """Write all region sets, or replace the named ones and leave the others as they are."""
    if names is None:
        tables.write_region_sets(df, data_dir, table)
    else:
        tables.replace_region_sets(df, data_dir, table, names)


def build_stochastic_graphs(
    spark: SparkSession,
    data_dir: str,
    beta_person_place: float,
    beta_person_category: float,
    regions: Sequence[int] | None = None,
) -> None:
    """Store the graphs of all region sets, or of those that hold one of ``regions``, from all stored facts."""
    use_utc(spark)
    facts, sets, names = _facts_and_sets(spark, data_dir, regions)
    graph.check_vertex_ids(facts)
    edges = graph.stochastic_graphs(facts, sets, beta_person_place, beta_person_category)
    _store(edges, data_dir, tables.GRAPH_TABLE, names)


def build_factored_graphs(spark: SparkSession, data_dir: str) -> None:
    """Store the graphs of all region sets in factors: counts once, cuts per set.

    They take the place of ``build_stochastic_graphs`` where regions are many; balance
    weights are given when edges are read.
    """
    use_utc(spark)
    facts, sets, _ = _facts_and_sets(spark, data_dir, None)
    graph.check_vertex_ids(facts)
    factored = factored_graph.factored_graph(facts, sets)
    tables.write_graph_counts(factored.counts, data_dir)
    tables.write_region_sets(factored.cuts, data_dir, tables.GRAPH_CUTS_TABLE)


def load_derived_graphs(
    spark: SparkSession, data_dir: str, sets: DataFrame, beta_person_place: float, beta_person_category: float
) -> DataFrame:
    """Graphs of the given region sets from stored factors; reads their regions' counts and their cuts."""
    sets = materialize(sets)
    names, regions = factored_graph.regions_of(sets)
    counts = tables.load_graph_counts(spark, data_dir, regions)
    cuts = tables.load_region_sets(spark, data_dir, tables.GRAPH_CUTS_TABLE, schemas.GRAPH_CUTS, names)
    stored = factored_graph.FactoredGraph(counts, cuts)
    return factored_graph.derived_graphs(stored, sets, beta_person_place, beta_person_category)


def build_ratings(
    spark: SparkSession,
    data_dir: str,
    max_rated_places: int,
    max_rated_categories: int,
    regions: Sequence[int] | None = None,
) -> None:
    """Store ratings and rating vectors of all region sets, or of those that hold one of ``regions``."""
    use_utc(spark)
    facts, sets, names = _facts_and_sets(spark, data_dir, regions)
    counts = materialize(ratings.visit_counts(facts))
    _store(ratings.region_place_ratings(counts, sets, max_rated_places), data_dir, tables.PLACE_RATINGS_TABLE, names)
    rated_categories = ratings.region_category_ratings(counts, sets, max_rated_categories)
    _store(rated_categories, data_dir, tables.CATEGORY_RATINGS_TABLE, names)
    place_ratings, category_ratings = load_ratings(spark, data_dir, names)
    for rated, entity, table in (
        (place_ratings, "place_id", tables.PLACE_RATING_VECTORS_TABLE),
        (category_ratings, "category_id", tables.CATEGORY_RATING_VECTORS_TABLE),
    ):
        vectors = ratings.rating_vectors(rated, entity, keys=["region_set"])
        _store(vectors, data_dir, table, names)


def load_ratings(
    spark: SparkSession, data_dir: str, region_set: str | Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    return (
        tables.load_region_sets(spark, data_dir, tables.PLACE_RATINGS_TABLE, schemas.ratings("place_id"), region_set),
        tables.load_region_sets(spark, data_dir, tables.CATEGORY_RATINGS_TABLE, schemas.ratings("category_id"), region_set),
    )


def load_graph(spark: SparkSession, data_dir: str, region_set: str | Sequence[str] | None = None) -> DataFrame:
    return tables.load_region_sets(spark, data_dir, tables.GRAPH_TABLE, schemas.GRAPH, region_set)


def _resolved(spark: SparkSession, data_dir: str, asked: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Known requests, those of unknown persons, and the names of the region sets asked for.

    The names reach the driver, so that the scans skip the folders of all other sets. There
    are at most n (n + 1) / 2 for n regions.
    """
    persons = tables.load_persons(spark, f"{data_dir}/persons")
    resolved = materialize(requests.resolve_requests(asked, persons))
    names = sorted(r.region_set for r in resolved.select("region_set").distinct().collect())
    return resolved, requests.rejected_requests(asked, persons), names


def _looked_up(stored: DataFrame, columns: Sequence[str], resolved: DataFrame) -> DataFrame:
    """Of a stored table, what has to do with the requested persons, where those are few."""
    ids = [r.person_id for r in resolved.select("person_id").distinct().limit(FEW_PERSONS + 1).collect()]
    return stored if len(ids) > FEW_PERSONS else tables.rows_with_ids(stored, columns, ids)


def _all_rejected(unknown: DataFrame, unserved: DataFrame) -> DataFrame:
    columns = ["person_id", F.col("target_region_id").alias("region_id"), "reason"]
    return unknown.select("person_id", "region_id", "reason").unionByName(unserved.select(*columns))


def recommend_by_walk(
    spark: SparkSession,
    data_dir: str,
    asked: DataFrame,
    epsilon: float = 0.05,
    max_iterations: int = 20,
    max_recommendations: int = 10,
    betas: tuple[float, float] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Recommended places and rejected requests of ``asked (person_id, region_id)``.

    Only the graphs of the region sets that are asked for are read; given ``betas`` of
    person and place, and person and category, they are derived from stored factors.
    """
    use_utc(spark)
    resolved, unknown, names = _resolved(spark, data_dir, asked)
    if betas is None:
        edges = load_graph(spark, data_dir, names)
    else:
        # Derived once for the walk and for the check of the requests.
        edges = materialize(load_derived_graphs(spark, data_dir, region_sets.requested_region_sets(resolved), *betas))
    places = tables.load_places(spark, f"{data_dir}/places")
    best = walk.walk_recommended_places(edges, resolved, places, epsilon, max_iterations, max_recommendations)
    of_persons = _looked_up(edges, ("source_id", "target_id"), resolved) if betas is None else edges
    return best, _all_rejected(unknown, requests.requests_outside_graph(resolved, of_persons))


def recommend_by_neighbours(
    spark: SparkSession,
    data_dir: str,
    asked: DataFrame,
    place_weight: float,
    category_weight: float,
    k_nearest: int,
    max_recommendations: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """Recommended places and rejected requests of ``asked (person_id, region_id)``.

    Only the ratings of the region sets that are asked for are read.
    """
    use_utc(spark)
    resolved, unknown, names = _resolved(spark, data_dir, asked)
    rated = load_ratings(spark, data_dir, names)
    places = tables.load_places(spark, f"{data_dir}/places")
    found = neighbours.knn_recommend(*rated, resolved, place_weight, category_weight, k_nearest)
    best = requests.recommended_places(
        found, places, resolved, "estimated_rating", max_recommendations, place="place_id"
    )
    of_persons = [_looked_up(table, ("person_id",), resolved) for table in rated]
    return best, _all_rejected(unknown, requests.requests_without_ratings(resolved, *of_persons))


def deduplicate_places(
    spark: SparkSession,
    data_dir: str,
    confirmed: DataFrame,
    max_distance_m: float = dedup.MAX_PLACE_DISTANCE_M,
    max_name_difference: int = dedup.MAX_NAME_DIFFERENCE,
) -> None:
    """Store the places without the duplicates of confirmed places as ``unique_places``."""
    places = tables.load_places(spark, f"{data_dir}/places")
    unique = dedup.drop_duplicate_places(places, confirmed, max_distance_m, max_name_difference)
    tables.write_places(unique, f"{data_dir}/unique_places")
