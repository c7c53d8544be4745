"""Every operator as a report over the test tables; results carry comparable types only.

Scores are rounded and timestamps are text, so that two engines can agree on each value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.rounding import rounded
from wayfare.operators import covisits, dedup, edges, factored_graph, graph, neighbours, place_visits, profiles, ratings, region_sets, requests, walk
from wayfare.operators.bounded_neighbours import BoundedNeighbours
from wayfare.runtime import materialize, new_folder, use_utc
from wayfare.sources import schemas, tables
from wayfare.sources.driver_tables import DriverTables

# Fixed values of the reports.
LAST_DAYS = 7
ALL_DAYS = 30
BETA_PERSON_PLACE, BETA_PERSON_CATEGORY = 0.5, 0.5
PLACE_WEIGHT, CATEGORY_WEIGHT = 0.5, 0.5
MAX_RATED_PLACES, MAX_RATED_CATEGORIES = 100, 10
TIGHT_TOP_PLACES, TIGHT_TOP_CATEGORIES = 5, 2
K_NEAREST = 10
MAX_RECOMMENDATIONS = 10
EPSILON = 0.05
FINE_EPSILON = 0.01
MAX_ITERATIONS = 20
# Steps that the SQL walks are written for; a test asserts that no walk takes more.
SQL_STEPS = 6
LARGE_K = 2_000_000
LARGE_N = 1_001
HEAVY_PLACES, HEAVY_VISITS = 4, 6
FIXED_STEPS = 3
OFF_BOUNDARY = 1.37e-10
STORED_REGION_SET = "region0_region1"
REBUILT_REGION, REBUILT_PERSON_PLACE = 1, 0.3

Query = Callable[[DriverTables], DataFrame]
_queries: dict[str, Query] = {}


def _report(query: Query) -> Query:
    _queries[query.__name__] = query
    return query


def _rounded(column: str, digits: int = 6) -> Column:
    return F.round(F.col(column), digits).alias(column)


def _pair_rounded(column: str, digits: int = 6) -> Column:
    """As ``_rounded``, for a row per pair of persons."""
    return rounded(F.col(column), digits).alias(column)


def _sum_rounded(column: str, digits: int = 6) -> Column:
    """Rounded sum of inexact terms; the offset keeps short decimals off the boundary."""
    return F.round(F.col(column) + OFF_BOUNDARY, digits).alias(column)


def _text(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def visits_of(t: DriverTables, last_days: int = LAST_DAYS) -> DataFrame:
    return place_visits.place_visits(t.location_visits(), t.places(), last_days)


def resolved(t: DriverTables) -> DataFrame:
    return requests.resolve_requests(t.requests(), t.persons())


def graph_of(t: DriverTables, sets: DataFrame | None = None) -> DataFrame:
    sets = region_sets.all_region_sets(t.places()) if sets is None else sets
    return graph.stochastic_graphs(visits_of(t), sets, BETA_PERSON_PLACE, BETA_PERSON_CATEGORY)


def requested_graph(t: DriverTables) -> DataFrame:
    return graph_of(t, region_sets.requested_region_sets(resolved(t)))


def region_ratings(t: DriverTables, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both rating tables, kept as the stored tables they are in production."""
    counts = materialize(ratings.visit_counts(visits_of(t)))
    return (
        materialize(ratings.region_place_ratings(counts, sets, MAX_RATED_PLACES)),
        materialize(ratings.region_category_ratings(counts, sets, MAX_RATED_CATEGORIES)),
    )


# --- stored tables --------------------------------------------------------------------


def _new_folder(t: DriverTables) -> str:
    return new_folder(t.spark, "tables")


@_report
def scan_persons(t: DriverTables) -> DataFrame:
    """Written by home region, then read back."""
    path = _new_folder(t)
    tables.write_persons(t.persons(), path)
    return tables.load_persons(t.spark, path)


@_report
def scan_places(t: DriverTables) -> DataFrame:
    """Written by region, then read back."""
    path = _new_folder(t)
    tables.write_places(t.places(), path)
    read = tables.load_places(t.spark, path)
    return read.select("id", "category_id", "name", "description", "region_id", _rounded("latitude"), _rounded("longitude"))


@_report
def scan_categories(t: DriverTables) -> DataFrame:
    path = _new_folder(t)
    tables.write_categories(t.categories(), path)
    return tables.load_categories(t.spark, path)


@_report
def scan_location_visits(t: DriverTables) -> DataFrame:
    """Written by region and month, then read back whole."""
    path = _new_folder(t)
    tables.write_location_visits(t.location_visits(), path)
    return tables.load_location_visits(t.spark, path).select(
        "person_id", "region_id", "year_month", _text("timestamp"), _rounded("latitude"), _rounded("longitude")
    )


@_report
def scan_place_visits(t: DriverTables) -> DataFrame:
    path = _new_folder(t)
    tables.write_place_visits(visits_of(t), path)
    read = tables.load_place_visits(t.spark, path)
    return read.select("person_id", _text("timestamp"), "place_id", "region_id", "category_id")


@_report
def scan_region_set_graph(t: DriverTables) -> DataFrame:
    """All graphs written by region set, then one set's folder read back."""
    path = _new_folder(t)
    tables.write_region_sets(graph_of(t), path, tables.GRAPH_TABLE)
    read = tables.load_region_sets(t.spark, path, tables.GRAPH_TABLE, schemas.GRAPH, STORED_REGION_SET)
    return read.select("region_set", "source_id", "target_id", _rounded("balanced_weight"))


@_report
def scan_region_set_ratings(t: DriverTables) -> DataFrame:
    """Ratings and their vectors written by region set; the vectors of one set read back."""
    path = _new_folder(t)
    places, _ = region_ratings(t, region_sets.all_region_sets(t.places()))
    tables.write_region_sets(places, path, tables.PLACE_RATINGS_TABLE)
    stored = tables.load_region_sets(t.spark, path, tables.PLACE_RATINGS_TABLE, schemas.ratings("place_id"))
    vectors = ratings.rating_vectors(stored, "place_id", keys=["region_set"])
    tables.write_region_sets(vectors, path, tables.PLACE_RATING_VECTORS_TABLE)
    read = tables.load_region_sets(
        t.spark, path, tables.PLACE_RATING_VECTORS_TABLE, region_set=STORED_REGION_SET
    )
    entries = read.select("region_set", "person_id", F.inline("rating_vector"))
    return entries.select("region_set", "person_id", "index", "value")


@_report
def scan_factored_graphs(t: DriverTables) -> DataFrame:
    """All graphs stored in factors, then derived from them for all sets."""
    path = _new_folder(t)
    sets = region_sets.all_region_sets(t.places())
    factored = factored_graph.factored_graph(visits_of(t), sets)
    tables.write_graph_counts(factored.counts, path)
    tables.write_region_sets(factored.cuts, path, tables.GRAPH_CUTS_TABLE)
    cuts = tables.load_region_sets(t.spark, path, tables.GRAPH_CUTS_TABLE, schemas.GRAPH_CUTS)
    read = factored_graph.FactoredGraph(tables.load_graph_counts(t.spark, path), cuts)
    edges = factored_graph.derived_graphs(read, sets, BETA_PERSON_PLACE, BETA_PERSON_CATEGORY)
    return edges.select("region_set", "source_id", "target_id", _rounded("balanced_weight"))


@_report
def scan_rebuilt_graphs(t: DriverTables) -> DataFrame:
    """All graphs stored, those with one region built anew with other weights, all read back."""
    path = _new_folder(t)
    sets, facts = region_sets.all_region_sets(t.places()), materialize(visits_of(t))
    stored = graph.stochastic_graphs(facts, sets, BETA_PERSON_PLACE, BETA_PERSON_CATEGORY)
    tables.write_region_sets(stored, path, tables.GRAPH_TABLE)
    again = materialize(region_sets.region_sets_with(sets, [REBUILT_REGION]))
    rebuilt = graph.stochastic_graphs(region_sets.facts_of(facts, again), again, REBUILT_PERSON_PLACE, 1 - REBUILT_PERSON_PLACE)
    names = [r.region_set for r in again.select("region_set").distinct().collect()]
    tables.replace_region_sets(rebuilt, path, tables.GRAPH_TABLE, names)
    read = tables.load_region_sets(t.spark, path, tables.GRAPH_TABLE, schemas.GRAPH)
    return read.select("region_set", "source_id", "target_id", _sum_rounded("balanced_weight"))


@_report
def scan_rebuilt_category_ratings(t: DriverTables) -> DataFrame:
    """Category ratings and vectors of all sets stored, one region's sets built anew with a tighter cut, all vectors read back."""
    path = _new_folder(t)
    sets = region_sets.all_region_sets(t.places())
    counts = materialize(ratings.visit_counts(visits_of(t)))
    again = materialize(region_sets.region_sets_with(sets, [REBUILT_REGION]))
    names = [r.region_set for r in again.select("region_set").distinct().collect()]
    for number, of, top in ((0, sets, MAX_RATED_CATEGORIES), (1, again, TIGHT_TOP_CATEGORIES)):
        rated = ratings.region_category_ratings(counts, of, top)
        if number:
            tables.replace_region_sets(rated, path, tables.CATEGORY_RATINGS_TABLE, names)
        else:
            tables.write_region_sets(rated, path, tables.CATEGORY_RATINGS_TABLE)
        asked = names if number else None
        stored = tables.load_region_sets(t.spark, path, tables.CATEGORY_RATINGS_TABLE, schemas.ratings("category_id"), asked)
        vectors = ratings.rating_vectors(stored, "category_id", keys=["region_set"])
        if number:
            tables.replace_region_sets(vectors, path, tables.CATEGORY_RATING_VECTORS_TABLE, names)
        else:
            tables.write_region_sets(vectors, path, tables.CATEGORY_RATING_VECTORS_TABLE)
    read = tables.load_region_sets(t.spark, path, tables.CATEGORY_RATING_VECTORS_TABLE)
    entries = read.select("region_set", "person_id", F.inline("rating_vector"))
    return entries.select("region_set", "person_id", "index", "value")


# --- visits -----------------------------------------------------------------------


@_report
def recent_visits(t: DriverTables) -> DataFrame:
    recent = place_visits.recent_visits(t.location_visits(), LAST_DAYS)
    return recent.select("event_id", "person_id", _text("timestamp"))


@_report
def place_visits_last_week(t: DriverTables) -> DataFrame:
    return visits_of(t).select("person_id", _text("timestamp"), "place_id", "region_id", "category_id")


@_report
def place_visits_all_days(t: DriverTables) -> DataFrame:
    facts = visits_of(t, ALL_DAYS)
    return facts.groupBy("person_id", "place_id", "region_id", "category_id").agg(F.count(F.lit(1)).alias("visits"))


@_report
def invalid_locations(t: DriverTables) -> DataFrame:
    """Coordinates pushed out of range for some events, to see them found."""
    shift = F.when(F.col("event_id") % 97 == 0, 180.0).otherwise(0.0)
    shifted = t.location_visits().withColumn("latitude", F.col("latitude") + shift)
    return place_visits.invalid_locations(shifted).select("event_id", _rounded("latitude"), _rounded("longitude"))


@_report
def bounding_box_violations(t: DriverTables) -> DataFrame:
    found = profiles.bounding_box_violations(t.location_visits(), t.regions(margin=0.0))
    return found.select("event_id", "region_id", "latitude_off", "longitude_off")


@_report
def bounding_box_violation_counts(t: DriverTables) -> DataFrame:
    return profiles.bounding_box_violation_counts(t.location_visits(), t.regions(margin=0.0))


@_report
def visit_summary(t: DriverTables) -> DataFrame:
    summary = profiles.visit_summary(visits_of(t, ALL_DAYS))
    return summary.select("visits", _text("first_timestamp"), _text("last_timestamp"), "visitors")


@_report
def visit_counts_by_region(t: DriverTables) -> DataFrame:
    return profiles.visit_counts_by_region(visits_of(t, ALL_DAYS))


@_report
def visit_profile_by_region(t: DriverTables) -> DataFrame:
    profile = profiles.location_profile_by_region(t.location_visits())
    spans = [_sum_rounded(c) for c in profile.columns if c not in ("region_id", "visits")]
    return profile.select("region_id", "visits", *spans)


@_report
def top_visitors(t: DriverTables) -> DataFrame:
    return profiles.top_visitors(visits_of(t, ALL_DAYS))


@_report
def visit_month_counts(t: DriverTables) -> DataFrame:
    return profiles.visit_counts_by_month(t.location_visits())


@_report
def place_profile(t: DriverTables) -> DataFrame:
    nothing = F.lit(-1).cast("long")
    return profiles.place_profile(t.places()).select(
        "level",
        F.coalesce("region_id", nothing).alias("region_id"),
        F.coalesce("category_id", nothing).alias("category_id"),
        "places",
    )


@_report
def category_names(t: DriverTables) -> DataFrame:
    return profiles.named_places(t.places(), t.categories()).select("id", "category_id", "category", "label")


# --- ratings ------------------------------------------------------------------------


@_report
def place_ratings_topn(t: DriverTables) -> DataFrame:
    return ratings.ratings(visits_of(t), "place_id", TIGHT_TOP_PLACES)


@_report
def category_ratings_topn(t: DriverTables) -> DataFrame:
    return ratings.ratings(visits_of(t), "category_id", TIGHT_TOP_CATEGORIES)


@_report
def place_ratings_preset(t: DriverTables) -> DataFrame:
    return ratings.place_ratings(visits_of(t))


@_report
def category_ratings_preset(t: DriverTables) -> DataFrame:
    return ratings.category_ratings(visits_of(t))


def _vector_rows(rated: DataFrame, entity: str) -> DataFrame:
    vectors = ratings.rating_vectors(rated, entity)
    size = ratings.vector_size(rated, entity).scalar()
    return vectors.select(
        "person_id", size.alias("size"), F.posexplode("rating_vector").alias("position", "entry")
    ).select("person_id", "size", "position", F.col("entry.index").alias("index"), F.col("entry.value").alias("value"))


@_report
def place_rating_vectors(t: DriverTables) -> DataFrame:
    return _vector_rows(ratings.ratings(visits_of(t), "place_id", MAX_RATED_PLACES), "place_id")


@_report
def category_rating_vectors(t: DriverTables) -> DataFrame:
    return _vector_rows(ratings.ratings(visits_of(t), "category_id", MAX_RATED_CATEGORIES), "category_id")


@_report
def rating_norms(t: DriverTables) -> DataFrame:
    rated = ratings.ratings(visits_of(t), "place_id", MAX_RATED_PLACES)
    return ratings.rating_norms(rated).select("person_id", _rounded("norm"))


@_report
def region_place_ratings(t: DriverTables) -> DataFrame:
    counts = ratings.visit_counts(visits_of(t))
    return ratings.region_place_ratings(counts, region_sets.all_region_sets(t.places()), TIGHT_TOP_PLACES)


@_report
def region_category_ratings(t: DriverTables) -> DataFrame:
    counts = ratings.visit_counts(visits_of(t))
    return ratings.region_category_ratings(counts, region_sets.all_region_sets(t.places()), TIGHT_TOP_CATEGORIES)


# --- graph --------------------------------------------------------------------------


def _edges(found: DataFrame) -> DataFrame:
    return found.select("source_id", "target_id", _rounded("weight"))


@_report
def edges_person_place(t: DriverTables) -> DataFrame:
    return _edges(edges.person_likes_place_edges(visits_of(t), TIGHT_TOP_PLACES))


@_report
def edges_person_category(t: DriverTables) -> DataFrame:
    return _edges(edges.person_likes_category_edges(visits_of(t), TIGHT_TOP_CATEGORIES))


@_report
def edges_category_place(t: DriverTables) -> DataFrame:
    return _edges(edges.category_selected_place_edges(visits_of(t), TIGHT_TOP_PLACES))


@_report
def edges_place_place(t: DriverTables) -> DataFrame:
    return _edges(edges.place_similar_place_edges(visits_of(t)))


@_report
def edges_place_place_banded(t: DriverTables) -> DataFrame:
    """Facts of 30 days, so the seven-day interval decides which visits pair."""
    return _edges(edges.place_similar_place_edges(visits_of(t, ALL_DAYS)))


@_report
def covisits_of_heavy_persons(t: DriverTables) -> DataFrame:
    """Co-visits of 30 days with limits so low that many persons count as heavy."""
    found = covisits.covisits_within(visits_of(t, ALL_DAYS), edges.SIMILARITY_DAYS, HEAVY_PLACES, HEAVY_VISITS)
    return found.groupBy("place_id", "that_place_id").agg(F.sum("visit_pairs").alias("visit_pairs"))


@_report
def region_set_visits(t: DriverTables) -> DataFrame:
    sets = region_sets.all_region_sets(t.places())
    copies = region_sets.expand_to_region_sets(ratings.visit_counts(visits_of(t)), sets)
    return copies.groupBy("region_set").agg(F.sum("visits").alias("visits"))


@_report
def region_set_members(t: DriverTables) -> DataFrame:
    return region_sets.all_region_sets(t.places())


@_report
def stochastic_graph(t: DriverTables) -> DataFrame:
    return graph_of(t).select("region_set", "source_id", "target_id", _rounded("balanced_weight"))


@_report
def stochastic_graph_all_days(t: DriverTables) -> DataFrame:
    """From facts of 30 days, in which the seven-day interval decides which visits pair."""
    sets = region_sets.all_region_sets(t.places())
    found = graph.stochastic_graphs(visits_of(t, ALL_DAYS), sets, BETA_PERSON_PLACE, BETA_PERSON_CATEGORY)
    return found.select("region_set", "source_id", "target_id", _rounded("balanced_weight"))


@_report
def graph_source_sums(t: DriverTables) -> DataFrame:
    return graph.graph_source_sums(graph_of(t)).select("region_set", "source_id", _sum_rounded("weight_sum"))


@_report
def graph_vertices(t: DriverTables) -> DataFrame:
    return graph.graph_vertices(graph_of(t))


@_report
def vertex_id_collisions(t: DriverTables) -> DataFrame:
    """Person ids moved onto the place ids, to see the collisions found."""
    moved = visits_of(t, ALL_DAYS).withColumn("person_id", F.col("person_id") - 100_000 + 40)
    return graph.vertex_id_collisions(moved)


# --- requests and recommendations ---------------------------------------------------


@_report
def resolved_requests(t: DriverTables) -> DataFrame:
    return resolved(t)


@_report
def rejected_requests(t: DriverTables) -> DataFrame:
    rejected = requests.rejected_requests(t.requests(), t.persons())
    return rejected.select("person_id", F.coalesce("region_id", F.lit(-1).cast("long")).alias("region_id"), "reason")


@_report
def requests_outside_graph(t: DriverTables) -> DataFrame:
    return requests.requests_outside_graph(resolved(t), requested_graph(t))


@_report
def requests_without_ratings(t: DriverTables) -> DataFrame:
    asked = resolved(t)
    rated = region_ratings(t, region_sets.requested_region_sets(asked))
    return requests.requests_without_ratings(asked, *rated)


def _walked(found: DataFrame) -> DataFrame:
    return found.select("region_set", "person_id", "id", _sum_rounded("probability", 8))


@_report
def walk_one_step(t: DriverTables) -> DataFrame:
    return _walked(walk.walk_recommend(requested_graph(t), resolved(t), epsilon=0.0, max_iterations=1))


@_report
def walk_fixed_steps(t: DriverTables) -> DataFrame:
    return _walked(walk.walk_recommend(requested_graph(t), resolved(t), epsilon=0.0, max_iterations=FIXED_STEPS))


@_report
def walk_converged(t: DriverTables) -> DataFrame:
    return _walked(walk.walk_recommend(requested_graph(t), resolved(t), EPSILON, MAX_ITERATIONS))


@_report
def walk_steps(t: DriverTables) -> DataFrame:
    """How many steps each person's walk takes until it converges or is stopped."""
    steps = walk.walk(requested_graph(t), resolved(t), FINE_EPSILON, MAX_ITERATIONS)[1]
    return steps.withColumn("steps", F.col("steps").cast("long"))


@_report
def walk_recommended_places(t: DriverTables) -> DataFrame:
    asked = resolved(t)
    best = walk.walk_recommended_places(
        requested_graph(t), asked, t.places(), EPSILON, MAX_ITERATIONS, MAX_RECOMMENDATIONS
    )
    return best.select("person_id", "region_id", "id", "category_id", "name", _sum_rounded("probability"))


def _asked_and_rated(t: DriverTables) -> tuple[DataFrame, tuple[DataFrame, DataFrame]]:
    """Requests and the ratings of their region sets. Both meet many times, so the requests are kept too."""
    asked = materialize(resolved(t))
    sets = materialize(region_sets.requested_region_sets(asked))
    return asked, region_ratings(t, sets)


@_report
def similar_persons(t: DriverTables) -> DataFrame:
    asked, rated = _asked_and_rated(t.stored())
    found = neighbours.similar_persons(*rated, asked, PLACE_WEIGHT, CATEGORY_WEIGHT, K_NEAREST)
    return found.select("region_set", "target_id", "person_id", _rounded("similarity"))


@_report
def similar_persons_by_bounds(t: DriverTables) -> DataFrame:
    """As ``similar_persons``, by bounds whatever the size."""
    asked, rated = _asked_and_rated(t.stored())
    ratings_of_all = neighbours.long_form(*rated)
    weights = {"place": PLACE_WEIGHT, "category": CATEGORY_WEIGHT}
    found = BoundedNeighbours(ratings_of_all, asked, weights, K_NEAREST).nearest()
    return found.select("region_set", "target_id", "person_id", _rounded("similarity"))


@_report
def cosine_pairs(t: DriverTables) -> DataFrame:
    """Place and category cosine of every two persons of a region set that share an entity."""
    asked, rated = _asked_and_rated(t.stored())
    found = neighbours.similarities(*rated, asked)
    return found.select("region_set", "target_id", "person_id", _pair_rounded("place_similarity"), _pair_rounded("category_similarity"))


@_report
def similar_persons_large_k(t: DriverTables) -> DataFrame:
    """As many neighbours as a production run asks for, found digit by digit."""
    asked, rated = _asked_and_rated(t.stored())
    found = neighbours.similar_persons(*rated, asked, PLACE_WEIGHT, CATEGORY_WEIGHT, LARGE_K)
    return found.select("region_set", "target_id", "person_id", _pair_rounded("similarity"))


def _estimates(asked: DataFrame, rated: tuple[DataFrame, DataFrame]) -> DataFrame:
    return neighbours.knn_recommend(*rated, asked, PLACE_WEIGHT, CATEGORY_WEIGHT, K_NEAREST)


@_report
def knn_estimates(t: DriverTables) -> DataFrame:
    return _estimates(*_asked_and_rated(t.stored())).select("region_set", "person_id", "place_id", _sum_rounded("estimated_rating"))


@_report
def knn_recommended_places(t: DriverTables) -> DataFrame:
    t = t.stored()
    asked, rated = _asked_and_rated(t)
    best = requests.recommended_places(
        _estimates(asked, rated), t.places(), asked, "estimated_rating", MAX_RECOMMENDATIONS, place="place_id"
    )
    return best.select("person_id", "region_id", "id", "category_id", "name", _sum_rounded("estimated_rating"))


@_report
def knn_recommended_places_large_n(t: DriverTables) -> DataFrame:
    """More places than a window would keep, by ratings above 1."""
    t = t.stored()
    asked, rated = _asked_and_rated(t)
    best = requests.recommended_places(
        _estimates(asked, rated), t.places(), asked, "estimated_rating", LARGE_N, place="place_id"
    )
    return best.select("person_id", "region_id", "id", "category_id", "name", _sum_rounded("estimated_rating"))


# --- duplicate places ---------------------------------------------------------------


@_report
def dedup_pairs(t: DriverTables) -> DataFrame:
    """The rows of the pair join, counted per place."""
    found = dedup.dedup_pair_counts(t.candidate_places(), t.confirmed_places())
    return found.select("id", "region_id", "name", "different_places")


@_report
def drop_duplicate_places(t: DriverTables) -> DataFrame:
    return dedup.drop_duplicate_places(t.candidate_places(), t.confirmed_places()).select("id", "region_id", "name")


@_report
def mark_duplicate_places(t: DriverTables) -> DataFrame:
    """Every place; -1 where it is no duplicate."""
    marked = dedup.mark_duplicate_places(t.candidate_places(), t.confirmed_places())
    return marked.select(
        "id",
        "region_id",
        "name",
        F.coalesce("duplicate_of", F.lit(-1).cast("long")).alias("duplicate_of"),
        F.round(F.coalesce("duplicate_distance", F.lit(-1.0)), 6).alias("duplicate_distance"),
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(DriverTables(use_utc(spark), sf_dir))

    return {name: runner(query) for name, query in _queries.items()}
