"""The stochastic graph: balanced union of edge sets, for one slice or all region sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.ranking import top_n_in_sets
from wayfare.operators import edges as E
from wayfare.operators.ratings import timed_visit_counts
from wayfare.operators.region_sets import expand_to_region_sets, region_pairs_of_sets
from wayfare.runtime import materialize

# Fixed values
BETA_PLACE_PLACE = 1.0
BETA_CATEGORY_PLACE = 1.0


def check_betas(beta_person_place: float, beta_person_category: float) -> None:
    for beta in (beta_person_place, beta_person_category):
        if not 0.0 < beta < 1.0:
            raise ValueError(f"beta must be between 0 and 1: {beta}")
    if abs(beta_person_place + beta_person_category - 1.0) >= 1e-9:
        raise ValueError(f"betas must sum to 1: {beta_person_place}, {beta_person_category}")


def balance_and_union(edge_sets: Sequence[DataFrame], betas: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Scale each edge set by its beta and put all into one graph."""
    if not edge_sets or len(edge_sets) != len(betas):
        raise ValueError(f"one beta per edge set is needed: {len(edge_sets)} sets, {len(betas)} betas")
    balanced = [
        edges.select(*keys, "source_id", "target_id", (F.col("weight") * F.lit(beta)).alias("balanced_weight"))
        for edges, beta in zip(edge_sets, betas)
    ]
    return reduce(DataFrame.unionByName, balanced)


def stochastic_graph(
    place_visits: DataFrame, beta_person_place: float, beta_person_category: float
) -> DataFrame:
    """The graph of one slice of place visits."""
    check_betas(beta_person_place, beta_person_category)
    return balance_and_union(
        [
            E.place_similar_place_edges(place_visits),
            E.category_selected_place_edges(place_visits),
            E.person_likes_place_edges(place_visits),
            E.person_likes_category_edges(place_visits),
        ],
        [BETA_PLACE_PLACE, BETA_CATEGORY_PLACE, beta_person_place, beta_person_category],
    )


def region_edges(place_visits: DataFrame, region_sets: DataFrame) -> dict[str, DataFrame]:
    """The four edge sets of all region sets at once, keyed by ``region_set``.

    Nothing is counted per set. Visits are counted once per person and place, co-visits
    once per pair of places; a place lies in one region, so those counts hold in every
    set. Both are used several times and written to the checkpoint folder for that.
    """
    counts = materialize(timed_visit_counts(place_visits))
    pairs = materialize(E.covisits(place_visits, E.SIMILARITY_DAYS, counts))

    def summed(source: str, target: str) -> DataFrame:
        return counts.groupBy(source, "region_id", target).agg(F.sum("visits").alias("visits"))

    def in_sets(counted: DataFrame, source: str, target: str, count: str, top_n: int, sets=region_sets, extra=()):
        kept = top_n_in_sets(counted, sets, ["region_id", *extra], [source], count, top_n, total="_total")
        return E.shares(kept, source, target, count, keys=["region_set"])

    # A category's visits add up over the regions of a set before they are ranked.
    person_category = (
        expand_to_region_sets(summed("person_id", "category_id"), region_sets)
        .groupBy("region_set", "person_id", "category_id")
        .agg(F.sum("visits").alias("visits"))
    )
    return {
        "place_place": in_sets(
            pairs,
            "place_id",
            "that_place_id",
            "visit_pairs",
            E.TOP_SIMILAR_PLACES,
            region_pairs_of_sets(region_sets),
            ["that_region_id"],
        ),
        "category_place": in_sets(
            summed("category_id", "place_id"), "category_id", "place_id", "visits", E.TOP_PLACES_PER_CATEGORY
        ),
        "person_place": in_sets(counts, "person_id", "place_id", "visits", E.TOP_PLACES_PER_PERSON),
        "person_category": E.share_edges(
            person_category, "person_id", "category_id", "visits", E.TOP_CATEGORIES_PER_PERSON, keys=["region_set"]
        ),
    }


def stochastic_graphs(
    place_visits: DataFrame,
    region_sets: DataFrame,
    beta_person_place: float,
    beta_person_category: float,
) -> DataFrame:
    """``(region_set, source_id, target_id, balanced_weight)`` of all given region sets."""
    check_betas(beta_person_place, beta_person_category)
    sets = region_edges(place_visits, region_sets)
    betas = {
        "place_place": BETA_PLACE_PLACE,
        "category_place": BETA_CATEGORY_PLACE,
        "person_place": beta_person_place,
        "person_category": beta_person_category,
    }
    return balance_and_union(list(sets.values()), [betas[name] for name in sets], keys=["region_set"])


def graph_vertices(graph: DataFrame, keys: Sequence[str] = ("region_set",)) -> DataFrame:
    """Distinct ids of sources and targets; each edge adds both without a second scan."""
    ends = F.explode(F.array("source_id", "target_id")).alias("id")
    return graph.select(*keys, ends).distinct()


def graph_source_sums(graph: DataFrame, keys: Sequence[str] = ("region_set",)) -> DataFrame:
    """Sum of the outgoing weights of each source; 1 everywhere in a stochastic graph."""
    return graph.groupBy(*keys, "source_id").agg(F.sum("balanced_weight").alias("weight_sum"))


def vertex_id_collisions(place_visits: DataFrame) -> DataFrame:
    """Ids used by more than one of person, place and category, with the kinds.

    Vertices share one id space, so such ids would merge unnoticed. Empty when all is well.
    """
    kinds = [("person_id", "person"), ("place_id", "place"), ("category_id", "category")]
    ends = F.explode(F.array(*[F.struct(F.col(c).alias("id"), F.lit(kind).alias("kind")) for c, kind in kinds]))
    used = place_visits.select("person_id", "place_id", "category_id").select(ends.alias("v")).select("v.*").distinct()
    return (
        used.groupBy("id")
        .agg(F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .drop("_n")
    )


def check_vertex_ids(place_visits: DataFrame) -> None:
    collisions = materialize(vertex_id_collisions(place_visits))
    number = collisions.count()
    if number:
        some = [(r.id, r.kinds) for r in collisions.orderBy("id").limit(5).collect()]
        raise ValueError(f"ids used for more than one kind of vertex: {number}, the first are {some}")
