"""The four edge sets ``(source_id, target_id, weight)`` of the stochastic graph.

Each keeps a source's most frequent targets, ties included, and turns their counts into
shares, so the weights of a source sum to 1 after the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.ranking import top_n_with_ties
from wayfare.functions.times import DAY_MILLIS
from wayfare.operators.covisits import covisits_any_time, covisits_within
from wayfare.operators.ratings import span_millis, timed_visit_counts
from wayfare.runtime import materialize

# Fixed values
TOP_PLACES_PER_PERSON = 100
TOP_CATEGORIES_PER_PERSON = 100
TOP_PLACES_PER_CATEGORY = 100
TOP_SIMILAR_PLACES = 50
SIMILARITY_DAYS = 7


def shares(kept: DataFrame, source: str, target: str, count: str, keys: Sequence[str] = ()) -> DataFrame:
    return kept.select(
        *keys,
        F.col(source).alias("source_id"),
        F.col(target).alias("target_id"),
        (F.col(count) / F.col("_total")).alias("weight"),
    )


def share_edges(
    counts: DataFrame, source: str, target: str, count: str, top_n: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Edges from counted ``(source, target)`` pairs."""
    kept = top_n_with_ties(counts, [*keys, source], count, top_n, total="_total")
    return shares(kept, source, target, count, keys)


def _visit_share_edges(place_visits: DataFrame, source: str, target: str, top_n: int) -> DataFrame:
    counts = place_visits.groupBy(source, target).agg(F.count(F.lit(1)).alias("visits"))
    return share_edges(counts, source, target, "visits", top_n)


def person_likes_place_edges(place_visits: DataFrame, top_n: int = TOP_PLACES_PER_PERSON) -> DataFrame:
    return _visit_share_edges(place_visits, "person_id", "place_id", top_n)


def person_likes_category_edges(place_visits: DataFrame, top_n: int = TOP_CATEGORIES_PER_PERSON) -> DataFrame:
    return _visit_share_edges(place_visits, "person_id", "category_id", top_n)


def category_selected_place_edges(place_visits: DataFrame, top_n: int = TOP_PLACES_PER_CATEGORY) -> DataFrame:
    return _visit_share_edges(place_visits, "category_id", "place_id", top_n)


def covisits(place_visits: DataFrame, interval_days: int, counts: DataFrame) -> DataFrame:
    """Co-visit counts, from facts and their ``timed_visit_counts``.

    The facts decide the form: when they span no more than the interval, every two visits
    of a person count, and the counts are enough.
    """
    if span_millis(counts) <= interval_days * DAY_MILLIS:
        return covisits_any_time(counts)
    return covisits_within(place_visits, interval_days)


def place_similar_place_edges(
    place_visits: DataFrame,
    interval_days: int = SIMILARITY_DAYS,
    top_n: int = TOP_SIMILAR_PLACES,
) -> DataFrame:
    """Edges between places that the same persons visit within ``interval_days``."""
    visits = materialize(timed_visit_counts(place_visits))
    counts = materialize(
        covisits(place_visits, interval_days, visits)
        .groupBy("place_id", "that_place_id")
        .agg(F.sum("visit_pairs").alias("visit_pairs"))
    )
    return share_edges(counts, "place_id", "that_place_id", "visit_pairs", top_n)
