"""Ratings (visit counts per person) and sparse rating vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.ranking import none_is_cut, top_n_in_sets, top_n_with_ties
from wayfare.functions.times import epoch_millis
from wayfare.operators.region_sets import expand_to_region_sets

# Fixed values
TOP_RATED_PLACES = 100
TOP_RATED_CATEGORIES = 10
_MAX_INT = 2_147_483_647


def ratings(
    place_visits: DataFrame, entity: str, top_n: int, rating: str = "rating", keys: Sequence[str] = ()
) -> DataFrame:
    """``(person_id, entity, rating)``: a person's most visited entities, ties included."""
    counts = place_visits.groupBy(*keys, "person_id", entity).agg(F.count(F.lit(1)).alias(rating))
    return top_n_with_ties(counts, [*keys, "person_id"], rating, top_n)


def place_ratings(place_visits: DataFrame) -> DataFrame:
    """Preset: the top 100 places of a person."""
    return ratings(place_visits, "place_id", TOP_RATED_PLACES, "place_rating")


def category_ratings(place_visits: DataFrame) -> DataFrame:
    """Preset: the top 10 categories of a person."""
    return ratings(place_visits, "category_id", TOP_RATED_CATEGORIES, "category_rating")


def visit_counts(place_visits: DataFrame) -> DataFrame:
    """Visits per person and place: the one pass over the facts that all else starts from.

    A place has one region and one category, so both ride along as keys.
    """
    return place_visits.groupBy("person_id", "place_id", "region_id", "category_id").agg(
        F.count(F.lit(1)).alias("visits")
    )


def timed_visit_counts(place_visits: DataFrame) -> DataFrame:
    """``visit_counts`` with the first and last millisecond of each person's visits to a place."""
    millis = epoch_millis(F.col("timestamp"))
    return place_visits.groupBy("person_id", "place_id", "region_id", "category_id").agg(
        F.count(F.lit(1)).alias("visits"), F.min(millis).alias("first_millis"), F.max(millis).alias("last_millis")
    )


def span_millis(timed_counts: DataFrame) -> int:
    """Milliseconds between the first and the last visit of all; 0 for no visits."""
    row = timed_counts.agg(F.min("first_millis").alias("a"), F.max("last_millis").alias("b")).first()
    return 0 if row.a is None else row.b - row.a


def region_place_ratings(counts: DataFrame, sets: DataFrame, top_n: int, rating: str = "rating") -> DataFrame:
    """Place ratings of every region set, from the output of ``visit_counts``.

    A place lies in one region, so its count is the same in every set.
    """
    rated = counts.select("person_id", "region_id", "place_id", F.col("visits").alias(rating))
    kept = top_n_in_sets(rated, sets, ["region_id"], ["person_id"], rating, top_n)
    return kept.select("region_set", "person_id", "place_id", rating)


def region_category_ratings(counts: DataFrame, sets: DataFrame, top_n: int, rating: str = "rating") -> DataFrame:
    """Category ratings of every region set; a category's visits add up over the regions."""
    own_region = counts.groupBy("person_id", "region_id", "category_id").agg(F.sum("visits").alias(rating))
    in_sets = (
        expand_to_region_sets(own_region, sets)
        .groupBy("region_set", "person_id", "category_id")
        .agg(F.sum(rating).alias(rating))
    )
    # A set's categories of a person are some of all those of the person.
    if none_is_cut(counts.select("person_id", "category_id").distinct(), ["person_id"], top_n):
        return in_sets.where(F.col("region_set").isNotNull() & F.col("person_id").isNotNull() & F.col(rating).isNotNull())
    return top_n_with_ties(in_sets, ["region_set", "person_id"], rating, top_n)


def vector_size(ratings_df: DataFrame, entity: str) -> DataFrame:
    """One row, ``size``: the largest entity id plus one, which must fit in an int."""
    size = F.max(entity) + 1
    checked = F.when((size <= _MAX_INT) & (F.min(entity) >= 0), size).otherwise(
        F.when(
            size.isNotNull(),
            F.raise_error(F.format_string("%s %s does not fit a vector index", F.lit(entity), F.max(entity))).cast("long"),
        )
    )
    return ratings_df.agg(checked.cast("int").alias("size"))


def rating_vectors(
    ratings_df: DataFrame, entity: str, rating: str = "rating", vector: str = "rating_vector", keys: Sequence[str] = ()
) -> DataFrame:
    """One sparse vector per person: ``array<struct<index, value>>`` sorted by index.

    An index is unique within a vector because ratings are grouped by entity. All vectors
    of a table share one size, see ``vector_size``.
    """
    entry = F.struct(F.col(entity).cast("int").alias("index"), F.col(rating).cast("double").alias("value"))
    return ratings_df.groupBy(*keys, "person_id").agg(F.array_sort(F.collect_list(entry)).alias(vector))


def vector_norm(vector: Column) -> Column:
    """Euclidean length of an array of ``struct<index, value>``."""
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, e: total + e["value"] * e["value"]))


def rating_norms(ratings_df: DataFrame, rating: str = "rating", keys: Sequence[str] = ()) -> DataFrame:
    """Euclidean length of each person's ratings in long form."""
    return ratings_df.groupBy(*keys, "person_id").agg(
        F.sqrt(F.sum(F.col(rating) * F.col(rating)).cast("double")).alias("norm")
    )
