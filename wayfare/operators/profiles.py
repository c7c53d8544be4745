"""Profiles of visits and places, and data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.runtime import materialize

from wayfare.functions.text import label
from wayfare.functions.times import year_month


def visit_summary(visits: DataFrame) -> DataFrame:
    """One row: number of visits, first and last time, number of distinct visitors."""
    return visits.agg(
        F.count(F.lit(1)).alias("visits"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
        F.count_distinct("person_id").alias("visitors"),
    )


def visit_counts_by_region(visits: DataFrame) -> DataFrame:
    return visits.groupBy("region_id").agg(F.count(F.lit(1)).alias("visits"))


def location_profile_by_region(visits: DataFrame) -> DataFrame:
    """Per region: number of visits and the extent and mean of their coordinates."""
    spans = [
        how(axis).alias(f"{name}_{axis}")
        for axis in ("latitude", "longitude")
        for name, how in (("min", F.min), ("max", F.max), ("avg", F.avg))
    ]
    return visits.groupBy("region_id").agg(F.count(F.lit(1)).alias("visits"), *spans)


def top_visitors(visits: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` persons with most visits; equal counts go by person id."""
    counts = visits.groupBy("person_id").agg(F.count(F.lit(1)).alias("visits"))
    return counts.orderBy(F.col("visits").desc(), "person_id").limit(n)


def visit_counts_by_month(visits: DataFrame) -> DataFrame:
    return visits.groupBy("region_id", year_month(F.col("timestamp")).alias("year_month")).agg(
        F.count(F.lit(1)).alias("visits")
    )


def place_profile(places: DataFrame) -> DataFrame:
    """Number of places in total, per region and per category, in one pass.

    The row of a total has null ids; ``level`` tells the three apart.
    """
    level = (
        F.when((F.grouping("region_id") == 1) & (F.grouping("category_id") == 1), "total")
        .when(F.grouping("category_id") == 1, "region")
        .otherwise("category")
    )
    return places.groupingSets(
        [[], [F.col("region_id")], [F.col("category_id")]], F.col("region_id"), F.col("category_id")
    ).agg(F.count(F.lit(1)).alias("places"), level.alias("level"))


def bounding_box_violations(visits: DataFrame, regions: DataFrame) -> DataFrame:
    """Visits outside the box of their region, with the axis or axes that are off."""
    boxes = regions.select(
        F.col("id").alias("region_id"), "min_latitude", "max_latitude", "min_longitude", "max_longitude"
    )
    latitude_off = (F.col("latitude") < F.col("min_latitude")) | (F.col("latitude") > F.col("max_latitude"))
    longitude_off = (F.col("longitude") < F.col("min_longitude")) | (F.col("longitude") > F.col("max_longitude"))
    return (
        visits.join(boxes, "region_id")
        .where(latitude_off | longitude_off)
        .withColumn("latitude_off", latitude_off)
        .withColumn("longitude_off", longitude_off)
        .select(*visits.columns, "latitude_off", "longitude_off")
    )


def bounding_box_violation_counts(visits: DataFrame, regions: DataFrame) -> DataFrame:
    return (
        bounding_box_violations(visits, regions)
        .groupBy("region_id")
        .agg(
            F.count_if("latitude_off").alias("latitude_violations"),
            F.count_if("longitude_off").alias("longitude_violations"),
        )
    )


def assert_inside_bounding_boxes(visits: DataFrame, regions: DataFrame) -> None:
    """Raise when a visit lies outside the box of its region, and name the regions."""
    bad = materialize(bounding_box_violation_counts(visits, regions))
    number = bad.count()
    if number:
        found = ", ".join(
            f"region {r.region_id}: {r.latitude_violations} latitudes, {r.longitude_violations} longitudes"
            for r in bad.orderBy("region_id").limit(20).collect()
        )
        raise ValueError(f"visits outside the box of their region in {number} regions, the first are {found}")


def named_places(places: DataFrame, categories: DataFrame) -> DataFrame:
    """Places with their category name and a ``category-id`` label.

    Categories are a dimension; Spark broadcasts them when it measures them as small.
    """
    return places.join(categories, "category_id").withColumn("label", label(F.col("category"), F.col("id")))
