"""Loaders and writers of the input tables and of the tables kept per region set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.functions.times import year_month
from wayfare.runtime import delete_folder, hadoop_path as _path
from wayfare.sources import schemas

# Names of the tables kept per region set.
GRAPH_TABLE = "stochastic_graph"
GRAPH_COUNTS_TABLE = "graph_counts"
GRAPH_CUTS_TABLE = "graph_cuts"
PLACE_RATINGS_TABLE = "place_ratings"
CATEGORY_RATINGS_TABLE = "category_ratings"
PLACE_RATING_VECTORS_TABLE = "place_rating_vectors"
CATEGORY_RATING_VECTORS_TABLE = "category_rating_vectors"
PLACE_VISITS_TABLE = "place_visits"
# Columns in which single ids are looked up when requests are served.
LOOKUPS = {
    GRAPH_TABLE: ("source_id", "target_id"),
    PLACE_RATINGS_TABLE: ("person_id",),
    CATEGORY_RATINGS_TABLE: ("person_id",),
    PLACE_RATING_VECTORS_TABLE: ("person_id",),
    CATEGORY_RATING_VECTORS_TABLE: ("person_id",),
}


def load_persons(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PERSONS).parquet(path)


def load_places(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PLACES).parquet(path)


def load_categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CATEGORIES).parquet(path)


def load_location_visits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LOCATION_VISITS).parquet(path)


def load_place_visits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PLACE_VISITS).parquet(path)


def _write(df: DataFrame, path: str, partition_by: Sequence[str] = (), lookup: Sequence[str] = (), **options: str) -> None:
    """Overwrite ``path``; the rebalance hint splits partitions that hold too many rows.

    A plain ``repartition`` on the partition columns would put a hot region in one task.
    Columns of ``lookup`` are those that single ids are looked up in: files are sorted by
    the first one and have a Bloom filter for each, so a lookup reads a few pages.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if lookup:
        df = df.sortWithinPartitions(*partition_by, lookup[0])
    filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in lookup} | ({"parquet.bloom.filter.adaptive.enabled": "true"} if lookup else {})
    df.write.mode("overwrite").options(**filters, **options).partitionBy(*partition_by).parquet(path)


def rows_with_ids(df: DataFrame, columns: Sequence[str], ids: Sequence[int]) -> DataFrame:
    """Rows of a stored table that have one of a few ids in one of the columns.

    Written as equalities, which reach the file filters, sorted pages and Bloom filters.
    """
    if not ids:
        return df.where(F.lit(False))
    return df.where(reduce(or_, [F.col(c) == F.lit(i) for c in columns for i in ids]))


def write_persons(persons: DataFrame, path: str) -> None:
    _write(persons.select("id", "home_region_id"), path, ["home_region_id"])


def write_places(places: DataFrame, path: str) -> None:
    _write(places.select(*schemas.PLACES.names), path, ["region_id"])


def write_categories(categories: DataFrame, path: str) -> None:
    _write(categories.select("category", "category_id"), path)


def write_location_visits(visits: DataFrame, path: str) -> None:
    dated = visits.withColumn("year_month", year_month(F.col("timestamp")))
    dated = dated.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    _write(dated.select(*schemas.LOCATION_VISITS.names), path, ["region_id", "year_month"])


def write_place_visits(place_visits: DataFrame, path: str) -> None:
    stored = place_visits.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    _write(stored.select(*schemas.PLACE_VISITS.names), path)


def region_set_key(region_ids: Column) -> Column:
    """Key such as ``region0_region2`` of an array of region ids, in any order, with repeats."""
    ordered = F.array_sort(F.array_distinct(region_ids))
    return F.array_join(F.transform(ordered, lambda r: F.concat(F.lit("region"), r.cast("string"))), "_")


def write_region_sets(df: DataFrame, root: str, table: str) -> None:
    """Write the rows of all region sets at once, one folder per set."""
    _write(df, f"{root}/{table}", ["region_set"], LOOKUPS.get(table, ()))


def replace_region_sets(df: DataFrame, root: str, table: str, names: Sequence[str]) -> None:
    """Replace the rows of the named region sets; the folders of all other sets stay as they are.

    Rows of other sets raise, before anything is replaced. A named set without rows ends
    without a folder. New files come first, so a job that fails in between leaves old sets
    or new ones, and running it again ends the same. A table that does not exist is made.
    """
    wanted = sorted(set(names))
    allowed = F.col("region_set").isin(wanted) if wanted else F.lit(False)
    told = F.raise_error(F.concat(F.lit("not a set to replace: "), F.coalesce(F.col("region_set"), F.lit("null"))))
    checked = df.withColumn("region_set", F.when(allowed, F.col("region_set")).otherwise(told.cast("string")))
    path = f"{root}/{table}"
    spark = df.sparkSession
    folders = [f"{path}/region_set={name}" for name in wanted]
    before = {folder: _file_names(spark, folder) for folder in folders}
    _write(checked, path, ["region_set"], LOOKUPS.get(table, ()), partitionOverwriteMode="dynamic")
    for folder in folders:
        if before[folder] and _file_names(spark, folder) == before[folder]:
            # No row came for this set.
            delete_folder(spark, folder)


def _file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder of any store that Spark reads; empty where there is none."""
    path, system = _path(spark, folder)
    return sorted(f.getPath().getName() for f in system.listStatus(path)) if system.exists(path) else []


def stored_region_sets(spark: SparkSession, root: str, table: str) -> list[str]:
    """Names of the sets that have a folder, without reading any file."""
    start = "region_set="
    return [n.removeprefix(start) for n in _file_names(spark, f"{root}/{table}") if n.startswith(start)]


def load_region_sets(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType | None = None,
    region_set: str | Sequence[str] | None = None,
) -> DataFrame:
    """Read a table kept per region set; naming one or several sets reads their folders only."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.parquet(f"{root}/{table}")
    if region_set is None:
        return rows
    return rows.where(F.col("region_set").isin([region_set] if isinstance(region_set, str) else list(region_set)))


def write_graph_counts(counts: DataFrame, root: str) -> None:
    """Counts of factored graphs, by kind and region."""
    _write(counts.select(*schemas.GRAPH_COUNTS.names), f"{root}/{GRAPH_COUNTS_TABLE}", ["kind", "region_id"])


def load_graph_counts(spark: SparkSession, root: str, regions: Sequence[int] | None = None) -> DataFrame:
    """Counts of factored graphs; naming regions reads what lies between them only."""
    rows = spark.read.schema(schemas.GRAPH_COUNTS).parquet(f"{root}/{GRAPH_COUNTS_TABLE}")
    if regions is None:
        return rows
    return rows.where(F.col("region_id").isin(list(regions)) & F.col("that_region_id").isin(list(regions)))
