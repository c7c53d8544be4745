"""Explicit table schemas, so that no read infers types; partition columns come last."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PERSONS = _struct(id=T.LongType(), home_region_id=T.LongType())

PLACES = _struct(
    id=T.LongType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
    category_id=T.LongType(),
    name=T.StringType(),
    description=T.StringType(),
    region_id=T.LongType(),
)

CATEGORIES = _struct(category=T.StringType(), category_id=T.LongType())

LOCATION_VISITS = _struct(
    person_id=T.LongType(),
    latitude=T.DoubleType(),
    longitude=T.DoubleType(),
    timestamp=T.TimestampType(),
    region_id=T.LongType(),
    year_month=T.StringType(),
)

REGIONS = _struct(
    id=T.LongType(),
    name=T.StringType(),
    min_latitude=T.DoubleType(),
    max_latitude=T.DoubleType(),
    min_longitude=T.DoubleType(),
    max_longitude=T.DoubleType(),
)

PLACE_VISITS = _struct(
    person_id=T.LongType(),
    timestamp=T.TimestampType(),
    place_id=T.LongType(),
    region_id=T.LongType(),
    category_id=T.LongType(),
)

GRAPH = _struct(
    source_id=T.LongType(),
    target_id=T.LongType(),
    balanced_weight=T.DoubleType(),
    region_set=T.StringType(),
)

GRAPH_COUNTS = _struct(
    that_region_id=T.LongType(),
    source_id=T.LongType(),
    target_id=T.LongType(),
    visits=T.LongType(),
    kind=T.StringType(),
    region_id=T.LongType(),
)

GRAPH_CUTS = _struct(
    kind=T.StringType(),
    source_id=T.LongType(),
    lowest=T.LongType(),
    total=T.LongType(),
    region_set=T.StringType(),
)


def ratings(entity: str) -> T.StructType:
    return _struct(person_id=T.LongType(), **{entity: T.LongType()}, rating=T.LongType(), region_set=T.StringType())
