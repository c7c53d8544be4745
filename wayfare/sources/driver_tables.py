"""Visits, places, persons and requests derived from the test tables.

The mapping is deterministic and runs in Spark, so every table grows with its source.
``k`` is the integer in ``events.props``; ids of persons, places and categories are disjoint.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.text import label
from wayfare.runtime import materialize

# Fixed values of the mapping.
FIRST_PLACE_ID = 40
FIRST_PERSON_ID = 100_000
PLACES_PER_REGION = 34
CATEGORY_COUNT = 5
REGION_COUNT = 3
BASE_LATITUDE, BASE_LONGITUDE = 55.0, 37.0
UNKNOWN_PERSON_ID = 999_999
REGION_MARGIN_DEGREES = 0.002


@dataclass(frozen=True)
class DriverTables:
    spark: SparkSession
    sf_dir: str
    events: DataFrame | None = None

    def stored(self) -> DriverTables:
        """The same tables over events that are parsed once and kept, for jobs that pass over them often."""
        return replace(self, events=materialize(self._events().select("event_id", "user_id", "ts", "k")))

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _events(self) -> DataFrame:
        """Events with ``k``. Exploding the single value keeps filters on what follows from
        ``k`` above the JSON parsing, which they would otherwise repeat."""
        if self.events is not None:
            return self.events
        slot = F.get_json_object("props", "$.k").cast("long")
        return self._read("events").withColumn("k", F.explode(F.array(slot)))

    def location_visits(self) -> DataFrame:
        k, event = F.col("k"), F.col("event_id")
        return self._events().select(
            event,
            (F.col("user_id") + FIRST_PERSON_ID).alias("person_id"),
            F.floor(k / PLACES_PER_REGION).alias("region_id"),
            F.col("ts").alias("timestamp"),
            (BASE_LATITUDE + F.floor(k / 10) * 0.0018 + ((event % 7) - 3) * 0.0003).alias("latitude"),
            (BASE_LONGITUDE + (k % 10) * 0.0025 + ((event % 5) - 2) * 0.0006).alias("longitude"),
        )

    def places(self) -> DataFrame:
        k = F.col("k")
        slots = self._events().select("k").where(k.isNotNull()).distinct()
        return slots.select(
            (k + FIRST_PLACE_ID).alias("id"),
            F.floor(k / PLACES_PER_REGION).alias("region_id"),
            (k % CATEGORY_COUNT).alias("category_id"),
            label(F.lit("place"), k).alias("name"),
            label(F.lit("place"), k).alias("description"),
            (BASE_LATITUDE + F.floor(k / 10) * 0.0018).alias("latitude"),
            (BASE_LONGITUDE + (k % 10) * 0.0025).alias("longitude"),
        )

    def persons(self) -> DataFrame:
        events = self._read("events") if self.events is None else self.events
        users = events.select("user_id").distinct()
        return users.select(
            (F.col("user_id") + FIRST_PERSON_ID).alias("id"),
            (F.col("user_id") % REGION_COUNT).alias("home_region_id"),
        )

    def categories(self) -> DataFrame:
        ids = self.places().select("category_id").distinct()
        return ids.select("category_id", label(F.lit("category"), F.col("category_id")).alias("category"))

    def regions(self, margin: float = REGION_MARGIN_DEGREES) -> DataFrame:
        """The box around a region's places, widened by ``margin`` degrees."""
        return (
            self.places()
            .groupBy(F.col("region_id").alias("id"))
            .agg(
                (F.min("latitude") - margin).alias("min_latitude"),
                (F.max("latitude") + margin).alias("max_latitude"),
                (F.min("longitude") - margin).alias("min_longitude"),
                (F.max("longitude") + margin).alias("max_longitude"),
            )
            .withColumn("name", label(F.lit("region"), F.col("id")))
        )

    def requests(self) -> DataFrame:
        """One request per person, half of them without a region, and one unknown person."""
        person = F.col("id")
        user = person - FIRST_PERSON_ID
        wanted = F.when(user % 2 != 0, (user + 1) % REGION_COUNT)
        known = self.persons().select(person.alias("person_id"), wanted.alias("region_id"))
        unknown = known.agg(
            F.lit(UNKNOWN_PERSON_ID).cast("long").alias("person_id"), F.lit(None).cast("long").alias("region_id")
        )
        return known.unionByName(unknown)

    def candidate_places(self) -> DataFrame:
        key = F.col("p_partkey")
        return self._read("part").select(
            key.alias("id"),
            (key % 6).alias("region_id"),
            F.col("p_name").alias("name"),
            (BASE_LATITUDE + (key % 17) * 0.0004).alias("latitude"),
            (BASE_LONGITUDE + (key % 13) * 0.0006).alias("longitude"),
        )

    def confirmed_places(self) -> DataFrame:
        """Places already checked by someone; region 5 has none, on purpose."""
        return self.candidate_places().where((F.col("id") % 41 == 0) & (F.col("region_id") != 5))
