from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wayfare.runtime import release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("wayfare-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from wayfare.sources.driver_tables import DriverTables

    return DriverTables(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def facts(tables):
    """Place visits of the last week and of all days, computed once."""
    from wayfare.operators.place_visits import place_visits
    from wayfare.runtime import materialize

    visits, places = tables.location_visits(), tables.places()
    return {days: materialize(place_visits(visits, places, days)) for days in (7, 30)}
