"""Neighbour reports pass over the events once, and alike persons side by side do not loosen a floor."""

from __future__ import annotations

import numpy as np
import pytest

from wayfare.operators.bounded_neighbours import _floors
from wayfare.plans import report
from wayfare.sources.driver_tables import DriverTables


@pytest.mark.parametrize(
    "name", ["similar_persons", "knn_estimates", "knn_recommended_places", "knn_recommended_places_large_n"]
)
def test_events_are_read_once(spark, monkeypatch, name):
    read = []

    def counted(self, table, plain=DriverTables._read):
        read.append(table)
        return plain(self, table)

    monkeypatch.setattr(DriverTables, "_read", counted)
    found = report.all_queries()[name](spark, "/root/testdata/sf0.001")
    assert read == ["events"]
    # Nothing in the plan goes back to the text of the events either.
    assert "get_json_object" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_stored_tables_hold_the_same_rows(spark):
    plain = DriverTables(spark, "/root/testdata/sf0.001")
    stored = plain.stored()
    for rows in ("location_visits", "places", "persons", "requests"):
        mine, theirs = getattr(stored, rows)(), getattr(plain, rows)()
        assert mine.schema == theirs.schema
        assert sorted(mine.collect(), key=str) == sorted(theirs.collect(), key=str)


def test_floors_count_alike_persons_side_by_side():
    k, width = 3, 4 * 256
    found = np.zeros((2, width), np.float32)
    found[0, 8:11] = found[1, 500:503] = 0.75
    assert _floors(found, k).tolist() == [0.75, 0.75]
    chance = np.random.default_rng(1).random((5, 3000), np.float32)
    assert (_floors(chance, k) <= np.sort(chance, axis=1)[:, -k]).all()
