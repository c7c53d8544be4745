"""Edges, co-visits, region sets, balancing and the graph's checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wayfare.functions.times import within_days
from wayfare.operators import factored_graph, covisits, edges, graph, ratings, region_sets
from wayfare.sources.tables import region_set_key

PAIR = ["place_id", "region_id", "that_place_id", "that_region_id", "visit_pairs"]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def plain_covisits(visits, days=None):
    a, b = visits.alias("a"), visits.alias("b")
    met = a.join(b, F.col("a.person_id") == F.col("b.person_id")).where("a.place_id <> b.place_id")
    if days is not None:
        met = met.where(within_days(F.col("a.timestamp"), F.col("b.timestamp"), days))
    return (
        met.groupBy(
            F.col("a.place_id").alias("place_id"),
            F.col("a.region_id").alias("region_id"),
            F.col("b.place_id").alias("that_place_id"),
            F.col("b.region_id").alias("that_region_id"),
        )
        .agg(F.count(F.lit(1)).alias("visit_pairs"))
        .select(*PAIR)
    )


@pytest.mark.parametrize("block", [2_048, 3])
def test_covisits_any_time_equal_the_self_join(facts, monkeypatch, block):
    monkeypatch.setattr(covisits, "_BLOCK", block)
    got = covisits.covisits_any_time(ratings.visit_counts(facts[7]))
    assert rows(got, *PAIR) == rows(plain_covisits(facts[7]))
    assert rows(got, *PAIR) == rows(plain_covisits(facts[7], days=7))


@pytest.mark.parametrize("days", [1, 7, 40])
@pytest.mark.parametrize("light", [4_096, 6, 0])
def test_covisits_within_equal_the_self_join(facts, monkeypatch, days, light):
    """With a low limit most seams, or all, are compared digit by digit."""
    monkeypatch.setattr(covisits, "_LIGHT_BUCKET", light)
    monkeypatch.setattr(covisits, "_BLOCK", 3 if light == 6 else 2_048)
    got = covisits.covisits_within(facts[30], days)
    assert rows(got, *PAIR) == rows(plain_covisits(facts[30], days))


def test_interval_limit_is_included(spark):
    at = "timestamp_millis(1700000000000L + {})".format
    week = 7 * 86_400_000
    visits = spark.sql(
        f"""select 1L person_id, {at(0)} timestamp, 10L place_id, 0L region_id
        union all select 1L, {at(week)}, 11L, 0L union all select 1L, {at(week + 1)}, 12L, 1L"""
    )
    got = {(r.place_id, r.that_place_id) for r in covisits.covisits_within(visits, 7).collect()}
    assert got == {(10, 11), (11, 10), (11, 12), (12, 11)}


def test_weights_are_shares_after_the_cut(spark):
    visits = spark.createDataFrame(
        [(1, 10, 100)] * 3 + [(1, 11, 100)] * 2 + [(1, 12, 101)] * 2 + [(1, 13, 101)],
        "person_id long, place_id long, category_id long",
    )
    got = rows(edges.person_likes_place_edges(visits, top_n=2))
    assert got == [(1, 10, 3 / 7), (1, 11, 2 / 7), (1, 12, 2 / 7)]
    assert rows(edges.person_likes_category_edges(visits)) == [(1, 100, 5 / 8), (1, 101, 3 / 8)]
    assert rows(edges.category_selected_place_edges(visits, 1)) == [(100, 10, 1.0), (101, 12, 1.0)]


def test_betas_balance_every_source_to_one(spark):
    def edge_set(*found):
        return spark.createDataFrame(found, "source_id long, target_id long, weight double").withColumn(
            "region_id", F.lit(0)
        )

    sets = [
        edge_set((1, 2, 1.0)),
        edge_set((1, 3, 0.4), (1, 5, 0.6)),
        edge_set((3, 5, 1.0), (5, 3, 1.0)),
        edge_set((2, 4, 1.0), (4, 2, 1.0)),
        edge_set((2, 3, 1.0), (4, 5, 1.0)),
    ]
    balanced = graph.balance_and_union(sets, [0.4, 0.6, 1.0, 0.3, 0.7])
    assert balanced.columns == ["source_id", "target_id", "balanced_weight"]
    assert balanced.count() == 9
    for row in graph.graph_source_sums(balanced, keys=()).collect():
        assert row.weight_sum == pytest.approx(1.0, abs=1e-12)
    with pytest.raises(ValueError):
        graph.balance_and_union(sets, [1.0])


@pytest.mark.parametrize("betas", [(0.0, 1.0), (0.5, 0.6), (1.2, -0.2)])
def test_bad_betas(betas):
    with pytest.raises(ValueError):
        graph.check_betas(*betas)


def test_region_set_key(spark):
    df = spark.createDataFrame([([2, 0],), ([10, 2],), ([1, 1],)], "ids array<long>")
    assert [r.k for r in df.select(region_set_key(F.col("ids")).alias("k")).collect()] == [
        "region0_region2",
        "region2_region10",
        "region1",
    ]


def test_all_region_sets(spark):
    places = spark.createDataFrame([(2,), (0,), (1,), (0,), (None,)], "region_id long")
    assert rows(region_sets.all_region_sets(places)) == sorted(
        [("region0", 0), ("region1", 1), ("region2", 2)]
        + [("region0_region1", 0), ("region0_region1", 1), ("region0_region2", 0)]
        + [("region0_region2", 2), ("region1_region2", 1), ("region1_region2", 2)]
    )


@pytest.mark.parametrize("days", [7, 30])
def test_graphs_of_all_sets_equal_the_graph_of_each_slice(tables, facts, days, monkeypatch):
    """Low limits, so that ranks cut and ties matter in every edge set."""
    for name in ("PLACES_PER_PERSON", "CATEGORIES_PER_PERSON", "PLACES_PER_CATEGORY"):
        monkeypatch.setattr(edges, f"TOP_{name}", 3)
    monkeypatch.setattr(edges, "TOP_SIMILAR_PLACES", 4)
    monkeypatch.setattr(edges.place_similar_place_edges, "__defaults__", (7, 4))
    for function in ("person_likes_place", "person_likes_category", "category_selected_place"):
        monkeypatch.setattr(getattr(edges, f"{function}_edges"), "__defaults__", (3,))
    sets = region_sets.all_region_sets(tables.places())
    together = graph.stochastic_graphs(facts[days], sets, 0.3, 0.7)
    together = rows(together, "region_set", "source_id", "target_id", F.round("balanced_weight", 12))
    for key in ("region1", "region0_region2"):
        regions = [r.region_id for r in sets.where(F.col("region_set") == key).collect()]
        alone = graph.stochastic_graph(facts[days].where(F.col("region_id").isin(regions)), 0.3, 0.7)
        expected = rows(alone, F.lit(key), "source_id", "target_id", F.round("balanced_weight", 12))
        assert [r for r in together if r[0] == key] == expected
    # The same from factors, each count once however many sets there are.
    factored = factored_graph.factored_graph(facts[days], sets)
    derived = factored_graph.derived_graphs(factored, sets, 0.3, 0.7)
    assert rows(derived, "region_set", "source_id", "target_id", F.round("balanced_weight", 12)) == together
    some = sets.where(F.col("region_set").isin("region1", "region0_region2"))
    derived = factored_graph.derived_graphs(factored, some, 0.3, 0.7)
    assert rows(derived, "region_set", "source_id", "target_id", F.round("balanced_weight", 12)) == [
        r for r in together if r[0] in ("region1", "region0_region2")
    ]
    key = ["kind", "region_id", "that_region_id", "source_id", "target_id"]
    assert factored.counts.count() == factored.counts.select(*key).distinct().count()


def test_only_requested_sets_are_built(spark, tables, facts):
    asked = spark.createDataFrame([(1, 0, 2)], "person_id long, home_region_id long, target_region_id long")
    sets = region_sets.requested_region_sets(asked)
    assert rows(sets) == [("region0_region2", 0), ("region0_region2", 2)]
    found = graph.stochastic_graphs(facts[7], sets, 0.5, 0.5)
    assert rows(found.select("region_set").distinct()) == [("region0_region2",)]
    everything = graph.stochastic_graphs(facts[7], region_sets.all_region_sets(tables.places()), 0.5, 0.5)
    assert rows(found) == rows(everything.where("region_set = 'region0_region2'"))


def test_vertex_ids_must_not_collide(spark):
    good = spark.createDataFrame([(1, 10, 100), (2, 11, 100)], "person_id long, place_id long, category_id long")
    graph.check_vertex_ids(good)
    bad = good.union(spark.createDataFrame([(10, 11, 1)], good.schema))
    assert rows(graph.vertex_id_collisions(bad)) == [(1, "category,person"), (10, "person,place")]
    with pytest.raises(ValueError):
        graph.check_vertex_ids(bad)
