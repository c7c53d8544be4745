"""The random walk: golden vectors, and batches against a dense walk in plain Python."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.operators import graph, region_sets, requests, walk
from wayfare.runtime import materialize

# A graph of five vertices and where walks from vertex 1 end.
EDGES = [
    (1, 2, 0.4),
    (1, 3, 0.24),
    (1, 5, 0.36),
    (2, 4, 0.3),
    (2, 3, 0.7),
    (3, 5, 1.0),
    (4, 2, 0.3),
    (4, 5, 0.7),
    (5, 3, 1.0),
]
AFTER_ONE_STEP = {5: 0.3502, 3: 0.3298, 2: 0.119, 4: 0.051}
CONVERGED = {3: 0.408242766375, 5: 0.371617124875, 2: 0.055161925125, 4: 0.014978183625}


def make_graph(spark, edges, region_set="s"):
    df = spark.createDataFrame(edges, "source_id long, target_id long, balanced_weight double")
    return df.withColumn("region_set", F.lit(region_set))


def ask(spark, *persons, region_set="s"):
    return spark.createDataFrame([(region_set, p) for p in persons], "region_set string, person_id long")


def by_seed(found):
    out = {}
    for r in found.collect():
        out.setdefault((r.region_set, r.person_id), {})[r.id] = r.probability
    return out


def dense_walk(edges, seed, epsilon, max_iterations):
    vertices = {v for s, t, _ in edges for v in (s, t)}
    x = {v: 1 / len(vertices) for v in vertices}
    for step in range(1, max_iterations + 1):
        moved = {v: 0.15 if v == seed else 0.0 for v in vertices}
        for s, t, w in edges:
            moved[t] += 0.85 * x[s] * w
        length = sum((moved[v] - x[v]) ** 2 for v in vertices)
        x = moved
        if length <= epsilon**2:
            break
    else:
        step = max_iterations
    return {v: p for v, p in x.items() if v != seed and p > 0}, step


def test_one_step(spark):
    found = by_seed(walk.walk_recommend(make_graph(spark, EDGES), ask(spark, 1), 0.05, 1))
    assert found == {("s", 1): pytest.approx(AFTER_ONE_STEP, abs=1e-12)}


def test_converges(spark):
    found, taken = walk.walk(make_graph(spark, EDGES), ask(spark, 1), 0.05, 20)
    assert by_seed(found) == {("s", 1): pytest.approx(CONVERGED, abs=1e-12)}
    assert [r.steps for r in taken.collect()] == [4]


def test_unknown_vertex_is_reported_and_left_out(spark):
    graphs = make_graph(spark, EDGES)
    asked = ask(spark, 1, 100)
    found = by_seed(walk.walk_recommend(graphs, asked, 0.05, 1))
    assert list(found) == [("s", 1)]
    missing = requests.requests_outside_graph(asked, graphs).collect()
    assert [(r.person_id, r.reason) for r in missing] == [(100, "person not in graph")]
    assert walk.walk_recommend(graphs, ask(spark, 100), 0.05, 3).count() == 0


def test_no_iterations_return_the_uniform_start(spark):
    found = by_seed(walk.walk_recommend(make_graph(spark, EDGES), ask(spark, 1), 0.05, 0))
    assert found == {("s", 1): {v: 0.2 for v in (2, 3, 4, 5)}}


@pytest.mark.parametrize("epsilon,iterations", [(-0.1, 1), (0.1, -1)])
def test_bad_arguments(spark, epsilon, iterations):
    with pytest.raises(ValueError):
        walk.walk(make_graph(spark, EDGES), ask(spark, 1), epsilon, iterations)


@pytest.mark.parametrize(
    "epsilon,iterations,limit,seeds,parts",
    [(0.12, 12, 2_000_000, 3, 9), (0.12, 12, 0, 3, 1), (0.02, 9, 0, 9, 9), (0.0, 4, 0, 1, 9), (0.0, 3, 2_000_000, 9, 9)],
)
def test_batch_of_all_vertices_equals_dense_walks(spark, monkeypatch, epsilon, iterations, limit, seeds, parts):
    """Includes a vertex without outgoing edges; each walk stops at its own step; edges broadcast and in blocks."""
    monkeypatch.setattr(walk, "MAX_BROADCAST_EDGES", limit)
    monkeypatch.setattr(walk, "SEEDS_PER_BLOCK", seeds)
    monkeypatch.setattr(walk, "EDGES_PER_PART", parts)
    edges = EDGES + [(5, 6, 0.2), (7, 1, 0.5), (7, 6, 0.5)]
    edges[8] = (5, 3, 0.8)
    found, taken = walk.walk(make_graph(spark, edges), ask(spark, *range(1, 8)), epsilon, iterations)
    found = by_seed(found)
    steps = {r.person_id: r.steps for r in taken.collect()}
    for seed in range(1, 8):
        expected, expected_steps = dense_walk(edges, seed, epsilon, iterations)
        assert steps[seed] == expected_steps
        assert found[("s", seed)] == pytest.approx(expected, abs=1e-12)
    if epsilon == 0.12:
        assert len(set(steps.values())) > 1


def test_five_million_inner_edges(spark):
    """100,000 places with 50 edges each, a third of them to one place; 40 persons, in blocks."""
    places, degree, persons = 100_000, 50, 40
    target = F.when(F.col("j") % 3 == 0, 0).otherwise((F.col("source_id") * 7_919 + F.col("j") * 104_729) % places)
    inner = spark.range(places).select(F.col("id").alias("source_id"), F.explode(F.sequence(F.lit(0), F.lit(degree - 1))).alias("j"))
    inner = inner.select("source_id", target.alias("target_id"), F.lit(1.0 / degree).alias("balanced_weight"))
    outer = spark.range(persons).select((F.col("id") + 1_000_000).alias("source_id"), F.explode(F.array(F.col("id"), F.col("id") * 2_000 + 1)).alias("target_id"), F.lit(0.5).alias("balanced_weight"))
    graphs = materialize(inner.unionByName(outer).withColumn("region_set", F.lit("s")))
    asked = spark.range(persons).select(F.lit("s").alias("region_set"), (F.col("id") + 1_000_000).alias("person_id"))
    walked = walk._walk(graphs, asked, 0.0, 4)
    mass = {r.seed: r.p for r in walked.own.groupBy("seed").agg(F.sum("probability").alias("p")).collect()}
    rest = walked.shared.where("steps = 4").agg(F.sum("probability")).first()[0]
    assert len(mass) == persons and all(m + rest == pytest.approx(1, abs=1e-9) for m in mass.values())
    # One person's own part by plain arrays.
    source, j = np.divmod(np.arange(places * degree), degree)
    to = np.where(j % 3 == 0, 0, (source * 7_919 + j * 104_729) % places)
    state, total = np.zeros(places), np.zeros(places)
    state[[3, 6_001]] = 0.15 * 0.85 * 0.5
    total += state
    for _ in range(2):
        state = 0.85 / degree * np.bincount(to, state[source], places)
        total += state
    got = {r.id: r.probability for r in walked.own.where("seed = 1000003 and id < 1000000").collect()}
    expected = {int(i): total[i] for i in np.flatnonzero(total)}
    assert got == pytest.approx(expected, abs=1e-12)


def test_region_sets_do_not_mix(spark):
    other = [(1, 2, 1.0), (2, 3, 1.0), (3, 1, 1.0)]
    graphs = make_graph(spark, EDGES).unionByName(make_graph(spark, other, "t"))
    asked = ask(spark, 1, 2).unionByName(ask(spark, 1, region_set="t"))
    found = by_seed(walk.walk_recommend(graphs, asked, 0.05, 8))
    assert set(found) == {("s", 1), ("s", 2), ("t", 1)}
    assert found[("s", 2)] == pytest.approx(dense_walk(EDGES, 2, 0.05, 8)[0], abs=1e-12)
    assert found[("t", 1)] == pytest.approx(dense_walk(other, 1, 0.05, 8)[0], abs=1e-12)


def test_recommended_places_equal_those_of_whole_vectors(spark, tables, facts):
    resolved = materialize(requests.resolve_requests(tables.requests(), tables.persons()))
    sets = region_sets.requested_region_sets(resolved)
    graphs = materialize(graph.stochastic_graphs(facts[7], sets, 0.5, 0.5))
    dense = materialize(walk.walk_recommend(graphs, resolved, 0.05, 20))
    key = lambda df: {(r.region_set, r.person_id, r.id, r.region_id, r.name): r.probability for r in df.collect()}
    for n in (3, 1_000):
        expected = requests.recommended_places(dense, tables.places(), resolved, "probability", n)
        got = walk.walk_recommended_places(graphs, resolved, tables.places(), 0.05, 20, n)
        assert key(got) == pytest.approx(key(expected), abs=1e-12)


def test_walks_on_a_graph_of_visits(spark, tables, facts):
    resolved = requests.resolve_requests(tables.requests(), tables.persons())
    sets = region_sets.requested_region_sets(resolved)
    graphs = graph.stochastic_graphs(facts[7], sets, 0.5, 0.5)
    asked = resolved.orderBy("person_id").limit(3)
    found = by_seed(walk.walk_recommend(graphs, asked, 0.02, 5))
    edges = {}
    for r in graphs.collect():
        edges.setdefault(r.region_set, []).append((r.source_id, r.target_id, r.balanced_weight))
    assert len(found) == 3
    for (region_set, person), got in found.items():
        assert got == pytest.approx(dense_walk(edges[region_set], person, 0.02, 5)[0], abs=1e-12)
