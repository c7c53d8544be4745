"""Random walk with restart over a stochastic graph, for many start vertices at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.ranking import comparable, top_k
from wayfare.functions.skew import partitions_for_pairs, salted_join, shuffle_partitions
from wayfare.operators.graph import graph_vertices
from wayfare.operators.requests import with_place_columns
from wayfare.runtime import materialize

# Fixed value: the probability of jumping back to the start vertex.
RESTART = 0.15
# At about 75 bytes each these stay below 150 MB on an executor.
MAX_BROADCAST_EDGES = 2_000_000
MOVES_PER_PARTITION = 50_000_000
# Beyond the broadcast, edges lie in blocks: a task meets the edges of a source with at most
# so many start vertices of a region set, and with at most so many edges of the source.
SEEDS_PER_BLOCK = 20_000
EDGES_PER_PART = 1_000

_SEED = ["region_set", "seed"]
# An own part's rows carry the block of their seed.
_STATE = [*_SEED, "block"]


def _along_edges(probability: str):
    """What the edges carry on of a column, per target."""
    return F.sum(F.col(probability) * F.col("balanced_weight")) * (1 - RESTART)


def _joined(state: DataFrame, edges: DataFrame) -> DataFrame:
    return state.join(
        edges.withColumnRenamed("region_set", "_set"),
        (F.col("region_set") == F.col("_set")) & (F.col("id") == F.col("source_id")),
    )


def _spread_shared(shared: DataFrame, edges: DataFrame) -> DataFrame:
    """One step of the shared vectors ``(region_set, id, probability)``."""
    return (
        _joined(shared, edges)
        .groupBy("region_set", F.col("target_id").alias("id"))
        .agg(_along_edges("probability").alias("probability"))
    )


def _spread_own(own: DataFrame, edges: DataFrame | BlockedEdges) -> DataFrame:
    """One step of the own parts ``(region_set, seed, block, id, total, delta)``.

    What moves is the last change; the total takes up what arrives. Rows of a seed stay
    together, so with broadcast edges neither the join nor the sum shuffles anything.
    """
    moving = edges.meet(own) if isinstance(edges, BlockedEdges) else _joined(own, edges)
    arriving = moving.select(
        *_STATE,
        F.col("target_id").alias("id"),
        F.lit(0.0).alias("total"),
        (F.col("delta") * F.col("balanced_weight") * (1 - RESTART)).alias("delta"),
    )
    staying = own.select(*_STATE, "id", "total", F.lit(0.0).alias("delta"))
    return _add_up(arriving.unionByName(staying))


class BlockedEdges:
    """Edges laid out once for all steps of a blocked sparse matrix product.

    A popular place is in the own parts of very many seeds, so a join by place alone would
    gather them in one task. Rows of the product are cut by blocks of seeds, its columns by
    sources, and the edges of a source with very many into parts. Edges are copied to the
    blocks of their set, which are one per ``SEEDS_PER_BLOCK`` seeds: few against what the
    seeds of a block send along them. The layout is kept on the executors' disks; what is
    lost with one comes back from the stored edges.
    """

    def __init__(self, edges: DataFrame, blocks: DataFrame, partitions: int):
        source = ["region_set", "source_id"]
        degrees = edges.groupBy(*source).agg(F.count(F.lit(1)).alias("_edges"))
        cut = degrees.where(F.col("_edges") > EDGES_PER_PART).select(*source, F.ceil(F.col("_edges") / EDGES_PER_PART).alias("_parts"))
        every_block = blocks.select("region_set", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        cut = materialize(cut)
        self.cut = None if cut.isEmpty() else materialize(cut.join(every_block, "region_set"))
        laid_out = edges
        self.keys = ["region_set", "block", "source_id"]
        if self.cut is not None:
            parts = F.coalesce(F.col("_parts"), F.lit(1).cast("long"))
            laid_out = laid_out.join(cut, source, "left").withColumn("_part", F.pmod(F.xxhash64("target_id"), parts)).drop("_parts")
        on = self.keys + (["_part"] if self.cut is not None else [])
        self.partitions = partitions
        self.edges = laid_out.join(every_block, "region_set").repartition(partitions, *on).persist(StorageLevel.DISK_ONLY)

    def meet(self, own: DataFrame) -> DataFrame:
        """Rows of the own parts with each edge of their vertex."""
        state = own.withColumnRenamed("id", "source_id")
        if self.cut is None:
            return state.repartition(self.partitions, *self.keys).join(self.edges, self.keys)
        parts = F.coalesce(F.col("_parts"), F.lit(1).cast("long"))
        state = state.join(self.cut, self.keys, "left")
        state = state.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
        on = [*self.keys, "_part"]
        return state.repartition(self.partitions, *on).join(self.edges, on)

    def drop(self) -> None:
        self.edges.unpersist()


def _add_up(parts: DataFrame) -> DataFrame:
    return (
        parts.groupBy(*_STATE, "id")
        .agg(F.sum("total").alias("total"), F.sum("delta").alias("delta"))
        .withColumn("total", F.col("total") + F.col("delta"))
    )


def _movement(own: DataFrame, now: DataFrame, before: DataFrame, active: DataFrame, blocks: DataFrame | None) -> DataFrame:
    """Squared length of the last step per active seed; ``blocks`` where sets have several.

    Vertices that a seed's own part has not reached move exactly as the shared vector
    does, so their sum is that of all vertices less that of the reached ones, and no
    seed's vector is ever written out densely.
    """
    shift = (
        now.unionByName(before.withColumn("probability", -F.col("probability")))
        .groupBy("region_set", "id")
        .agg(F.sum("probability").alias("_shift"))
    )
    everywhere = shift.groupBy("region_set").agg(F.sum(F.col("_shift") * F.col("_shift")).alias("_everywhere"))
    moved = F.coalesce(F.col("_shift"), F.lit(0.0))
    there, on = shift, ["region_set", "id"]
    if blocks is not None:
        # A popular vertex is in many own parts: each block of seeds has its copy.
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
        there, on = shift.join(blocks.select("region_set", every), "region_set"), ["region_set", "block", "id"]
    reached = (
        own.join(there, on, "left")
        .groupBy(*_SEED)
        .agg(
            F.sum((moved + F.col("delta")) * (moved + F.col("delta"))).alias("_reached"),
            F.sum(moved * moved).alias("_shared_there"),
        )
    )
    elsewhere = F.col("_everywhere") - F.coalesce("_shared_there", F.lit(0.0))
    return (
        active.join(reached, _SEED, "left")
        .join(everywhere, "region_set")
        .select(*_STATE, (F.coalesce("_reached", F.lit(0.0)) + F.greatest(elsewhere, F.lit(0.0))).alias("squared_step"))
    )


def _partitions_for(seeds: DataFrame, edges: DataFrame) -> int:
    """Enough partitions for the moves of one step; bytes say little about them."""
    n_seeds = seeds.groupBy("region_set").agg(F.count(F.lit(1)).alias("_seeds"))
    n_edges = edges.groupBy("region_set").agg(F.count(F.lit(1)).alias("_edges"))
    moves = n_seeds.join(n_edges, "region_set").agg(F.sum(F.col("_seeds") * F.col("_edges")).alias("n")).first().n or 0
    return partitions_for_pairs(seeds.sparkSession, moves, MOVES_PER_PARTITION)


@dataclass(frozen=True)
class Walked:
    """What the walks end with, in parts.

    ``taken``: (region_set, seed, steps). ``shared``: (region_set, steps, id, probability),
    the vectors that all seeds of a set have in common at a step. ``own``: (region_set,
    seed, id, probability), what a seed has besides.
    """

    taken: DataFrame
    shared: DataFrame
    own: DataFrame


def _walk(graph: DataFrame, requests: DataFrame, epsilon: float, max_iterations: int) -> Walked:
    if epsilon < 0:
        raise ValueError(f"epsilon must not be negative: {epsilon}")
    if max_iterations < 0:
        raise ValueError(f"max_iterations must not be negative: {max_iterations}")

    asked = requests.select("region_set", F.col("person_id").alias("seed")).distinct()
    edges = materialize(
        graph.join(asked.select("region_set").distinct(), "region_set", "left_semi").select(
            "region_set", "source_id", "target_id", "balanced_weight"
        )
    )
    vertices = materialize(graph_vertices(edges))
    in_graph = vertices.select("region_set", F.col("id").alias("seed"))
    known = materialize(asked.join(in_graph, _SEED, "left_semi"))
    blocks = known.groupBy("region_set").agg(F.ceil(F.count(F.lit(1)) / SEEDS_PER_BLOCK).cast("int").alias("blocks"))
    several = (blocks.agg(F.max("blocks").alias("n")).first().n or 1) > 1
    if several:
        blocks = materialize(blocks)
        block = F.pmod(F.xxhash64("seed"), F.col("blocks")).cast("int")
        active = materialize(known.join(blocks, "region_set").select(*_SEED, block.alias("block")))
    else:
        active = known.withColumn("block", F.lit(0))
    targets = edges.select("region_set", F.col("target_id").alias("source_id")).distinct()
    inner = materialize(edges.join(targets, ["region_set", "source_id"], "left_semi"))
    partitions = _partitions_for(active, inner)
    few = inner.limit(MAX_BROADCAST_EDGES + 1).count() <= MAX_BROADCAST_EDGES
    inner = F.broadcast(inner) if few else BlockedEdges(inner, blocks, max(partitions, shuffle_partitions(edges.sparkSession)))

    sizes = vertices.groupBy("region_set").agg(F.count(F.lit(1)).alias("_size"))
    shared = vertices.join(sizes, "region_set").select(
        "region_set", "id", (F.lit(1.0) / F.col("_size")).alias("probability")
    )
    own = active.select(
        *_STATE, F.col("seed").alias("id"), F.lit(0.0).alias("total"), F.lit(0.0).alias("delta")
    ).limit(0)
    shared_by_step = [shared.withColumn("steps", F.lit(0))]
    finished: list[DataFrame] = []
    stopped: list[DataFrame] = []
    steps = 0
    while steps < max_iterations:
        before, shared = shared, materialize(_spread_shared(shared, edges))
        steps += 1
        shared_by_step.append(shared.withColumn("steps", F.lit(steps)))
        if steps == 1:
            restart = F.lit(RESTART)
            own = active.select(*_STATE, F.col("seed").alias("id"), restart.alias("total"), restart.alias("delta"))
        elif steps == 2:
            own = materialize(_spread_own(own, edges))
        else:
            own = materialize(_spread_own(own.repartition(partitions, *_SEED) if few else own, inner))
        if epsilon > 0 and steps < max_iterations:
            movement = materialize(_movement(own, shared, before, active, blocks if several else None))
            close = F.col("squared_step") <= epsilon * epsilon
            done = movement.where(close).select(*_SEED)
            stopped.append(done.withColumn("steps", F.lit(steps)))
            finished.append(own.join(done, _SEED, "left_semi"))
            active = movement.where(~close).select(*_STATE)
            if active.isEmpty():
                break
            own = own.join(active.select(*_SEED), _SEED, "left_semi")
    else:
        stopped.append(active.select(*_SEED).withColumn("steps", F.lit(steps)))
        finished.append(own)
    if not few:
        inner.drop()

    taken = materialize(reduce(DataFrame.unionByName, stopped))
    parts = [p.select(*_SEED, "id", F.col("total").alias("probability")) for p in finished]
    return Walked(taken, reduce(DataFrame.unionByName, shared_by_step), reduce(DataFrame.unionByName, parts))


def walk(
    graph: DataFrame, requests: DataFrame, epsilon: float = 0.05, max_iterations: int = 20
) -> tuple[DataFrame, DataFrame]:
    """Run the walk for every requested ``(region_set, person_id)``.

    Returns the distributions ``(region_set, person_id, id, probability)`` and the number
    of steps taken ``(region_set, person_id, steps)``.

    The walk starts uniformly on all vertices and jumps back to the person with the
    restart probability. It stops for a person after the first step of length at most
    ``epsilon``, or after ``max_iterations``; others go on. Requests for vertices that
    their graph lacks are left out, see ``requests_outside_graph``. Vertices without
    outgoing edges lose their probability.

    The step is linear, so a vector is a shared vector, the same for all persons of a
    region set, plus a person's own part. The shared one starts uniform and only follows
    the edges. The own part grows each step by the restart probability at the person
    moved along the edges once more, and touches reached vertices only.

    Persons have no incoming edges, so beyond the first move the own parts need only the
    edges between places and categories. While those are few by count, they are broadcast
    and a step shuffles the own parts once, by seed, and not what they send along the
    edges. Beyond that they lie in blocks, see ``BlockedEdges``. Each step is checkpointed, and one flag per step reaches the driver.
    """
    walked = _walk(graph, requests, epsilon, max_iterations)
    # Every start vertex gets its own copy of the shared vector at the step it stopped.
    parts = salted_join(walked.taken, walked.shared, ["region_set", "steps"], ["seed"])
    parts = parts.select(*_SEED, "id", "probability").unionByName(walked.own)
    found = (
        parts.groupBy("region_set", F.col("seed").alias("person_id"), "id")
        .agg(F.sum("probability").alias("probability"))
        .where((F.col("id") != F.col("person_id")) & (F.col("probability") > 0))
    )
    return found, walked.taken.select("region_set", F.col("seed").alias("person_id"), "steps")


def walk_recommend(
    graph: DataFrame, requests: DataFrame, epsilon: float = 0.05, max_iterations: int = 20
) -> DataFrame:
    """``(region_set, person_id, id, probability)`` of all vertices a walk may end at.

    Not ordered, and places already visited stay in. The person is left out.
    """
    return walk(graph, requests, epsilon, max_iterations)[0]


def walk_recommended_places(
    graph: DataFrame,
    resolved: DataFrame,
    places: DataFrame,
    epsilon: float = 0.05,
    max_iterations: int = 20,
    n: int = 10,
) -> DataFrame:
    """The ``n`` best places of each request's target region, without writing vectors densely.

    The same as ``recommended_places`` of ``walk_recommend``. Both parts of a vector are cut
    to places of target regions first. The shared places are ranked once per region set,
    step and region. Of them a request needs no more than the first n plus as many as its
    own part reached there, since all parts are positive; it joins those by their rank.
    """
    walked = _walk(graph, resolved, epsilon, max_iterations)
    wanted = resolved.select("region_set", F.col("person_id").alias("seed"), F.col("target_region_id").alias("region_id")).distinct()
    wanted = materialize(wanted.join(walked.taken, _SEED))
    ids = places.select("id", "region_id")
    regions = wanted.select("region_set", "steps", "region_id").distinct()
    shared = walked.shared.join(ids, "id").join(regions, ["region_set", "steps", "region_id"], "left_semi")
    order = Window.partitionBy("region_set", "steps", "region_id").orderBy(comparable(F.col("probability")).desc(), "id")
    shared = materialize(shared.where(F.col("probability") > 0).withColumn("rank", F.row_number().over(order)))
    own = walked.own.join(ids, "id").join(wanted, [*_SEED, "region_id"])
    there = shared.select("region_set", "steps", "id", F.col("probability").alias("_shared"))
    own = materialize(
        own.join(there, ["region_set", "steps", "id"], "left").select(
            *_SEED, "region_id", "id", (F.col("probability") + F.coalesce("_shared", F.lit(0.0))).alias("probability")
        )
    )
    reached = own.groupBy(*_SEED, "region_id").agg(F.count(F.lit(1)).alias("_reached"))
    deep = F.lit(n).cast("long") + F.coalesce("_reached", F.lit(0))
    asked = wanted.join(reached, [*_SEED, "region_id"], "left").withColumn("rank", F.explode(F.sequence(F.lit(1).cast("long"), deep)))
    from_shared = asked.drop("_reached").join(
        shared.withColumn("rank", F.col("rank").cast("long")), ["region_set", "steps", "region_id", "rank"]
    )
    others = from_shared.join(own.select(*_SEED, "region_id", "id"), [*_SEED, "region_id", "id"], "left_anti")
    columns = ["region_set", F.col("seed").alias("person_id"), "region_id", "id", "probability"]
    scored = others.select(*columns).unionByName(own.select(*columns))
    scored = scored.where((F.col("id") != F.col("person_id")) & (F.col("probability") > 0))
    # One person may ask for several regions: the rank is that of all its places in a set.
    best = top_k(scored, ["region_set", "person_id"], "probability", "id", n)
    return with_place_columns(best, places)
