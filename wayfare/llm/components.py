"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.runtime import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) of ids to one row per linked id: ``id`` and ``component``, the smallest id reachable.

    Each round hooks every node to its smallest neighbour if that is smaller, follows the
    hooks to their roots by pointer doubling, and replaces the ends of the links by their
    roots. Links inside one tree vanish, and every tree with links left joins another one,
    so the rounds are logarithmic. Hot nodes cost partial minima only.
    """
    both = links.select("a", "b").where(F.col("a") != F.col("b"))
    edges = materialize(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    owner: DataFrame | None = None
    while not edges.isEmpty():
        hooks = materialize(edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root")))
        while True:
            # A root is itself no smaller neighbour's child: follow one more step where there is one.
            step = hooks.select(F.col("id").alias("root"), F.col("root").alias("_next"))
            followed = materialize(
                hooks.join(step, "root", "left").select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
            )
            moved = not followed.where("_moved").isEmpty()
            hooks = followed.drop("_moved")
            if not moved:
                break
        nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct() if owner is None else owner
        if owner is None:
            owner = nodes.join(hooks, "id", "left").select("id", F.coalesce("root", "id").alias("component"))
        else:
            step = hooks.select(F.col("id").alias("component"), "root")
            owner = owner.join(step, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
        owner = materialize(owner)
        ends_a = hooks.select(F.col("id").alias("a"), F.col("root").alias("_a"))
        ends_b = hooks.select(F.col("id").alias("b"), F.col("root").alias("_b"))
        renamed = edges.join(ends_a, "a", "left").join(ends_b, "b", "left")
        a, b = F.coalesce("_a", "a"), F.coalesce("_b", "b")
        renamed = renamed.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()
        edges = materialize(renamed)
    if owner is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return owner
