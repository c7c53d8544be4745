"""Joins whose output is much larger than their input, on keys that may be very hot."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.runtime import materialize


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Fewer pairs than this are not worth a task of their own.
_PAIRS_WORTH_A_TASK = 50_000


def partitions_for_pairs(spark: SparkSession, pairs: int, pairs_per_partition: int) -> int:
    """Number of partitions for a join that is known to form ``pairs`` pairs.

    The session's number of shuffle partitions, or fewer when there is little to do, or
    more when a task would get more than ``pairs_per_partition``.
    """
    usual = min(shuffle_partitions(spark), math.ceil(pairs / _PAIRS_WORTH_A_TASK))
    return max(1, usual, math.ceil(pairs / pairs_per_partition))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    pairs_per_part: int = 2_000_000,
    store_hot: bool = False,
) -> DataFrame:
    """Inner join in which a key with very many pairs is spread over many tasks.

    The pairs of a key are the product of its row counts on both sides. A key with more than
    ``pairs_per_part`` is cut into a grid of parts: left rows fall into its rows by a hash of
    ``spread_by``, right rows into its columns by a hash of theirs, and each is copied along
    the other direction. The grid is as oblong as the two counts, which copies least; so a
    key that is hot on both sides costs the square root of its parts in copies of a row.
    All other rows stay single. Every pair still meets exactly once.

    Adaptive execution goes by bytes. It would neither split a key of few bytes and many
    pairs nor leave small partitions of such keys apart, so the number of partitions is
    fixed here. The table of hot keys is left to Spark's own check before a broadcast. With
    ``store_hot`` it is stored first, so that Spark knows its size and shuffles no side for it.
    """
    keys = list(on)
    left_rows = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_left"))
    right_rows = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_right"))
    pairs = F.col("_left") * F.col("_right")
    parts = F.ceil(pairs / pairs_per_part)
    across = F.ceil(F.sqrt(parts * F.col("_left") / F.col("_right")))
    hot = (
        left_rows.join(right_rows, keys)
        .where(pairs > pairs_per_part)
        .withColumn("_rows", F.greatest(F.lit(1).cast("long"), F.least(F.col("_left"), parts, across)))
        .withColumn("_columns", F.greatest(F.lit(1).cast("long"), F.least(F.col("_right"), F.ceil(parts / F.col("_rows")))))
        .select(*keys, "_rows", "_columns")
    )
    if store_hot:
        hot = materialize(hot)
    one = F.lit(1).cast("long")
    rows, columns = F.coalesce(F.col("_rows"), one), F.coalesce(F.col("_columns"), one)

    def every(number: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), number - 1))

    own_row, own_column = F.pmod(F.xxhash64(*spread_by), rows), F.pmod(F.xxhash64(*right.columns), columns)
    spread = left.join(hot, keys, "left").withColumn("_row", own_row).withColumn("_column", every(columns))
    copied = right.join(hot, keys, "left").withColumn("_column", own_column).withColumn("_row", every(rows))
    n = shuffle_partitions(left.sparkSession)
    part = [*keys, "_row", "_column"]
    return (
        spread.drop("_rows", "_columns")
        .repartition(n, *part)
        .join(copied.drop("_rows", "_columns").repartition(n, *part), part)
        .drop("_row", "_column")
    )
