"""Top-N per group, without ever holding one group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.runtime import materialize

# Up to this k a window keeps k rows of a group in each task; above it, brackets are counted.
# Both ways compare by the same rules and return the same rows.
SMALL_K = 1_000
_SCORE_STEPS = 1_000_000_000
_OFF_BOUNDARY = 0.137
_MOST = 9.2e9
_LOWEST = -(2**63)


def comparable(score: Column) -> Column:
    """A score as a whole number of billionths, so that rounding noise does not decide.

    Equal scores summed in different orders differ in the last bits. The odd offset keeps
    the boundary between two numbers away from short decimal fractions, where such scores
    would fall on both sides. Scores that have no such number (NaN, or beyond 9.2e9) raise;
    null stays null.
    """
    number = score.cast("double")
    wrong = F.raise_error(F.concat(F.lit("score cannot be ranked: "), number.cast("string"))).cast("long")
    return F.when(F.abs(number) >= _MOST, wrong).otherwise(F.floor(number * _SCORE_STEPS + _OFF_BOUNDARY))


def _cuts(histogram: DataFrame, by: Sequence[str], value: str, n: int, total: str | None) -> DataFrame:
    """One row per group: ``_lowest``, the least value whose rank is at most ``n``, and the total kept.

    ``histogram`` says how many rows (``_ties``) of a group hold each value.
    """
    better = Window.partitionBy(*by).orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    kept = histogram.withColumn("_ahead", F.coalesce(F.sum("_ties").over(better), F.lit(0))).where(
        F.col("_ahead") < n
    )
    aggregates = [F.min(value).alias("_lowest")]
    if total is not None:
        aggregates.append(F.sum(F.col(value) * F.col("_ties")).alias(total))
    return kept.groupBy(*by).agg(*aggregates)


def top_n_with_ties(df: DataFrame, by: Sequence[str], value: str, n: int, total: str | None = None) -> DataFrame:
    """Keep the rows whose ``rank()`` by ``value`` (an integer, descending) is at most ``n``.

    Ties at the cut are all kept, so a group may return more than ``n`` rows. A plain
    rank window would sort a whole group in one task, and ties defeat its early cut. Here
    the group shrinks to a histogram of its distinct values first: how many rows hold
    each value. Distinct positive counts that add up to V number at most sqrt(2 V), so
    the window runs over thousands of rows even for a group of billions. The histogram
    also gives the total over the kept rows, which saves the share's separate sum.
    """
    if n <= 0:
        raise ValueError(f"n must be positive: {n}")
    histogram = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_ties"))
    cut = _cuts(histogram, by, value, n, total)
    return df.join(cut, list(by)).where(F.col(value) >= F.col("_lowest")).drop("_lowest")


def none_is_cut(df: DataFrame, by: Sequence[str], n: int) -> bool:
    """Whether no group has more than ``n`` rows, so that a cut at ``n`` keeps every row of every part of a group."""
    if n <= 0:
        raise ValueError(f"n must be positive: {n}")
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    return (sizes.agg(F.max("_size").alias("most")).first().most or 0) <= n


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that joining their group's cut would keep: those with a group and a value."""
    return df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in columns]))


def cuts_in_sets(
    df: DataFrame,
    sets: DataFrame | None,
    members: Sequence[str],
    by: Sequence[str],
    value: str,
    n: int,
    total: str | None = None,
) -> DataFrame:
    """``(region_set, *by, _lowest[, total])``: the least value that a group keeps in each set.

    Without ``sets`` the rows have their ``region_set`` themselves, as the only member.
    """
    if n <= 0:
        raise ValueError(f"n must be positive: {n}")
    per_set = df.groupBy(*by, *members, value).agg(F.count(F.lit(1)).alias("_ties"))
    if sets is not None:
        per_set = per_set.join(sets, list(members)).groupBy("region_set", *by, value).agg(F.sum("_ties").alias("_ties"))
    return _cuts(per_set, ["region_set", *by], value, n, total)


def top_n_in_sets(
    df: DataFrame,
    sets: DataFrame,
    members: Sequence[str],
    by: Sequence[str],
    value: str,
    n: int,
    total: str | None = None,
) -> DataFrame:
    """``top_n_with_ties`` inside each region set, without copying the rows to the sets.

    ``sets`` lists the ``members`` (columns of ``df``) of each ``region_set``. Only the
    histograms are copied and added up per set; a row then joins the cuts of the sets that
    it belongs to, and leaves the join for those alone where it is kept. Where ``none_is_cut``,
    rows join their sets alone.
    """
    if total is None and none_is_cut(df, by, n):
        return _complete(df, [*by, value]).join(sets, list(members))
    cut = cuts_in_sets(df, sets, members, by, value, n, total)
    return (
        df.join(cut.join(sets, "region_set"), [*by, *members])
        .where(F.col(value) >= F.col("_lowest"))
        .drop("_lowest")
    )


def top_k(df: DataFrame, by: Sequence[str], score: str, tie: str, k: int) -> DataFrame:
    """Keep exactly ``k`` rows per group: highest ``score`` first, then lowest ``tie``.

    Scores are compared in billionths, see ``comparable``; a null score comes last, a null
    tie first. Ties are whole numbers. The same holds for every ``k``.
    """
    if k < 0:
        raise ValueError(f"k must not be negative: {k}")
    if k <= SMALL_K:
        # Each task keeps at most k rows of a group before the shuffle (WindowGroupLimit).
        order = Window.partitionBy(*by).orderBy(comparable(F.col(score)).desc_nulls_last(), F.col(tie).asc_nulls_first())
        return df.withColumn("_row", F.row_number().over(order)).where(F.col("_row") <= k).drop("_row")
    return _top_k_by_brackets(df, by, score, tie, k)


# Brackets per pass, and rows of a group in one of them that a task may sort.
_BRACKETS = 1_024
_SORTED_AT_ONCE = 50_000
# Groups whose brackets are broadcast, at about 100 bytes.
_MOST_BROADCAST = 500_000
_EXACT_DIFFERENCE = float(2**52)


def _bracket(value: Column, low: Column, high: Column) -> Column:
    """Number of a value's bracket between ``low`` and ``high``; never falls as the value rises.

    Differences that a double cannot hold are taken between doubles: that may put
    neighbouring values into one bracket, and the next pass has them closer together.
    """
    far = high.cast("double") - low.cast("double")
    near = far < _EXACT_DIFFERENCE
    part = F.when(near, (value - low).cast("double")).otherwise(value.cast("double") - low.cast("double"))
    whole = F.when(near, (high - low).cast("double") + 1.0).otherwise(far)
    return F.least(F.floor(part / whole * _BRACKETS), F.lit(_BRACKETS - 1)).cast("int")


def _top_k_by_brackets(df: DataFrame, by: Sequence[str], score: str, tie: str, k: int) -> DataFrame:
    """Top-k for a large k: bracket each group's k-th key, then look inside the bracket only.

    The key is (score descending, tie ascending) as two longs that keep the order of all
    values, negative ones included. A pass counts a group's rows in brackets between its
    least and greatest key, which adds up in every task first. Rows before the bracket of
    the k-th key are kept, rows after it are not; only those inside go on, as a rule a
    thousandth, and are sorted. Where very many share a bracket, such as equal scores, it is
    bracketed once more, by the tie where the scores are all equal.
    """
    # Descending scores are ascending complements; null, the lowest score, comes last.
    down = F.coalesce(comparable(F.col(score)), F.lit(_LOWEST)).bitwiseXOR(F.lit(-1))
    up = F.coalesce(F.col(tie).cast("long"), F.lit(_LOWEST))
    keys = list(by)
    rows = materialize(df.withColumn("_score_key", down).withColumn("_tie_key", up))
    ends = [f(c).alias(f"{name}{c}") for name, f in (("_low", F.min), ("_high", F.max)) for c in ("_score_key", "_tie_key")]
    need, kept = None, []
    while True:
        # Groups that need fewer rows than they have, with the range of their keys.
        found = rows.groupBy(*keys).agg(*ends, F.count(F.lit(1)).alias("_size"))
        if need is None:
            found = found.withColumn("_need", F.lit(k).cast("long"))
        else:
            found = found.join(need, keys)
        found = materialize(found)
        small = F.broadcast if found.count() <= _MOST_BROADCAST else (lambda t: t)
        tagged = rows.join(small(found), keys)
        names = [c for c in rows.columns]
        kept.append(tagged.where(F.col("_size") <= F.col("_need")).select(*names))
        # Rows that are equal in both keys need no order.
        equal = (F.col("_low_score_key") == F.col("_high_score_key")) & (F.col("_low_tie_key") == F.col("_high_tie_key"))
        sorted_now = (F.col("_size") <= _SORTED_AT_ONCE) | equal
        few = tagged.where((F.col("_size") > F.col("_need")) & sorted_now)
        order = Window.partitionBy(*keys).orderBy("_score_key", "_tie_key")
        few = few.withColumn("_row", F.row_number().over(order)).where(F.col("_row") <= F.col("_need"))
        kept.append(few.select(*names))
        many = (F.col("_size") > F.col("_need")) & ~sorted_now
        if found.where(many).isEmpty():
            break
        by_score = F.col("_low_score_key") < F.col("_high_score_key")
        at = F.when(by_score, _bracket(F.col("_score_key"), F.col("_low_score_key"), F.col("_high_score_key")))
        at = at.otherwise(_bracket(F.col("_tie_key"), F.col("_low_tie_key"), F.col("_high_tie_key")))
        placed = tagged.where(many).withColumn("_bracket", at)
        counts = placed.groupBy(*keys, "_need", "_bracket").agg(F.count(F.lit(1)).alias("_n"))
        running = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bracket").rowsBetween(Window.unboundedPreceding, 0))
        ahead = F.col("_running") - F.col("_n")
        cut = counts.withColumn("_running", running).where((F.col("_running") >= F.col("_need")) & (ahead < F.col("_need")))
        cut = materialize(cut.select(*keys, F.col("_bracket").alias("_cut"), (F.col("_need") - ahead).alias("_left")))
        sided = placed.join(small(cut), keys)
        kept.append(sided.where(F.col("_bracket") < F.col("_cut")).select(*names))
        rows = materialize(sided.where(F.col("_bracket") == F.col("_cut")).select(*names))
        need = cut.select(*keys, F.col("_left").alias("_need"))
    return reduce(DataFrame.unionByName, kept).drop("_score_key", "_tie_key")
