"""How often two places were visited by the same person within some days.

Counted per ordered pair of different places, over pairs of visits. The plain form joins
a person's visits with themselves, which is hopeless for a person with very many visits.
Both forms here count before they join, and cut a heavy person's work into many tasks.
All of them return ``(place_id, region_id, that_place_id, that_region_id, visit_pairs)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.skew import partitions_for_pairs
from wayfare.functions.times import DAY_MILLIS, epoch_millis
from wayfare.runtime import materialize

_PLACE = ("place_id", "region_id")
# Distinct places of one person (and time bucket) that one task pairs with as many others.
_BLOCK = 2_048
# Visits of one person in one time bucket that may be compared one by one.
_LIGHT_BUCKET = 4_096
_DIGIT_BITS = 5
_PAIRS_PER_PARTITION = 20_000_000


def _product_pairs(counts: DataFrame, keys: Sequence[str], block: int | None = None) -> DataFrame:
    """Pairs of places under the same ``keys``, with the product of their ``visits``.

    Each unordered pair is formed once; the counts are symmetric. The places of a key with
    more than ``block`` are cut into blocks by hash, and each pair of blocks is a task of
    its own. The number of partitions follows the counted pairs, as bytes say little.
    """
    keys, block = list(keys), block or _BLOCK
    sizes = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_places"))
    known = sizes.agg(F.sum(F.col("_places") * F.col("_places") / 2).alias("pairs"), F.max("_places").alias("most")).first()
    partitions = partitions_for_pairs(counts.sparkSession, known.pairs or 0, _PAIRS_PER_PARTITION)
    if (known.most or 0) <= block:
        ours = counts.repartition(partitions, *keys)
        theirs = ours.select(*keys, *[F.col(c).alias(f"that_{c}") for c in _PLACE], F.col("visits").alias("_that_visits"))
        met = ours.join(theirs, keys).where(F.col("place_id") < F.col("that_place_id"))
        return met.select(*_PLACE, *[f"that_{c}" for c in _PLACE], (F.col("visits") * F.col("_that_visits")).alias("visit_pairs"))
    heavy = sizes.where(F.col("_places") > block).select(*keys, F.ceil(F.col("_places") / block).alias("_blocks"))
    blocks = F.coalesce(F.col("_blocks"), F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("place_id"), blocks)
    blocked = counts.join(heavy, keys, "left").withColumn("_blocks", blocks).withColumn("_own", own)
    # A block meets itself and those after it.
    left = blocked.select(
        *keys, *_PLACE, "visits", F.col("_own").alias("_row"), F.explode(F.sequence(F.col("_own"), F.col("_blocks") - 1)).alias("_column")
    )
    right = blocked.select(
        *keys,
        *[F.col(c).alias(f"that_{c}") for c in _PLACE],
        F.col("visits").alias("_that_visits"),
        F.col("_own").alias("_column"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_own"))).alias("_row"),
    )
    on = [*keys, "_row", "_column"]
    swap = F.col("place_id") > F.col("that_place_id")
    met = left.repartition(partitions, *on).join(right.repartition(partitions, *on), on)
    met = met.where(
        F.when(F.col("_row") == F.col("_column"), F.col("place_id") < F.col("that_place_id")).otherwise(
            F.col("place_id") != F.col("that_place_id")
        )
    )
    return met.select(
        *[F.when(swap, F.col(f"that_{c}")).otherwise(F.col(c)).alias(c) for c in _PLACE],
        *[F.when(swap, F.col(c)).otherwise(F.col(f"that_{c}")).alias(f"that_{c}") for c in _PLACE],
        (F.col("visits") * F.col("_that_visits")).alias("visit_pairs"),
    )


def _sum_both_ways(pairs: DataFrame) -> DataFrame:
    """Sum pairs formed in one order and return both orders."""
    that = [f"that_{c}" for c in _PLACE]
    sums = pairs.groupBy(*_PLACE, *that).agg(F.sum("visit_pairs").alias("visit_pairs"))

    def side(first: Sequence[str], second: Sequence[str]):
        names = [*_PLACE, *that]
        return F.struct(*[F.col(c).alias(name) for c, name in zip([*first, *second], names)], F.col("visit_pairs"))

    return sums.select(F.explode(F.array(side(_PLACE, that), side(that, _PLACE))).alias("pair")).select("pair.*")


def covisits_any_time(counts: DataFrame) -> DataFrame:
    """Every two visits of a person count, however far apart.

    This is the whole answer when the facts span no more days than the interval, as they
    do with the usual seven days for both. It needs only the visit counts per person and
    place: the pairs of visits at places a and b are the product of the two counts.
    """
    return _sum_both_ways(_product_pairs(counts, ["person_id"]))


def covisits_within(
    place_visits: DataFrame, interval_days: int, block: int | None = None, light_bucket: int | None = None
) -> DataFrame:
    """Two visits of a person count when at most ``interval_days`` apart.

    Time is cut into buckets one millisecond longer than the interval. Within a bucket
    all visits pair, which is a product of counts. Of two neighbouring buckets, a visit at
    offset o in the earlier and one at offset p in the later bucket pair when p < o.
    Buckets further apart never pair. ``block`` and ``light_bucket`` say what is heavy:
    distinct places, and visits, of one person in one bucket.
    """
    light_bucket = _LIGHT_BUCKET if light_bucket is None else light_bucket
    width = interval_days * DAY_MILLIS + 1
    millis = epoch_millis(F.col("timestamp"))
    timed = materialize(
        place_visits.select("person_id", *_PLACE, millis.alias("_millis"))
        .withColumn("_bucket", F.floor(F.col("_millis") / width))
        .withColumn("_offset", F.col("_millis") - F.col("_bucket") * width)
        .groupBy("person_id", *_PLACE, "_bucket", "_offset")
        .agg(F.count(F.lit(1)).alias("visits"))
    )
    in_bucket = timed.groupBy("person_id", "_bucket", *_PLACE).agg(F.sum("visits").alias("visits"))
    same = _product_pairs(materialize(in_bucket), ["person_id", "_bucket"], block)

    # A seam lies between a bucket and the next; visits stand before or after it.
    heavy_seams = (
        timed.groupBy("person_id", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > light_bucket)
        .select(
            "person_id", F.explode(F.array(F.col("_bucket"), F.col("_bucket") - 1)).alias("_seam"), F.lit(True).alias("_heavy")
        )
        .distinct()
    )

    def beside_seams(shift: int) -> DataFrame:
        rows = timed.withColumn("_seam", F.col("_bucket") - shift)
        return rows.join(heavy_seams, ["person_id", "_seam"], "left").withColumn(
            "_heavy", F.coalesce("_heavy", F.lit(False))
        )

    before, after = beside_seams(0), beside_seams(1)
    light = _compare_offsets(before.where(~F.col("_heavy")), after.where(~F.col("_heavy")))
    heavy = _compare_digits(before.where("_heavy"), after.where("_heavy"), (width - 1).bit_length())
    return _sum_both_ways(same.unionByName(light).unionByName(heavy))


def _as_pairs(before: DataFrame, after: DataFrame, keys: Sequence[str], condition) -> DataFrame:
    """Join both sides of the seams and put each pair of places in one order."""
    that = [F.col(c).alias(f"that_{c}") for c in _PLACE]
    extra = [c for c in after.columns if c in ("_offset", "_digit")]
    right = after.select(
        *keys, *that, F.col("visits").alias("_that_visits"), *[F.col(c).alias(f"_that{c}") for c in extra]
    )
    joined = before.join(right, list(keys)).where(condition & (F.col("place_id") != F.col("that_place_id")))
    swap = F.col("place_id") > F.col("that_place_id")
    return joined.select(
        *[F.when(swap, F.col(f"that_{c}")).otherwise(F.col(c)).alias(c) for c in _PLACE],
        *[F.when(swap, F.col(c)).otherwise(F.col(f"that_{c}")).alias(f"that_{c}") for c in _PLACE],
        (F.col("visits") * F.col("_that_visits")).alias("visit_pairs"),
    )


def _compare_offsets(before: DataFrame, after: DataFrame) -> DataFrame:
    """Compare single visits; only for seams with few visits on either side."""
    return _as_pairs(before, after, ["person_id", "_seam"], F.col("_that_offset") < F.col("_offset"))


def _compare_digits(before: DataFrame, after: DataFrame, bits: int) -> DataFrame:
    """Compare offsets without pairing the single visits.

    p < o exactly when, at the first digit in which they differ, p's digit is the lower.
    So visits are counted per place, common leading digits and next digit, one time for
    each position of that digit, and the counts multiply. What is joined is bounded by
    places and digits, no longer by visits.
    """
    levels = range((bits - 1) // _DIGIT_BITS, -1, -1)

    def by_digit(side: DataFrame) -> DataFrame:
        offset = F.col("_offset")
        digits = F.array(
            *[
                F.struct(
                    F.lit(level).alias("_level"),
                    F.shiftright(offset, (level + 1) * _DIGIT_BITS).alias("_prefix"),
                    F.shiftright(offset, level * _DIGIT_BITS).bitwiseAND((1 << _DIGIT_BITS) - 1).alias("_digit"),
                )
                for level in levels
            ]
        )
        rows = side.select("person_id", "_seam", *_PLACE, "visits", F.inline(digits))
        return rows.groupBy("person_id", "_seam", "_level", "_prefix", "_digit", *_PLACE).agg(
            F.sum("visits").alias("visits")
        )

    keys = ["person_id", "_seam", "_level", "_prefix"]
    return _as_pairs(by_digit(before), by_digit(after), keys, F.col("_that_digit") < F.col("_digit"))
