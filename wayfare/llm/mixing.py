"""Mix sources to target weights with a low-discrepancy schedule, in DataFrame functions only.

The words of a source form a stream: its documents in a shuffled order. The stream is cut
into blocks of equal length. A schedule of slots maps points of the golden-ratio sequence
through the cumulative demand of the sources; the r-th slot of a source takes the r-th
block of its stream, starting over at the end. So every prefix of the schedule has nearly
the target proportions.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; documents of size 0 and sources of size 0 take nothing; rows with one id are
separate documents; an empty table gives an empty mix. Extra columns are not looked at.
"""

from __future__ import annotations

from decimal import Decimal, getcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.runtime import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
BLOCK_WORDS = 256
_SEED = 5
_ROWS_PER_BUCKET = 4096
_SLOTS_PER_CHUNK = 8192
_CELLS = 4096
# A table of sources up to this many rows is broadcast; a larger one is joined by shuffle.
_MAX_BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    r"""Number of words ``[^\x20\x09-\x0D]+``; 0 for null."""
    marks = F.regexp_replace(text, r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++", "x")
    return F.coalesce(F.length(F.translate(marks, " \t\n\x0b\f\r", "")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, share: float = SHARE, weights=WEIGHTS, epochs: int = MOST_EPOCHS) -> DataFrame:
    """One row per source: number, size, rows and target.

    Sources in code-point order (null last) weigh ``weights``, repeating, and share
    ``share`` times all words. A target stops at ``epochs`` times its source's size; what
    is above goes to the others by weight. The level that this ends at is found in one
    pass: sources ordered by cap per weight are full up to the first one that the level,
    computed as if all before it were full, does not fill.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    table = sources.withColumn("source_no", number).withColumn("_weight", weight)
    table = table.withColumn("_cap", F.col("source_size") * epochs).withColumn("_full_at", F.col("_cap") / F.col("_weight"))
    by_level = Window.orderBy("_full_at", "source_no")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    table = table.withColumn("_total", F.sum("source_size").over(everything) * F.lit(share))
    table = table.withColumn(
        "_level",
        (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_weight").over(after),
    )
    open_level = F.when(F.col("_full_at") > F.col("_level"), F.struct("_full_at", "source_no", "_level"))
    level = F.min(open_level).over(everything)["_level"]
    return table.withColumn("_at", level).select(
        "source",
        "source_no",
        "source_size",
        "source_rows",
        F.coalesce(F.least(F.col("_cap"), F.col("_at") * F.col("_weight")), F.col("_cap")).cast("double").alias("target"),
    )


def _demand(targets: DataFrame, block: int) -> DataFrame:
    """Add the words to take, the blocks of the stream and the slots that the source needs."""
    words = F.round("target").cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    per_epoch = F.ceil(F.col("source_size") / block).cast("long")
    return (
        targets.withColumn("words", words)
        .withColumn("blocks", per_epoch)
        .withColumn(
            "slots",
            F.floor(F.col("words") / size) * F.col("blocks") + F.ceil((F.col("words") % size) / block).cast("long"),
        )
    )


def _golden_point(i: Column) -> Column:
    """The i-th point of the golden-ratio sequence in [0, 1), exact enough for i below 2**50."""
    getcontext().prec = 50
    ratio = (Decimal(5).sqrt() - 1) / 2
    low, high = float(ratio), float((ratio * 2**20) % 1)
    return F.pmod((i % 2**20) * F.lit(low) + F.floor(i / 2**20) * F.lit(high), F.lit(1.0))


def schedule(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The slots: ``slot`` (its place in the mix), source, ``rank`` in the source, epoch, block and words.

    Slots beyond a source's need are left out; the few that the sequence leaves short (at
    most its discrepancy) come at the end. So each source's words are its rounded target.
    """
    spark = targets.sparkSession
    need = _demand(targets, block).where(F.col("slots") > 0)
    total = need.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    ahead = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    from_slot = F.coalesce(F.sum("slots").over(ahead), F.lit(0))
    bounds = need.withColumn("_from", from_slot)
    low, high = F.col("_from") / max(total, 1), (F.col("_from") + F.col("slots")) / max(total, 1)
    cells = bounds.select("source_no", "slots", low.alias("_low"), high.alias("_high")).withColumn(
        "_cell",
        F.explode(F.sequence(F.floor(F.col("_low") * _CELLS), F.least(F.floor(F.col("_high") * _CELLS), F.lit(_CELLS - 1)))),
    )
    points = spark.range(total).select(F.col("id").alias("slot"), _golden_point(F.col("id")).alias("_point"))
    points = points.withColumn("_cell", F.floor(F.col("_point") * _CELLS))
    drawn = points.join(cells, "_cell").where((F.col("_point") >= F.col("_low")) & (F.col("_point") < F.col("_high")))
    drawn = drawn.select("slot", "source_no", F.floor(F.col("slot") / _SLOTS_PER_CHUNK).alias("_chunk"))
    counts = drawn.groupBy("source_no", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("source_no").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    inside = Window.partitionBy("source_no", "_chunk").orderBy("slot")
    ranked = (
        drawn.withColumn("_row", F.row_number().over(inside))
        .join(counts, ["source_no", "_chunk"])
        .select("slot", "source_no", (F.col("_before") + F.col("_row") - 1).alias("rank"))
    )
    found = counts.groupBy("source_no").agg(F.sum("_n").alias("_found"))
    short = (
        need.join(found, "source_no", "left")
        .withColumn("_found", F.coalesce("_found", F.lit(0)))
        .where(F.col("_found") < F.col("slots"))
        .select(
            F.lit(total).cast("long").alias("slot"),
            "source_no",
            F.explode(F.sequence(F.col("_found"), F.col("slots") - 1)).alias("rank"),
        )
    )
    epoch = F.floor(F.col("rank") / F.col("blocks"))
    place = F.col("rank") % F.col("blocks")
    left = F.col("words") - epoch * F.col("source_size") - place * block
    return (
        ranked.unionByName(short)
        .join(need.drop("source"), "source_no")
        .where(F.col("rank") < F.col("slots"))
        .select("slot", "source_no", "rank", epoch.alias("epoch"), place.alias("block"), F.least(F.lit(block), left).alias("words"))
    )


def _streams(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Give each document its source's number and ``start``, the place of its first word in the stream.

    A running sum over a whole source would sort it in one task. Documents are dealt to
    buckets by the range of their shuffle key, about 4,096 rows each; sums of buckets
    are added up per source, and rows inside each bucket.
    """
    spread = sized.join(targets.select("source", "source_no", "source_rows").alias("t"), sized["source"].eqNullSafe(F.col("t.source")))
    spread = spread.drop(F.col("t.source"))
    buckets = F.ceil(F.col("source_rows") / _ROWS_PER_BUCKET)
    spread = spread.withColumn("_bucket", F.floor(F.col("_key") * buckets)).drop("source_rows")
    sums = spread.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("source_no").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "_bucket", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("source_no", "_bucket").orderBy("_key", "doc_id", "size", "_text")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    return (
        spread.withColumn("_running", running)
        .join(sums, ["source_no", "_bucket"])
        .withColumn("start", F.col("_offset") + F.col("_running"))
        .drop("_running", "_offset", "_bucket", "_key")
    )


def mix(
    documents: DataFrame, share: float = SHARE, weights=WEIGHTS, epochs: int = MOST_EPOCHS, block: int = BLOCK_WORDS
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken and ``_text``, a hash of the text."""
    text = F.xxhash64("text")
    sized = materialize(
        documents.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            (F.pmod(F.xxhash64("doc_id", text, F.lit(_SEED)), F.lit(2**52)) / 2**52).alias("_key"),
            text.alias("_text"),
        )
    )
    targets = materialize(source_targets(sized, share, weights, epochs))
    small = targets.count() <= _MAX_BROADCAST_SOURCES
    table = F.broadcast(targets) if small else targets
    stream = materialize(_streams(sized, table))
    slots = schedule(targets, block).select("source_no", "block", "words")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    pieces = stream.where(F.col("size") > 0).withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start") - F.col("block") * block, F.lit(0))
    end = F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
    used = (
        pieces.select("source_no", "start", "block", begin.alias("_b"), end.alias("_e"))
        .join(slots, ["source_no", "block"])
        .groupBy("source_no", "start")
        .agg(F.sum(F.greatest(F.least("_e", "words") - F.col("_b"), F.lit(0))).alias("taken"))
        .select("source_no", "start", F.lit(True).alias("_filled"), "taken")
    )
    rows = stream.withColumn("_filled", F.when(F.col("size") > 0, F.lit(True)))
    return (
        rows.join(used, ["source_no", "start", "_filled"], "left")
        .join(table.select("source_no", "source_size", "target"), "source_no")
        .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "_text")
    )


_ADDED = ("size", "target", "taken")


def mix_documents(documents: DataFrame) -> DataFrame:
    """The documents that the mix takes words from, whole, with ``size``, ``target`` and ``taken``.

    Equal rows (same id and text) come once, with their words added up. Own columns of the
    three names are replaced.
    """
    taken = mix(documents).where(F.col("taken") > 0)
    taken = taken.groupBy("doc_id", "_text").agg(F.sum("size").alias("size"), F.min("target").alias("target"), F.sum("taken").alias("taken"))
    kept = [c for c in documents.columns if c not in _ADDED]
    rows = documents.dropDuplicates(["doc_id", "text"]).select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash")
    )
    same = F.col("_id").eqNullSafe(F.col("t.doc_id")) & (F.col("_hash") == F.col("t._text"))
    return rows.join(taken.alias("t"), same).select("row.*", *[f"t.{c}" for c in _ADDED])
