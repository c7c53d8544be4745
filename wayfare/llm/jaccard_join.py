"""Join documents whose sets of word n-grams are similar: rare-first prefix filtering.

1. Sets. A document's set holds the hashes of its distinct n-word shingles. Documents with
   equal sets form a class; only the class representative (smallest id) goes on.
2. Order. All documents add up a table of shingle counts of bounded size, in which a few
   shingles share a cell. Shingles are ordered by the magnitude of their cell, rarest
   first, then by hash. Any one order gives right results; a good one gives short lists.
3. Prefixes. Two sets similar enough share a shingle among the first few of each. A
   representative puts its prefix into the index, with its size, position and a digest.
4. Candidates. Entries that meet at a shingle pass the length filter, the positional filter
   (what can still follow) and the suffix filter (set members per hash range, counted
   modulo 2, bound the difference from below). First every list is compared with one leader; then
   only entries whose documents are not yet connected are compared with each other.
5. Verification. Each pair is verified once, by exact intersection of the two sets.

Classes and links go through connected components. Defined results: null and empty texts
have empty sets and link with nothing; equal texts link; rows with a null id are kept and
link with nothing; rows with equal ids are one node. Extra columns are not looked at.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.bitmaps import bitmap, known
from wayfare.llm.components import connected_components
from wayfare.llm.words import bound_batches, mix, word_chunks
from wayfare.runtime import materialize

# Cells of the table of shingle counts: one per 100 bytes of text (16 shingles or so), a
# power of two. The upper bound is one byte each in every task: 64 MB. Beyond it, lists of
# frequent shingles get longer, but results stay the same.
_BYTES_PER_CELL = 100
_LEAST_BITS, _MOST_BITS = 16, 26
_CHUNK = 1 << 16
# A cell counts to 65,535 before its task sends what it has.
_DOCUMENTS_AT_ONCE = 65_000
# Digests that a task keeps in order to leave out further copies of a set; the rest is left to Spark.
_REMEMBERED = 200_000


def _sets(texts: pa.Array, words: int):
    """Per text, its sorted distinct shingle hashes."""
    for _, _, chunk in word_chunks(texts):
        hashes, bounds = chunk.shingles(words)
        for a, b in zip(bounds, bounds[1:]):
            yield np.unique(hashes[a:b])


def _signed(value: np.uint64) -> int:
    return int(np.int64(np.uint64(value).view(np.int64)))


def _digests(own: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever its order."""
    with np.errstate(over="ignore"):
        return _signed(mix(own).sum(dtype=np.uint64)), _signed(mix(own ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64))


def _parities(own: np.ndarray) -> list[int]:
    """For 256 ranges of hash values, whether the set has an odd number of members there, as four numbers.

    Each member that only one of two sets holds flips one of these bits, so the bits in
    which the sets differ are at most as many as such members.
    """
    counts = np.bincount(((mix(own)) >> np.uint64(56)).astype(np.int64), minlength=256)
    return np.packbits((counts & 1).astype(np.uint8)).view("<i8").tolist()


_PARITIES = ("p0", "p1", "p2", "p3")
_SUMMARY = "doc_id long, n long, h1 long, h2 long, p0 long, p1 long, p2 long, p3 long, row int, gaps binary, counts binary"


def _cell_rows(cells: np.ndarray):
    """The cells that are not 0, per chunk: distances between them and counts up to 255, a byte each.

    A distance above 255 is cut by entries that count 0.
    """
    for row in range(len(cells) // _CHUNK):
        own = cells[row * _CHUNK : (row + 1) * _CHUNK]
        used = np.flatnonzero(own)
        if not len(used):
            continue
        gaps = np.diff(used, prepend=0)
        fill = (gaps - 1).clip(0) // 255
        places = np.cumsum(fill + 1) - 1
        out, counts = np.full(places[-1] + 1, 255, np.uint8), np.zeros(places[-1] + 1, np.uint8)
        out[places] = gaps - 255 * fill
        counts[places] = np.minimum(own[used], 255)
        yield row, out.tobytes(), counts.tobytes()


def _summarise(batches, words: int, bits: int):
    """Per document: size and digest of its set; per task: counts of shingles per cell, in rows of cells.

    Both come from one pass over the texts, as two kinds of rows.
    """
    cells, since = np.zeros(1 << bits, np.uint16), 0
    names = [c.split()[0] for c in _SUMMARY.split(", ")]
    schema = pa.schema([*[(c, pa.int64()) for c in names[:-3]], ("row", pa.int32()), ("gaps", pa.binary()), ("counts", pa.binary())])

    def counted() -> pa.RecordBatch:
        rows = list(_cell_rows(cells))
        none = pa.nulls(len(rows)).cast(pa.int64())
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays(
            [*[none] * 8, *[pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()))]], schema=schema
        )

    for batch in batches:
        sizes, first, second, parities = [], [], [], []
        for own in _sets(batch.column(1), words):
            sizes.append(len(own))
            digest = _digests(own)
            first.append(digest[0])
            second.append(digest[1])
            parities.append(_parities(own))
            if len(own):
                np.add.at(cells, (own >> np.uint64(64 - bits)).astype(np.int64), np.uint16(1))
                since += 1
                if since == _DOCUMENTS_AT_ONCE:
                    yield counted()
                    cells[:], since = 0, 0
        none = pa.nulls(len(sizes))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64())]
            + [pa.array([p[i] for p in parities], pa.int64()) for i in range(4)]
            + [none.cast(pa.int32()), none.cast(pa.binary()), none.cast(pa.binary())],
            schema=schema,
        )
    yield counted()


def _levels(batches):
    """Add up the chunks of one task: quarter powers of two of their counts, a byte per cell."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for row, gaps, counts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            places = np.cumsum(np.frombuffer(gaps.as_buffer(), np.uint8), dtype=np.int64)
            own = total.setdefault(row, np.zeros(_CHUNK, np.uint32))
            # Entries that only cut a distance add 0 where they stand.
            np.add.at(own, places, np.frombuffer(counts.as_buffer(), np.uint8).astype(np.uint32))
    levels = [np.round(4 * np.log2(1 + c.astype(np.float64))).astype(np.uint8).tobytes() for c in total.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(levels, pa.binary())], names=["row", "levels"])


def shingle_order(summary: DataFrame, bits: int) -> np.ndarray:
    """Magnitude of each cell's count, from all documents: one byte per cell."""
    counts = summary.where("row is not null").select("row", "gaps", "counts")
    table = counts.repartition("row").mapInArrow(_levels, "row int, levels binary").toArrow()
    order = np.zeros(1 << bits, np.uint8)
    for row, own in zip(table["row"].to_pylist(), table["levels"]):
        order[row * _CHUNK : (row + 1) * _CHUNK] = np.frombuffer(own.as_buffer(), np.uint8)
    return order


def _ordered(own: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The set, rarest first."""
    shift = np.uint64(65 - len(order).bit_length())
    return own[np.lexsort((own, order[(own >> shift).astype(np.int64)]))]


def _needed(n: np.ndarray | int, num: int, den: int):
    """Least overlap of a set of size n with any set similar to it."""
    return -(-n * num // den)


def _index_entries(batches, words: int, num: int, den: int, order: np.ndarray):
    """Prefix entries of each different set that the task sees: shingle, digests of the set, size, place."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        shingles, first, second, sizes, places = [], [], [], [], []
        for own in _sets(batch.column(0), words):
            n = len(own)
            digest = _digests(own)
            if not n or digest in seen:
                continue
            if len(seen) < _REMEMBERED:
                seen.add(digest)
            length = n - _needed(n, num, den) + 1
            shingles.append(_ordered(own, order)[:length].view(np.int64))
            first += [digest[0]] * length
            second += [digest[1]] * length
            sizes += [n] * length
            places += range(1, length + 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(shingles) if shingles else np.empty(0, np.int64)),
                pa.array(first, pa.int64()),
                pa.array(second, pa.int64()),
                pa.array(sizes, pa.int32()),
                pa.array(places, pa.int32()),
            ],
            names=["shingle", "h1", "h2", "n", "place"],
        )


def _pair_filter(num: int, den: int) -> Column:
    """Length, positional and suffix filter for entries a and b that meet at a shingle."""
    na, nb = F.col("a.n").cast("long"), F.col("b.n").cast("long")
    # |A and B| >= num / (num + den) (|A| + |B|)
    least = F.ceil((na + nb) * num / (num + den))
    follow = F.least(na - F.col("a.place"), nb - F.col("b.place")) + F.least("a.nth", "b.nth")
    apart = sum(F.bit_count(F.col(f"a.{p}").bitwiseXOR(F.col(f"b.{p}"))) for p in _PARITIES)
    return (na * den >= nb * num) & (nb * den >= na * num) & (follow >= least) & (apart <= na + nb - 2 * least)


def _verify(batches, num: int, den: int):
    """Exact intersection of both sets."""
    for batch in batches:
        kept, shared = [], []
        first, second = batch.column("sa"), batch.column("sb")
        for i in range(batch.num_rows):
            a, b = np.frombuffer(first[i].as_buffer(), "<u8"), np.frombuffer(second[i].as_buffer(), "<u8")
            overlap = len(np.intersect1d(a, b, assume_unique=True))
            if overlap * den >= num * (len(a) + len(b) - overlap):
                kept.append(i)
                shared.append(overlap)
        out = batch.take(pa.array(kept, pa.int64()))
        yield pa.RecordBatch.from_arrays([out.column("a"), out.column("b"), pa.array(shared, pa.int64())], names=["a", "b", "overlap"])


class JaccardJoin:
    """Self-join of ``documents`` (doc_id, text) at similarity ``num / den`` over ``words``-word shingles."""

    def __init__(self, documents: DataFrame, words: int, num: int, den: int):
        self.words, self.num, self.den = words, num, den
        self.documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        size = self.documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.bits = min(max((size // _BYTES_PER_CELL).bit_length(), _LEAST_BITS), _MOST_BITS)
        self.summary = materialize(
            self.documents.mapInArrow(partial(_summarise, words=words, bits=self.bits), _SUMMARY)
        )
        self.nodes = self.summary.where("row is null").select("doc_id", "n", "h1", "h2", *_PARITIES)
        key = ["n", "h1", "h2", *_PARITIES]
        usable = self.nodes.where("n > 0 and doc_id is not null")
        # One row per class of equal sets; partial minima, so a class of any size is cheap.
        self.classes = materialize(usable.groupBy(*key).agg(F.min("doc_id").alias("id")))

    def links(self) -> DataFrame:
        """Verified links between class representatives that connect all that is linked: a, b, overlap."""
        words, num, den = self.words, self.num, self.den
        order = self.summary.sparkSession.sparkContext.broadcast(shingle_order(self.summary, self.bits))

        def entries(batches):
            yield from _index_entries(batches, words, num, den, order.value)

        emitted = self.documents.where("doc_id is not null").select("text").mapInArrow(
            entries, "shingle long, h1 long, h2 long, n int, place int"
        )
        # One shuffle by shingle serves the copies that tasks share, the list sizes and the lists.
        index = emitted.repartition("shingle").dropDuplicates()
        lists = Window.partitionBy("shingle")
        shared = index.withColumn("_entries", F.count(F.lit(1)).over(lists)).where("_entries > 1").drop("_entries")
        # A shingle of one list entry is in no other prefix: matches before a place are at most the shared ones there.
        earlier = Window.partitionBy("n", "h1", "h2").orderBy("place")
        shared = shared.withColumn("nth", F.row_number().over(earlier)).withColumn("before", F.lag("shingle").over(earlier))
        shared = shared.join(self.classes, ["n", "h1", "h2"])
        shared = materialize(shared.select("shingle", "id", "n", "place", "nth", "before", *_PARITIES))
        leaders = shared.groupBy("shingle").agg(F.min(F.struct("n", "id", "place", "nth", *_PARITIES)).alias("leader"))
        shared = shared.join(leaders, "shingle")
        led = shared.where(F.col("id") != F.col("leader.id")).select(
            F.col("leader").alias("a"),
            F.struct("id", "n", "place", "nth", *_PARITIES).alias("b"),
        )
        asked = self._pairs(led.where(_pair_filter(num, den)))
        sets = self._sets_of(self._ends(asked))
        first = self._verified(asked, sets)
        joined = connected_components(first)
        # Only lists that still hold documents of several components need all their pairs.
        tagged = shared.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
        mixed = tagged.groupBy("shingle").agg(F.min("component").alias("_x"), F.max("component").alias("_y")).where("_x < _y")
        open_entries = tagged.join(mixed.select("shingle"), "shingle").where(F.col("id") != F.col("leader.id"))
        open_entries = materialize(open_entries.select("shingle", "id", "n", "place", "nth", "before", "component", *_PARITIES))
        left, right = open_entries.alias("a"), open_entries.alias("b")
        ahead = F.struct(F.col("a.n"), F.col("a.id")) < F.struct(F.col("b.n"), F.col("b.id"))
        # Two entries with the same shared shingle before them have met there, under the same filters.
        met = F.coalesce(F.col("a.before") == F.col("b.before"), F.lit(False))
        pairs = left.join(
            right,
            (F.col("a.shingle") == F.col("b.shingle"))
            & ~met
            & ahead
            & (F.col("a.component") != F.col("b.component"))
            & _pair_filter(num, den),
        )
        rest = self._pairs(pairs.select(F.struct("a.id", "a.n").alias("a"), F.struct("b.id", "b.n").alias("b")), asked)
        more = self._sets_of(self._ends(rest).join(sets.select("id"), "id", "left_anti"))
        return first.unionByName(self._verified(rest, sets.unionByName(more)))

    @staticmethod
    def _ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()

    @staticmethod
    def _pairs(met: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
        """Each pair once, without those that were verified earlier."""
        pairs = met.select(F.col("a.id").alias("a"), F.col("a.n").alias("na"), F.col("b.id").alias("b"), F.col("b.n").alias("nb")).distinct()
        return materialize(pairs if earlier is None else pairs.join(earlier.select("a", "b"), ["a", "b"], "left_anti").select("a", "na", "b", "nb"))

    def _sets_of(self, ids: DataFrame) -> DataFrame:
        """The sets of some documents, and of a few more: id, set as bytes.

        Texts stay where they are read. A bitmap of the ids goes to them, and only sets that
        pass it are written.
        """
        wanted = materialize(ids)
        spark, words = ids.sparkSession, self.words
        marks = spark.sparkContext.broadcast(bitmap(wanted.select(F.xxhash64("id").alias("h")), wanted.count(), bits_per_key=64))

        def run(batches):
            for batch in batches:
                passed = pa.array(np.flatnonzero(known(marks.value, batch.column(2).to_numpy().view(np.uint64))))
                made = [own.astype("<u8").tobytes() for own in _sets(batch.column(1).take(passed), words)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(passed), pa.array(made, pa.binary())], names=["id", "set"])

        texts = self.documents.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("h"))
        return materialize(texts.mapInArrow(run, "id long, set binary"))

    def _verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        num, den = self.num, self.den
        sided = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
        sided = sided.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")

        def run(batches):
            yield from _verify(batches, num, den)

        return materialize(sided.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long, overlap long"))

    def components(self) -> DataFrame:
        """One row per document: doc_id, n_shingles and component_id."""
        usable = F.coalesce((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.lit(False))
        member = self.nodes.where(usable).join(self.classes, ["n", "h1", "h2"]).select("doc_id", "id", "n")
        found = connected_components(self.links())
        linked = member.join(found, "id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
        alone = self.nodes.where(~usable).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        return linked.unionByName(alone)


def near_duplicates(documents: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links).

    Where ids repeat, the join runs on hashes of id and text; rows of one id are then one
    node, so that their components become one.
    """
    bound_batches(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    repeated = rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return JaccardJoin(rows, words, num, den).components()
    hashed = rows.where("doc_id is not null").withColumn("_own", F.xxhash64("doc_id", "text"))
    distinct = hashed.select(F.col("_own").alias("doc_id"), "text").dropDuplicates(["doc_id"])
    found = JaccardJoin(distinct, words, num, den).components().select(F.col("doc_id").alias("_own"), "n_shingles", F.col("component_id").alias("_group"))
    known = materialize(hashed.select("doc_id", "_own").join(found, "_own"))
    smallest = known.groupBy("_group").agg(F.min("doc_id").alias("_least"))
    ties = known.join(smallest, "_group").where("doc_id <> _least").select(F.col("_least").alias("a"), F.col("doc_id").alias("b"))
    joined = connected_components(ties).select(F.col("id").alias("doc_id"), "component")
    out = known.join(joined, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    nameless = rows.where("doc_id is null")
    return out.unionByName(JaccardJoin(nameless, words, num, den).components())


def keep_one_each(documents: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents without near-duplicates: of each component the row with the smallest id stays.

    Rows are told apart by a hash of id and text, so rows with a null id take part as all
    others do; a null id comes after all ids. Of rows that are equal in id and text one
    stays. Texts without words link with nothing and stay.
    """
    bound_batches(documents.sparkSession)
    columns = documents.columns
    keyed = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.xxhash64("doc_id", "text").alias("key"))
    rows = keyed.select("key", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    counted = materialize(rows.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")))
    repeated = counted.where("n > 1")
    texts = rows.select(F.col("key").alias("doc_id"), "text")
    if not repeated.isEmpty():
        texts = texts.dropDuplicates(["doc_id"])
    found = JaccardJoin(texts, words, num, den).components()
    found = materialize(found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("component"), "n_shingles"))
    linked = found.where("n_shingles > 0").join(counted, "key")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
    stays = linked.groupBy("component").agg(first).select("component", F.col("first.key").alias("stays"))
    gone = linked.join(stays, "component").where("key <> stays").select("key")
    left = keyed.join(gone, "key", "left_anti")
    if not repeated.isEmpty():
        # Copies of a row that stays; those without words are no copies.
        several = repeated.join(found.where("n_shingles > 0"), "key").select("key")
        once = left.join(several, "key", "left_semi").groupBy("key").agg(F.any_value("row").alias("row"))
        left = left.join(several, "key", "left_anti").select("key", "row").unionByName(once.select("key", "row"))
    return left.select("row.*")
