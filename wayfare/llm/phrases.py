"""Collocation mining: vertical partitioning of a word suffix tree, one subtree group at a time.

1. Prefixes of one word. Texts are cut into pieces and words; every word is counted per
   language. A phrase is no more frequent than its words, so other words end a suffix.
2. Prefixes of two words. Pairs of frequent words are counted; a pair below the limit ends
   a suffix too. Both tests go to the tasks as bitmaps of bounded size, which let a few
   words and pairs too many pass and lose none.
3. Leaves. Each word starts a suffix, cut to ``longest`` words; equal ones add up to one leaf
   with a total.
4. Vertical partitioning. Leaves are weighed by classes of their first two words. A class
   beyond the memory budget is divided by one word more, and so on; classes are then packed
   into groups within the budget.
5. Subtrees. Each group sorts its leaves, which lays out its part of the suffix tree, and
   reads the count of each inner node from the totals of the leaves below it. A class that
   was divided leaves its upper nodes in several groups, which add them up.
6. Scores. The counts of a phrase's two parts are looked up in the table of counts. Then
   phrases inside a longer one with as many occurrences go, and the best stay.

Defined results: null and empty texts have no words; a null language is ``und``; repeated
rows and rows of one id count once each; documents without a candidate phrase, and empty
tables, give no rows; ids and extra columns are not looked at. Texts of any length are
handled whole; words of any length are words. Words are compared by 64-bit hashes of
language and word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.bitmaps import bitmap, known
from wayfare.llm.words import LOWER, bound_batches, chunks, combine, hash_words
from wayfare.runtime import materialize

LEAST = 100
LONGEST = 5
BEST = 2_000
NO_LANGUAGE = "und"
# Leaves of a group, which one task holds at once: 48 bytes each, a few times over.
BUDGET = 500_000
# Classes of two-word prefixes, and of each further word where a class is divided.
_CLASSES, _FAN = 4_096, 64
# Counters that a task holds before it hands them on.
_HELD = 1 << 19

# Bytes between words, and those that also end a piece.
_BETWEEN = np.ones(256, np.uint8)
_BETWEEN[[0x20, 0x09]] = 0
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_BETWEEN[_ENDS] = 0

_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def _language_hash(name: str) -> np.ndarray:
    data = np.frombuffer(b"l" + name.encode(), np.uint8)
    return hash_words(data, np.array([0, len(data)]), lower=False, kinds=np.ones(256, np.uint8)).hashes


class _Chunk:
    """Words of a few texts: hashes of language and word, byte ranges, and where a piece begins."""

    def __init__(self, data, offsets, languages: list[str]):
        words = hash_words(data, offsets, kinds=_BETWEEN)
        self.data, self.starts, self.ends = data, words.starts, words.ends
        per_text = np.diff(words.first)
        names = sorted(set(languages))
        number = {name: i for i, name in enumerate(names)}
        codes = np.array([number[x] for x in languages], np.int64)
        salts = np.concatenate([_language_hash(x) for x in names])
        self.names, self.language = names, np.repeat(codes, per_text)
        self.hashes = combine(salts[self.language], words.hashes)
        self.hashes[self.hashes == 0] = 1  # 0 stands for no word
        self.totals = np.bincount(codes, per_text, len(names)).astype(np.int64)
        ended = np.concatenate([[0], np.cumsum(_ENDS[data])])
        follows = np.zeros(len(self.hashes), bool)
        follows[1:] = ended[self.starts[1:]] == ended[self.ends[:-1]]
        follows[words.first[:-1][per_text > 0]] = False
        self.follows = follows

    def strings(self, at: np.ndarray) -> pa.Array:
        """The lower-case words at these places."""
        starts, sizes = self.starts[at], self.ends[at] - self.starts[at]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1])
        raw = LOWER[self.data[where]]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw))


def _read(batches) -> Iterator[_Chunk]:
    for batch in batches:
        languages = batch.column(1).to_pylist()
        for row, until, data, offsets in chunks(batch.column(0)):
            yield _Chunk(data, offsets, languages[row:until])


def _longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _word_counts(batches):
    """lang, h, word, n of the words, added up over a stretch of texts; h null for a language's total."""

    def out(held):
        table = pa.concat_tables(held)
        added = table.group_by(["lang", "h", "word"], use_threads=False).aggregate([("n", "sum")])
        yield from added.rename_columns(["lang", "h", "word", "n"]).to_batches(100_000)

    held, size = [], 0
    for chunk in _read(batches):
        hashes, first, counts = np.unique(chunk.hashes, return_index=True, return_counts=True)
        names = pa.array(chunk.names, pa.large_string())
        words = pa.table({
            "lang": names.take(pa.array(chunk.language[first])),
            "h": _longs(hashes),
            "word": chunk.strings(first),
            "n": pa.array(counts.astype(np.int64)),
        })
        totals = pa.table({
            "lang": names,
            "h": pa.nulls(len(names), pa.int64()),
            "word": pa.nulls(len(names), pa.large_string()),
            "n": pa.array(chunk.totals),
        })
        held += [words, totals]
        size += len(hashes)
        if size > _HELD:
            yield from out(held)
            held, size = [], 0
    if held:
        yield from out(held)


def _pairs_of(chunk: _Chunk, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose word and next word stand in one piece and are frequent, and the pairs' keys."""
    frequent = known(words, chunk.hashes)
    at = np.flatnonzero(frequent[:-1] & frequent[1:] & chunk.follows[1:])
    return at, combine(chunk.hashes[at], chunk.hashes[at + 1])


def _added(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sort rows by their columns and add up ``n`` of equal ones."""
    order = np.lexsort(columns[::-1])
    columns, n = [c[order] for c in columns], n[order]
    new = np.ones(len(n), bool)
    if len(n):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(n, first) if len(first) else n


def _stretches(parts: Iterator[list[np.ndarray]], names: list[str]):
    """Hand on rows (columns of hashes, each an occurrence) with the count of equal ones per stretch."""

    def out(held, counts):
        columns, n = _added([np.concatenate(c) for c in zip(*held)], np.concatenate(counts))
        for i in range(0, len(n), 100_000):
            arrays = [_longs(c[i : i + 100_000]) for c in columns] + [pa.array(n[i : i + 100_000])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n"])

    held, counts, size = [], [], 0
    for columns in parts:
        columns, n = _added(columns, np.ones(len(columns[0]), np.int64))
        held.append(columns)
        counts.append(n)
        size += len(n)
        if size > _HELD:
            yield from out(held, counts)
            held, counts, size = [], [], 0
    if held:
        yield from out(held, counts)


def _pair_counts(batches, words: np.ndarray):
    yield from _stretches(([_pairs_of(chunk, words)[1]] for chunk in _read(batches)), ["h"])


def _suffixes(batches, words: np.ndarray, pairs: np.ndarray, longest: int):
    """Suffixes of two words or more, cut to ``longest`` and after the last frequent pair."""

    def parts():
        for chunk in _read(batches):
            at, keys = _pairs_of(chunk, words)
            goes_on = np.zeros(len(chunk.hashes) + longest, bool)
            goes_on[at[known(pairs, keys)]] = True
            start = np.flatnonzero(goes_on)
            padded = np.concatenate([chunk.hashes, np.zeros(longest, np.uint64)])
            columns, alive = [padded[start]], np.ones(len(start), bool)
            for depth in range(1, longest):
                alive = alive & goes_on[start + depth - 1]
                columns.append(np.where(alive, padded[start + depth], np.uint64(0)))
            yield columns

    yield from _stretches(parts(), _WORDS[:longest])


def _partitioned(leaves: DataFrame, longest: int, budget: int) -> DataFrame:
    """Give each leaf the group and the depth of its class of prefixes.

    The driver holds the classes' weights: 4,096, and 64 for each class beyond the budget.
    """
    depth = 2
    node = F.pmod(F.xxhash64(*_WORDS[:2]), F.lit(_CLASSES))
    open_leaves = leaves.withColumn("_node", node)
    placed, group = [], -1
    while True:
        weights = open_leaves.groupBy("_node").agg(F.count(F.lit(1)).alias("n")).collect()
        divided, room = [], 0
        # Next fit in the order of the classes; beyond the last word a class is as small as it gets.
        for row in sorted(weights):
            if row["n"] > budget and depth < longest:
                divided.append((row["_node"],))
                continue
            if row["n"] > room:
                group, room = group + 1, budget
            room -= row["n"]
            placed.append((row["_node"], depth, group))
        if not divided:
            break
        spark = leaves.sparkSession
        heavy = F.broadcast(spark.createDataFrame(divided, "_node long"))
        depth += 1
        finer = F.col("_node") * _FAN + F.pmod(F.xxhash64(*_WORDS[:depth]), F.lit(_FAN))
        open_leaves = open_leaves.join(heavy, "_node").withColumn("_node", finer)
    table = leaves.sparkSession.createDataFrame(placed, "_node long, _depth int, _group int")
    # The class of a leaf at each depth; the table holds exactly one of them.
    classes, at = [], node
    for d in range(2, longest + 1):
        if d > 2:
            at = at * _FAN + F.pmod(F.xxhash64(*_WORDS[:d]), F.lit(_FAN))
        classes.append(at)
    out = None
    for d, at in enumerate(classes, start=2):
        if not any(row[1] == d for row in placed):
            continue
        here = leaves.withColumn("_node", at).join(F.broadcast(table.where(F.col("_depth") == d)), "_node").drop("_node")
        out = here if out is None else out.unionByName(here)
    if out is None:
        return leaves.withColumn("_depth", F.lit(2)).withColumn("_group", F.lit(0))
    return out


def _chain(words: list[np.ndarray]) -> np.ndarray:
    """Key of a phrase given by columns of word hashes; of one word its hash."""
    key = words[0]
    for w in words[1:]:
        key = combine(key, w)
    return key


def _subtree(table: pa.Table, least: int, longest: int) -> pa.Table:
    """Nodes of a group of leaves: the phrase's words and key, and the keys of its parts."""
    names = _WORDS[:longest]
    depth = table["_depth"].to_numpy()
    kept: list[list] = []
    # Groups may pack classes of several depths; each class's nodes are whole below its own depth.
    columns = [table[w].to_numpy().view(np.uint64) for w in names]
    totals = table["n"].to_numpy()
    order = np.lexsort([*columns[::-1], depth])
    columns, totals, depth = [c[order] for c in columns], totals[order], depth[order]
    changed = np.ones(len(totals), bool)
    changed[1:] = (depth[1:] != depth[:-1]) | (columns[0][1:] != columns[0][:-1])
    for m in range(2, longest + 1):
        changed[1:] |= columns[m - 1][1:] != columns[m - 1][:-1]
        first = np.flatnonzero(changed)
        f = np.add.reduceat(totals, first)
        good = (columns[m - 1][first] != 0) & ((f >= least) | (depth[first] > m))
        first, f = first[good], f[good]
        words = [c[first] for c in columns[:m]]
        none = np.zeros(len(first), np.uint64)
        heads = [_chain(words[:k]) if k < m else none for k in range(1, longest)]
        rests = [_chain(words[k:]) if k < m else none for k in range(1, longest)]
        kept.append([_chain(words), f, np.full(len(f), m, np.int32), words + [none] * (longest - m), heads, rests])

    def whole(parts):
        return pa.concat_arrays([_longs(p) for p in parts])

    def lists(parts, width):
        flat = np.concatenate([np.stack(p, 1).ravel() for p in parts]) if width else np.empty(0, np.uint64)
        return pa.FixedSizeListArray.from_arrays(_longs(flat), width).cast(pa.list_(pa.int64()))

    return pa.table({
        "key": whole([k[0] for k in kept]),
        "f": pa.array(np.concatenate([k[1] for k in kept])),
        "m": pa.array(np.concatenate([k[2] for k in kept])),
        "words": lists([k[3] for k in kept], longest),
        "heads": lists([k[4] for k in kept], longest - 1),
        "rests": lists([k[5] for k in kept], longest - 1),
    })


_NODE = "key long, f long, m int, words array<long>, heads array<long>, rests array<long>"


class PhraseCounts:
    """Counts of words and of phrases of up to ``longest`` words with ``least`` occurrences, per language."""

    def __init__(self, documents: DataFrame, least: int = LEAST, longest: int = LONGEST, budget: int = BUDGET):
        if not 2 <= longest <= LONGEST:
            raise ValueError(f"phrases have 2 to {LONGEST} words")
        bound_batches(documents.sparkSession)
        self.least, self.longest = max(least, 1), longest
        texts = documents.select("text", F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"))
        counted = texts.mapInArrow(_word_counts, "lang string, h long, word string, n long")
        counted = counted.groupBy("lang", "h", "word").agg(F.sum("n").alias("n"))
        stored = materialize(counted.where(F.col("h").isNull() | (F.col("n") >= self.least)))
        self.totals = stored.where("h is null").select("lang", F.col("n").alias("total"))
        self.words = stored.where("h is not null")
        words = bitmap(self.words, self.words.count())
        pairs = texts.mapInArrow(partial(_pair_counts, words=words), "h long, n long")
        pairs = materialize(pairs.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= self.least))
        pair_bits = bitmap(pairs, pairs.count())
        names = _WORDS[:longest]
        schema = ", ".join(f"{w} long" for w in names) + ", n long"
        ends = texts.mapInArrow(partial(_suffixes, words=words, pairs=pair_bits, longest=longest), schema)
        self.leaves = materialize(ends.groupBy(*names).agg(F.sum("n").alias("n")))
        grouped = _partitioned(self.leaves, longest, budget).groupBy("_group")
        least = self.least

        def subtree(table: pa.Table) -> pa.Table:
            return _subtree(table, least, longest)

        nodes = grouped.applyInArrow(subtree, _NODE)
        # Upper nodes of divided classes come from several groups; their lists are the same.
        same = [F.any_value(c).alias(c) for c in ("m", "words", "heads", "rests")]
        nodes = nodes.groupBy("key").agg(F.sum("f").alias("f"), *same)
        self.phrases = materialize(nodes.where(F.col("f") >= self.least))

    def scored(self) -> DataFrame:
        """lang, key, words, m, a, l, r, n and score of each phrase, by its weakest cut."""
        counts = self.phrases.select("key", "f").union(self.words.select("h", "n"))
        cuts = self.phrases.select("key", F.col("f").alias("a"), F.posexplode(F.arrays_zip("heads", "rests")).alias("k", "cut"), "m")
        cuts = cuts.where("k < m - 1").select("key", "a", "k", F.col("cut.heads").alias("head"), F.col("cut.rests").alias("rest"))
        left = counts.select(F.col("key").alias("head"), F.col("f").alias("l"))
        right = counts.select(F.col("key").alias("rest"), F.col("f").alias("r"))
        sized = cuts.join(left, "head").join(right, "rest")
        first_word = F.col("words")[0].alias("h")
        placed = self.phrases.select("key", "words", "m", first_word).join(self.words.select("h", "lang"), "h").join(self.totals, "lang")
        big = "decimal(20,0)"
        # All cuts share a and n, so the largest l * r scores lowest; flooring may still tie, so all are scored.
        scored = placed.join(sized, "key").withColumn(
            "score", F.expr(f"cast((cast(a as {big}) * cast(total as {big}) * 1000) div (cast(l as {big}) * cast(r as {big})) as long)")
        )
        weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
        same = [F.any_value(c).alias(c) for c in ("lang", "words", "m", "a", "total")]
        return scored.groupBy("key").agg(weakest, *same).select(
            "lang", "key", "words", "m", "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score"
        )

    def kept(self, percent: int = 100) -> DataFrame:
        """``scored`` without phrases inside a longer one that has ``percent`` % of their occurrences.

        A phrase between the two has as many occurrences as the longer one, so longer by one
        word is enough to look at.
        """
        longer = self.phrases.where("m > 2")
        inside = longer.select(F.explode(F.array(F.element_at("heads", F.col("m") - 1), F.element_at("rests", 1))).alias("key"), F.col("f").alias("_longer"))
        inside = inside.groupBy("key").agg(F.max("_longer").alias("_longer"))
        scored = self.scored().join(inside, "key", "left")
        return scored.where(F.col("_longer").isNull() | (F.lit(100) * F.col("_longer") < F.lit(percent) * F.col("a"))).drop("_longer")

    def spelled(self, phrases: DataFrame) -> DataFrame:
        """Add the column ``phrase``: the words, joined by spaces."""
        words = phrases.select("key", F.posexplode("words").alias("at", "h")).where("h <> 0")
        words = words.join(self.words.select("h", "word"), "h")
        texts = words.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("_found"))
        texts = texts.select("key", F.array_join(F.col("_found.word"), " ").alias("phrase"))
        return phrases.join(texts, "key")


def collocations(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, percent: int = 100, best: int = BEST, budget: int = BUDGET
) -> DataFrame:
    """The ``best`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts = PhraseCounts(documents, least, longest, budget)
    order = [F.desc("score"), F.desc("a")]
    # The first cut needs no spelling and runs in each task before the shuffle; ties stay in.
    near = counts.kept(percent).withColumn("_rank", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_rank") <= best)
    spelled = counts.spelled(materialize(near.drop("_rank")))
    last = Window.partitionBy("lang").orderBy(*order, F.asc("phrase"))
    ranked = spelled.withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
