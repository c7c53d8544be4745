"""Benchmark decontamination: BM25 index of test items, searched with every training passage.

1. Index. Items are cut into shards of bounded size. A shard is an inverted index with BM25
   impacts, divided by what an item needs to be retrieved: ``share`` of the score that it
   has with itself. Posting lists are cut into blocks with their largest impact.
2. Search. A document's passages are windows of words that overlap by half. A vectorised
   bound (sum of block maxima per range of items) rules out most passages; block-max WAND
   finds all items that the rest retrieve in the ranges left, none left out.
3. Verification. Question and answer (the last sentence) of a retrieved item are compared
   with the whole document by their word 5-grams.

A shard is sent to all tasks; more items mean more passes, not larger ones. Defined
results: null and empty texts retrieve nothing; items without words are never found; rows
with equal ids are separate in the search and come once per item in the report, with
their best values; null ids are reported as null. Extra columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.words import CLASSES, Words, bound_batches, hash_words, word_chunks

K1, B = 1.2, 0.75
SHARE = 0.5
STRIDE = 64
OVERLAP = 0.6
GRAM = 5
SHARD_ITEMS = 10_000
_BLOCK = 16
_RANGES = 64

_WORD = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]+")
_SENTENCE_END = re.compile(r"[.?!\n]+(?=\s|\Z)")


def lowered(text: str) -> str:
    """Lower case of items and documents alike, sign by sign: a final sigma is a sigma."""
    return pc.utf8_lower(pa.scalar(text)).as_py()


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item: the last sentence is the answer, if another one is before it."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text.rstrip())]
    starts = [e for e in ends if text[e:].strip()]
    return (text[: starts[-1]], text[starts[-1] :]) if starts else (text, "")


def _letters(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that are no signs, and the first one of each text."""
    kept = CLASSES[words.data[words.starts]] == 1
    return words.hashes[kept], np.searchsorted(words.starts[kept], words.offsets)


@dataclass
class Index:
    """Postings of one shard; impacts are in units of what an item needs."""

    ids: list
    texts: list[str]
    terms: np.ndarray  # sorted hashes
    postings: list[list[int]]  # items of each term, ascending
    impacts: list[list[float]]
    block_maxima: list[list[float]]
    term_maxima: np.ndarray
    range_maxima: np.ndarray  # terms x ranges of items
    known_parts: dict[int, list[tuple[set, int, int]]] = field(default_factory=dict)  # of items retrieved so far

    @classmethod
    def build(cls, items: list[tuple[object, str]], share: float = SHARE, stride: int = STRIDE) -> Index:
        found: dict[int, dict[int, int]] = {}
        sizes = []
        for number, (_, text) in enumerate(items):
            raw = np.frombuffer(lowered(text or "").encode(), np.uint8)
            hashes, _ = _letters(hash_words(raw, np.array([0, len(raw)]), signs=True))
            sizes.append(len(hashes))
            for h in hashes.tolist():
                own = found.setdefault(h, {})
                own[number] = own.get(number, 0) + 1
        mean = max(sum(sizes) / max(len(items), 1), 1)
        terms = np.array(sorted(found), np.uint64)
        impacts = []
        whole = np.zeros(len(items))
        for h in terms.tolist():
            own = found[h]
            idf = np.log(1 + (len(items) - len(own) + 0.5) / (len(own) + 0.5))
            row = [idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[n] / mean)) for n, tf in own.items()]
            impacts.append(row)
            whole[list(own)] += row
        # A passage of an item longer than half a window holds that part of it at least.
        need = whole * share * np.minimum(1, stride / np.maximum(sizes, 1))
        # Rounding must not turn a passage that just reaches the threshold away.
        need = np.maximum(need * (1 - 1e-9), 1e-12)
        postings = [list(found[h]) for h in terms.tolist()]
        impacts = [[v / need[n] for n, v in zip(p, row)] for p, row in zip(postings, impacts)]
        maxima = [[max(row[i : i + _BLOCK]) for i in range(0, len(row), _BLOCK)] for row in impacts]
        width = -(-len(items) // _RANGES)
        ranges = np.zeros((len(terms), _RANGES if width else 1), np.float32)
        for t, (p, row) in enumerate(zip(postings, impacts)):
            np.maximum.at(ranges[t], np.array(p) // max(width, 1), np.array(row, np.float32))
        return cls(
            [i for i, _ in items], [t or "" for _, t in items], terms, postings, impacts, maxima,
            np.array([max(m) for m in maxima]), ranges,
        )

    def parts(self, number: int) -> list[tuple[set, int, int]]:
        """Word 5-grams of an item's question and answer (the whole sequence, if shorter), their length, 0 for
        no words, and their number."""
        if number not in self.known_parts:
            words = [_WORD.findall(lowered(p)) for p in split_item(self.texts[number])]
            sizes = [min(GRAM, len(w)) for w in words]
            self.known_parts[number] = [(_grams(w, n), n, max(1, len(w) - GRAM + 1)) for w, n in zip(words, sizes)]
        return self.known_parts[number]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for words of no item."""
        out = np.full(len(hashes), -1, np.int64)
        if len(self.terms):
            table = np.zeros(1 << 16, bool)
            table[self.terms >> np.uint64(48)] = True
            maybe = np.flatnonzero(table[hashes >> np.uint64(48)])
            at = np.minimum(np.searchsorted(self.terms, hashes[maybe]), len(self.terms) - 1)
            out[maybe] = np.where(self.terms[at] == hashes[maybe], at, -1)
        return out

    def retrieve(self, query: list[int], ranges: list[int] | None = None) -> list[tuple[int, float]]:
        """Block-max WAND: all (item, score) with a score of at least 1 for a set of terms.

        Only in ``ranges``, where given; no item of another one may reach 1.
        """
        if ranges is None:
            ranges = list(range(self.range_maxima.shape[1]))
        out = []
        for r, maxima in zip(ranges, self.range_maxima[query][:, ranges].T.tolist()):
            out += self._retrieve_in(r, [(t, m) for t, m in zip(query, maxima) if m > 0])
        return out

    def _retrieve_in(self, number: int, query: list[tuple[int, float]]) -> list[tuple[int, float]]:
        """``retrieve`` in one range of items, with the largest impact of each term there."""
        width = max(1, -(-len(self.ids) // _RANGES))
        # The maxima are of single precision.
        lists = [(self.postings[t], self.impacts[t], self.block_maxima[t], m * (1 + 1e-6)) for t, m in query]
        places = [bisect_left(own, number * width) for own, *_ in lists]
        stops = [bisect_left(own, (number + 1) * width, at) for (own, *_), at in zip(lists, places)]
        live = list(range(len(lists)))
        out = []
        while live:
            live.sort(key=lambda i: lists[i][0][places[i]])
            total, pivot = 0.0, -1
            for k, i in enumerate(live):
                total += lists[i][3]
                if total >= 1:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[live[pivot]][0][places[live[pivot]]]
            # All lists that stand at the pivot item take part.
            while pivot + 1 < len(live) and lists[live[pivot + 1]][0][places[live[pivot + 1]]] == item:
                pivot += 1
            bound, beyond = 0.0, lists[live[pivot + 1]][0][places[live[pivot + 1]]] if pivot + 1 < len(live) else 1 << 62
            for i in live[: pivot + 1]:
                own, _, maxima, _ = lists[i]
                block = bisect_left(own, item, places[i]) // _BLOCK
                if block < len(maxima):
                    bound += maxima[block]
                    beyond = min(beyond, own[min(len(own), (block + 1) * _BLOCK) - 1] + 1)
            if bound < 1:
                # No item before the end of the nearest block, nor before the next list, can reach it.
                target = max(beyond, item + 1)
            else:
                score = 0.0
                for i in live[: pivot + 1]:
                    own, impacts, _, _ = lists[i]
                    at = bisect_left(own, item, places[i])
                    if at < stops[i] and own[at] == item:
                        score += impacts[at]
                if score >= 1:
                    out.append((item, score))
                target = item + 1
            for i in live[: pivot + 1]:
                places[i] = bisect_left(lists[i][0], target, places[i])
            live = [i for i in live if places[i] < stops[i]]
        return out

    def search(self, words: Words, stride: int = STRIDE) -> list[tuple[int, int, float]]:
        """(text, item, best score) of all passages of the texts: windows of 2 * stride words."""
        hashes, first = _letters(words)
        if not len(hashes) or not len(self.terms):
            return []
        counts = np.diff(first)
        windows = np.maximum(1, -(-counts // stride) - 1) * (counts > 0)
        window_from = np.concatenate([[0], np.cumsum(windows)])
        terms = self.lookup(hashes)
        at = np.flatnonzero(terms >= 0)
        owner = np.repeat(np.arange(len(counts)), counts)[at]
        half = (at - first[owner]) // stride
        terms = terms[at]
        placed = []
        loose = np.zeros(window_from[-1])
        for step in (0, -1):
            own = half + step
            inside = np.flatnonzero((own >= 0) & (own < windows[owner]))
            window = window_from[owner[inside]] + own[inside]
            loose += np.bincount(window, self.term_maxima[terms[inside]], len(loose))
            placed.append((window, terms[inside]))
        # Repeated words count each time here, so no passage is lost; most go without a sort.
        hopeful = loose >= 1 - 1e-6
        keys = np.unique(np.concatenate([w[hopeful[w]] * len(self.terms) + t[hopeful[w]] for w, t in placed]))
        if not len(keys):
            return []
        passage, term = keys // len(self.terms), keys % len(self.terms)
        begins = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        bounds = np.add.reduceat(self.term_maxima[term], begins)
        hopeful = np.flatnonzero(bounds >= 1)
        ends = np.append(begins[1:], len(keys))
        best: dict[tuple[int, int], float] = {}
        for k in hopeful:
            own = term[begins[k] : ends[k]]
            ranges = np.flatnonzero(self.range_maxima[own].sum(axis=0) >= 1 - 1e-4)
            if not len(ranges):
                continue
            text = int(np.searchsorted(window_from, passage[begins[k]], "right")) - 1
            for item, score in self.retrieve(own.tolist(), ranges.tolist()):
                if score > best.get((text, item), 0):
                    best[text, item] = score
        return [(t, i, s) for (t, i), s in sorted(best.items())]


def _grams(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def leaks(documents: DataFrame, benchmark: DataFrame, share: float = SHARE, least: float = OVERLAP, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """doc_id, item_id, score, question_overlap and answer_overlap of each item that a document holds.

    The score is that of the best passage, 1 being what is needed. The parts together must
    overlap by ``least``, weighed by their 5-grams' number.
    """
    bound_batches(documents.sparkSession)
    items = benchmark.select("item_id", "text")
    shards = max(1, -(-items.count() // shard_items))
    doc, item = (t.schema[c].dataType.simpleString() for t, c in ((documents, "doc_id"), (benchmark, "item_id")))
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
    spark = documents.sparkSession

    def searched(shard: int) -> DataFrame:
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard) if shards > 1 else items
        # Items with like words lie together, which tightens the maxima of ranges.
        rows = sorted(own.toArrow().to_pylist(), key=lambda r: (sorted(_WORD.findall((r["text"] or "").lower()), key=len)[:3], str(r["item_id"])))
        index = spark.sparkContext.broadcast(Index.build([(r["item_id"], r["text"]) for r in rows], share))

        def run(batches):
            for batch in batches:
                found = []
                texts = pc.utf8_lower(batch.column(1))
                for row, _, words in word_chunks(texts, signs=True):
                    last, text_words, grams = None, [], {}
                    for text, number, score in index.value.search(words):
                        if text != last:
                            last, text_words, grams = text, _WORD.findall(texts[row + text].as_py()), {}
                        both, shares = [], []
                        for part, n, weight in index.value.parts(number):
                            if n and n not in grams:
                                grams[n] = _grams(text_words, n)
                            shares.append(len(part & grams[n]) / len(part) if n else None)
                            both += [(shares[-1], weight)] if n else []
                        q, a = shares
                        if both and sum(v * w for v, w in both) / sum(w for _, w in both) >= least:
                            found.append((batch.column(0)[row + text].as_py(), index.value.ids[number], score, q, a))
                columns = list(zip(*found)) if found else [[]] * 5
                types = [batch.column(0).type, kind, pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        kind = own.limit(0).toArrow().schema.field("item_id").type
        return documents.select("doc_id", "text").mapInArrow(
            run, f"doc_id {doc}, item_id {item}, score double, question_overlap double, answer_overlap double"
        )

    found = reduce(DataFrame.unionByName, [searched(s) for s in range(shards)])
    best = [F.max(c).alias(c) for c in names[2:]]
    return found.groupBy("doc_id", "item_id").agg(*best)


def clean_documents(documents: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The documents that hold no benchmark item, judged by their text whatever their id."""
    key = F.xxhash64("doc_id", "text")
    keyed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), key.alias("key"))
    held = leaks(keyed.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), benchmark, **limits)
    return keyed.join(held.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").select("row.*")
