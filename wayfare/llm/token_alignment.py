"""Align the tokens of two tokenizers: identity map for plain groups, pair shuffle for the rest.

1. Encoding. Every text is encoded by both tokenizers once. Byte offsets where tokens of
   both end cut them into groups; token pairs that share a group are links.
2. Identity map. An array gives, for an id of A, the id of B with the same bytes. A group of
   one token on each side that agrees with the map needs no pair: a document counts once for
   its A id, and documents are counted in vectors as long as A's vocabulary.
3. Other groups. Only their pairs enter a shuffle, once per document with a multiplicity;
   pairs that agree with the map join the vectors, so that no document counts twice.
4. Scores. Vectors and the highest count per A id are as long as the vocabulary and go to all
   tasks. Of the pairs' counts, those of the most frequent pairs go too, at most ``hot`` of
   them; all others are joined by shuffle, where a pair then has few rows.

Defined results: texts that are null or empty, or whose tokens of one side do not spell a
space and the text, have zeros and an empty string, no links, and count for no pair; every
row is a document, also repeated rows and rows of one id; extra columns are not looked at.
Texts of any length are encoded whole. A group with very many tokens on both sides is
expanded in slices of A ids, over distinct ids with their numbers.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wayfare.llm.words import bound_batches
from wayfare.runtime import materialize

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
# Counts of pairs that every task holds, 24 bytes each; all further pairs are joined.
HOT_PAIRS = 300_000
# Pairs of distinct ids that a task expands at once, and bytes of text that it aligns at once.
_PAIRS_AT_ONCE = 1 << 21
_BYTES_AT_ONCE = 1 << 20
# Texts up to this size go through the faster of A's two encoders, which give equal ids.
_SHORT = 200_000

# Fixed value: how byte-level tokenizers cut a text before merging.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: itself if printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers with the bytes of their ids and the identity map."""

    def __init__(self, a_file: str, b_file: str):
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        with open(a_file, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["id"]: t["content"] for t in described["added_tokens"] if t["special"]}
        letters = _byte_letters()
        vocabulary = described["model"]["vocab"]
        self.a_bytes = [b""] * (max([*vocabulary.values(), *special]) + 1)
        for token, number in vocabulary.items():
            self.a_bytes[number] = token.encode() if number in special else bytes(letters[c] for c in token)
        # The merges are in the order of their ids, so the same vocabulary as ranks encodes alike.
        ranks = {self.a_bytes[n]: n for n in vocabulary.values() if n not in special}
        self.a_fast = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # Where a byte piece and a plain piece have the same bytes, the plain one is written later and stays.
        order = sorted(range(size), key=lambda i: not self.b.is_byte(i))
        spelled = {self.b_bytes[i]: i for i in order if not (self.b.is_control(i) or self.b.is_unknown(i))}
        self.same = np.array([spelled.get(b, -1) if i not in special else -1 for i, b in enumerate(self.a_bytes)], np.int64)
        self.a_sizes = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(b) for b in self.b_bytes], np.int64)
        most = max(len(self.a_bytes), size)
        self.written = np.array([[b"%d%s" % (i, sep) for i in range(most)] for sep in (b",", b"|", b";", b"")], object)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        a = [
            np.array(self.a_fast.encode_ordinary(" " + t), np.int64)
            if len(t) <= _SHORT
            else np.array(self.a.encode(" " + t, add_special_tokens=False).ids, np.int64)
            for t in texts
        ]
        return a, [np.array(ids, np.int64) for ids in self.b.encode(texts, num_threads=1)]

    def spells(self, ids_a: np.ndarray, ids_b: np.ndarray, text: str) -> bool:
        whole = b" " + text.encode()
        return (
            int(self.a_sizes[ids_a].sum()) == len(whole) == int(self.b_sizes[ids_b].sum())
            and b"".join(map(self.b_bytes.__getitem__, ids_b.tolist())) == whole
            and b"".join(map(self.a_bytes.__getitem__, ids_a.tolist())) == whole
        )


@lru_cache(maxsize=2)
def tokenizers(a_file: str, b_file: str) -> Tokenizers:
    return Tokenizers(a_file, b_file)


def _counted(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, and the sums of their weights."""
    if not len(codes):
        return codes, weights
    order = np.argsort(codes, kind="stable")
    codes, weights = codes[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(weights, first)


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each run of the given lengths."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


@dataclass
class Aligned:
    """Groups of a few documents. ``same`` and ``odd`` give (document, code, number of links)."""

    groups: np.ndarray
    links: np.ndarray
    sha256: list[str]
    same: tuple[np.ndarray, np.ndarray, np.ndarray]
    slices: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def align(t: Tokenizers, a: list[np.ndarray], b: list[np.ndarray]) -> Aligned:
    """Align documents one behind the other: where one ends, tokens of both sides end."""
    size_a, size_b = len(t.a_bytes), len(t.b_bytes)
    docs = len(a)
    doc_a = np.repeat(np.arange(docs), [len(x) for x in a])
    ids_a, ids_b = np.concatenate(a), np.concatenate(b)
    end_a, end_b = np.cumsum(t.a_sizes[ids_a]), np.cumsum(t.b_sizes[ids_b])
    at = np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)
    last_a = end_b[at] == end_a
    last_b = np.zeros(len(ids_b), bool)
    last_b[at[last_a]] = True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    doc = doc_a[last_a]
    n_a, n_b = np.bincount(group_a), np.bincount(group_b)
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    starts = np.searchsorted(doc, np.arange(docs))
    groups = np.diff(np.append(starts, len(doc)))
    links = np.add.reduceat(n_a * n_b, starts)
    # The written form: A tokens of a group, then its B tokens.
    code_a = np.where(last_a, 1, 0), ids_a
    ends_doc = np.zeros(len(n_b), bool)
    ends_doc[np.append(starts[1:], len(doc)) - 1] = True
    code_b = np.where(last_b, np.where(ends_doc[group_b], 3, 2), 0), ids_b
    written = np.empty(len(ids_a) + len(ids_b), object)
    written[np.arange(len(ids_a)) + first_b[group_a]] = t.written[code_a]
    written[np.arange(len(ids_b)) + (first_a + n_a)[group_b]] = t.written[code_b]
    cuts = np.append((first_a + first_b)[starts], len(written)).tolist()
    written = written.tolist()
    sha256 = [hashlib.sha256(b"".join(written[i:j])).hexdigest() for i, j in zip(cuts, cuts[1:])]
    # Plain groups agree with the identity map.
    plain = (n_a == 1) & (n_b == 1)
    plain &= t.same[ids_a[first_a]] == ids_b[first_b]
    same_doc, same_a = [doc[plain]], [ids_a[first_a[plain]]]
    same_n = [np.ones(len(same_a[0]), np.int64)]
    # All others: distinct ids of each group with their numbers, then their products.
    odd_a, odd_b = ~plain[group_a], ~plain[group_b]
    one = np.ones(1, np.int64)
    code, count_a = _counted(group_a[odd_a] * size_a + ids_a[odd_a], np.broadcast_to(one, int(odd_a.sum())))
    in_a, of_a = code // size_a, code % size_a
    code, count_b = _counted(group_b[odd_b] * size_b + ids_b[odd_b], np.broadcast_to(one, int(odd_b.sum())))
    in_b, of_b = code // size_b, code % size_b
    each = np.bincount(in_b, minlength=len(doc))
    begin = np.cumsum(each) - each
    parts = -(-int(each[in_a].sum()) // _PAIRS_AT_ONCE)
    slices = []
    for part in range(parts):
        mine = np.flatnonzero(of_a % parts == part)
        repeats = each[in_a[mine]]
        left = np.repeat(mine, repeats)
        right = begin[in_a[left]] + _within(repeats)
        pair_a, pair_b, n = of_a[left], of_b[right], count_a[left] * count_b[right]
        where = doc[in_a[left]]
        agree = t.same[pair_a] == pair_b
        same_doc.append(where[agree])
        same_a.append(pair_a[agree])
        same_n.append(n[agree])
        other = ~agree
        code, n = _counted((where[other] * size_a + pair_a[other]) * size_b + pair_b[other], n[other])
        slices.append((code // (size_a * size_b), code % (size_a * size_b), n))
    code, n = _counted(np.concatenate(same_doc) * size_a + np.concatenate(same_a), np.concatenate(same_n))
    return Aligned(groups, links, sha256, (code // size_a, code % size_a, n), slices or [(np.empty(0, np.int64),) * 3])


_COUNTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_PAIRS = "array<struct<code:bigint,n:bigint>>"
_PAIR_TYPE = pa.struct([("code", pa.int64()), ("n", pa.int64())])


def _lists(doc: np.ndarray, code: np.ndarray, n: np.ndarray, docs: int) -> pa.Array:
    bounds = np.searchsorted(doc, np.arange(docs + 1)).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(code), pa.array(n)], fields=list(_PAIR_TYPE))
    return pa.ListArray.from_arrays(pa.array(bounds), values)


def _aligned_rows(t: Tokenizers, keys: range, texts: list[str]):
    """Record batches of the documents ``keys``: one row each, and further ones with pairs only."""
    a, b = t.encode(texts)
    good = [i for i, text in enumerate(texts) if text and t.spells(a[i], b[i], text)]
    bad = sorted(set(range(len(texts))) - set(good))
    names = ["_key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "same", "odd"]
    if bad:
        zeros = pa.array(np.zeros(len(bad), np.int64))
        none = _lists(*(np.empty(0, np.int64),) * 3, len(bad))
        yield pa.RecordBatch.from_arrays([pa.array([keys[i] for i in bad]), zeros, zeros, zeros, zeros, pa.array([""] * len(bad)), none, none], names=names)
    if not good:
        return
    found = align(t, [a[i] for i in good], [b[i] for i in good])
    own = pa.array([keys[i] for i in good])
    counts = [
        pa.array([len(a[i]) for i in good], pa.int64()),
        pa.array([len(b[i]) for i in good], pa.int64()),
        pa.array(found.groups.astype(np.int64)),
        pa.array(found.links.astype(np.int64)),
        pa.array(found.sha256),
        _lists(*found.same, len(good)),
    ]
    for part, odd in enumerate(found.slices):
        pairs = _lists(*odd, len(good))
        if part:
            counts = [pa.nulls(len(good), c.type) for c in counts]
        yield pa.RecordBatch.from_arrays([own, *counts, pairs], names=names)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and number of all pairs of a list column; null lists are empty."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    return np.repeat(np.arange(len(sizes)), sizes), flat.field("code").to_numpy(), flat.field("n").to_numpy()


class TokenAlignment:
    """Aligned documents, the number of documents of each linked id pair, and scores per document."""

    def __init__(self, documents: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, hot: int = HOT_PAIRS):
        bound_batches(documents.sparkSession)
        self.hot = hot
        both = tokenizers(a_file, b_file)
        self.size_a, self.size_b = len(both.a_bytes), len(both.b_bytes)
        self.identity = both.same

        def stretches(batch):
            """Rows of the batch whose texts are about a megabyte together, or one longer text."""
            at, texts, size = 0, [], 0
            for text in batch.column(1):
                text = text.as_py() or ""
                if texts and size + len(text) > _BYTES_AT_ONCE:
                    yield at, texts
                    at, texts, size = at + len(texts), [], 0
                texts.append(text)
                size += len(text)
            if texts:
                yield at, texts

        def run(batches):
            t = tokenizers(a_file, b_file)
            for batch in batches:
                keys = batch.column(0).to_pylist()
                for at, texts in stretches(batch):
                    for rows in _aligned_rows(t, range(at, at + len(texts)), texts):
                        number = rows.column(0)
                        found = [batch.column(2).take(number), pa.array(keys).take(number), *rows.columns[1:]]
                        yield pa.RecordBatch.from_arrays(found, names=["doc_id", *rows.schema.names])

        keyed = documents.select(F.monotonically_increasing_id().alias("_key"), F.col("text").alias("_text"), "doc_id")
        kind = documents.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {kind}, _key long, {_COUNTS}, same {_PAIRS}, odd {_PAIRS}"
        self.rows = materialize(keyed.mapInArrow(run, schema))

    def identity_counts(self) -> np.ndarray:
        """Documents that hold each A id linked with the B id of its bytes; as long as A's vocabulary."""
        size = self.size_a

        def added(batches):
            total = np.zeros(size, np.int64)
            for batch in batches:
                total += np.bincount(_flat(batch.column(0))[1], minlength=size)
            held = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["a", "n"])

        counted = self.rows.where("same is not null").select("same").mapInArrow(added, "a long, n long")
        out = np.zeros(size, np.int64)
        for row in counted.groupBy("a").agg(F.sum("n").alias("n")).collect():
            out[row["a"]] = row["n"]
        return out

    def pair_counts(self) -> DataFrame:
        """Documents of each pair that does not agree with the identity map: code, n."""
        return self.rows.select(F.explode("odd").alias("pair")).groupBy(F.col("pair.code").alias("code")).agg(F.count(F.lit(1)).alias("n"))

    def scores(self) -> DataFrame:
        """One row per document with the counts of its links."""
        vector = self.identity_counts()
        pairs = materialize(self.pair_counts())
        of_a = F.expr(f"code div {self.size_b}")
        best = vector.copy()
        for row in pairs.groupBy(of_a.alias("a")).agg(F.max("n").alias("n")).collect():
            best[row["a"]] = max(best[row["a"]], row["n"])
        size = pairs.agg(F.count(F.lit(1)).alias("pairs"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
        # Counts add up to all rows, so at most ``hot`` pairs have rows / hot documents or more.
        least = 0 if size["pairs"] <= self.hot else -(-size["rows"] // max(self.hot, 1))
        known = pairs.where(F.col("n") >= least).toArrow().sort_by("code") if self.hot else None
        codes = known["code"].to_numpy() if known is not None and len(known) else np.empty(0, np.int64)
        counts = known["n"].to_numpy() if known is not None and len(known) else np.empty(0, np.int64)
        size_b = self.size_b

        def looked_up(batches):
            for batch in batches:
                row, a, n = _flat(batch.column(7))
                n_best = np.zeros(batch.num_rows, np.int64)
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, row, n * vector[a])
                np.add.at(n_best, row, n * (vector[a] == best[a]))
                row, code, n = _flat(batch.column(8))
                at = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
                hit = codes[at] == code if len(codes) else np.zeros(len(code), bool)
                count = counts[at[hit]]
                np.add.at(total, row[hit], n[hit] * count)
                np.add.at(n_best, row[hit], n[hit] * (count == best[code[hit] // size_b]))
                rest = _lists(row[~hit], code[~hit], n[~hit], batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:7], pa.array(n_best), pa.array(total), rest],
                    names=[*batch.schema.names[:7], "n_best", "count_sum", "rest"],
                )

        kind = self.rows.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {kind}, _key long, {_COUNTS}, n_best long, count_sum long, rest {_PAIRS}"
        found = self.rows.mapInArrow(looked_up, schema)
        shown = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        if size["pairs"] > len(codes):
            found = materialize(found)
            highest = self.rows.sparkSession.createDataFrame(pa.table({"a": np.arange(self.size_a), "_best": best}))
            cold = pairs.where(F.col("n") < least) if self.hot else pairs
            cold = cold.withColumn("a", of_a).join(F.broadcast(highest), "a").select("code", F.col("n").alias("_count"), "_best")
            asked = found.select("_key", F.explode("rest").alias("pair")).select("_key", "pair.code", "pair.n")
            joined = asked.join(cold, "code").select(
                "_key", F.when(F.col("_count") == F.col("_best"), F.col("n")).otherwise(0).alias("n_best"), (F.col("n") * F.col("_count")).alias("count_sum")
            )
            found = found.drop("rest").unionByName(joined, allowMissingColumns=True)
        # Documents may have several rows of pairs; one of them holds what describes the document.
        one = found.groupBy("_key").agg(*[F.max(c).alias(c) for c in shown], F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        return one.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def align_documents(documents: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, hot: int = HOT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    return TokenAlignment(documents, a_file, b_file, hot).scores()
