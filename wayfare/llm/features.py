"""Hashed word features of whole texts, and sparse linear models over them."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.words import Words, combine, mix, word_chunks

# A vector is (indices, values) of a text.
Vector = tuple[np.ndarray, np.ndarray]


def remainder(ids: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(ids.cast("string")) % parts


def remainder_of(value: object, parts: int) -> int:
    return zlib.crc32(str(value).encode()) % parts


def unigrams_and_bigrams(words: Words) -> Iterator[tuple[int, int, np.ndarray]]:
    """Hash streams (first word of each text, shift, hashes): words, and pairs of neighbours.

    A word that follows itself gives one common pair, whatever the word is.
    """
    h = words.hashes
    yield 0, 0, h
    if len(h) > 1:
        pairs = combine(h[:-1], h[1:])
        pairs[h[:-1] == h[1:]] = np.uint64(0x5265706561746564)
        yield 1, 1, pairs


def counted_vectors(words: Words, bits: int, streams: Callable = unigrams_and_bigrams) -> Iterator[Vector]:
    """Per text: hashed feature indices, and 1 + log(count), scaled to length 1."""
    shift = np.uint64(64 - bits)
    made = [(size, (hashes >> shift).astype(np.int64)) for size, _, hashes in streams(words)]
    for i in range(len(words.first) - 1):
        a, b = words.first[i], words.first[i + 1]
        own = np.concatenate([x[a : max(a, b - size)] for size, x in made]) if b > a else np.empty(0, np.int64)
        indices, counts = np.unique(own, return_counts=True)
        values = 1 + np.log(counts)
        norm = np.sqrt((values * values).sum())
        yield indices.astype(np.int32), (values / norm if norm else values).astype(np.float32)


@dataclass(frozen=True)
class LinearModel:
    """Weights of hashed features and a bias; ``bits`` is the size of the index space."""

    bits: int
    indices: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << self.bits, np.float32)
        table[self.indices] = self.weights
        return table


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_ftrl(
    vectors: list[Vector],
    labels: np.ndarray,
    bits: int,
    alpha: float = 4.0,
    beta: float = 1.0,
    l1: float = 0.1,
    l2: float = 0.02,
    passes: int = 6,
    seed: int = 4,
) -> LinearModel:
    """Logistic regression by follow-the-regularised-leader updates, one example at a time.

    Each coordinate keeps the sum of its adjusted gradients and of their squares; its
    weight is the closed-form minimum of the regularised sum, zero below ``l1``. Labels
    may be probabilities. With one class or no rows the bias alone is learned.
    """
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    order = np.random.Generator(np.random.PCG64(seed))

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        w = -(own - np.sign(own) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(own) <= l1] = 0
        return w

    bias_at = np.array([size])
    for _ in range(passes):
        for k in order.permutation(len(vectors)):
            indices, values = vectors[k]
            at, x = np.concatenate([indices, bias_at]), np.append(values, np.float32(1))
            w = weights(at)
            g = (sigmoid(float(w @ x)) - labels[k]) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    seen = np.flatnonzero(n[:-1])
    learned = weights(seen)
    used = learned != 0
    return LinearModel(bits, seen[used].astype(np.int32), learned[used].astype(np.float32), float(weights(bias_at)[0]))


def linear_scores(words: Words, model: LinearModel, table: np.ndarray, streams: Callable = unigrams_and_bigrams) -> np.ndarray:
    """Probability of class 1 for each text: sparse dot product, bias, sigmoid."""
    dots = [float(table[i] @ v) for i, v in counted_vectors(words, model.bits, streams)]
    return sigmoid(np.array(dots, float) + model.bias)


def score_table(documents: DataFrame, model: LinearModel, streams: Callable = unigrams_and_bigrams, **options) -> DataFrame:
    """doc_id and ``score`` of every whole text, one task per partition."""

    def run(batches):
        table = model.dense()
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for row, until, words in word_chunks(batch.column(1), **options):
                scores[row:until] = linear_scores(words, model, table, streams)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents, by the order of a hash of the id: doc_id, text, label.

    Labels that are null take no part; a document with several label rows counts with the
    smallest label.
    """
    # The sample is drawn from the ids, so that texts of other rows are not moved.
    drawn = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id")
        .limit(rows)
    )
    return one_text_each(documents, drawn)


def one_text_each(documents: DataFrame, drawn: DataFrame) -> DataFrame:
    """Documents of the drawn ids, few by number; of rows with one id that with the smallest hash of its text."""
    rows = documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    same = [F.any_value(c).alias(c) for c in drawn.columns if c != "doc_id"]
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), *same)


def collect_vectors(sample: DataFrame, bits: int, streams: Callable = unigrams_and_bigrams, **options) -> tuple[list[Vector], np.ndarray]:
    """Feature vectors and labels of a bounded sample (doc_id, text, label), in a fixed order."""

    def run(batches):
        for batch in batches:
            ids, vectors = batch.column(0), []
            for _, _, words in word_chunks(batch.column(1), **options):
                vectors += counted_vectors(words, bits, streams)
            indices = pa.array([v[0] for v in vectors], pa.list_(pa.int32()))
            values = pa.array([v[1] for v in vectors], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([ids, batch.column(2), indices, values], names=["doc_id", "label", "indices", "values"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    got = sample.select("doc_id", "text", F.col("label").cast("double")).mapInArrow(
        run, f"doc_id {kind}, label double, indices array<int>, values array<float>"
    )
    table = got.toArrow().sort_by("doc_id")
    vectors = [
        (np.asarray(i.values), np.asarray(v.values)) for i, v in zip(table["indices"], table["values"])
    ]
    return vectors, table["label"].to_numpy()
