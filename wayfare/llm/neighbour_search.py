"""Nearest neighbours by randomly rotated one-bit codes, with error bounds that choose what to rerank.

A unit vector, extended to the code's length with zeros and rotated at random, keeps one
bit per coordinate: its sign. With the code c = sign / sqrt(bits) and the correction
scalar s = <c, v>, the inner product <v, q> is estimated as <c, q> / s. Its error is
|q_rest| sqrt(1 - s^2) / s times a component of a random direction, which stays below
``margin / sqrt(bits - 1)`` but for a chance that ``margin`` sets.

Vectors lie in blocks of bounded size; queries, in groups of bounded size, meet every
block. In a block a group estimates all products from the packed bits. The k-th largest
lower bound of a query is a floor: only vectors whose upper bound reaches it are reranked
with their exact cosine in double precision. Each block returns its k best per query.

Defined results: vectors that are null, empty or zero, or hold null or non-finite
components, take no part; vectors compare with those of their own length; rows with the
id of the query are the query's own; repeated ids are separate candidates, equal rows
one query; ties go to the smaller id. Extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5
BITS = 256
MARGIN = 3.5
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
# Queries of a group that are compared at once, which bounds the table of estimates.
_AT_ONCE = 128
_SEED = 1


@lru_cache(maxsize=4)
def rotation(dimension: int, bits: int) -> np.ndarray:
    """The first ``dimension`` rows of a random orthogonal matrix of size ``bits``."""
    size = max(dimension, bits)
    gaussian = np.random.Generator(np.random.PCG64(_SEED)).standard_normal((size, size))
    q, r = np.linalg.qr(gaussian)
    return (q * np.sign(np.diag(r)))[:dimension].astype(np.float32)


def encode(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits and correction scalars of unit vectors."""
    turned = vectors.astype(np.float32) @ rotation(vectors.shape[1], bits)
    scale = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return np.packbits(turned > 0, axis=1), scale.astype(np.float32)


def estimate(codes: np.ndarray, scalars: np.ndarray, queries: np.ndarray, bits: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (queries x vectors) and their error bounds (vectors)."""
    turned = queries.astype(np.float32) @ rotation(queries.shape[1], bits)
    width = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=width).astype(np.float32)
    # <c, q> with bits b in {0, 1}: (2 <b, q> - sum q) / sqrt(width).
    products = (2 * (turned @ signs.T) - turned.sum(axis=1, keepdims=True)) / np.sqrt(width)
    wrong = np.sqrt(np.maximum(1 - scalars**2, 0)) / scalars * (margin / np.sqrt(width - 1))
    return products / scalars, wrong


def _matrix(values: pa.Array) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # The largest component first, so that no square overflows or vanishes.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cosine(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision of one vector with the rows of a matrix.

    Row sums, not a matrix product: equal rows must give equal numbers wherever they stand.
    """
    with np.errstate(all="ignore"):
        lengths = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum())
        out = (vectors * query).sum(axis=1) / lengths
    odd = ~np.isfinite(out) | (lengths < 1e-150) | (lengths > 1e150)
    if odd.any():
        out[odd] = (_unit(vectors[odd]) * _unit(query[None])[0]).sum(axis=1)
    return out


def nearest_in_block(ids, vectors, codes, scalars, query_ids, queries, k, bits, margin):
    """For each query its k best of the block: (position of the query, id, cosine)."""
    estimates, wrong = estimate(codes, scalars, _unit(queries), bits, margin)
    own = query_ids[:, None] == ids[None, :]
    estimates[own] = -np.inf
    low = estimates - wrong
    depth = min(k, low.shape[1])
    floor = np.partition(low, low.shape[1] - depth, axis=1)[:, low.shape[1] - depth]
    out = []
    for i in range(len(query_ids)):
        chosen = np.flatnonzero((estimates[i] + wrong >= floor[i]) & ~own[i])
        if not len(chosen):
            continue
        exact = cosine(queries[i], vectors[chosen])
        best = np.lexsort((ids[chosen], -exact))[:k]
        out += [(i, int(ids[chosen[b]]), float(exact[b])) for b in best]
    return out


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    bits: int = BITS,
    margin: float = MARGIN,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest of ``vectors`` for each row of ``queries`` (vec_id, embedding)."""
    taken = [F.col("vec_id").cast("long").alias("vec_id"), "embedding"]
    base = vectors.where(F.col("vec_id").isNotNull()).select(*taken).where(usable(F.col("embedding")))
    asked = queries.where(F.col("vec_id").isNotNull()).select(*taken).where(usable(F.col("embedding")))
    asked = asked.dropDuplicates()
    kind = base.schema["embedding"].dataType.simpleString()
    dealt = F.xxhash64("vec_id", "embedding")

    # Two numbers for the driver: how many blocks and groups of queries there are.
    rows, wanted = base.count(), asked.count()
    blocks, groups = max(1, -(-rows // block_rows)), max(1, -(-wanted // query_rows))

    def code(batches):
        for batch in batches:
            table = {}
            sizes = np.diff(np.asarray(batch.column(1).offsets))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                table[size] = (at, *encode(_unit(_matrix(batch.column(1).take(pa.array(at)))), bits))
            codes, scalars = [b""] * batch.num_rows, np.zeros(batch.num_rows, np.float32)
            for at, packed, scale in table.values():
                scalars[at] = scale
                for i, row in zip(at, packed):
                    codes[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.binary()), pa.array(scalars)], names=["vec_id", "embedding", "_block", "code", "scalar"]
            )

    coded = base.withColumn("_block", F.pmod(dealt, F.lit(blocks)).cast("int")).mapInArrow(
        code, f"vec_id long, embedding {kind}, _block int, code binary, scalar float"
    )
    # Every group of queries meets every block, each pair in a task's memory of fixed size.
    coded = coded.withColumn("_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    spread = asked.withColumn("_group", F.pmod(dealt, F.lit(groups)).cast("int")).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        left_size = np.diff(np.asarray(left.column("embedding").combine_chunks().offsets)) if left.num_rows else np.empty(0)
        right_size = np.diff(np.asarray(right.column("embedding").combine_chunks().offsets)) if right.num_rows else np.empty(0)
        for size in np.intersect1d(left_size, right_size):
            b = left.take(pa.array(np.flatnonzero(left_size == size)))
            ids, block = b["vec_id"].to_numpy(), _matrix(b["embedding"].combine_chunks())
            codes = np.frombuffer(b"".join(b["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
            scalars = b["scalar"].to_numpy()
            at = np.flatnonzero(right_size == size)
            for part in np.array_split(at, -(-len(at) // _AT_ONCE)):
                q = right.take(pa.array(part))
                query_ids, matrix = q["vec_id"].to_numpy(), _matrix(q["embedding"].combine_chunks())
                found = nearest_in_block(ids, block, codes, scalars, query_ids, matrix, k, bits, margin)
                rows += [(int(query_ids[i]), int(q["_row"][int(i)].as_py()), v, s) for i, v, s in found]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "_row", "vec_id", "score"])

    met = (
        coded.groupBy("_block", "_group")
        .cogroup(spread.select("vec_id", "embedding", dealt.alias("_row"), "_block", "_group").groupBy("_block", "_group"))
        .applyInArrow(meet, "query_id long, _row long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id", "_row").orderBy(F.col("score").desc(), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
