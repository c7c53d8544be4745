"""Bitmaps of hashes: tests of bounded size that let a few keys too many pass and lose none."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# 32 MB. With more keys than fit, a bitmap lets more through; what follows it is exact anyway.
MOST_BITS = 28
_CHUNK_BITS = 15


def bitmap(keys: DataFrame, count: int, bits_per_key: int = 16) -> np.ndarray:
    """Bits of the 64-bit hashes ``h``, about ``count`` in number, made on the executors in chunks."""
    bits = min(max((bits_per_key * count).bit_length(), _CHUNK_BITS + 3), MOST_BITS)

    def chunk_bits(table: pa.Table) -> pa.Table:
        marks = np.zeros(1 << _CHUNK_BITS, np.uint8)
        marks[table["at"].to_numpy()] = 1
        return pa.table({"chunk": table["chunk"][:1], "bits": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary())})

    cell = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    cells = keys.select(
        F.shiftright(cell, _CHUNK_BITS).cast("int").alias("chunk"),
        cell.bitwiseAND(F.lit((1 << _CHUNK_BITS) - 1)).cast("int").alias("at"),
    ).distinct()
    size = 1 << (_CHUNK_BITS - 3)
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in cells.groupBy("chunk").applyInArrow(chunk_bits, "chunk int, bits binary").toLocalIterator():
        out[row["chunk"] * size : (row["chunk"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bitmap holds each hash."""
    cell = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
