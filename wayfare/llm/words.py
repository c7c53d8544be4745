"""Hash the words of many texts at once: numpy over the bytes of an Arrow string column.

A word's 64-bit hash is a polynomial over random numbers of its bytes. Running sums give
the hash of any byte range, so prefixes of words cost no second pass. Work goes in
segments of about a megabyte that end between words, which bounds the extra memory for
texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

_SEGMENT = 1 << 18
_CHUNK_BYTES = 2 << 20
_FACTOR = np.uint64(0x5851F42D4C957F2D)
_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_NUMBERS = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# 0 white space, 1 letters, digits and all bytes of other scripts, 2 signs.
CLASSES = np.where(SPACE, 0, 1).astype(np.uint8)
CLASSES[[b for b in range(128) if not SPACE[b] and not chr(b).isalnum()]] = 2


@lru_cache(maxsize=1)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        inverse = np.uint64(pow(int(_FACTOR), -1, 2**64))
        up = np.cumprod(np.full(length, _FACTOR), dtype=np.uint64)
        down = np.cumprod(np.full(length, inverse), dtype=np.uint64)
    return up, down


def mix(hashes: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        h = (hashes ^ (hashes >> np.uint64(32))) * _MIX_A
        h = (h ^ (h >> np.uint64(29))) * _MIX_B
        return h ^ (h >> np.uint64(32))


def combine(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of ordered pairs of hashes."""
    with np.errstate(over="ignore"):
        return mix(first * _MIX_B + (second ^ _MIX_A))


@dataclass
class Words:
    """The words of a run of texts: hash, byte range in ``data``, and the texts' word ranges."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # number of the first word of each text, and the end
    offsets: np.ndarray  # bytes of each text
    prefixes: dict[int, np.ndarray]

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-word sequences and, per text, where its own begin (n + 1 numbers).

        A text with fewer than k words, but some, has its whole sequence as one.
        """
        n = len(self.hashes)
        counts = np.diff(self.first)
        if n == 0:
            return np.empty(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
        run = self.hashes
        for j in range(1, k):
            run = combine(run[: n - j], self.hashes[j:]) if n > j else np.empty(0, np.uint64)
        kept = np.where(counts >= k, counts - k + 1, 0)
        inside = np.ones(len(run), bool)
        for j in range(1, k):
            at = self.first[1:-1] - j
            at = at[(at >= 0) & (at < len(run))]
            inside[at] = False
        # The last text needs no mark: its sequences end with the array.
        full = run[inside & (np.repeat(counts >= k, counts)[: len(run)])] if len(run) else run
        short = np.flatnonzero((counts > 0) & (counts < k))
        sizes = kept.copy()
        sizes[short] = 1
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(bounds[-1], np.uint64)
        if len(short):
            whole = np.zeros(bounds[-1], bool)
            whole[bounds[short]] = True
            out[~whole] = full
            for i in short:
                h = np.array([counts[i]], np.uint64)
                for w in range(self.first[i], self.first[i + 1]):
                    h = combine(h, self.hashes[w : w + 1])
                out[bounds[i]] = h[0]
        else:
            out[:] = full
        return out, bounds


def _text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def hash_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, signs: bool = False, prefixes=(), kinds: np.ndarray | None = None) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``.

    Words are runs of other bytes than white space; with ``signs``, runs of letters and
    runs of signs are separate words; ``kinds`` gives any other class of each byte, 0 for
    what is between words, which holds all white space but line ends. ``lower`` turns A-Z
    into a-z. For each length in ``prefixes`` the hash of a word's first bytes is kept too.
    """
    if kinds is None:
        kinds = CLASSES if signs else (~SPACE).astype(np.uint8)
    numbers = _NUMBERS[LOWER] if lower else _NUMBERS
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[offsets] = True
    parts: list[tuple[np.ndarray, ...]] = []
    at, total = 0, len(data)
    while at < total:
        until = min(total, at + _SEGMENT)
        while until < total and not (SPACE[data[until]] or starts_text[until]):
            step = data[until : until + _SEGMENT]
            stop = np.flatnonzero(SPACE[step] | starts_text[until : until + len(step)])
            until += int(stop[0]) if len(stop) else len(step)
        part = data[at:until]
        kind = kinds[part]
        change = np.empty(len(part) + 1, bool)
        change[0] = change[-1] = True
        np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
        change[:-1] |= starts_text[at:until]
        edges = np.flatnonzero(change)
        begin, end = edges[:-1], edges[1:]
        real = kind[begin] > 0
        begin, end = begin[real], end[real]
        up, down = _powers(max(_SEGMENT * 2, 1 << int(len(part)).bit_length()))
        with np.errstate(over="ignore"):
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(numbers[part] * up[: len(part)], out=sums[1:])
            base, inverse = sums[begin], down[begin]
            hashes = mix((sums[end] - base) * inverse)
            heads = [mix((sums[np.minimum(begin + k, end)] - base) * inverse + np.uint64(k)) for k in prefixes]
        parts.append((hashes, begin + at, end + at, *heads))
        at = until
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), *[np.empty(0, np.uint64) for _ in prefixes]]
    first = np.searchsorted(columns[1], offsets)
    return Words(data, columns[0], columns[1], columns[2], first, offsets, dict(zip(prefixes, columns[3:])))


def chunks(texts: pa.Array, most_bytes: int = _CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into runs of rows of about ``most_bytes``, or one longer text: (from, to, bytes, offsets)."""
    data, offsets = _text_bytes(texts)
    row, rows = 0, len(texts)
    while row < rows:
        until = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most_bytes, "right")) - 1)
        until = min(until, rows)
        yield row, until, data[offsets[row] : offsets[until]], offsets[row : until + 1] - offsets[row]
        row = until


# Rows that Spark hands to Python at once, in all operators over texts: their memory in
# both processes is this many texts.
_ROWS_AT_ONCE = 1_000


def bound_batches(spark: SparkSession) -> None:
    """Keep the batches between Spark and Python small, unless the session has smaller ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    current = int(spark.conf.get(name))
    if current <= 0 or current > _ROWS_AT_ONCE:
        spark.conf.set(name, str(_ROWS_AT_ONCE))


def word_chunks(texts: pa.Array, **options) -> Iterator[tuple[int, int, Words]]:
    for row, until, data, offsets in chunks(texts):
        yield row, until, hash_words(data, offsets, **options)
