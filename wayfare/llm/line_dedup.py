"""Delete repeated runs of lines: winnowing over line hashes.

A gram is the shortest run of lines from a line on that holds ``gram_words`` words. From
each window, the shortest run of gram starts whose lines hold ``window_words`` words, the
gram with the smallest hash is a fingerprint. So a repeated run that holds a window and
the grams that start in it is sure to share a fingerprint, and a long line always is one.

Each fingerprint joins its first occurrence (smallest document, then line) only. From there
the match is extended both ways, line by line, and if it holds ``run_words`` words, the
later run is deleted.

A first occurrence may stand in other surroundings than a later one. So with ``every_run``,
as the queries ask for, the shortest runs that hold ``run_words`` words, from each line on and up to each line, join their own first
occurrences, and the later ones are deleted. A repeated run of ``run_words`` words or more
is covered by such runs, each of which repeats: a line with too few words behind it in the
run lies in the shortest one up to the run's end, any other in the one that begins with it.
So a line is deleted if and only if it lies in a run of ``run_words`` words that stands
earlier. Without ``every_run`` only fingerprints find runs. Every deleted line still stands at an earlier place.

Documents are ordered by id, null last, then by a hash of the text. Lines end at "\\n" and
compare without white space around them; blank lines count for nothing, and go when they
lie inside a deleted run. Defined results: a null text stays null; an empty one stays
empty; equal rows (same id and text) are one document and keep equal results. Extra
columns are passed on.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from wayfare.llm.words import bound_batches
from wayfare.runtime import materialize

GRAM_WORDS = 20
WINDOW_WORDS = 20
RUN_WORDS = 40

_LAST = 2**63 - 1


def _lines(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and number of words of the lines that are not blank, and their line numbers."""
    numbers, hashes, words = [], [], []
    for number, line in enumerate(text.split("\n")):
        line = line.strip()
        if line:
            numbers.append(number)
            hashes.append(xxhash.xxh3_64_intdigest(line.encode()))
            words.append(len(line.split()))
    return np.array(hashes, np.uint64), np.array(words, np.int64), np.array(numbers, np.int64)


def fingerprints(hashes: np.ndarray, words: np.ndarray, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS) -> list[tuple[int, int]]:
    """(gram hash, first line) of the selected grams, lines being numbered without blank ones."""
    before = np.concatenate([[0], np.cumsum(words)])
    ends = np.searchsorted(before, before[:-1] + gram_words)  # one past the last line of the gram
    count = int((ends <= len(hashes)).sum())  # grams that fit are those of the first lines
    if not count:
        return []
    grams = [xxhash.xxh3_64_intdigest(hashes[i : ends[i]].tobytes()) for i in range(count)]
    # A window ends before the first gram start that is window_words further on; all grams
    # together are one where there is none.
    stops = np.searchsorted(before[: count + 1], before[:count] + window_words)
    stops = stops[stops <= count]
    if not len(stops):
        stops = np.array([count])
    selected, best, stack = [], -1, []
    # Monotone stack over the sliding window; the smallest gram, the last one of equals.
    head, right = 0, 0
    for left in range(len(stops)):
        while right < stops[left]:
            while len(stack) > head and grams[stack[-1]] >= grams[right]:
                stack.pop()
            stack.append(right)
            right += 1
        while stack[head] < left:
            head += 1
        if stack[head] != best:
            best = stack[head]
            selected.append((grams[best] - 2**63, best))
    return selected


def shortest_runs(hashes: np.ndarray, words: np.ndarray, run_words: int = RUN_WORDS) -> list[tuple[int, int, int]]:
    """(hash, first line, one past the last line) of the shortest runs with ``run_words`` words from and up to each line."""
    before = np.concatenate([[0], np.cumsum(words)])
    stops = np.searchsorted(before, before[:-1] + run_words)
    found = {(i, int(stop)) for i, stop in enumerate(stops) if stop <= len(hashes)}
    starts = np.searchsorted(before, before[1:] - run_words, side="right") - 1
    found |= {(int(start), i + 1) for i, start in enumerate(starts) if start >= 0}
    return [(xxhash.xxh3_64_intdigest(hashes[a:b].tobytes()) - 2**63, a, b) for a, b in sorted(found)]


def _fingerprint_rows(batches, gram_words: int, window_words: int, run_words: int | None):
    for batch in batches:
        hashes, words, found, runs = [], [], [], []
        for value in batch.column(2):
            h, w, _ = _lines(value.as_py() or "")
            hashes.append(h.view(np.int64))
            words.append(w.astype(np.int32))
            found.append([{"gram": g, "line": i} for g, i in fingerprints(h, w, gram_words, window_words)])
            runs.append([{"run": r, "line": a, "stop": b} for r, a, b in (shortest_runs(h, w, run_words) if run_words else ())])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(hashes, pa.list_(pa.int64())),
                pa.array(words, pa.list_(pa.int32())),
                pa.array(found, pa.list_(pa.struct([("gram", pa.int64()), ("line", pa.int32())]))),
                pa.array(runs, pa.list_(pa.struct([("run", pa.int64()), ("line", pa.int32()), ("stop", pa.int32())]))),
            ],
            names=["_key", "_order", "hashes", "words", "found", "shortest"],
        )


def _extended(batches, run_words: int):
    """Runs to delete: for each match the maximal equal run around it."""
    for batch in batches:
        keys, runs = [], []
        columns = [batch.column(c) for c in ("_key", "hashes", "words", "first_hashes", "places")]
        for key, own, words, first, places in zip(*columns):
            a, b = own.values.to_numpy(), first.values.to_numpy()
            sums = np.concatenate([[0], np.cumsum(words.values.to_numpy())])
            done: dict[int, int] = {}  # by diagonal, the end of the last run
            out = []
            for place in sorted(places.as_py(), key=lambda p: p["line"]):
                i, j = place["line"], place["first"]
                if done.get(i - j, -1) > i:
                    continue
                low = min(i, j)
                differ = np.flatnonzero(a[i - low : i] != b[j - low : j])
                start = i - low + int(differ[-1]) + 1 if len(differ) else i - low
                high = min(len(a) - i, len(b) - j)
                differ = np.flatnonzero(a[i : i + high] != b[j : j + high])
                stop = i + (int(differ[0]) if len(differ) else high)
                done[i - j] = stop
                if sums[stop] - sums[start] >= run_words:
                    out.append({"start": start, "stop": stop})
            keys.append(key.as_py())
            runs.append(out)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(runs, kind)], names=["_key", "runs"])


def _keyed(documents: DataFrame) -> tuple[Column, Column]:
    key = F.xxhash64("doc_id", "text")
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))
    return key.alias("_key"), order.alias("_order")


def repeated_runs(
    documents: DataFrame, gram_words: int = GRAM_WORDS, window_words: int = WINDOW_WORDS, run_words: int = RUN_WORDS, every_run: bool = False
) -> DataFrame:
    """``_key`` of a document (hash of id and text) and ``runs`` of its lines (not counting blank ones) to delete."""
    bound_batches(documents.sparkSession)
    texts = documents.select(*_keyed(documents), "text").where("text is not null")
    lined = texts.mapInArrow(
        partial(_fingerprint_rows, gram_words=gram_words, window_words=window_words, run_words=run_words if every_run else None),
        "_key long, _order long, hashes array<long>, words array<int>, found array<struct<gram:long,line:int>>, "
        "shortest array<struct<run:long,line:int,stop:int>>",
    )
    lined = materialize(lined)
    prints = lined.select("_key", "_order", F.explode("found").alias("f")).select("_key", "_order", "f.gram", "f.line").distinct()
    place = F.struct("_order", "_key", "line")
    firsts = prints.groupBy("gram").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    matches = (
        prints.join(firsts.select("gram", "first"), "gram")
        .where(place != F.col("first"))
        .select("_key", F.col("first._key").alias("_first"), F.struct(F.col("line"), F.col("first.line").alias("first")).alias("place"))
    )
    # At most one match per fingerprint of a document.
    pairs = materialize(matches.groupBy("_key", "_first").agg(F.collect_list("place").alias("places")))
    arrays = lined.dropDuplicates(["_key"]) if _repeated(lined) else lined
    wanted = materialize(
        arrays.join(pairs.select("_key").union(pairs.select("_first")).distinct(), "_key").select("_key", "hashes", "words")
    )
    sided = pairs.join(wanted.select(F.col("_key").alias("_first"), F.col("hashes").alias("first_hashes")), "_first")
    sided = sided.join(wanted, "_key").select("_key", "hashes", "words", "first_hashes", "places")
    runs = sided.mapInArrow(partial(_extended, run_words=run_words), "_key long, runs array<struct<start:int,stop:int>>")
    found = runs.select("_key", F.explode("runs").alias("run")).select("_key", "run.start", "run.stop")
    if every_run:
        found = found.union(_later_runs(lined))
    # A set, as equal documents send the same runs.
    return found.groupBy("_key").agg(F.collect_set(F.struct("start", "stop")).alias("runs"))


def _later_runs(lined: DataFrame) -> DataFrame:
    """``_key``, ``start`` and ``stop`` of the shortest runs that are not the first occurrence of their lines."""
    shortest = lined.select("_key", "_order", F.explode("shortest").alias("s")).select("_key", "_order", "s.run", "s.line", "s.stop")
    place = F.struct("_order", "_key", "line")
    # Equal documents share their places, so a run that only they hold has one place.
    firsts = shortest.groupBy("run").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last")
    later = shortest.join(firsts.select("run", "first"), "run").where(place != F.col("first"))
    return later.select("_key", F.col("line").alias("start"), "stop")


def _repeated(lined: DataFrame) -> bool:
    return not lined.groupBy("_key").count().where("count > 1").isEmpty()


def cut(text: str, runs: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the runs (numbers of lines that are not blank), and the lines and words deleted."""
    lines = text.split("\n")
    numbers = [n for n, line in enumerate(lines) if line.strip()]
    gone: set[int] = set()
    words = 0
    for start, stop in runs:
        for k in range(start, stop):
            if numbers[k] not in gone:
                words += len(lines[numbers[k]].split())
        # Blank lines between two deleted lines go with them.
        gone.update(range(numbers[start], numbers[stop - 1] + 1))
    return "\n".join(line for n, line in enumerate(lines) if n not in gone), len(gone), words


def _cut_rows(batches, names: list[str]):
    for batch in batches:
        fields = dict(zip(names, batch.column("row").flatten()))
        runs = batch.column("runs").to_pylist()
        made = [
            cut(t, [(r["start"], r["stop"]) for r in own]) if own else (t, 0, 0)
            for t, own in zip(fields["text"].to_pylist(), runs)
        ]
        fields["text"] = pa.array([m[0] for m in made], pa.string())
        fields["_lines_deleted"] = pa.array([m[1] for m in made], pa.int64())
        fields["_words_deleted"] = pa.array([m[2] for m in made], pa.int64())
        yield pa.RecordBatch.from_arrays(list(fields.values()), names=list(fields))


_COUNTS = ("_lines_deleted", "_words_deleted")


def delete_repeated_lines(documents: DataFrame, **limits) -> DataFrame:
    """All documents, each text without its repeated runs, with ``_lines_deleted`` and ``_words_deleted``.

    Own columns of these two names are replaced; all others are passed on as they are.
    """
    runs = repeated_runs(documents, **limits)
    kept = [f for f in documents.schema if f.name not in _COUNTS]
    row = F.struct(*[F.col(f"`{f.name}`") for f in kept]).alias("row")
    joined = documents.select(row, _keyed(documents)[0]).join(runs, "_key", "left").select("row", "runs")
    schema = StructType([*kept, *[StructField(c, LongType()) for c in _COUNTS]])
    return joined.mapInArrow(partial(_cut_rows, names=[f.name for f in kept]), schema)


def dedup_documents(documents: DataFrame, every_run: bool = True, **limits) -> DataFrame:
    """Documents with repeated runs deleted; a document of which nothing is left goes. ``n_chars`` is counted anew."""
    done = delete_repeated_lines(documents, every_run=every_run, **limits)
    kept = done.where((F.col("_lines_deleted") == 0) | (F.length(F.regexp_replace("text", r"\s+", "")) > 0))
    if "n_chars" in documents.columns:
        changed = F.when(F.col("_lines_deleted") > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", changed.cast(documents.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"`{c}`") for c in documents.columns])
