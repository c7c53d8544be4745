from __future__ import annotations

import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns whose names the operators use."""

    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        if extra:
            for name in ("score", "_key", "n", "id", "runs", "_gone", "_text", "label", "row", "component", "_lines_deleted"):
                df = df.withColumn(name, F.lit("own"))
        return df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and white texts, a very long text, ties, repeated rows and ids."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, long),
        (6, "same words in this text here"),
        (7, "same words in this text here"),
        (7, "same words in this text here"),
        (8, "first text of the id"),
        (8, "second text of the id"),
        (None, "no id here"),
        (9, "Ünïcödé ＠ 😀 text\x00with​signs"),
    ]
