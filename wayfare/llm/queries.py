"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import decontaminate, html_text, jaccard_join, language_model, licenses, line_dedup, mixing, neighbour_search, oracles, phrases, pii, quality, token_alignment, toxicity


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors of every 50th."""
    vectors = read(spark, sf_dir, "embeddings")
    return neighbour_search.search(vectors, vectors.where("vec_id % 50 = 0"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    documents = read(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, read(spark, sf_dir, "labels")))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles are 90 % similar."""
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    documents = read(spark, sf_dir, "documents")
    return quality.score(documents, quality.fit(documents, read(spark, sf_dir, "labels")))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    return mixing.mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source"
    )


def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold."""
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that stand earlier."""
    done = line_dedup.delete_repeated_lines(read(spark, sf_dir, "documents"), every_run=True)
    return done.select(
        "doc_id",
        F.col("_lines_deleted").alias("lines_deleted"),
        F.col("_words_deleted").alias("words_deleted"),
        "text",
    )


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document."""
    documents = read(spark, sf_dir, "documents")
    return language_model.score(documents, *language_model.fit(documents))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in each document, base and disguised."""
    return pii.find_personal_data(read(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between the tokens of two tokenizers in each document."""
    return token_alignment.align_documents(read(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License signatures in each document."""
    return licenses.summary(licenses.scan(read(spark, sf_dir, "documents")))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def all_oracles() -> dict[str, str]:
    return {"op11_collocations": oracles.PHRASES}
