"""Quality classifier: hashed word n-grams, logistic regression by FTRL updates, sparse scoring.

Words are runs of letters and figures, and runs of signs; their case counts. Defined
results: a null or empty text gets the bias as its score; texts without label are scored
too; repeated rows get equal scores; with no usable label every score is 0.5. Extra
columns are not looked at; only the text makes the score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.features import LinearModel, collect_vectors, fit_ftrl, labelled_sample, remainder, score_table
from wayfare.llm.words import bound_batches

BITS = 18
# Bound of the training sample: labelled rows, drawn by a hash of the id.
TRAINING_ROWS = 6_000
FOLDS = 5
THRESHOLD = 0.3
_WORDS = {"lower": False, "signs": True}


def fit(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> LinearModel:
    """Fit on labelled documents outside the held-out fold."""
    bound_batches(documents.sparkSession)
    used = labels.where(remainder(F.col("doc_id"), FOLDS) != 0)
    sample = labelled_sample(documents, used, "quality", rows)
    vectors, target = collect_vectors(sample, BITS, **_WORDS)
    return fit_ftrl(vectors, target, BITS)


def score(documents: DataFrame, model: LinearModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return score_table(documents, model, **_WORDS).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
