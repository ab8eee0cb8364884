"""Graded quality: a cumulative-link (proportional odds) model over hashed words and character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from . import hashed, textarrays as ta
from .fitting import Rows, minimise, sigmoid

#: Bound of the graded rows that the model is trained on.
TRAINING_ROWS = 4000
RIDGE = 1e-3
#: A document is selected if grade SELECT_GRADE or better has at least this probability.
SELECT_GRADE, MIN_TAIL = 1, 0.5


@dataclass
class OrdinalModel:
    """P(grade > k) = sigmoid(score - thresholds[k]): one weight vector for all grades, thresholds in rising order."""
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, chunk: ta.Chunk) -> np.ndarray:
        """P(grade > k) of each text, a column for each threshold."""
        return sigmoid(hashed.linear(chunk, self.weights)[:, None] - self.thresholds[None, :])


def fit(rows: Rows, grade: np.ndarray, levels: int, ridge: float = RIDGE) -> OrdinalModel:
    """Penalised maximum likelihood. Thresholds are the first one and the logarithms of the steps, so they stay ordered."""
    cuts, count = levels - 1, len(grade)
    share = np.array([(grade > k).mean() for k in range(cuts)]).clip(0.01, 0.99)
    at = -np.log(share / (1 - share))
    start = np.concatenate([np.zeros(rows.width), at[:1], np.log(np.maximum(np.diff(at), 0.1))])

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, steps = x[:rows.width], np.exp(x[rows.width + 1:])
        thresholds = x[rows.width] + np.concatenate([[0.0], np.cumsum(steps)])
        score = rows.times(w)
        above = np.concatenate([np.ones((count, 1)), sigmoid(score[:, None] - thresholds), np.zeros((count, 1))], axis=1)
        i = np.arange(count)
        p = np.maximum(above[i, grade] - above[i, grade + 1], 1e-12)
        slope = above * (1 - above)
        by_score = -(slope[i, grade] - slope[i, grade + 1]) / p / count
        by_threshold = np.zeros(cuts)
        for k in range(cuts):
            by_threshold[k] = (slope[:, k + 1] / p / count * ((grade == k + 1).astype(float) - (grade == k))).sum()
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([rows.back(by_score) + ridge * w, tail[:1], tail[1:] * steps])
        return -np.log(p).mean() + ridge * (w @ w) / 2, gradient

    x = minimise(loss, start)
    return OrdinalModel(x[:rows.width].astype(np.float32), x[rows.width] + np.concatenate([[0.0], np.cumsum(np.exp(x[rows.width + 1:]))]))


def train(docs: DataFrame, graded: DataFrame, levels: int, rows: int = TRAINING_ROWS) -> OrdinalModel | None:
    """Fit on at most ``rows`` graded documents (doc_id, grade from 0). None where fewer than two grades occur."""
    found = hashed.labelled_sample(docs, graded, "grade", rows).select(
        "doc_id", "target", hashed.sparse_row(F.col("text")).alias("x")).toArrow().combine_chunks().sort_by("doc_id")
    grade = np.clip(found["target"].to_numpy().astype(np.int64), 0, levels - 1)
    if len(np.unique(grade)) < 2:
        return None
    x = found["x"].combine_chunks()
    x = x if isinstance(x, pa.StructArray) else x.chunk(0)
    columns, values = x.field("columns"), x.field("values")
    return fit(Rows(np.diff(columns.offsets.to_numpy()), columns.flatten().to_numpy(), values.flatten().to_numpy(), hashed.WIDTH), grade, levels)


def grades(labels: DataFrame) -> DataFrame:
    """Ratings from the two labels: 0 poor, 1 good but toxic, 2 good. A null toxic label counts as not toxic."""
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) > 0
    return labels.where(F.col("quality").isNotNull()).select(
        "doc_id", F.when(F.col("quality") <= 0, 0).when(toxic, 1).otherwise(2).alias("grade"))


def ordinal_quality(docs: DataFrame, graded: DataFrame, levels: int = 3, training_rows: int = TRAINING_ROWS,
                    select_grade: int = SELECT_GRADE, min_tail: float = MIN_TAIL) -> DataFrame:
    """All columns of ``docs`` in a struct ``document``, and a struct ``grade``: expected_grade, tail_probability, kept.

    ``tail_probability`` is that of ``select_grade`` or better; ``kept``: it is at least ``min_tail``. Null and empty texts
    have score 0, so they get what the thresholds alone say. Without a model (fewer than two grades among the
    labels) both numbers are null and nothing is kept back. Repeated rows are graded each for itself.
    """
    model = train(docs, graded, levels, training_rows)

    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in batches:
            parts = [model.tails(c) for c in ta.chunks(text)] if model else [np.full((len(text), levels - 1), np.nan)]
            tails = np.concatenate(parts) if parts else np.zeros((0, levels - 1))
            yield pa.StructArray.from_arrays([pa.array(tails.sum(axis=1), from_pandas=True), pa.array(tails[:, select_grade - 1], from_pandas=True)],
                                             names=["expected_grade", "tail_probability"])

    out = docs.select(F.struct("*").alias("document")).withColumn(
        "g", arrow_udf(judged, "struct<expected_grade: double, tail_probability: double>")(F.col("document.text")))
    kept = F.coalesce(F.col("g.tail_probability"), F.lit(1.0)) >= min_tail
    return out.select("document", F.struct("g.*", kept.alias("kept")).alias("grade"))
