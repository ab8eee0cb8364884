"""Quality rules: fixed counts of a text, and a calibrated classifier over hashed words and character n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from . import hashed, textarrays as ta
from .fitting import Rows, logistic, platt, sigmoid

SYMBOLS = np.zeros(256, bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = True
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Documents below this calibrated probability of good quality go.
MIN_PROBABILITY = 0.5
#: Bound of the labelled rows that the classifier is trained and calibrated on.
TRAINING_ROWS = 4000
RIDGE = 1e-3


@dataclass
class QualityModel:
    weights: np.ndarray
    intercept: float

    def probability(self, chunk: ta.Chunk) -> np.ndarray:
        return sigmoid(hashed.linear(chunk, self.weights) + self.intercept)


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = TRAINING_ROWS) -> QualityModel | None:
    """Fit on three quarters of a bounded labelled sample, calibrate on the rest (Platt scaling).

    None where the sample has no row of one of the two classes: no classifier can be trained then.
    """
    found = hashed.labelled_sample(docs, labels, target, rows).select(
        "doc_id", "target", hashed.sparse_row(F.col("text")).alias("x")).toArrow().combine_chunks().sort_by("doc_id")
    y = (found["target"].to_numpy() > 0).astype(float)
    held = np.arange(len(y)) % 4 == 3
    if not (0 < y[~held].sum() < (~held).sum()):
        return None

    def part(chosen: np.ndarray) -> Rows:
        x = found["x"].combine_chunks().filter(pa.array(chosen))
        columns, values = x.field("columns"), x.field("values")
        return Rows(np.diff(columns.offsets.to_numpy()), columns.flatten().to_numpy(), values.flatten().to_numpy(), hashed.WIDTH)

    weights, intercept = logistic(part(~held), y[~held], np.ones((~held).sum()), RIDGE)
    if 0 < y[held].sum() < held.sum():
        slope, shift = platt(part(held).times(weights) + intercept, y[held])
        weights, intercept = weights * slope, intercept * slope + shift
    return QualityModel(weights.astype(np.float32), intercept)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_rules(chunk: ta.Chunk) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    words = ta.split(chunk, ta.WHITE)
    hashes = ta.hash_spans(chunk.data, words.start, words.end)
    letter = ((chunk.data & 0xC0) != 0x80) & ~ta.WHITE[chunk.data]

    every = ta.lines(chunk)
    first_word = np.searchsorted(words.start, every.start)
    has_word = np.searchsorted(words.start, every.end) > first_word
    text = every.text[has_word]
    line_bounds = np.searchsorted(text, np.arange(chunk.texts + 1))
    line_hashes = ta.hash_spans(chunk.data, every.start[has_word], every.end[has_word])

    found, first = ta.windows(words, hashes)
    again = first[ta.repeated(found, np.searchsorted(words.text[first], np.arange(chunk.texts + 1)), first_too=True)]
    covered = np.zeros(len(hashes) + ta.SHINGLE_WORDS + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + ta.SHINGLE_WORDS, -1)
    in_repeat = np.cumsum(covered)[:len(hashes)] > 0
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": ta.sums(letter, chunk.offsets),
        "n_symbols": ta.sums(SYMBOLS[chunk.data], chunk.offsets),
        "n_dup_lines": ta.sums(ta.repeated(line_hashes, line_bounds, first_too=False), line_bounds),
        "n_repeat_words": ta.sums(in_repeat, words.bounds),
    }


def judge(model: QualityModel | None):
    """A column function text -> struct of the counts and the probability of good quality (null without a model)."""

    @arrow_udf("struct<" + ", ".join(f"{c}: bigint" for c in COUNTS) + ", probability: double>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in batches:
            parts: dict[str, list[np.ndarray]] = {c: [] for c in (*COUNTS, "probability")}
            for chunk in ta.chunks(text):
                for name, values in count_rules(chunk).items():
                    parts[name].append(values)
                parts["probability"].append(model.probability(chunk) if model else np.full(chunk.texts, np.nan))
            columns = [pa.array(np.concatenate(p) if p else np.zeros(0, np.int64)) for p in parts.values()]
            columns[-1] = pa.array(np.concatenate(parts["probability"]) if parts["probability"] else np.zeros(0), from_pandas=True)
            yield pa.StructArray.from_arrays(columns, names=list(parts))

    return judged


def quality_rules(docs: DataFrame, labels: DataFrame, target: str = "quality", training_rows: int = TRAINING_ROWS,
                  min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """All columns of ``docs`` in a struct ``document``, and a struct ``quality`` with counts, probability and verdicts.

    ``base_failed``: fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT % of the words in five-word windows
    that occur twice or more. ``kept``: not base_failed and probability >= min_probability. A null or empty text has no
    words, so it fails. Without a trainable classifier the probability is null and the base rules decide alone.
    Repeated rows are judged each for itself; null ids are rows like others.
    """
    judged = judge(train(docs, labels, target, training_rows))
    out = docs.select(F.struct("*").alias("document")).withColumn("q", judged(F.col("document.text")))
    failed = (F.col("q.n_words") < MIN_WORDS) | (100 * F.col("q.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("q.n_words"))
    kept = ~failed & (F.coalesce(F.col("q.probability"), F.lit(1.0)) >= min_probability)
    return out.select("document", F.struct(
        F.col("q").dropFields("probability").alias("q"), failed.alias("base_failed"), kept.alias("kept"), "q.probability").alias("quality")).withColumn(
        "quality", F.struct("quality.q.*", "quality.base_failed", "quality.kept", "quality.probability"))
