"""Toxicity by weak supervision: many voters, a generative label model of their votes, a linear text classifier.

Voters are words of a fixed lexicon, words and word beginnings that training labels single out, patterns of writing, and the
given label. All but the last vote for toxicity or abstain; an abstention is no vote against. The label model has for
each voter its accuracy and coverage, as the rates at which it votes in toxic and in other texts, and the pairwise
correlations of votes within the classes, so that voters which repeat one another count less than independent ones. The
balance of the classes is held at the training share. Expectation maximisation fits it to votes. A ridge logistic classifier
over hashed words and character n-grams is then trained on the posterior labels, and scores every text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from . import textarrays as ta
from .fitting import Rows, logistic, platt, sigmoid
from .staging import staged

#: Words of abuse that vote for toxicity.
LEXICON = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown")
#: Bound of the labelled rows that voters, label model and classifier are fitted on.
TRAINING_ROWS = 12_000
#: Hashed columns, as a power of two.
BITS = 20
GRAMS = (4, 5, 6)
#: Columns that fewer rows have are not learnt from; of the rest the most telling ones are used.
MIN_ROWS = 4
CLASSIFIER_COLUMNS = 3000
LEARNT_VOTERS = 96
#: A column votes if at least this share of the training rows that have it are toxic.
VOTER_PRECISION = 0.8
FOLDS, HELD_OUT_FOLD = 5, 0
RIDGES = (2e-4, 1e-3, 5e-3)
#: Fits whose held-back rows calibrate the scores.
CROSS_FITS = 4
#: The given label is one more voter. Its accuracy is estimated with the others', from this start.
START_ACCURACY = 0.97
#: Log-odds that the evidence on one row is bounded to.
MOST_EVIDENCE = 5.0
PATTERNS = ("shouting", "exclaiming", "marking")


def columns(chunk: ta.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashed columns of words and of character n-grams inside words (over bytes), with the text of each; repeats included."""
    chunk = chunk.lowered()
    words = ta.split(chunk, ta.NOT_ALPHANUMERIC)
    shift = np.uint64(64 - BITS)
    found, text = [(ta.hash_spans(chunk.data, words.start, words.end) >> shift).astype(np.int32)], [words.text]
    data = chunk.data.astype(np.uint64)
    length = words.end - words.start
    for size in GRAMS:
        own = np.flatnonzero(length > size)
        count = length[own] - size + 1
        at = np.repeat(words.start[own] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        key = np.zeros(len(at), np.uint64)
        for i in range(size):
            key = (key << np.uint64(8)) | data[at + i]
        found.append((ta.mix(key, size) >> shift).astype(np.int32))
        text.append(np.repeat(words.text[own], count))
    return np.concatenate(found), np.concatenate(text)


def word_column(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(ta.hash_spans(data, np.array([0]), np.array([len(data)]))[0] >> np.uint64(64 - BITS))


def patterns(chunk: ta.Chunk) -> np.ndarray:
    """Votes of the writing patterns: mostly capitals, many exclamation marks, many odd marks."""
    data, size = chunk.data, np.maximum(np.diff(chunk.offsets), 1)
    upper = ta.sums((data >= 65) & (data <= 90), chunk.offsets)
    lower = ta.sums((data >= 97) & (data <= 122), chunk.offsets)
    calls = ta.sums(data == 33, chunk.offsets)
    marks = ta.sums(np.isin(data, np.frombuffer(b"#*$%&", np.uint8)), chunk.offsets)
    return np.stack([upper > lower, calls * 50 > size, marks * 20 > size], axis=1)


def features(text: Column) -> Column:
    """Distinct columns of a text, and its pattern votes."""

    def batch(texts: pa.Array) -> pa.Array:
        ends, values, votes = [0], [], []
        for chunk in ta.chunks(texts):
            found, owner = columns(chunk)
            key = np.unique(owner.astype(np.int64) << BITS | found)
            values.append((key & ((1 << BITS) - 1)).astype(np.int32))
            ends += (ends[-1] + np.searchsorted(key >> BITS, np.arange(1, chunk.texts + 1))).tolist()
            votes += patterns(chunk).tolist()
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else np.zeros(0, np.int32))),
             pa.array(votes, pa.list_(pa.bool_()))], names=["columns", "patterns"])

    return arrow_udf(batch, "struct<columns: array<int>, patterns: array<boolean>>")(text)


@dataclass
class LabelModel:
    """Rates of voting in toxic and in other texts (their ratio is the accuracy, their mean the coverage), those of the given
    label, correlations of votes, share of toxic texts."""
    toxic: np.ndarray
    other: np.ndarray
    given: tuple[float, float]
    correlation: np.ndarray
    share: float

    def posterior(self, votes: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Probability of toxicity. A vote's log-odds are divided by the sum of its correlations with the other votes of the
        row; no row's evidence counts for more than MOST_EVIDENCE."""
        worth = np.maximum(np.log(self.toxic / self.other), 0.0)
        shared = 1 + votes @ np.maximum(self.correlation, 0.0)
        evidence = (votes * worth / shared).sum(axis=1)
        yes, no = self.given
        evidence += np.where(known > 0, np.log(yes / no), np.log((1 - yes) / (1 - no)))
        evidence = np.clip(evidence, -MOST_EVIDENCE, MOST_EVIDENCE)
        low, high = -40.0, 40.0  # the intercept at which the mean posterior is the training share
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if sigmoid(evidence + middle).mean() < self.share else (low, middle)
        return sigmoid(evidence + low)


def label_model(votes: np.ndarray, known: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, LabelModel]:
    """Posterior probability of toxicity for each row of votes, and the model. ``known`` is the vote of the given label."""
    known = known.astype(float)
    share = float(known.mean())
    posterior = START_ACCURACY * known + (1 - START_ACCURACY) * (1 - known)
    rate = lambda weight, what: (weight @ what + 1) / (weight.sum() + 2)
    for _ in range(rounds):
        toxic, other = rate(posterior, votes), rate(1 - posterior, votes)
        given = (float(np.clip(rate(posterior, known), 0.5, 0.995)), float(np.clip(rate(1 - posterior, known), 0.005, 0.5)))
        rest = votes - np.outer(posterior, toxic) - np.outer(1 - posterior, other)
        spread = np.sqrt(np.maximum((rest * rest).mean(axis=0), 1e-9))
        correlation = (rest.T @ rest) / len(votes) / np.outer(spread, spread)
        np.fill_diagonal(correlation, 0.0)
        model = LabelModel(toxic, other, given, correlation, share)
        new = model.posterior(votes, known)
        moved = np.abs(new - posterior).max()
        posterior = new
        if moved < 1e-6:
            break
    return posterior, model


@dataclass
class ToxicityModel:
    columns: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, chunk: ta.Chunk, table: np.ndarray) -> np.ndarray:
        """``table`` has the weights by column. Each column counts once in a text."""
        found, owner = columns(chunk)
        at = np.flatnonzero(table[found])
        key = np.unique(owner[at].astype(np.int64) << BITS | found[at])
        return sigmoid(np.bincount(key >> BITS, table[key & ((1 << BITS) - 1)], chunk.texts) + self.intercept)


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", rows: int = TRAINING_ROWS) -> ToxicityModel | None:
    """Fit on at most ``rows`` labelled documents outside the held-out fold. None where one of the classes is missing."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & (fold(F.col("doc_id")) != HELD_OUT_FOLD))
    chosen = own.groupBy("doc_id").agg(F.min(target).alias("target")).orderBy(F.xxhash64(F.lit(17), "doc_id"), "doc_id").limit(rows)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "target").agg(
        F.min("text").alias("text"))
    sample = staged(texts.select("doc_id", (F.col("target") > 0).cast("int").alias("y"), features(F.col("text")).alias("f")).select("doc_id", "y", "f.*"), "votes")

    base = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("yes")).first()
    if not 0 < base["yes"] < base["n"]:
        return None
    share = base["yes"] / base["n"]
    # The signed root of the chi-squared statistic of column and label.
    n, yes = F.col("n"), F.col("yes")
    telling = (yes - n * share) / F.sqrt(n * share * (1 - share))
    counted = sample.select("y", F.explode("columns").alias("column")).groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("yes")).where(n >= MIN_ROWS).withColumn("telling", telling)
    best = counted.orderBy(F.abs("telling").desc(), "column").limit(CLASSIFIER_COLUMNS).collect()
    used = np.array(sorted(r["column"] for r in best), np.int64)
    voters = [word_column(w) for w in LEXICON]
    sure = [r for r in best if (r["yes"] + 1) / (r["n"] + 2) >= VOTER_PRECISION and r["column"] not in voters]
    voters += [r["column"] for r in sorted(sure, key=lambda r: (-r["telling"], r["column"]))][:LEARNT_VOTERS]

    wanted = F.array([F.lit(int(c)) for c in sorted({*used.tolist(), *voters})])
    found = sample.select("doc_id", "y", F.array_intersect("columns", wanted).alias("columns"), "patterns").toArrow().combine_chunks().sort_by("doc_id")
    y = found["y"].to_numpy().astype(float)
    kept = found["columns"].combine_chunks()
    sizes, values = np.diff(kept.offsets.to_numpy()), kept.flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(y)), sizes)
    votes = np.zeros((len(y), len(voters) + len(PATTERNS)))
    for i, column in enumerate(voters):
        votes[owner[values == column], i] = 1
    votes[:, len(voters):] = np.array(found["patterns"].to_pylist(), float)
    posterior, _ = label_model(votes, y)

    place = np.minimum(np.searchsorted(used, values), len(used) - 1)
    inside = used[place] == values
    def fitted(rows: np.ndarray, ridge: float) -> tuple[np.ndarray, float, Callable]:
        """Weights and intercept learnt from some rows, and the scores they give to others."""
        def design(rows: np.ndarray) -> Rows:
            number = np.full(len(y), -1)
            number[rows] = np.arange(len(rows))
            own = inside & (number[owner] >= 0)
            return Rows(np.bincount(number[owner[own]], minlength=len(rows)), place[own], np.ones(int(own.sum())), len(used))

        weights, intercept = logistic(design(rows), posterior[rows], np.ones(len(rows)), ridge)
        return weights, intercept, lambda other: design(other).times(weights) + intercept

    # Scores of rows that a fit has not seen choose the ridge, and tell how far it shrinks: the final scores are
    # stretched accordingly.
    goal = (posterior >= 0.5).astype(float)
    tried = []
    for ridge in RIDGES:
        unseen = np.zeros(len(y))
        for i in range(CROSS_FITS):
            part = np.arange(len(y)) % CROSS_FITS == i
            unseen[part] = fitted(np.flatnonzero(~part), ridge)[2](np.flatnonzero(part))
        slope, shift = platt(unseen, goal)
        tried.append((float((np.logaddexp(0, slope * unseen + shift) - goal * (slope * unseen + shift)).mean()), ridge, slope, shift))
    _, ridge, slope, shift = min(tried)
    weights, intercept, _ = fitted(np.arange(len(y)), ridge)
    return ToxicityModel(used, (weights * slope).astype(np.float32), intercept * slope + shift)


def toxicity(docs: DataFrame, labels: DataFrame, target: str = "toxic", training_rows: int = TRAINING_ROWS) -> DataFrame:
    """All columns of ``docs`` in a struct ``document``, and a struct ``toxicity``: held_out, score, predicted.

    Scores look at the text alone. A null or empty text gets the score of no evidence. ``held_out``: crc32 of the id as text
    leaves remainder 0 by 5; such rows are never learnt from. A null id counts as empty text there. Without a trainable model
    every score is 0. Repeated rows are scored each for itself.
    """
    model = train(docs, labels, target, training_rows)

    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = np.zeros(1 << BITS, np.float32)
        if model:
            table[model.columns] = model.weights
        for text in batches:
            parts = [model.score(c, table) for c in ta.chunks(text)] if model else [np.zeros(len(text))]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    out = docs.select(F.struct("*").alias("document")).withColumn("score", arrow_udf(judged, "double")(F.col("document.text")))
    return out.select("document", F.struct((fold(F.col("document.doc_id")) == HELD_OUT_FOLD).alias("held_out"), "score",
                                           (F.col("score") >= 0.5).cast("int").alias("predicted")).alias("toxicity"))
