"""Hashed words and character n-grams of whole texts, as frequencies; a linear score over them costs one table look-up
per position."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from . import textarrays as ta

#: Columns of the word family and of the character family, as powers of two.
WORD_BITS, GRAM_BITS = 14, 14
WIDTH = (1 << WORD_BITS) + (1 << GRAM_BITS)
GRAM = 3
#: A frequency of one in SCALE counts as 1, so that ridge penalties act on comparable weights.
SCALE = 20.0


def families(chunk: ta.Chunk) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words and for character n-grams (over UTF-8 bytes): hashed column of each occurrence, bounds of the texts."""
    words = ta.split(chunk, ta.WHITE)
    hashes = ta.hash_spans(chunk.data, words.start, words.end)
    word_columns = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int32)
    lengths = np.maximum(np.diff(chunk.offsets) - GRAM + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    size = max(len(chunk.data) - GRAM + 1, 0)
    key = np.zeros(size, np.uint32)
    for i in range(GRAM):
        key = (key << np.uint32(8)) | chunk.data[i:i + size]
    key *= np.uint32(0x9E3779B1)
    key ^= key >> np.uint32(15)
    key *= np.uint32(0x85EBCA77)
    whole = np.ones(size, bool)
    for edge in range(1, GRAM):
        crossing = chunk.offsets[1:-1] - edge
        whole[crossing[(crossing >= 0) & (crossing < size)]] = False
    if (lengths == 0).any():  # texts shorter than a gram put several edges close together
        starts = np.flatnonzero(whole)
        text = np.searchsorted(chunk.offsets, starts, "right") - 1
        whole[starts[starts + GRAM > chunk.offsets[text + 1]]] = False
    gram_columns = (key[whole] >> np.uint32(32 - GRAM_BITS)).astype(np.int32) + (1 << WORD_BITS)
    return [(word_columns, words.bounds), (gram_columns, bounds)]


def linear(chunk: ta.Chunk, weights: np.ndarray) -> np.ndarray:
    """The score of each text without intercept: over both families, the mean weight of all occurrences."""
    score = np.zeros(chunk.texts)
    for columns, bounds in families(chunk):
        score += SCALE * ta.sums(weights[columns].astype(float), bounds) / np.maximum(np.diff(bounds), 1)
    return score


def sparse_batch(text: pa.Array) -> pa.Array:
    """The same features as sparse rows, for training: at most WIDTH entries whatever the length of the text."""
    columns, values, ends = [], [], [0]
    for chunk in ta.chunks(text):
        found = families(chunk)
        for i in range(chunk.texts):
            size = 0
            for all_columns, bounds in found:
                a, b = bounds[i], bounds[i + 1]
                if b > a:
                    own, count = np.unique(all_columns[a:b], return_counts=True)
                    columns.append(own)
                    values.append(count * (SCALE / (b - a)))
                    size += len(own)
            ends.append(ends[-1] + size)
    ends = pa.array(np.array(ends, np.int32))
    join = lambda parts, kind: pa.array(np.concatenate(parts or [np.zeros(0)]).astype(kind))
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(ends, join(columns, np.int32)), pa.ListArray.from_arrays(ends, join(values, np.float32))],
        names=["columns", "values"])


def sparse_row(text: Column) -> Column:
    """``sparse_batch`` as a column. The function object is made here: module-level ones cannot be shipped by value."""
    return arrow_udf(sparse_batch, "struct<columns: array<int>, values: array<float>>")(text)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, rows: int) -> DataFrame:
    """(doc_id, text, target) of at most ``rows`` labelled documents, chosen by a hash of the id.

    A document with several labels takes the smallest, an id with several texts the smallest text, so the sample does
    not depend on row order. Null ids, labels and texts are left out. The sample is bounded by ``rows``, hence the
    broadcast.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull()).groupBy("doc_id").agg(
        F.min(target).alias("target"))
    chosen = own.orderBy(F.xxhash64(F.lit(11), "doc_id"), "doc_id").limit(rows)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "target").agg(F.min("text").alias("text"))
