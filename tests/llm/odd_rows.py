"""Fixtures: rows that operators must bear."""

from __future__ import annotations

import random

import pytest

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, document string, node int, rank int, quality string, lines string"


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null values in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rng = random.Random(5)
    base, long = sentence(rng, 80), sentence(rng, 60_000)
    texts = [base, base, base + " tail", None, "", "   \n\t ", "one two", "one two", long, base.upper(), "日本語 テキスト é", "x" * 50_000,
             "a|b <b> &amp;\n\n\nline\nline", "Released under the MIT License."]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", None]), None if t is None else len(t), "d", 1, 2, "q", "l")
            for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base, None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None),
             (0, sentence(rng, 30), "en", "s3", 9, "d", 1, 2, "q", "l")]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(14)] + [(None, 1, 0), (3, None, None), (3, 1, 1), (3, 0, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
