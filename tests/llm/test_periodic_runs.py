"""Periodic runs against plain enumeration of all lags."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import FOLDER, no_docs, odd_docs  # noqa: F401  fixtures

from patronscope.llm import periodic_runs, queries, textarrays as ta


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(w):
    found, taken = [], set()
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j - i >= q and j - i + q >= 12 and (i - q, j) not in taken:
                taken.add((i - q, j))
                found.append((i - q, j - i + q, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def spun(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def hard_texts():
    rng = random.Random(3)
    texts = [None, "", " \t", "a", "a " * 11, "a " * 12, "a\nb\tc " * 4, "a b c d e f " * 2, "a b c d e " * 2, "ab " * 500]
    for letters in (1, 2, 3, 5):
        texts += [" ".join(rng.choice("vwxyz"[:letters]) for _ in range(rng.randint(1, 150))) for _ in range(60)]
    for _ in range(60):  # runs in runs, cut and joined at odd places
        part = [rng.choice("uvw") for _ in range(rng.randint(1, 9))]
        for _ in range(4):
            part = (part * rng.randint(1, 4))[:rng.randint(1, 200)] + [rng.choice("uvwx")] * rng.randint(0, 3)
        texts.append(" ".join(part))
    for k in (10, 25):
        texts += [" ".join(["a", "b"] * k + ["b", "a"] * k), " ".join((["a"] * k + ["b"]) * 5 + ["a"] * (2 * k))]
    return texts


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_runs_of_words_against_all_lags(most):
    texts = hard_texts()
    for chunk in ta.chunks(pa.array(texts)):
        spans = ta.split(chunk, ta.WHITE)
        start, end, period = periodic_runs.runs_of(spans, ta.hash_spans(chunk.data, spans.start, spans.end), most)
        first = spans.bounds[:-1]
        for i in range(chunk.texts):
            own = (start >= first[i]) & (start < spans.bounds[i + 1])
            got = list(zip((start[own] - first[i]).tolist(), (end - start)[own].tolist(), period[own].tolist()))
            assert got == plain_runs(words(texts[chunk.first + i])), texts[chunk.first + i]


def test_long_texts_of_few_words_stay_sparse():
    rng = np.random.default_rng(2)
    for text in ("same " * 60_000, "to and fro " * 20_000, " ".join(f"w{i}" for i in rng.integers(0, 500, 20_000)) + " " + "x y " * 9_000):
        got = periodic_runs._batch(pa.array([text]))[0].as_py()
        assert got["n_words"] == len(words(text))
        assert max(r["length"] for r in got["runs"]) >= 18_000


def test_operator_on_odd_rows(odd_docs, no_docs):
    rows = periodic_runs.periodic_runs(odd_docs).select("document.*", "periodic.*").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        w = words(r["text"])
        assert r["n_words"] == len(w)
        if len(w) < 1000:
            assert [tuple(x) for x in r["runs"]] == plain_runs(w)
        assert r["collapsed"] == collapsed(w, [tuple(x) for x in r["runs"]])
    assert periodic_runs.periodic_runs(no_docs).count() == 0


def test_query_against_plain_python(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.queries()["op13_periodic_runs"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    some = 0
    for r in rows:
        w = spun(r["doc_id"], words(texts[r["doc_id"]]))
        runs = plain_runs(w)
        some += len(runs) > 0
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == sha("".join(f"{a},{b},{c}\n" for a, b, c in runs))
        assert r["collapsed_sha256"] == sha(collapsed(w, runs))
    assert some > 10


def test_query_of_odd_ids(spark, tmp_path):
    rows = [(None, "a b " * 30), (None, None), (7, None), (7, ""), (7, "one"), (17, "a b c d e f g h i j k l m n o p"), (17, "a " * 40)]
    spark.createDataFrame(rows * 2, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.queries()["op13_periodic_runs"](spark, str(tmp_path)).collect()
    got = sorted((str(r["doc_id"]), r["n_runs"], str(r["length"]), r["collapsed_sha256"]) for r in found)
    wanted = []
    for i, text in rows * 2:
        w = spun(i, words(text))
        runs = plain_runs(w)
        longest = str(max((x[1] for x in runs), default=None))
        wanted.append((str(i), len(runs), longest, hashlib.sha256(collapsed(w, runs).encode()).hexdigest()))
    assert got == sorted(wanted)
