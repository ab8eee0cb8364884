"""Operators on odd rows, empty tables and against brute force."""

import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import FOLDER, labels, no_docs, no_labels, odd_docs  # noqa: F401  fixtures
from oracle_compare import compare, duck, type_differences
from pyspark.sql import functions as F

from patronscope.llm import (embedding_dedup, hilbert_sharding, license_scan, line_dedup, minhash_dedup, mixing, ordinal_quality, packing, queries,
                             quality_rules, textarrays as ta, toxicity)
from patronscope.llm.components import components


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    df = queries.queries()[name](spark, FOLDER)
    connection, sql = duck(FOLDER), queries.oracle_sql()[name]
    assert compare(df, connection, sql) is None
    assert type_differences(df, connection, sql) == []


def test_sets_and_words_of_batches():
    texts = ["a b  c\td e f", None, "", " x ", "A b c d e f a b c d e f", "é ü", "one\ntwo\n\nthree"]
    for size in (1, 1 << 20):
        got = []
        for chunk in ta.chunks(pa.array(texts), size):
            sets, bounds = ta.shingle_sets(chunk)
            got += np.diff(bounds).tolist()
        assert got == [len(shingles(t)) for t in texts]


def test_quality_counts_against_plain_python(spark, odd_docs, labels):
    got = quality_rules.quality_rules(odd_docs, labels).select("document.text", "quality.*").collect()
    assert len(got) == odd_docs.count()
    for r in got:
        w, text = words(r["text"]), r["text"] or ""
        lines = [x for x in text.split("\n") if words(x)]
        windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        count, covered = Counter(windows), set()
        for i, x in enumerate(windows):
            if count[x] > 1:
                covered |= set(range(i, i + 5))
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_without_labels_rules_decide_alone(odd_docs, no_labels, no_docs, labels):
    rows = quality_rules.quality_rules(odd_docs, no_labels).select("quality.*").collect()
    assert all(r["probability"] is None and r["kept"] == (not r["base_failed"]) for r in rows)
    assert quality_rules.quality_rules(no_docs, labels).count() == 0


def test_quality_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, own = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    training = own.where("doc_id % 3 <> 0")
    judged = quality_rules.quality_rules(docs, training).select("document.doc_id", "quality.*").join(own.where("doc_id % 3 = 0"), "doc_id")
    assert judged.where("(probability >= 0.5) <> (quality > 0)").count() <= 0.03 * judged.count()
    graded = ordinal_quality.ordinal_quality(docs, ordinal_quality.grades(training)).select("document.doc_id", "grade.*").join(own.where("doc_id % 3 = 0"), "doc_id")
    assert graded.where("kept <> (quality > 0)").count() <= 0.03 * graded.count()


def test_ordinal_model_recovers_order():
    from patronscope.llm.fitting import Rows

    rng = np.random.default_rng(1)
    x = rng.normal(size=3000)
    grade = np.searchsorted([-1.0, 0.5], 2 * x + rng.logistic(size=3000))
    model = ordinal_quality.fit(Rows(np.ones(3000, np.int64), np.zeros(3000, np.int64), x, 1), grade, 3, 1e-6)
    assert abs(model.weights[0] - 2) < 0.2 and np.allclose(model.thresholds, [-1.0, 0.5], atol=0.2)


def test_grades_of_odd_rows(odd_docs, no_docs, labels, no_labels):
    graded = ordinal_quality.ordinal_quality(odd_docs, ordinal_quality.grades(labels)).select("grade.*").collect()
    assert len(graded) == odd_docs.count() and all(0 <= r["tail_probability"] <= 1 for r in graded)
    assert all(r["kept"] and r["expected_grade"] is None for r in ordinal_quality.ordinal_quality(odd_docs, ordinal_quality.grades(no_labels)).select("grade.*").collect())
    assert ordinal_quality.ordinal_quality(no_docs, ordinal_quality.grades(labels)).count() == 0


def test_lines_of_odd_rows(spark, odd_docs, no_docs):
    rows = line_dedup.line_dedup(odd_docs).select("document.*", "lines.n_lines", "lines.n_removed").collect()
    assert len(rows) == odd_docs.count() and sum(r["n_removed"] for r in rows) == 0
    assert all(r["n_lines"] == (0 if r["text"] is None else len(r["text"].split("\n"))) for r in rows)
    assert line_dedup.line_dedup(no_docs).count() == 0


def test_boilerplate_goes_from_all_but_one_text(spark):
    rows = [(i, f"own {i}\n Share this page \nend {i % 3}", f"s{i}") for i in range(12)] + [(100 + i, "copied\ntext", f"s{i}") for i in range(12)]
    rows += [(200, "Share this page", None), (201, None, "s1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r["doc_id"]: r for r in line_dedup.line_dedup(docs, 10).select("document.doc_id", "document.text", "lines.*").collect()}
    assert found[0]["text"] == "own 0\n Share this page \nend 0"
    assert all(found[i]["text"] == f"own {i}\nend {i % 3}" and found[i]["n_removed"] == 1 for i in range(1, 12))
    assert found[105]["text"] == "copied\ntext" and found[201]["text"] is None
    assert found[200]["text"] == "" and found[200]["emptied"]
    lines = spark.createDataFrame([(f"k{n}", f"s{s}") for n in range(1, 40) for s in range(n)] * 2, "key string, site string")
    assert {r["key"] for r in line_dedup.boilerplate(lines, 10).collect()} == {f"k{n}" for n in range(10, 40)}


def licences_of(w):
    """Labels and best containment of the licence windows of a list of words, by plain enumeration."""
    best, labels = 0.0, set()
    for name, (label, notice) in license_scan.TEMPLATES.items():
        listed = [x.decode() for x in license_scan.words_of(notice)]
        needed, barred = map(set, license_scan.TELLING[name])
        for i in range(len(w)):
            block = set(w[i:i + len(listed)])
            share = Fraction(len(block & set(listed)), len(set(listed)))
            if w[i] in listed and share >= license_scan.MIN_CONTAINMENT and needed <= block and not barred & block:
                labels.add(label)
                best = max(best, float(share))
    return labels, best


def test_licences_against_plain_python(odd_docs, no_docs):
    got = license_scan.license_scan(odd_docs).select("document.text", "license.*").collect()
    for r in got:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r["text"]))
        places = [(i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
        labels, best = licences_of(w)
        labels |= {label for _, label in places}
        assert (r["n_words"], r["n_base"], r["labels"], r["score"]) == (len(w), len(places), ",".join(sorted(labels)), best)
    assert license_scan.license_scan(no_docs).count() == 0


def test_labels_of_other_licences_are_not_given(spark):
    notices = {
        "Released under the BSD License.": "", "Licensed under the GNU General Public License, version 2.": "gpl", "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc-4.0",
        "Licensed under CC BY-ND 4.0.": "cc-by", "Licensed under CC BY-NC-SA 4.0.": "cc-by", "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0", "Released under the MIT License.": "mit",
        "Licensed under the Apache License, Version 1.1.": "apache", "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
        "released " + "x " * 400 + "under " + "x " * 400 + "the " + "x " * 400 + "mit " + "x " * 400 + "license": "",
        "Licensed under Creative Commons Attribution-ShareAlike 4.0 International.": "",
    }
    docs = spark.createDataFrame(list(enumerate(notices)), "doc_id bigint, text string")
    found = license_scan.license_scan(docs).select("document.text", "license.labels").collect()
    assert {r["text"]: r["labels"] for r in found} == notices


def shares_of_sample(cells, by):
    kept = cells["share"] * cells["probability"]
    return (kept.groupby(cells[by]).sum() / kept.sum()).to_dict(), kept.sum()


def test_sample_meets_its_marginals(spark, odd_docs, no_docs):
    cells = spark.createDataFrame([(s, l, t, 10 * i + 7) for i, (s, l, t) in enumerate((s, l, t) for s in "xyz" for l in ("en", "de", "zz") for t in ("prose", "long"))],
                                  "source string, lang string, topic string, tokens bigint")
    raked, keep = mixing.rake(cells, 0.2)  # every target can be met at this size
    raked = raked.toPandas()
    assert keep == 0.2 and raked["probability"].between(0, 1).all()
    for by, wanted in (("lang", {"en": 0.5, "de": 0.2, "zz": raked.groupby("lang")["share"].sum()["zz"]}), ("topic", {"prose": 0.5, "long": 0.25})):
        found, kept = shares_of_sample(raked, by)
        assert abs(kept - 0.2) < 0.002
        for value, share in found.items():
            assert abs(share - wanted[value] / sum(wanted.values())) < 0.01 * share
    mixed = mixing.mix(odd_docs).select("document.text", "mix.*").collect()
    assert len(mixed) == odd_docs.count() and all(r["tokens"] == len(words(r["text"])) for r in mixed)
    assert not any(r["sampled"] for r in mixed if r["tokens"] == 0)
    assert mixing.mix(no_docs).count() == 0


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_sample_of_documents_meets_what_its_tokens_allow(spark, folder):
    rows = mixing.mix(spark.read.parquet(f"{folder}/documents.parquet")).select("mix.*").groupBy("source", "lang", "topic", "probability", "kept_share").agg(
        F.sum("tokens").alias("tokens"), F.sum(F.when(F.col("sampled"), F.col("tokens")).otherwise(0)).alias("drawn")).toPandas()
    rows["share"] = rows["tokens"] / rows["tokens"].sum()
    keep = rows["kept_share"][0]
    assert 0.5 <= keep <= mixing.KEEP
    for by in ("lang", "topic"):
        own, wanted = rows.groupby(by)["share"].sum(), mixing.TARGETS[by]
        cap = own / mixing.KEEP
        goal = own * 0
        for _ in range(20):  # plain water-filling
            full = {v for v in own.index if goal[v] >= cap[v] - 1e-12}
            rest = sum(wanted[v] for v in own.index if v not in full)
            goal = own.index.to_series().map(lambda v: cap[v] if v in full else min(cap[v], (1 - cap[list(full)].sum()) * wanted[v] / rest))
        found, kept = shares_of_sample(rows, by)
        assert abs(kept - keep) < 0.01 * keep
        assert all(abs(found[v] - goal[v]) <= max(0.011 * goal[v], 0.0011) for v in found)
        drawn = rows.groupby(by)["drawn"].sum() / rows["drawn"].sum()
        assert all(abs(drawn[v] - found[v]) < 0.05 for v in found)


def components_of(sets, percent=85):
    names = list(range(len(sets)))

    def root(i):
        while names[i] != i:
            i = names[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                names[root(i)] = root(j)
    return [root(i) for i in range(len(sets))]


def near_copies(rng, count):
    """Families around an original, each with a second family around one of its far copies, chains of small steps and strangers."""
    vocabulary = [f"w{i}" for i in range(4000)]
    docs = []
    for _ in range(4):
        original = list(rng.choice(vocabulary, 90))
        docs.append(original)
        for _ in range(count):
            copy = list(original)
            for at in rng.integers(0, 90, int(rng.integers(1, 5))):
                copy[at] = rng.choice(vocabulary)
            docs.append(copy)
        far = list(original)
        for at in (10, 30, 50, 70):
            far[at] = rng.choice(vocabulary)
        for _ in range(count // 2):
            copy = list(far)
            copy[rng.integers(0, 90)] = rng.choice(vocabulary)
            docs.append(copy)
    chain = list(rng.choice(vocabulary, 120))
    for step in range(count):
        chain = list(chain)
        chain[(step * 17) % 120] = rng.choice(vocabulary)
        docs.append(chain)
    return [" ".join(d) for d in docs] + [" ".join(rng.choice(vocabulary, 50)) for _ in range(count)]


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    texts = near_copies(np.random.default_rng(8), 25)
    texts += texts[:5] + [None, "", "a b", "A B", "a b c"]
    root = components_of([shingles(t) for t in texts])
    lowest = {r: min(i for i in range(len(texts)) if root[i] == r) for r in set(root)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for wide in (minhash_dedup.WIDE_BUCKET, 0):  # the second settles every bucket by changes from its hub
        monkeypatch.setattr(minhash_dedup, "WIDE_BUCKET", wide)
        found = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(docs).collect()}
        assert [found[i]["component_id"] for i in range(len(texts))] == [lowest[r] for r in root]
        assert [found[i]["n_shingles"] for i in range(len(texts))] == [len(shingles(t)) for t in texts]


def test_changes_are_cut_to_prefixes_in_the_tasks(spark):
    rng = np.random.default_rng(3)
    common, sets = rng.integers(-2**62, 2**62, 12), {}
    for i in range(40):  # 10 changes that no other set has, and up to twelve that some have
        sets[bytes([i] * 16)] = (bytes([i % 2] * 8 + [9] * 8), 40 + i, [*rng.integers(-2**62, 2**62, 10).tolist(), *common[:1 + i % 12].tolist()])
    found = spark.createDataFrame(
        [(node, hub, node, size, 2 * size, changes, len(changes), False) for node, (hub, size, changes) in sets.items()],
        "node binary, hub binary, component binary, size bigint, both bigint, changes array<bigint>, n int, near boolean").repartition(5)
    prefixes = minhash_dedup._prefixes(found, 80).collect()
    often = {(h, c): sum(h == hub and c in changes for hub, _, changes in sets.values()) for h, _, own in sets.values() for c in own}
    wanted = set()
    for node, (hub, size, changes) in sets.items():
        ordered = sorted(changes, key=lambda c: (often[hub, c], c % 2**64))
        wanted |= {(hub, node, c, place) for place, c in enumerate(ordered) if 80 * place <= 20 * size and often[hub, c] > 1}
    assert {(bytes(r["hub"]), bytes(r["node"]), r["change"], r["place"]) for r in prefixes} == wanted and len(prefixes) == len(wanted)
    assert len(prefixes) < sum(len(changes) for *_, changes in sets.values()) / 2


def test_few_counters_lose_no_link(spark, monkeypatch):
    texts = near_copies(np.random.default_rng(8), 25)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    monkeypatch.setattr(minhash_dedup, "WIDE_BUCKET", 0)
    found = minhash_dedup.near_duplicates(docs).select("doc_id", "component_id").orderBy("doc_id").collect()
    monkeypatch.setattr(minhash_dedup, "COUNTERS", 8)
    monkeypatch.setattr(minhash_dedup, "SLICE", 4)
    assert minhash_dedup.near_duplicates(docs).select("doc_id", "component_id").orderBy("doc_id").collect() == found


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = minhash_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert minhash_dedup.near_duplicates(no_docs).count() == 0
    kept = minhash_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [r["text"] for r in kept.collect()]
    assert sum(bool(words(t)) for t in texts) == len({r["component"] for r in rows if r["component"]})
    assert sum(not words(t) for t in texts) == sum(not words(r["text"]) for r in odd_docs.collect())


def test_odd_sketch_estimates():
    rng = np.random.default_rng(3)
    for common in (0.95, 0.85, 0.7):
        n = 2000
        both = rng.integers(0, 1 << 63, n, np.uint64)
        k = int(n * 2 * common / (1 + common))
        sets = [np.sort(both), np.sort(np.concatenate([both[:k], rng.integers(0, 1 << 63, n - k, np.uint64)]))]
        sketches = minhash_dedup.odd_sketches(minhash_dedup.samples(np.concatenate(sets), np.array([0, n, 2 * n]))).view(np.uint64)
        odd = int(np.bitwise_count(sketches[0] ^ sketches[1]).sum())
        guess = 1 + minhash_dedup.SKETCH_BITS / 2 * np.log(max(1 - 2 * odd / minhash_dedup.SKETCH_BITS, 1e-9)) / (2 * minhash_dedup.SAMPLES)
        assert abs(guess - common) < 0.15


def test_components_of_a_long_chain_and_a_star(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)], "a int, b int")
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[i] == 100 for i in range(100, 150))


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 24))
    near = np.concatenate([centres[i % 20][None] + rng.normal(size=(1, 24)) * rng.choice([0.05, 0.2, 0.3]) for i in range(260)])
    rows = [v.tolist() for v in np.concatenate([near, near[:3], rng.normal(size=(50, 24))])]
    unit = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    odd = [None, [], [0.0] * 24, [1.0, None] * 12, [float("nan")] * 24, [1e200] * 24, rows[0][:8]]
    data = [(i, v, 1) for i, v in enumerate(rows + odd)]
    found = {r["vec_id"]: r for r in embedding_dedup.near_vectors(spark.createDataFrame(data, "vec_id bigint, embedding array<double>, node int")).collect()}
    wanted = linked.sum(axis=1) - 1
    got = np.array([found[i]["n_links"] for i in range(len(rows))])
    assert (got <= wanted).all() and got.sum() >= 0.9 * wanted.sum()
    assert all(found[i]["n_links"] == 0 and found[i]["component_id"] == i for i in range(len(rows), len(data)))
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_hilbert_curve_visits_neighbours():
    bits, axes = 3, 3
    grid = np.array(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij")).reshape(axes, -1)
    index = hilbert_sharding.hilbert_index(list(grid), bits)
    assert sorted(index.tolist()) == list(range(1 << bits * axes))
    path = grid[:, np.argsort(index)]
    assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def test_shards_of_odd_rows(odd_docs, no_docs, tmp_path):
    clashing = odd_docs.withColumns({c: F.lit(c) for c in ("shard", "slot", "hilbert", "tie", "rn", "size", "placement")})
    found = hilbert_sharding.shard(clashing)
    assert found.select("document.*").columns == clashing.columns and found.where("document.slot <> 'slot'").count() == 0
    rows = found.select("document.text", "placement.*").collect()
    count = Counter(r["shard"] for r in rows)
    assert len(rows) == odd_docs.count() and max(count.values()) - min(count.values()) <= 1 and len(count) == 8
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in count.items())
    assert all(r["size"] == len((r["text"] or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((r["text"] or "").encode()) for r in rows)
    assert hilbert_sharding.shard(no_docs).count() == 0
    few = hilbert_sharding.shard(odd_docs.limit(3)).select("placement.*").collect()
    assert len({r["shard"] for r in few}) == 3 and {r["slot"] for r in few} == {0}
    hilbert_sharding.write_shards(odd_docs, f"{tmp_path}/shards")
    back = odd_docs.sparkSession.read.parquet(f"{tmp_path}/shards")
    assert back.count() == odd_docs.count() and back.select("shard").distinct().count() == 8


def test_curve_against_plain_python_with_long_common_beginnings(spark):
    rng = np.random.default_rng(9)
    rows = [(i, f"https://www.example.org/a/very/long/path/{rng.integers(0, 40):02d}", ["en", "de", None][i % 3], "x" * int(rng.integers(0, 200))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string").repartition(4)
    bits, names = 3, ("source", "lang", "size", "doc_id")
    got = {r["doc_id"]: r["hilbert"] for r in hilbert_sharding.shard(docs, bits=bits).select("document.doc_id", "placement.hilbert").collect()}

    def coordinates(values, text):
        some = sorted(v for v in values if v is not None)
        if text:  # a value starts where its first row stands
            return [0 if v is None else some.index(v) * (1 << bits) // len(some) for v in values]
        cuts = sorted({some[max(-(-len(some) * k // (1 << bits)) - 1, 0)] for k in range(1, 1 << bits)})
        return [sum(c <= v for c in cuts) for v in values]

    columns = [[r[1] for r in rows], [r[2] for r in rows], [len(r[3]) + 1 for r in rows], [r[0] for r in rows]]
    wanted = hilbert_sharding.hilbert_index([np.array(coordinates(c, n in ("source", "lang"))) for c, n in zip(columns, names)], bits)
    assert got == dict(zip((r[0] for r in rows), wanted.tolist()))
    assert len({w >> 9 for w in wanted.tolist()}) > 1 and len(set(coordinates(columns[0], True))) == 1 << bits


def test_packing_round_trip(odd_docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    docs = odd_docs.withColumn("doc_id", F.monotonically_increasing_id())
    rows = packing.pack(docs, with_ids=True).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    for d in docs.collect():
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [packing.END_ID]
        own = sorted(pieces[d["doc_id"]], key=lambda r: r["piece"])
        assert [i for r in own for i in r["ids"]] == ids
        assert [r["start"] for r in own] == list(range(0, len(ids), packing.CAPACITY))
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) for r in own)
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0] + [n for _, n in own])[:-1].tolist() and sum(n for _, n in own) <= packing.CAPACITY
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("seed,count", [(1, 40), (2, 3000), (3, 20_000)])
def test_plan_is_near_the_lower_bound(seed, count):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(6, 1.2, count).astype(int) + 1, packing.CAPACITY)
    plan = packing.Plan(*np.unique(lengths, return_counts=True))
    ranked = np.sort(lengths)[::-1]
    gaps = np.full(plan.bins, packing.CAPACITY)
    seen = np.zeros(count, int)
    seen[:plan.full] += 1
    for first, n, start, share in plan.slots:
        np.subtract.at(gaps, start + np.arange(n) // share, ranked[first:first + n])
        seen[first:first + n] += 1
    rows, used = plan.best_fit(*np.unique(gaps, return_counts=True))
    fill = np.concatenate([np.sort(gaps), np.full(used - plan.bins, packing.CAPACITY)])
    for first, n, place in rows:
        fill[place:place + n] -= ranked[first:first + n]
        seen[first:first + n] += 1
    assert (fill >= 0).all() and (seen == 1).all()
    assert plan.full + used <= 1.03 * -(-int(lengths.sum()) // packing.CAPACITY) + 1


def test_encoder_equals_the_tokenizer():
    import public_tokenizers

    encoder = packing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    texts = ["", "don't I'm 5's", "a<|endoftext|>b", "İstanbul ÀÉÖ ×÷ ¼²", "  x  ", "٣١ 文字 ok", "ab12cd--!!é.e", "ÀÖØÞ ǅx ŉ", "A\x0bB\x1cC D­E", "_a_ __ ~~~", None]
    for text, ids in zip(texts, encoder.encode(pa.array(texts))):
        assert ids.tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_toxicity_finds_held_out_abuse(spark, odd_docs, no_docs, labels, no_labels):
    rng = np.random.default_rng(6)
    clean = [f"w{i}" for i in range(500)]
    slang = [f"grumf{e}" for e in ("a", "o", "en", "ix", "ur")]
    rows, own = [], []
    for i in range(900):
        text = list(rng.choice(clean, 40))
        bad = i % 5 == 0
        if bad:
            for at in rng.integers(0, 40, 3):
                text[at] = rng.choice([*slang, "idiot", "scum"])
        rows.append((i, " ".join(text)))
        own.append((i, int(bad)))
    docs, truth = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(own, "doc_id bigint, toxic int")
    found = toxicity.toxicity(docs, truth).select("document.doc_id", "toxicity.*").join(truth, "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert held and sum(r["predicted"] != r["toxic"] for r in held) <= 0.03 * len(held)
    assert len(toxicity.toxicity(odd_docs, labels).collect()) == odd_docs.count()
    assert all(r["score"] == 0 for r in toxicity.toxicity(odd_docs, no_labels).select("toxicity.score").collect())
    assert toxicity.toxicity(no_docs, labels).count() == 0


def test_label_model_discounts_repeated_voters_and_keeps_the_balance():
    rng = np.random.default_rng(9)
    y = rng.random(4000) < 0.3
    vote = lambda yes, no: (rng.random(4000) < np.where(y, yes, no)).astype(float)
    copied = vote(0.4, 0.1)
    votes = np.stack([vote(0.5, 0.05), vote(0.5, 0.05), copied, copied, copied, vote(0.2, 0.2)], axis=1)
    given = np.where(rng.random(4000) < 0.1, ~y, y)  # one label in ten is wrong
    posterior, model = toxicity.label_model(votes, given)
    assert abs(posterior.mean() - given.mean()) < 1e-3
    assert ((posterior > 0.5) == y).mean() >= (given == y).mean()
    assert posterior[given & y].mean() > posterior[given & ~y].mean() + 0.05
    assert 0.75 < model.given[0] <= 0.995 and 0.005 <= model.given[1] < 0.15
    assert (np.abs(model.correlation[2:5, 2:5] + np.eye(3) - 1) < 0.05).all()
    assert abs(model.toxic[0] - 0.5) < 0.12 and abs(model.other[0] - 0.05) < 0.05
    row = lambda *voters: model.posterior(np.vstack([np.eye(6)[list(voters)].sum(axis=0), np.zeros((999, 6))]), np.zeros(1000))[0]
    assert row(0) > row(2) and row(2, 3, 4) < row(0, 1) and abs(row(5) - row()) < 0.02
    assert row(0) > row()  # an abstention is no vote against


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, own = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    found = toxicity.toxicity(docs.select("doc_id", "text"), own).select("document.doc_id", "toxicity.*").join(own, "doc_id").where("held_out AND toxic IS NOT NULL").toPandas()
    y, score = found["toxic"].to_numpy() > 0, found["score"].to_numpy()
    rank = found["score"].rank().to_numpy()
    area = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert area >= 0.95 and (score[y] >= 0.5).mean() >= 0.75 and (score[~y] >= 0.5).mean() <= 0.01


@pytest.mark.parametrize("wrap", [72, 20])
def test_wrapped_licence_notices(spark, wrap):
    import textwrap

    templates = license_scan.TEMPLATES
    rows, wanted = [], {}
    for i, (name, (label, text)) in enumerate(templates.items()):
        for k, (mark, lead) in enumerate([("", ""), ("# ", "zz " * 9), (" * ", "zz " * 11)]):
            lines = "\n".join(mark + x for x in textwrap.wrap(lead + text + " and so on", wrap))
            rows.append((10 * i + k, f"before\n\n{lines}\n\nafter"))
            wanted[10 * i + k] = (name, label)
    far = "permission is hereby granted free of charge to any person" + "\nzz zz zz zz" * 4 + "\nobtaining a copy of this software and associated documentation files"
    rows += [(1000, far), (1001, "Permission is hereby granted, free of charge, to any person"), (1002, "obtaining a copy of this software and associated documentation files")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = {r["doc_id"]: r for r in license_scan.license_scan(docs).select("document.doc_id", "license.*").collect()}
    for i, (name, label) in wanted.items():
        assert label in found[i]["labels"].split(",") and found[i]["score"] == 1.0
        assert any(b["template"] == name and b["containment"] == 1.0 for b in found[i]["blocks"])
    assert all(found[i]["labels"] == "" and found[i]["score"] == 0 for i in (1000, 1001, 1002))


def test_licence_windows_against_plain_python():
    rng = np.random.default_rng(2)
    scanner = license_scan.Scanner(license_scan.TEMPLATES, license_scan.PHRASES)
    vocabulary = [w.decode() for w in license_scan.words_of(license_scan.TEMPLATES["mit_grant"][1] + " " + license_scan.TEMPLATES["mit_notice"][1])]
    texts = []
    for _ in range(150):
        own = list(rng.choice(vocabulary, 60))
        for at in rng.integers(0, 30, 2):
            own[at:at + 20] = license_scan.TEMPLATES["mit_grant"][1].lower().replace(",", "").split()
        texts.append("".join(w + ("\n" if rng.random() < 0.15 else " ") for w in own))
    frequency = rng.permutation(len(scanner.words))
    rows = license_scan.Matcher(scanner, frequency, license_scan.MIN_CONTAINMENT).scan(pa.array(texts)).to_pylist()
    for text, row in zip(texts, rows):
        labels, best = licences_of(text.split())
        labels |= {x for x in row["base_labels"].split(",") if x}
        assert (row["labels"], row["score"]) == (",".join(sorted(labels)), best)


def test_ordinal_fit_against_plain_maximum_likelihood():
    """The same penalised likelihood over a dense design, climbed by plain gradient steps with numerical slopes."""
    from patronscope.llm.fitting import Rows

    rng = np.random.default_rng(21)
    count, width, levels, ridge = 400, 3, 4, 1e-2
    dense = rng.normal(size=(count, width)) * (rng.random((count, width)) < 0.7)
    grade = np.searchsorted([-1.0, 0.2, 1.1], dense @ [1.5, -1.0, 0.0] + rng.logistic(size=count))
    at = np.nonzero(dense)
    model = ordinal_quality.fit(Rows(np.bincount(at[0], minlength=count), at[1], dense[at], width), grade, levels, ridge)

    def loss(w, cuts):
        tails = 1 / (1 + np.exp(-((dense @ w)[:, None] - cuts)))
        bounds = np.concatenate([np.ones((count, 1)), tails, np.zeros((count, 1))], axis=1)
        return -np.log(bounds[np.arange(count), grade] - bounds[np.arange(count), grade + 1]).mean() + ridge * (w @ w) / 2

    x = np.concatenate([np.zeros(width), [-1.0, 0.0, 1.0]])
    for _ in range(1500):
        slope = np.array([(loss(*np.split(x + e, [width])) - loss(*np.split(x - e, [width]))) / 2e-5 for e in np.eye(len(x)) * 1e-5])
        x -= 2.0 * slope
    assert np.allclose(model.weights, x[:width], atol=2e-3) and np.allclose(model.thresholds, x[width:], atol=2e-3)


def test_raking_joins_by_whole_numbers(spark, monkeypatch):
    cells = spark.createDataFrame([("a", "en", "prose", 70), ("a", "de", "long", 20), ("b", "fr", "prose", 10), ("c", "es", "short", 0)],
                                  "source string, lang string, topic string, tokens long")
    plans, whole = [], mixing.staged

    def staged(df, label):
        if label == "cells":
            plans.append([x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x])
        return whole(df, label)

    monkeypatch.setattr(mixing, "staged", staged)
    raked, _ = mixing.rake(cells)
    assert plans and all(len(joins) == 1 and "_id#" in joins[0] for joins in plans)
    found = {(r["source"], r["lang"]): r["probability"] for r in raked.collect()}
    assert len(found) == 4 and found["c", "es"] == 0 and all(0 < p <= 1 for key, p in found.items() if key != ("c", "es"))
