"""The corpus pipeline: every stage on odd rows and empty tables, and its chain on the smallest tables."""

import pytest
from odd_rows import FOLDER, no_docs, odd_docs  # noqa: F401  fixtures
from pyspark.sql import functions as F

import corpus_pipeline
from patronscope.llm import line_dedup, mixing, quality_rules

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stage_on_odd_rows_and_empty_tables(spark, odd_docs, no_docs, stage):
    function = dict(corpus_pipeline.STAGES)[stage]
    last = stage == corpus_pipeline.STAGES[-1][0]
    found = function(spark, odd_docs, FOLDER)
    assert found.count() > 0
    assert last or found.columns == odd_docs.columns
    assert function(spark, no_docs, FOLDER).count() == 0


def test_chain_follows_each_stage(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, FOLDER).cache()
    verdicts = quality_rules.quality_rules(docs, labels)
    assert sorted(r[0] for r in good.select("doc_id").collect()) == sorted(
        r[0] for r in verdicts.where("quality.kept").select("document.doc_id").collect())

    cleaned = stages["line_dedup"](spark, good, FOLDER).cache()
    assert cleaned.columns == COLUMNS and cleaned.where("n_chars <> char_length(text)").count() == 0
    sites = good.select("text", "source", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.btrim("line"))
    common = {r["line"] for r in sites.groupBy("line").agg(F.count_distinct("source").alias("n"), F.count_distinct("text").alias("texts")).where(
        f"n >= {line_dedup.MIN_SITES} AND texts > 1 AND line <> ''").collect()}
    left = cleaned.select("text").distinct().select(F.explode(F.split("text", "\n")).alias("line")).where(F.btrim("line").isin(*common)) if common else cleaned.limit(0)
    assert left.select(F.btrim(left.columns[0])).distinct().count() == left.count()  # each once, in the text that keeps it

    single = stages["minhash_dedup"](spark, cleaned, FOLDER).cache()
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    from test_operators import components_of, shingles
    ids = sorted(texts)
    root = components_of([shingles(texts[i]) for i in ids], corpus_pipeline.NEAR_PERCENT)
    wanted = sorted({min(ids[k] for k in range(len(ids)) if root[k] == r) for r in set(root)})
    assert sorted(r["doc_id"] for r in single.select("doc_id").collect()) == wanted

    mixed = stages["source_mixing"](spark, single, FOLDER).cache()
    assert mixed.count() == mixing.mix(single).where("mix.sampled").count()
    packed = stages["best_fit_packing"](spark, mixed, FOLDER)
    assert packed.select("doc_id").distinct().count() == mixed.count()
    assert corpus_pipeline.run(spark, FOLDER).count() == packed.count()


def test_near_duplicate_stage_against_all_pairs_at_80(spark):
    import numpy as np
    from test_operators import components_of, near_copies, shingles

    rng = np.random.default_rng(12)
    texts = near_copies(rng, 12)
    for i in range(30):  # pairs from 0.80 to below 0.85, of which one at 0.85 keeps both
        size = 70 + i
        first = [f"p{i}x{k}" for k in range(size)]
        changed = next(n for n in range(5, size) if 100 * (size - 4 - n) < 85 * (size - 4 + n))
        texts += [" ".join(first), " ".join(first[:size - changed] + [f"q{i}x{k}" for k in range(changed)])]
    sets = [shingles(t) for t in texts]
    keep = lambda percent: [i for i, r in enumerate(components_of(sets, percent)) if i == min(
        j for j, s in enumerate(components_of(sets, percent)) if s == r)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, FOLDER).select("doc_id").collect())
    assert found == keep(80) and len(keep(85)) >= len(keep(80)) + 30


def test_line_stage_counts_the_sites_of_all_copies(spark):
    # Four texts, each copied to four sites of its own and to s00, which sorts first; one text alone on twelve sites.
    rows = [(10 * t + k, f"own {t}\nShare this page", "en", site, 1) for t in range(4) for k, site in enumerate(["s00"] + [f"s{t}{n}x" for n in range(4)])]
    rows += [(100 + i, "copied\ntext", "en", f"s{i}", 1) for i in range(12)]
    rows += [(200 + i, f"few {i % 3}\nnine sites", "en", f"n{i}", 1) for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = {r["doc_id"]: r for r in corpus_pipeline.line_stage(spark, docs, FOLDER).collect()}
    assert len(found) == len(rows)
    assert all(found[10 * t + k]["text"] == f"own {t}" + ("\nShare this page" if t == 0 else "") for t in range(4) for k in range(5))
    assert all(found[100 + i]["text"] == "copied\ntext" for i in range(12))
    assert all(found[200 + i]["text"] == f"few {i % 3}\nnine sites" for i in range(9))
    plain = line_dedup.line_dedup(docs).where("document.doc_id BETWEEN 10 AND 39").select("lines.*").collect()
    assert all((r["n_lines"], r["n_removed"]) == (2, 1) for r in plain)


def test_near_duplicate_stage_keeps_a_defined_row_of_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "en", s, 1) for s in ("c", "a", "b")] + [(2, text + " more", "de", "z", 2), (3, "", "en", "q", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for parts in (1, 5):
        found = corpus_pipeline.near_duplicate_stage(spark, docs.repartition(parts), FOLDER).collect()
        assert sorted((r["doc_id"], r["source"]) for r in found) == [(1, "a"), (3, "q")]
