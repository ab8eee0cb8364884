"""The registered queries of the subpackage, each applying its operator to a whole table, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (embedding_dedup, hilbert_sharding, license_scan, line_dedup, minhash_dedup, mixing, ordinal_quality, packing,
               periodic_runs as periods, quality_rules as rules, token_alignment, toxicity, warc_bundles as warc)
from .staging import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's lines, removed lines and the checksum of its cleaned text."""
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("document.doc_id", "lines.n_lines", "lines.n_removed", F.md5("document.text").alias("text_md5"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts for each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.quality_rules(docs, table(spark, sf_dir, "labels")).select("document.doc_id", "quality.*")


def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and selection of each document."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return ordinal_quality.ordinal_quality(docs, ordinal_quality.grades(labels)).select("document.doc_id", "grade.*")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places, labels and best containment of each document."""
    return license_scan.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("document.doc_id", "license.*").drop("blocks")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampling probability and decision of each document."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")).select("document.doc_id", "mix.*")


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-copies of each document."""
    found = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 85)
    return found.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of each vector."""
    found = embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of each document along the curve, by the law of equal counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return hilbert_sharding.shard(docs, carry=("doc_id",)).select(
        "document.doc_id", "placement.size", "placement.text_crc32", F.lit("rows").alias("law"), "placement.shard", "placement.slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each piece of a document in a sequence."""
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels")).select("document.doc_id", "toxicity.*")


def op11_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of each page, as read back from the archives."""
    path = fresh_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.read_records(spark, path, payloads=False)
    return records.select(warc.page_id("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          warc.page_id("refers_to").alias("refers_to"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two tokenizers meet in each document, and how usual its pairs are in the corpus."""
    found = token_alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text")).documents
    return found.select("document.doc_id", "alignment.*")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of each document, with every tenth document made to repeat itself first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", periods.planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periods.periodic_runs(docs).select("document.doc_id", "periodic.*")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r.alias("run"))))["run"]
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("1000 * longest.length DIV longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_line_dedup, op2_quality_rules, op3_ordinal_quality, op4_license_scan, op5_source_mixing, op6_minhash_dedup,
             op7_embedding_dedup, op8_hilbert_sharding, op9_best_fit_packing, op10_toxicity, op11_warc_bundles, op12_token_alignment, op13_periodic_runs)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE_SQL, "op4_license_scan": license_scan.oracle_sql(),
            "op5_source_mixing": mixing.oracle_sql(), "op11_warc_bundles": warc.oracle_sql()}
