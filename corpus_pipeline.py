"""A training-data pipeline: quality rules, line dedup, near-duplicate removal, source mixing, packing.

Every stage takes all rows its predecessor kept and, but for the last, returns the columns of documents. Repeated rows
and null ids pass as rows of their own until the near-duplicate stage keeps one row of each group; a table without rows
stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronscope.llm import line_dedup, minhash_dedup, mixing, packing, quality_rules

#: Near-copies share this percentage of their five-word shingles (intersection by union) or more.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    judged = quality_rules.quality_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.where("quality.kept").select("document.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines; one that had only such lines goes."""
    return line_dedup.line_dedup(docs).where(~F.col("lines.emptied")).select("document.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: the one with the smallest doc_id."""
    return minhash_dedup.keep_one(docs, NEAR_PERCENT)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents sampled towards the target weights."""
    return mixing.mix(docs).where("mix.sampled").select("document.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every token in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("minhash_dedup", near_duplicate_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: The classifier of the first stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    from patronscope.llm.staging import staged

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
