"""Tables written to the shared folder to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, below one folder for each application."""
    return f"{shared_dir(spark)}/patronscope-llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the folder of ``spark.checkpoint.dir`` and read it back.

    Later jobs start from the files: a lost executor costs a re-read, not the work before. The folder is the cluster's
    to clean; names are unique, so nothing is overwritten.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
