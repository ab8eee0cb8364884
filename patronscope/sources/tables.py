"""Staging tables, named sinks and ad-hoc SQL."""

from __future__ import annotations

import hashlib
from itertools import count
from weakref import WeakValueDictionary

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir
from .transactions import CSV_OPTIONS

#: The stages in use, by their folders.
_stages: "WeakValueDictionary[str, Stage]" = WeakValueDictionary()


class Stage:
    """Parquet stage tables in the cluster's shared folder.

    A stage table cuts lineage at a pipeline boundary: lost executors re-read it instead of recomputing, later scans
    prune columns and push filters into it, and its size on disk is what Spark's broadcast decision is checked against.
    A second stage of the same label has a folder of its own while the first is in use.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        digest = hashlib.sha256(label.encode()).hexdigest()[:12]
        root = f"{shared_dir(spark)}/patronscope/{spark.sparkContext.applicationId}/{digest}"
        self.root = next(path for n in count() if (path := f"{root}-{n}" if n else root) not in _stages)
        _stages[self.root] = self
        self._tables: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str, build) -> DataFrame:
        """Read a stage table, writing it on first use."""
        if name not in self._tables:
            self._tables[name] = stage_table(build(), self.path(name))
        return self._tables[name]


def stage_table(df: DataFrame, path: str) -> DataFrame:
    """Replace-write a staging table and read it back with the same schema."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_intermediate(spark: SparkSession, *paths: str, schema=None) -> DataFrame:
    """The first stage folder of ``paths`` that exists."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        location = hadoop.Path(path)
        if location.getFileSystem(conf).exists(location):
            return reader.parquet(path)
    raise FileNotFoundError(f"no stage table in {paths}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet",
                 partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Write named results, one directory per table; a re-run replaces what is there."""
    written = {}
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        columns = (partition_by or {}).get(name)
        if columns:
            writer = writer.partitionBy(*columns)
        path = f"{folder}/{name}"
        if fmt == "csv":
            writer.options(**CSV_OPTIONS).csv(path)
        else:
            writer.format(fmt).save(path)
        written[name] = path
    return written


def overwrite_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Idempotent refresh: only the partitions present in ``df`` are replaced.

    The rebalance hint groups rows by partition value for few files, and lets adaptive execution split a value that
    holds far more rows than the others.
    """
    (df.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


def query_views(spark: SparkSession, tables: dict[str, DataFrame], sql: str) -> DataFrame:
    """Ad-hoc SQL over named tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
