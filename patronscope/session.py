"""Session settings used by tests, the benchmark and stand-alone jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: list[tempfile.TemporaryDirectory] = []


def build_session(app: str = "patronscope", master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session with adaptive execution and a UTC clock.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` so that one shuffle partition stays near
    128-256 MB (a few thousand for a multi-terabyte exchange); adaptive execution merges what turns out small.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording a Python call site for every column expression is the largest driver cost of building a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it then gets a temporary folder that is removed at exit. A
    cluster session without it is refused, because executors cannot see the driver's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _local_dirs:
        _local_dirs.append(tempfile.TemporaryDirectory(prefix="patronscope-"))
    return _local_dirs[0].name


def enable_checkpoints(spark: SparkSession) -> None:
    """Give ``DataFrame.checkpoint`` a place to write, without replacing one that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def written(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back, for loops that join a table to what it became.

    A checkpoint keeps the constraints and the guessed size of the plan it ends. Both multiply where the table is joined to
    itself, until planning a round outgrows the driver. A table read back has neither.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/patronscope/{spark.sparkContext.applicationId}/rounds/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
