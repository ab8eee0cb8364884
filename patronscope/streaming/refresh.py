"""Incremental refresh with Structured Streaming: new invoice files are cleaned and merged into sinks by day.

A sink is a Parquet table partitioned by date (lines by day; daily totals, one row a day, by month), and it is all the state
that lasts: a refresh reads and writes the partitions that it has lines of, however old they are. Nothing is ever too late,
nothing outside these partitions is read or rewritten, and no state grows with the history. Totals are merged batch by batch,
lines once for all batches of a refresh. A batch that is tried again after a failure changes nothing twice.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import amount, units
from ..operators.cleaning import clean_sql_rules
from ..session import enable_checkpoints
from ..sources.tables import overwrite_partitions, read_intermediate, remove
from ..sources.transactions import RAW_SCHEMA

DAY, MONTH = "day", "month"
REVENUE_SCHEMA = f"{DAY} string, lines bigint, units bigint, batch bigint, {MONTH} string"
#: Lines of one day that go to one task; a day with more is dealt to several.
DAY_LINES = 1_000_000


def raw_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def valid_lines(raw: DataFrame) -> DataFrame:
    """Strict cleaning of arriving lines, repeats included, with their day."""
    cleaned = clean_sql_rules(raw.withColumn("invoice_date", F.col("invoice_date").cast("timestamp")))
    return cleaned.withColumn(DAY, F.coalesce(F.date_format("invoice_date", "yyyy-MM-dd"), F.lit("none")))


def _run(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived, batch by batch, then stop."""
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _touched(sink: DataFrame, arrived: DataFrame, by: str) -> DataFrame:
    """The part of a sink that has the dates of a batch; their list prunes partitions before any file is opened."""
    dates = [r[by] for r in arrived.select(by).distinct().collect()]  # one row a date
    return sink.where(F.col(by).isin(dates))


def _lines_by_day(lines: DataFrame) -> Counter:
    return Counter({r[DAY]: r["count"] for r in lines.groupBy(DAY).count().collect()})  # one row a date


def _distinct(lines: DataFrame) -> DataFrame:
    """Each line once, ``stored`` if one of its copies is."""
    return lines.groupBy(*[c for c in lines.columns if c != "stored"]).agg(F.max("stored").alias("stored"))


def _add_lines(lines: DataFrame, path: str) -> None:
    """Add cleaned lines that the sink does not have yet; exact repeats are one line, whenever they come.

    The sink's own days are compared, so lines that were already written are not added again. Lines are dealt by day, once for
    the comparison and the writing: few files, and no day is a bottleneck, as one with very many lines goes to several tasks.
    Its copies, which cannot be parted, meet before that where they are read.
    """
    spark, columns = lines.sparkSession, lines.columns
    lines.limit(0).write.mode("append").partitionBy(DAY).parquet(path)  # the folder exists from the first batch on
    counts = _lines_by_day(lines)
    known = spark.read.schema(lines.schema).parquet(path).where(F.col(DAY).isin(list(counts))).select(columns)
    found, stored = lines.withColumn("stored", F.lit(False)), _lines_by_day(known)
    if stored:
        found = found.unionByName(known.withColumn("stored", F.lit(True)))
    crowded: dict[int, list[str]] = {}
    for day, count in (counts + stored).items():
        if parts := count // DAY_LINES:
            crowded.setdefault(2 ** parts.bit_length(), []).append(day)
    by = [DAY]
    if crowded:
        part, many = F.lit(0), F.col(DAY).isin(sum(crowded.values(), []))
        for parts, days in crowded.items():
            part = F.when(F.col(DAY).isin(days), F.pmod(F.xxhash64(*columns), F.lit(parts))).otherwise(part)
        found = found.where(~many).unionByName(_distinct(found.where(many))).withColumn("part", part)
        by = [DAY, "part"]  # not without need: a constant here would have Spark deal the lines again, by all columns
    fresh = _distinct(found.repartition(*by)).where("NOT stored").select(columns)
    fresh.write.mode("append").partitionBy(DAY).parquet(path)


def merge_lines(arrived: DataFrame, path: str) -> None:
    """Clean ``arrived`` and add the lines that the sink does not have yet."""
    fresh = valid_lines(arrived).persist()
    try:
        _add_lines(fresh, path)
    finally:
        fresh.unpersist()


def refresh_lines(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Clean what has arrived and keep each distinct line once, in a sink by day.

    A batch puts its cleaned lines aside under its number, so one that is tried again replaces itself. What is aside meets the
    sink once, after the last batch: work grows with the lines, and not with the batches times the sink. After a failure
    it waits for the next refresh.
    """
    spark, aside, form = stream.sparkSession, f"{checkpoint}/arrived", valid_lines(stream)
    query = _run(stream, lambda batch, number: valid_lines(batch).write.mode("overwrite").parquet(f"{aside}/number={number}"), checkpoint)
    try:
        lines = read_intermediate(spark, aside, schema=form.schema)
    except FileNotFoundError:  # nothing has arrived
        return query
    _add_lines(lines.select(form.columns), path)
    remove(spark, aside)
    return query


def merge_revenue(arrived: DataFrame, batch: int, path: str) -> None:
    """Add a batch's lines and revenue to the totals of its days, once.

    Each day's row names the last batch that it holds. Months are replaced one by one, so after a failure some days may hold
    the batch and others not; a repeated batch adds to the latter only. A sink belongs to one checkpoint, which numbers its
    batches.
    """
    spark = arrived.sparkSession
    enable_checkpoints(spark)
    added = valid_lines(arrived).groupBy(DAY).agg(F.count(F.lit(1)).alias("new_lines"), F.sum(units("total_amount")).alias("new_units")).withColumn(
        MONTH, F.substring(DAY, 1, 7)).persist()
    try:
        empty = spark.createDataFrame([], REVENUE_SCHEMA)
        empty.write.mode("append").partitionBy(MONTH).parquet(path)  # the folder exists from the first batch on
        known = _touched(spark.read.schema(REVENUE_SCHEMA).parquet(path), added, MONTH)
        # Days of a touched month that the batch has no lines of, or that hold it already, stay as they are.
        due = F.col("new_lines").isNotNull() & (F.coalesce(F.col("batch"), F.lit(-1)) < batch)
        total = lambda c: (F.coalesce(c, F.lit(0)) + F.when(due, F.col(f"new_{c}")).otherwise(0)).alias(c)
        merged = known.join(added, [DAY, MONTH], "full").select(
            DAY, total("lines"), total("units"), F.when(due, batch).otherwise(F.col("batch")).cast("bigint").alias("batch"), MONTH)
        # One row a day, cut off from the files that the next step replaces.
        overwrite_partitions(merged.checkpoint(), path, [MONTH])
    finally:
        added.unpersist()


def refresh_revenue(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep lines and revenue of every day up to date, repeats included; only months with arriving lines are touched."""
    return _run(stream, lambda batch, number: merge_revenue(batch, number, path), checkpoint)


def daily_revenue(spark: SparkSession, path: str) -> DataFrame:
    """Lines and revenue of every day in the sink of ``refresh_revenue``: one stored row a day, nothing is aggregated."""
    kept = spark.read.schema(REVENUE_SCHEMA).parquet(path)
    return kept.select(DAY, "lines", amount(F.col("units")).alias("revenue"))
