"""Row numbers, ranks and running totals over a whole table, without a single-partition window.

A range shuffle puts the table in global order, one sorted partition per range. A reliable checkpoint fixes that layout,
after which ``monotonically_increasing_id`` carries (partition, position). Per-partition totals, one row each, then turn
local positions into global ones. Ordering columns must be unique together, so equal values never pile up in one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import enable_checkpoints

_POSITION_BITS = 33


def number_rows(df: DataFrame, order: Sequence[Column], running: Column | None = None,
                partitions: int | None = None) -> DataFrame:
    """Add ``rn`` (1-based global row number) and, for ``running``, ``running_total`` up to and including the row."""
    spark = df.sparkSession
    enable_checkpoints(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = df if running is None else df.withColumn("_add", running)
    ordered = ordered.repartitionByRange(partitions, *order).sortWithinPartitions(*order).checkpoint()

    place = ordered.withColumn("_id", F.monotonically_increasing_id())
    place = place.withColumn("_part", F.shiftright("_id", _POSITION_BITS)).withColumn(
        "_pos", F.col("_id").bitwiseAND((1 << _POSITION_BITS) - 1))
    sums = [F.sum("_add").alias("_s")] if running is not None else []
    totals = place.groupBy("_part").agg(F.count(F.lit(1)).alias("_c"), *sums)
    # One row per range partition: the window is as small as the number of partitions.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_rows_before"),
        *([F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_sum_before")] if running is not None else []),
    )
    numbered = place.join(F.broadcast(offsets), "_part").withColumn("rn", F.col("_rows_before") + F.col("_pos") + 1)
    if running is not None:
        local = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
        numbered = numbered.withColumn("running_total", F.col("_sum_before") + F.sum("_add").over(local))
    return numbered.drop("_id", "_part", "_pos", "_rows_before", "_sum_before", "_add")


def rank_values(df: DataFrame, value: str, ascending: bool = True, carry: Sequence[Column] = ()) -> DataFrame:
    """RANK and DENSE_RANK of every distinct value: (value, ties, rank, dense_rank), plus aggregates in ``carry``.

    Equal values are counted on the map side first, so ranking works on distinct values only.
    """
    distinct = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("ties"), *carry)
    order = F.col(value).asc() if ascending else F.col(value).desc()
    numbered = number_rows(distinct, [order], running=F.col("ties"))
    return numbered.withColumn("rank", F.col("running_total") - F.col("ties") + 1).withColumnRenamed(
        "rn", "dense_rank").drop("running_total")
