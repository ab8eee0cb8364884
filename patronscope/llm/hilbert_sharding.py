"""Shards cut from a Hilbert curve over several metadata dimensions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from ..operators.numbering import number_rows, rank_values
from .staging import staged

SHARDS = 8
#: Each dimension is cut into 2 ** BITS ranges of about equally many documents.
BITS = 5
DIMENSIONS = ("source", "lang", "size", "doc_id")


def hilbert_index(coordinates: list[np.ndarray], bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with integer coordinates below 2 ** bits (Skilling's transform)."""
    x = [c.astype(np.int64).copy() for c in coordinates]
    for bit in reversed(range(1, bits)):
        low = (1 << bit) - 1
        for i in range(len(x)):
            set_ = (x[i] >> bit) & 1 == 1
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in reversed(range(1, bits)):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    index = np.zeros_like(x[0])
    for bit in reversed(range(bits)):
        for c in x:
            index = (index << 1) | (((c ^ turn) >> bit) & 1)
    return index


def ranges(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """(value, coordinate) of a text column: its distinct values in order, cut where their rows pass each 1 / 2 ** bits of
    all rows. Whole values are compared, so that a long common beginning does not matter; a value is in one range."""
    ranked = rank_values(rows.select(F.col(name).alias("value")), "value")
    total = rows.agg(F.count(name)).first()[0] or 1
    return staged(ranked.select("value", F.expr(f"cast(((rank - 1) * {1 << bits}) div {total} as int)").alias("coordinate")), "ranges")


def curve(rows: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """``rows`` with ``hilbert``, their index on the curve over ``dimensions``; nulls come first.

    Text dimensions are cut by the rank of their value, the others at approximate quantiles found in one pass.
    """
    kinds = dict(rows.dtypes)
    numbers = [d for d in dimensions if kinds[d] != "string"]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = rows.agg(F.count(F.lit(1)), *[F.percentile_approx(F.col(d).cast("double"), F.lit(shares), 10_000) for d in numbers]).first()
    cuts = [np.unique(np.array(c, float)) if c else np.zeros(0) for c in found[1:]]
    coordinates = {}
    for d in (d for d in dimensions if kinds[d] == "string"):
        own = ranges(rows, d, bits).select(F.col("value").alias(d), F.col("coordinate").alias(f"{d}_range"))
        rows = rows.join(own, d, "left")
        coordinates[d] = F.coalesce(F.col(f"{d}_range") + 1, F.lit(0)).cast("double")
    coordinates |= {d: F.coalesce(F.col(d).cast("double"), F.lit(float("-inf"))) for d in numbers}

    def indexed(*columns: pa.Array) -> pa.Array:
        placed = dict(zip(dimensions, (x.to_numpy(zero_copy_only=False) for x in columns)))
        placed |= {d: np.searchsorted(c, placed[d], "right") for d, c in zip(numbers, cuts)}
        # Null shares the first range; the order of rows inside a cell puts it first.
        return pa.array(hilbert_index([np.maximum(placed[d] - (kinds[d] == "string"), 0).astype(np.int64) for d in dimensions], bits))

    return rows.withColumn("hilbert", arrow_udf(indexed, "bigint")(*[coordinates[d] for d in dimensions])).drop(*[f"{d}_range" for d in dimensions])


def shard(docs: DataFrame, shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS, carry: tuple[str, ...] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those named in ``carry``) in a struct ``document``, and a struct ``placement``: size, text_crc32,
    hilbert, shard, slot.

    ``size`` is the UTF-8 bytes of the text, and one; a null text has neither bytes nor checksum bits. It may be named among
    ``dimensions`` beside columns of ``docs``. Rows are numbered along the curve and cut into runs whose lengths differ by one at most, so
    every shard covers few ranges of each dimension and file statistics prune on all of them. Rows of one cell of the
    curve are ordered by the dimensions, then crc32, which puts equal texts side by side; full ties keep their input
    order. Null values come first. Fewer rows than shards leave shards empty; an empty table gives no rows.
    """
    kept = [F.col(c) for c in carry] if carry is not None else [F.col(c) for c in docs.columns]
    own = [F.col(d).alias(f"by_{d}") for d in dimensions if d != "size"]
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("by_size")
    rows = docs.select(F.struct(*kept).alias("document"), *own, size, F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("crc"))
    rows = curve(rows, tuple(f"by_{d}" for d in dimensions), bits).withColumn("tie", F.monotonically_increasing_id())
    numbered = number_rows(rows, [F.col("hilbert"), *[F.col(f"by_{d}") for d in dimensions if d != "doc_id"], F.col("crc"), *[F.col(f"by_{d}") for d in dimensions if d == "doc_id"], F.col("tie")])
    total = numbered.count()
    # In whole numbers: shard s starts at row ceil(s * total / shards).
    which = f"(rn - 1) * {shards} div {max(total, 1)}"
    return numbered.select("document", F.struct(
        F.col("by_size").alias("size"), F.col("crc").alias("text_crc32"), "hilbert", F.expr(f"cast({which} as int)").alias("shard"),
        F.expr(f"rn - 1 - (({which}) * {total} + {shards - 1}) div {shards}").alias("slot")).alias("placement"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write whole documents as Parquet, a folder for each shard, in slot order within it. The folder's name takes the place of a
    column ``shard`` of ``docs``."""
    placed = shard(docs, shards).select("document", "placement")
    (placed.repartition(shards, "placement.shard").sortWithinPartitions("placement.shard", "placement.slot")
     .select(*[F.col(f"document.{c}") for c in docs.columns if c != "shard"], F.col("placement.shard").alias("shard")).write.partitionBy("shard").parquet(path))
