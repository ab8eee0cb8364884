"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosine checks.

Unit vectors are projected on random directions and the projections quantised; ROWS quantised values name a bucket of a
table, TABLES tables are kept. Equal vectors are one node. Dense groups are not compared pair by pair: all vectors
within half the linking angle of one hub are linked with each other, by the triangle inequality of angles.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, cos

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from . import textarrays as ta
from .components import components
from .staging import staged

MIN_COSINE = 0.9
#: With these a pair of cosine 0.9 shares a bucket with probability 0.93, one of 0.95 with 0.9997. More rows separate
#: strangers better (needed as the table grows), more tables find more links.
TABLES, ROWS, WIDTH = 80, 22, 2.5
SEED = 20


def _matrix(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and rows of usable vectors, by dimension: no nulls inside, all finite, not all zero."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    length = np.where(vectors.is_valid().to_numpy(zero_copy_only=False), pa.compute.fill_null(pa.compute.list_value_length(vectors), 0).to_numpy(zero_copy_only=False), 0)
    for size in np.unique(length[length > 0]).tolist():
        rows = np.flatnonzero(length == size)
        flat = vectors.take(pa.array(rows)).flatten()
        table = flat.to_numpy(zero_copy_only=False).reshape(-1, size)  # a null inside becomes NaN
        good = np.isfinite(table).all(axis=1) & (table != 0).any(axis=1)
        yield rows[good], table[good]


def bucket_keys(unit: np.ndarray) -> np.ndarray:
    """Bucket names (vectors x TABLES) of unit vectors: quantised Gaussian projections, hashed table by table."""
    size = unit.shape[1]
    rng = np.random.default_rng([SEED, size])
    directions = rng.standard_normal((size, TABLES * ROWS))
    shifts = rng.uniform(0, WIDTH, TABLES * ROWS)
    keys = np.empty((len(unit), TABLES), np.uint64)
    for first in range(0, len(unit), 1000):
        cells = np.floor((unit[first:first + 1000] @ directions + shifts) / WIDTH).astype(np.int64).view(np.uint64)
        cells = cells.reshape(-1, TABLES, ROWS)
        name = np.full((len(cells), TABLES), size, np.uint64)
        for row in range(ROWS):
            name = ta.mix(name + cells[:, :, row], row)
        keys[first:first + 1000] = ta.mix(name + np.arange(TABLES, dtype=np.uint64), 31)
    return keys


def hashed(vector: Column) -> Column:
    """Bucket names of a vector; null for one that links with nothing."""

    def batch(vectors: pa.Array) -> pa.Array:
        found = np.zeros((len(vectors), TABLES), np.int64)
        valid = np.zeros(len(vectors), bool)
        for rows, table in _matrix(vectors):
            largest = np.abs(table).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
            scaled = table / largest
            found[rows] = bucket_keys(scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).view(np.int64)
            valid[rows] = True
        ends = np.concatenate([[0], np.cumsum(valid * TABLES)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found[valid].ravel()), mask=pa.array(~valid))

    return arrow_udf(batch, "array<bigint>")(vector)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two usable vectors in double precision; -2 for vectors of different dimension."""

    def batch(x: pa.Array, y: pa.Array) -> pa.Array:
        out = np.full(len(x), -2.0)
        other = {}
        for rows, table in _matrix(y):
            place = np.full(len(x), -1)
            place[rows] = np.arange(len(rows))
            other[table.shape[1]] = (place, table)
        for rows, table in _matrix(x):
            if table.shape[1] not in other:
                continue
            place, right = other[table.shape[1]]
            both = place[rows] >= 0
            p, q = table[both], right[place[rows[both]]]
            p = p / np.abs(p).max(axis=1, keepdims=True)
            q = q / np.abs(q).max(axis=1, keepdims=True)
            out[rows[both]] = (p * q).sum(axis=1) / np.sqrt((p * p).sum(axis=1) * (q * q).sum(axis=1))
        return pa.array(out)

    return arrow_udf(batch, "double")(a, b)


def _with_cosine(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("vector").alias(f"vector_{name}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.withColumn("cosine", cosine(F.col("vector_a"), F.col("vector_b"))).drop("vector_a", "vector_b")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", min_cosine: float = MIN_COSINE) -> DataFrame:
    """(vec_id, node, n_links, component_id), one row for each row of ``vectors``.

    Vectors that are null, empty, zero or hold a null or non-finite component have no links and are their own component;
    so are vectors of another dimension for each other. Repeated rows are vectors of their own, linked by cosine 1. Null
    ids count as larger than all others. Labels and other columns are not looked at.
    """
    angle = acos(min_cosine)
    rows = staged(vectors.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
                  .withColumn("buckets", hashed(F.col("vector")))
                  .withColumn("node", F.when(F.col("buckets").isNotNull(), F.unhex(F.md5(F.to_json("vector"))))), "vectors")
    nodes = staged(rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.any_value("vector").alias("vector"), F.any_value("buckets").alias("buckets"), F.count(F.lit(1)).alias("weight"),
        F.min("vec_id").alias("vec_id")), "nodes")
    keyed = nodes.select("node", F.explode("buckets").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = staged(keyed.join(sizes, "key"), "buckets")

    # The hub of a bucket is the member that meets most others in all its buckets; each node joins its nearest hub.
    meets = buckets.groupBy("node").agg(F.sum("size").alias("meets"))
    hubs = buckets.join(meets, "node").groupBy("key").agg(F.max(F.struct("meets", F.col("node").alias("hub")))["hub"].alias("hub"))
    reach = buckets.join(hubs, "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    # A little inside half the angle, so that rounding never makes a link out of nothing.
    own = (_with_cosine(reach, nodes).where(F.col("cosine") >= cos(angle / 2) + 1e-9).groupBy("a")
           .agg(F.max(F.struct("cosine", "b")).alias("best")).select(F.col("a").alias("node"), F.col("best.b").alias("hub"), F.acos(F.least(F.col("best.cosine"), F.lit(1.0))).alias("off")))
    balls = staged(nodes.select("node", "weight").join(own, "node", "left").select(
        "node", "weight", F.coalesce("hub", "node").alias("ball"), F.coalesce("off", F.lit(0.0)).alias("off")), "balls")
    radius = staged(balls.groupBy("ball").agg(F.max("off").alias("radius"), F.sum("weight").alias("inside")), "radius")

    # Balls meet where their members share a bucket. Their hubs' angle tells whether any two members can be linked.
    met = buckets.join(balls.select("node", "ball"), "node").select("key", "ball").distinct()
    x, y = met.alias("x"), met.alias("y")
    apart = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.ball") < F.col("y.ball"))).select(
        F.col("x.ball").alias("a"), F.col("y.ball").alias("b")).distinct()
    side = lambda name: radius.select(F.col("ball").alias(name), F.col("radius").alias(f"radius_{name}"))
    close = _with_cosine(apart, nodes).join(side("a"), "a").join(side("b"), "b").where(
        F.acos(F.greatest(F.lit(-1.0), F.least(F.col("cosine"), F.lit(1.0)))) <= F.lit(angle + 1e-9) + F.col("radius_a") + F.col("radius_b"))
    inside = lambda name: balls.select(F.col("ball").alias(f"ball_{name}"), F.col("node").alias(name), F.col("weight").alias(f"weight_{name}"))
    wide = close.select(F.col("a").alias("ball_a"), F.col("b").alias("ball_b")).join(inside("a"), "ball_a").join(inside("b"), "ball_b")
    links = staged(_with_cosine(wide.select("a", "b", "weight_a", "weight_b"), nodes).where(F.col("cosine") >= min_cosine), "links")

    outside = links.select(F.col("a").alias("node"), F.col("weight_b").alias("n")).union(
        links.select(F.col("b").alias("node"), F.col("weight_a").alias("n"))).groupBy("node").agg(F.sum("n").alias("outside"))
    counted = balls.join(radius.select("ball", "inside"), "ball").join(outside, "node", "left").select(
        "node", "ball", (F.col("inside") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"))
    grouped = components(links.select("a", "b").union(balls.where("ball <> node").select(F.col("node").alias("a"), F.col("ball").alias("b"))))
    # A hub that went to another ball is no member of its own; its ball is still one component through its members.
    placed = staged(counted.join(grouped, "node", "left").join(nodes.select("node", "vec_id"), "node").select(
        "node", "n_links", "vec_id", F.coalesce("component", "node").alias("component")), "placed")
    named = placed.join(placed.groupBy("component").agg(F.min("vec_id").alias("component_id")), "component").select("node", "n_links", "component_id")
    return rows.select("vec_id", "node").join(named, "node", "left").select(
        "vec_id", "node", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
