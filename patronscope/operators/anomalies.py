"""Isolation-forest anomaly detection (Liu, Ting and Zhou 2008) and its reports."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import money_avg, money_sum, round_to, share, units
from ..session import written
from .order_stats import order_statistics, quantiles
from .rfm import rfm_scaled

SAMPLE = 256
TX_TREES, CUSTOMER_TREES = 200, 300
TX_CONTAMINATION, CUSTOMER_CONTAMINATION = 0.02, 0.03
PRICE_CAP = 500.0
TX_FEATURES = ("quantity", "total_amount", "implied_unit_price")
TX_SCALED = ("quantity_scaled", "total_scaled", "price_scaled")
CUSTOMER_SCALED = ("r_scaled", "f_scaled", "m_scaled")
EULER_GAMMA = 0.5772156649015329
#: Whole units of features and of path lengths.
UNIT, PATH_UNIT = 1_000_000, 1_000_000_000
#: Copies of one content that a row of a task stands for.
COPY_BLOCK = 1 << 16
#: Modulus of the orders of the trees.
PRIME = 2 ** 31 - 1
#: Tasks that share the pool, which has at most trees * SAMPLE rows.
POOL_TASKS = 8


def tx_features(lines: DataFrame) -> DataFrame:
    """Implied unit price, capped, and three standardised features."""
    priced = lines.withColumn("implied_unit_price", F.least(
        F.col("total_amount") / F.greatest("quantity", F.lit(1)), F.lit(PRICE_CAP)))
    return rfm_scaled(priced, TX_FEATURES, TX_SCALED, log=False)


def cust_features(seg: DataFrame) -> DataFrame:
    return rfm_scaled(seg)


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def path_units(n: int) -> int:
    """``average_path`` in whole units, so that path lengths add up alike in any order."""
    return math.floor(average_path(n) * PATH_UNIT + 0.5)


def draw(seed: int, tree: int, node: int) -> tuple[float, float]:
    """Two numbers in [0, 1) for a node: which feature is cut, and where."""
    digits = md5(f"{seed}:{tree}:{node}".encode()).hexdigest()
    return int(digits[:8], 16) / 2.0 ** 32, int(digits[8:21], 16) / 2.0 ** 52


def _grow(values: np.ndarray, seed: int, tree: int) -> list[tuple]:
    """One tree as rows (node, feature, threshold, path units); the root is node 1, the children of node i are 2i and
    2i + 1, and feature -1 marks a leaf."""
    limit = max(1, math.ceil(math.log2(max(len(values), 2))))
    nodes, waiting = [], [(1, 0, values)]
    while waiting:
        node, depth, rows = waiting.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(usable) == 0:
            nodes.append((node, -1, 0.0, depth * PATH_UNIT + path_units(len(rows))))
            continue
        which, where = draw(seed, tree, node)
        feature = int(usable[int(which * len(usable))])
        threshold = float(low[feature]) + where * float(high[feature] - low[feature])
        nodes.append((node, feature, threshold, 0))
        goes_left = rows[:, feature] <= threshold
        waiting += [(2 * node, depth + 1, rows[goes_left]), (2 * node + 1, depth + 1, rows[~goes_left])]
    return nodes


def _whole(column: str) -> Column:
    return F.floor(F.col(column) * UNIT + 0.5).cast("bigint")


def _text(df: DataFrame, column: str) -> Column:
    """A column as text for a hash, the same in any engine."""
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp"):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
    return (units(F.col(column)) if kind in ("double", "float") else F.col(column)).cast("string")


def sample_pool(df: DataFrame, features: Sequence[str], identity: Sequence[str], trees: int, seed: int) -> DataFrame:
    """The ``trees * SAMPLE`` rows with the smallest hash of content and copy number: (f0, f1, ..., h).

    A bottom-k sample: it can be merged, it does not depend on partitioning, and a table with fewer rows is its own
    sample. Equal rows are counted on the map side first; their copies are numbered again in blocks of a bounded size, so
    content that a third of all rows share is spread over many tasks. The hashed rows are written once: the rounds that find
    the last hash of the sample read them and do not group the table again.
    """
    who = F.concat_ws("|", *[F.coalesce(_text(df, c), F.lit("")) for c in identity])
    names = [f"f{i}" for i in range(len(features))]
    content = df.select(*[_whole(c).alias(n) for c, n in zip(features, names)], who.alias("who")).groupBy(*names, "who").agg(F.count(F.lit(1)).alias("copies"))
    block = F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPY_BLOCK})")).alias("block")
    blocks = content.select("*", block)
    many = blocks.where(f"copies > {COPY_BLOCK}").repartition("who", "block")
    copies = blocks.where(f"copies <= {COPY_BLOCK}").unionByName(many).select(
        *names, "who", F.explode(F.expr(f"sequence(block * {COPY_BLOCK} + 1, least((block + 1) * {COPY_BLOCK}, copies))")).alias("copy"))
    name = F.concat_ws("|", F.lit(str(seed)), "who", F.col("copy").cast("string"))
    hashed = written(copies.select(*names, F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("bigint").alias("h")))
    edge = order_statistics(hashed, "h", {"edge": f"least(n, {trees * SAMPLE})"}).first()
    return hashed.where(F.col("h") <= F.lit(edge["value"] if edge else 0).cast("bigint"))


def tree_order(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """The place of rows in the order of a tree: a linear map of their hashes modulo a prime, drawn by seed and tree."""
    which, where = draw(seed, tree, 0)
    return ((h % PRIME) * (1 + int(which * (PRIME - 1))) + int(where * PRIME)) % PRIME


def iforest_fit(df: DataFrame, features: Sequence[str], identity: Sequence[str], trees: int, seed: int = 42) -> DataFrame:
    """Forest as a table: tree, node, feature, threshold, path_units, sample_size.

    Features are taken in millionths (``UNIT``). Every tree is grown by its own task from the up to SAMPLE rows of the
    pool that come first in its own order; tasks keep only so many rows for each tree, so what is shuffled is bounded.
    Features and cuts follow from md5 of (seed, tree, node). Nothing is drawn at random: the forest is the same for any
    partitioning, and the way is the same at any size.
    """
    names = [f"f{i}" for i in range(len(features))]
    pool = sample_pool(df, features, identity, trees, seed).repartition(POOL_TASKS)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None  # at most the pool
        if held is None or not len(held):
            return
        columns = [held.column(n).to_numpy() for n in (*names, "h")]
        for tree in range(trees):
            order = np.lexsort((*columns, tree_order(columns[-1], tree, seed)))[:SAMPLE]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(order), tree, np.int32)), *[pa.array(c[order]) for c in columns]], ["tree", *names, "h"])

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        columns = [rows[n].to_numpy() for n in (*names, "h")]
        order = np.lexsort((*columns, tree_order(columns[-1], tree, seed)))[:SAMPLE]
        grown = pd.DataFrame(_grow(np.stack(columns[:-1], axis=1)[order], seed, tree), columns=["node", "feature", "threshold", "path_units"])
        grown.insert(0, "tree", tree)
        return grown.assign(sample_size=len(order))

    kinds = ", ".join(f"{n} bigint" for n in (*names, "h"))
    return pool.mapInArrow(first, f"tree int, {kinds}").groupBy("tree").applyInPandas(
        grow, "tree int, node int, feature int, threshold double, path_units bigint, sample_size int")


def _as_heaps(table: pd.DataFrame) -> tuple:
    """Trees as complete binary heaps, early leaves carried down to the last level."""
    size = int(table["sample_size"].max())
    depth = max(1, math.ceil(math.log2(max(size, 2))))
    numbers = {t: i for i, t in enumerate(sorted(table["tree"].unique()))}
    width = 2 ** (depth + 1)
    feature = np.zeros((len(numbers), width), np.int64)
    threshold = np.full((len(numbers), width), np.inf)
    path = np.zeros((len(numbers), width), np.int64)
    for tree, node, f, cut, length in zip(*(table[c].tolist() for c in ("tree", "node", "feature", "threshold", "path_units"))):
        t = numbers[tree]
        if f >= 0:
            feature[t, node], threshold[t, node] = f, cut
        else:
            while node < width // 2:
                node = 2 * node  # the threshold there is infinite
            path[t, node] = length
    return feature, threshold, path, depth, average_path(size) or 1.0


def iforest_score(df: DataFrame, forest: DataFrame, features: Sequence[str], name: str = "anomaly_score") -> DataFrame:
    """Anomaly score of every row, lower is more anomalous.

    The forest has at most trees * 511 rows whatever the data size; it travels once per executor as a broadcast of flat
    arrays and rows are scored in Arrow batches. Path lengths are whole numbers until their sum is known.
    """
    table = forest.toPandas()
    if not len(table):
        return df.withColumn(name, F.lit(None).cast("double"))
    model = df.sparkSession.sparkContext.broadcast(_as_heaps(table))

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        feature, threshold, path, depth, scale = model.value
        for columns in batches:
            x = np.column_stack([c.to_numpy(float) for c in columns])
            flat, first = x.ravel(), np.arange(len(x)) * x.shape[1]
            length = np.zeros(len(x), np.int64)
            for tree in range(len(feature)):
                node = np.ones(len(x), np.int64)
                for _ in range(depth):
                    value = flat.take(first + feature[tree].take(node))
                    node = 2 * node + (value > threshold[tree].take(node))
                length += path[tree].take(node)
            yield pd.Series(-np.exp2(-(length / PATH_UNIT / len(feature) / scale)))

    return df.withColumn(name, score(*[_whole(c) for c in features]))


def anomaly_flag(scored: DataFrame, contamination: float, score: str = "anomaly_score") -> DataFrame:
    """Flag scores strictly below the contamination quantile."""
    cut = quantiles(scored, score, {"cut": contamination})["cut"]
    return scored.withColumn("is_anomaly", F.col(score) < F.lit(cut))


def _typed(flagged: DataFrame, kind: Column) -> DataFrame:
    return flagged.withColumn("anomaly_type", F.when(F.col("is_anomaly"), kind))


def tx_thresholds(lines: DataFrame) -> tuple[float, float]:
    return (quantiles(lines, "total_amount", {"q": 0.998})["q"], quantiles(lines, "implied_unit_price", {"q": 0.998})["q"])


def tx_anomaly_type(flagged: DataFrame) -> DataFrame:
    total, price = tx_thresholds(flagged)
    kind = (
        F.when(F.col("quantity") > 200, "Bulk Order").when(F.col("total_amount") > F.lit(total), "Extreme Value")
        .when(F.col("implied_unit_price") > F.lit(price), "Unusual Price").otherwise("Statistical Outlier"))
    return _typed(flagged, kind)


def cust_anomaly_type(flagged: DataFrame) -> DataFrame:
    spend = quantiles(flagged, "monetary", {"q": 0.99})["q"]
    orders = quantiles(flagged, "frequency", {"q": 0.99})["q"]
    kind = (
        F.when(F.col("monetary") > F.lit(spend), "Possible Wholesale").when(F.col("frequency") > F.lit(orders), "Power Buyer")
        .when((F.col("recency_days") < 7) & (F.col("frequency") > 20), "Suspicious Velocity").otherwise("Statistical Outlier"))
    return _typed(flagged, kind)


def type_counts(typed: DataFrame) -> DataFrame:
    return typed.where("is_anomaly").groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("flagged"))


def anomaly_profile(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("is_anomaly").agg(
        F.count(F.lit(1)).alias("customers"), round_to(F.avg("recency_days"), 1).alias("avg_recency"),
        round_to(F.avg("frequency"), 1).alias("avg_frequency"), round_to(money_avg("monetary"), 1).alias("avg_monetary"))


def anomaly_rate_by_segment(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("is_anomaly").alias("flagged"),
        share(F.count_if("is_anomaly"), F.count(F.lit(1)), 1).alias("pct"))


def anomaly_revenue(flagged: DataFrame, amount: str = "total_amount") -> DataFrame:
    held = money_sum(F.when(F.col("is_anomaly"), F.col(amount)).otherwise(0.0))
    return flagged.agg(
        F.count_if("is_anomaly").alias("flagged"), share(F.count_if("is_anomaly"), F.count(F.lit(1)), 1).alias("flagged_pct"),
        round_to(held, 2).alias("flagged_revenue"), share(held, money_sum(amount), 1).alias("revenue_pct"))


def top_anomalies(flagged: DataFrame, amount: str = "total_amount", k: int = 10,
                  tie_break: Sequence[str] = ("invoice", "stock_code")) -> DataFrame:
    return flagged.where("is_anomaly").orderBy(F.desc(amount), *tie_break).limit(k)


def exclude_anomalies(flagged: DataFrame) -> DataFrame:
    return flagged.where("NOT is_anomaly").drop("is_anomaly", "anomaly_type", "anomaly_score")


def anomaly_score_hist(flagged: DataFrame, normal_bins: int = 50, anomaly_bins: int = 20) -> DataFrame:
    """Score density of normal and flagged rows, each over its own range."""
    from ..functions.numeric import equal_width_bin

    limits = F.broadcast(flagged.groupBy("is_anomaly").agg(
        F.min("anomaly_score").alias("lo"), F.max("anomaly_score").alias("hi"), F.count(F.lit(1)).alias("n")))
    x, lo, hi = F.col("anomaly_score"), F.col("lo"), F.col("hi")
    bins = F.when(F.col("is_anomaly"), anomaly_bins).otherwise(normal_bins)
    slot = F.when(F.col("is_anomaly"), equal_width_bin(x, lo, hi, anomaly_bins)).otherwise(equal_width_bin(x, lo, hi, normal_bins))
    counted = flagged.join(limits, "is_anomaly").groupBy("is_anomaly", "lo", "hi", "n", slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("row_count"))
    width = (F.col("hi") - F.col("lo")) / bins
    return counted.select("is_anomaly", "bin", "row_count", round_to(F.col("row_count") / F.nullif(F.col("n") * width, F.lit(0.0)), 6)
                          .alias("density"))
