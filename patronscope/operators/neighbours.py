"""Exact nearest-neighbour distance and DBSCAN on low-dimensional points.

Both work on *sites*: distinct coordinates with the number of points there and the smallest key. Any number of identical
points is one row. Space is cut into cubes, so a point meets only what lies in nearby cubes, and cubes are never expanded
against themselves: where a cube is crowded a finer cube is used instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import enable_checkpoints, written
from .numbering import number_rows
from .order_stats import quantiles

MIN_SAMPLES = 5
EPS_QUANTILE = 0.85
CROWDED = 64
CUBE_REACH = 2
PAIRS_PER_SITE = 64
AXES = ("x0", "x1", "x2")
NOISE = -1
_MAX_HALVINGS = 40


def sites(points: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Distinct coordinates: site (smallest key), weight, x0, x1, x2."""
    coords = [F.col(c).cast("double").alias(a) for c, a in zip(columns, AXES)]
    return points.select(F.col(key).alias("site"), *coords).groupBy(*AXES).agg(
        F.min("site").alias("site"), F.count(F.lit(1)).alias("weight"))


def _cells(side: float, prefix: str = "g") -> list[Column]:
    return [F.floor(F.col(a) / F.lit(side)).alias(f"{prefix}{i}") for i, a in enumerate(AXES)]


def _visit(df: DataFrame, reach: int) -> DataFrame:
    """Every row once per cube within ``reach`` of its own, the shift in o0, o1, o2."""
    for i in range(3):
        df = df.select("*", F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias(f"o{i}"))
    return df


def _near(left: DataFrame, right: DataFrame, side: float, reach: int, limit: float) -> DataFrame:
    """Pairs (left site, right site) with distance at most ``limit``, which must not exceed ``reach * side``.

    The left side visits the cubes around its own; an equi-join on the cube finds the right side. Neither side is broadcast:
    Spark takes the visits to be as few as the rows that make them.
    """
    g = ["g0", "g1", "g2"]
    visiting = _visit(left.select("site", *AXES, *_cells(side)), reach).select(
        F.col("site").alias("a"), *[F.col(x).alias(f"a_{x}") for x in AXES],
        *[(F.col(c) + F.col(f"o{i}")).alias(c) for i, c in enumerate(g)])
    found = visiting.hint("merge").join(right.select("*", *_cells(side)), g)
    squared = sum((F.pow(F.col(x) - F.col(f"a_{x}"), 2) for x in AXES), F.lit(0.0))
    return found.withColumn("distance", F.sqrt(squared)).where(F.col("distance") <= F.lit(limit))


def kth_distance(points: DataFrame, key: str, columns: Sequence[str], k: int = MIN_SAMPLES) -> DataFrame:
    """Distance from every point to its k-th nearest, itself counted first: (key, distance).

    Cubes start small enough that none is crowded, and double in size. At each size every neighbour within one cube side
    is known, so a point with k of them is finished; only the unfinished continue, and they have few close neighbours.
    """
    enable_checkpoints(points.sparkSession)
    all_sites = sites(points, key, columns).checkpoint()
    extent = all_sites.agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"),
                           *[(F.max(a) - F.min(a)).alias(a) for a in AXES]).first()
    if not extent["n"] or extent["w"] < k:
        return points.select(key, F.lit(None).cast("double").alias("distance"))
    widest = max(extent[a] for a in AXES) or 1.0
    side = widest / max(1.0, (extent["n"] / k) ** (1 / 3))
    for _ in range(_MAX_HALVINGS):
        fullest = all_sites.groupBy(*_cells(side)).agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0]
        if fullest <= CROWDED:
            break
        side /= 2

    stacked = F.col("weight") >= k
    finished = all_sites.where(stacked).select("site", F.lit(0.0).alias("distance"))
    pending = all_sites.where(~stacked)
    nearest = Window.partitionBy("a").orderBy("distance", "site")
    while True:
        close = _near(pending, all_sites, side, 1, side)
        # At most k rows per point are kept; the rank filter runs before the shuffle as well as after it.
        close = close.withColumn("rn", F.row_number().over(nearest)).where(F.col("rn") <= k)
        reached = close.withColumn("cum", F.sum("weight").over(nearest.rowsBetween(Window.unboundedPreceding, 0)))
        done = reached.groupBy(F.col("a").alias("site")).agg(
            F.min(F.when(F.col("cum") >= k, F.col("distance"))).alias("distance")).where("distance IS NOT NULL").checkpoint()
        finished = finished.unionByName(done)
        pending = pending.join(done, "site", "left_anti").checkpoint()
        if pending.isEmpty():
            break
        side *= 2
    coords = [F.col(c).cast("double").alias(a) for c, a in zip(columns, AXES)]
    located = finished.join(all_sites.select("site", *AXES), "site")
    return points.select(key, *coords).join(located, list(AXES)).select(key, "distance")


def knn_eps(distances: DataFrame, q: float = EPS_QUANTILE) -> float:
    return quantiles(distances, "distance", {"eps": q})["eps"]


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label) with the smallest node id of each component.

    Every round takes the smallest label among neighbours and then the label of that label, so chains halve in length;
    a table written per round keeps the plan short.
    """
    both = written(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = written(nodes.select("node", F.col("node").alias("label")))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(
            F.min("label").alias("heard"))
        lowered = labels.join(heard, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("heard", "label")).alias("label"))
        lowered = written(lowered)
        parent = lowered.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = written(lowered.join(parent, "label").select("node", "old", F.col("root").alias("label")))
        labels = jumped.select("node", "label")
        if jumped.where(F.col("old") != F.col("label")).isEmpty():
            return labels


def _box_gap(side: float) -> Column:
    """Smallest distance between two equal cubes given by their integer corners."""
    gaps = (F.greatest(F.abs(F.col(f"a{i}") - F.col(f"b{i}")) - 1, F.lit(0)) * side for i in range(3))
    return F.sqrt(sum((g * g for g in gaps), F.lit(0.0)))


def _meet_directly(pairs: DataFrame, core: DataFrame, side: float, eps: float) -> DataFrame:
    """Settle the remaining cube pairs site by site; the caller has checked that this is linear work overall."""
    placed = core.select("node", *AXES, *_cells(side))
    for p, node in (("a", "u"), ("b", "v")):
        one = placed.select(F.col("node").alias(node), *[F.col(f"g{i}").alias(f"{p}{i}") for i in range(3)],
                            *[F.col(x).alias(f"{p}_{x}") for x in AXES])
        pairs = pairs.join(one, [node, *[f"{p}{i}" for i in range(3)]])
    squared = sum((F.pow(F.col(f"a_{x}") - F.col(f"b_{x}"), 2) for x in AXES), F.lit(0.0))
    return pairs.where(F.sqrt(squared) <= eps).select("u", "v").distinct()


def _linked_cells(core: DataFrame, side: float, eps: float) -> DataFrame:
    """Pairs (u, v) of core cubes that hold two core sites within ``eps`` of each other.

    Each cube is represented by one of its sites. A pair of representatives within ``eps`` settles its cubes; otherwise
    both cubes are halved along every axis and only sub-cubes that could still be close go on. The rest is settled site by
    site once the remaining combinations are counted to be no more than a fixed multiple of the number of sites, so two
    crowded cubes are never multiplied out against each other.
    """
    level_side = side
    core_sites = core.count()
    cube = ["g0", "g1", "g2"]

    def level(s: float) -> DataFrame:
        return core.select("node", "site", *AXES, *_cells(s)).groupBy("node", *cube).agg(
            F.min(F.struct("site", *AXES)).alias("rep"), F.count(F.lit(1)).alias("c"))

    def pick(df: DataFrame, p: str) -> DataFrame:
        return df.select(F.col("node").alias("u" if p == "a" else "v"), *[F.col(c).alias(f"{p}{i}") for i, c in enumerate(cube)],
                         F.col("rep").alias(f"{p}_rep"), F.col("c").alias(f"{p}_c"))

    now = level(level_side)
    around = _visit(now, CUBE_REACH).select(
        F.col("node").alias("u"), F.col("rep").alias("a_rep"), F.col("c").alias("a_c"),
        *[F.col(c).alias(f"a{i}") for i, c in enumerate(cube)], *[(F.col(c) + F.col(f"o{i}")).alias(f"b{i}") for i, c in enumerate(cube)])
    pairs = around.hint("merge").join(pick(now, "b"), ["b0", "b1", "b2"]).where((F.col("u") < F.col("v")) & (_box_gap(level_side) <= eps))
    linked = None
    while True:
        apart = F.sqrt(sum((F.pow(F.col(f"a_rep.{x}") - F.col(f"b_rep.{x}"), 2) for x in AXES), F.lit(0.0)))
        judged = written(pairs.withColumn("met", apart <= eps))
        met = written(judged.where("met").select("u", "v").distinct())
        linked = met if linked is None else linked.unionByName(met)
        open_pairs = judged.where("NOT met AND (a_c > 1 OR b_c > 1)").join(met, ["u", "v"], "left_anti")
        open_pairs = written(open_pairs.select("u", "v", "a_c", "b_c", *[f"{p}{i}" for p in "ab" for i in range(3)]))
        work = open_pairs.agg(F.sum(F.col("a_c").cast("double") * F.col("b_c"))).first()[0] or 0.0
        if work == 0:
            return linked.distinct()
        if work <= PAIRS_PER_SITE * core_sites:
            return linked.unionByName(_meet_directly(open_pairs, core, level_side, eps)).distinct()
        level_side /= 2
        finer = level(level_side)
        parents = [F.floor(F.col(c) / 2).alias(f"p{i}") for i, c in enumerate(cube)]
        child = finer.select("*", *parents)
        open_pairs = open_pairs.drop("a_c", "b_c")
        for p, node in (("a", "u"), ("b", "v")):
            side_rows = child.select(
                F.col("node").alias(node), *[F.col(c).alias(f"n{p}{i}") for i, c in enumerate(cube)],
                *[F.col(f"p{i}").alias(f"{p}{i}") for i in range(3)], F.col("rep").alias(f"{p}_rep"), F.col("c").alias(f"{p}_c"))
            open_pairs = open_pairs.join(side_rows, [node, *[f"{p}{i}" for i in range(3)]])
        pairs = open_pairs.select("u", "v", *[F.col(f"n{p}{i}").alias(f"{p}{i}") for p in "ab" for i in range(3)],
                                  "a_rep", "b_rep", "a_c", "b_c").where(_box_gap(level_side) <= eps)


def _stacks(points: DataFrame, key: str, columns: Sequence[str], min_samples: int) -> DataFrame:
    """Clusters at a radius of 0 (or none, for a table without distances): places that hold ``min_samples`` points."""
    placed = sites(points, key, columns)
    core = placed.where(F.col("weight") >= min_samples)
    numbered = number_rows(core.select("site"), [F.col("site")]).select("site", (F.col("rn") - 1).alias("cluster"))
    final = placed.join(numbered, "site", "left").select(
        *AXES, F.coalesce("cluster", F.lit(NOISE)).cast("int").alias("dbscan_cluster"), (F.col("weight") >= min_samples).alias("is_core"))
    coords = [F.col(c).cast("double").alias(a) for c, a in zip(columns, AXES)]
    return points.select(key, *coords).join(final, list(AXES)).select(key, "dbscan_cluster", "is_core")


def dbscan(points: DataFrame, key: str, columns: Sequence[str], eps: float, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Exact DBSCAN: (key, dbscan_cluster, is_core); -1 is noise, clusters are numbered by their smallest core key.

    Cubes have diagonal ``eps``: a cube with ``min_samples`` points is all core, and core sites of one cube share a
    cluster. Only points of thin cubes count their neighbours. A border point joins its smallest core neighbour's cluster.
    """
    if not eps:
        return _stacks(points, key, columns, min_samples)
    # Slightly under the diagonal, so that rounding cannot put two sites of a cube more than eps apart.
    side = eps / math.sqrt(3.0) * (1 - 1e-12)
    reach = CUBE_REACH
    cube = ["g0", "g1", "g2"]
    located = sites(points, key, columns).select("*", *_cells(side))
    filled = located.groupBy(*cube).agg(F.sum("weight").alias("cube_weight"))
    located = written(located.join(filled, cube))
    dense = F.col("cube_weight") >= min_samples
    plain = located.select("site", "weight", *AXES)

    thin = located.where(~dense).select("site", "weight", *AXES)
    counts = _near(thin, plain, side, reach, eps).groupBy(F.col("a").alias("site")).agg(F.sum("weight").alias("near"))
    thin_core = counts.where(F.col("near") >= min_samples).select("site", F.lit(True).alias("by_count"))
    judged = written(located.join(thin_core, "site", "left").withColumn(
        "is_core", dense | F.coalesce("by_count", F.lit(False))).drop("by_count"))

    nodes = judged.where("is_core").groupBy(*cube).agg(F.min("site").alias("node"))
    core = written(judged.where("is_core").join(nodes, cube).select("node", "site", *AXES))
    edges = _linked_cells(core, side, eps)
    labels = connected_components(core.select("node").distinct(), edges)
    core_labels = core.join(labels, "node").select("site", *AXES, "label")
    # The component's smallest core key is its smallest cube node, since a node is the smallest site of its cube.
    border = _near(judged.where("NOT is_core").select("site", "weight", *AXES), core_labels, side, reach, eps)
    border_labels = border.groupBy(F.col("a").alias("site")).agg(F.min("label").alias("label"))
    numbered = number_rows(labels.select("label").distinct(), [F.col("label")]).select("label", (F.col("rn") - 1).alias("cluster"))
    assigned = core_labels.select("site", "label").unionByName(border_labels).join(numbered, "label").select("site", "cluster")
    final = judged.join(assigned, "site", "left").select(
        *AXES, F.coalesce("cluster", F.lit(NOISE)).cast("int").alias("dbscan_cluster"), "is_core")
    coords = [F.col(c).cast("double").alias(a) for c, a in zip(columns, AXES)]
    return points.select(key, *coords).join(final, list(AXES)).select(key, "dbscan_cluster", "is_core")


def dbscan_summary(labelled: DataFrame) -> DataFrame:
    noise = F.col("dbscan_cluster") == NOISE
    return labelled.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_distinct(F.when(~noise, F.col("dbscan_cluster"))).alias("clusters"),
        F.count_if(noise).alias("noise_points"))
