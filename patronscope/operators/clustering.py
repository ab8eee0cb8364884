"""K-means segmentation, cluster quality, labelling and PCA.

K-means works in whole numbers: coordinates are rounded to millionths of a standard deviation, sums are exact, and a centre is
the rounded mean. Results therefore do not depend on partitioning. Customers with the same coordinates are one weighted site.
A pass over the sites serves all K and all restarts that still move: a task adds up its sites by model and cluster, whole
blocks of neighbouring sites at a time where one centre is nearest to all of them, and a few numbers for each centre meet at the
driver. So do, up to a fixed number, the sites next to a border between clusters, the more of them the faster its two centres move:
while every centre is near its place in the pass no other site changes its cluster, and a run takes as many steps as these sites
settle before it needs the next pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.functions import arrow_udf

from ..functions.numeric import money_avg, money_sum, round_to, share
from ..functions.segments import SEGMENTS
from .insights import literal_table
from .order_stats import group_quantiles

FEATURES = ("r_scaled", "f_scaled", "m_scaled")
K_RANGE = range(2, 12)
MIN_K = 5
#: Runs of each K that the sweep compares, and that the final model is the best of.
SWEEP_RESTARTS, RESTARTS = 15, 20
ITERATIONS = 500
#: Whole units in one standard deviation.
UNIT = 1_000_000
#: Sites whose distances to all centres a task holds at once.
SITE_BLOCK = 4096
#: Sites of a task of a pass, unless there are more cores than that makes tasks.
TASK_SITES = 1 << 17
#: Partial sums of tasks that the driver adds up itself.
DRIVER_ROWS = 1 << 17
#: Sites next to a border that the tasks of a pass give to the driver, for all runs together.
OPEN_SITES = 1 << 20
#: Steps as long as the last one that such sites are to last for, unless they are too many.
STEPS_AHEAD = 48
#: The way that a centre is given in them at least, as a part of the fastest one's.
SLOWEST = 1 / 8
#: Marks of rows, in place of a cluster's number: the sites next to borders, and how far they last.
OPEN, REACHED = -1, -2
#: Parts in which the latter is told.
REACH_UNIT = 1 << 20
#: Parts of a block of neighbouring sites; blocks that a pass looks at first.
BLOCK, TOP_BLOCKS = 8, 64
#: Units by which distances may be wrong in floating point, amply: closer calls are decided site by site.
ROUNDING = 1.0


def _unit(column: str) -> Column:
    return F.floor(F.col(column) * UNIT + 0.5).cast("bigint")


def sites_of(scaled: DataFrame, columns: Sequence[str] = FEATURES, key: str = "customer_id") -> DataFrame:
    """Distinct coordinates in whole units (q0, q1, ...) with their weight and smallest key."""
    return scaled.groupBy(*[_unit(c).alias(f"q{i}") for i, c in enumerate(columns)]).agg(
        F.count(F.lit(1)).alias("weight"), F.min(key).alias("id"))


@dataclass(frozen=True)
class Fit:
    """One finished run: centres in whole units; of each cluster the weight, the sums of its coordinates and of their squares;
    the cost, which is the sum of squared distances."""
    centres: tuple[tuple[int, ...], ...]
    weights: tuple[int, ...]
    sums: tuple[tuple[int, ...], ...]
    squares: tuple[int, ...]
    cost: int


def best_of(runs: Sequence[Fit]) -> Fit:
    """The run of the smallest cost, the first of equals."""
    return min(runs, key=lambda f: f.cost)


def starting_sites(sites: DataFrame, restarts: int, most: int, dims: int) -> dict[int, list[tuple[int, ...]]]:
    """For each restart the ``most`` sites whose md5 of (restart, key) is smallest: the same for any partitioning."""
    dealt = sites.select("*", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("restart"))
    draw = F.md5(F.concat(F.col("restart").cast("string"), F.lit(":"), F.col("id").cast("string")))
    place = F.row_number().over(Window.partitionBy("restart").orderBy(draw, "id"))
    chosen = dealt.withColumn("place", place).where(F.col("place") <= most).orderBy("restart", "place").collect()
    found: dict[int, list[tuple[int, ...]]] = {r: [] for r in range(restarts)}
    for row in chosen:
        found[row["restart"]].append(tuple(row[f"q{i}"] for i in range(dims)))
    return found


@dataclass(frozen=True)
class Level:
    """Blocks of sites that are neighbours on the curve: the middle of a block's box, how far its sites are from it at most, and the
    sums over its sites. On the lowest level a block is one site."""
    middle: np.ndarray
    reach: np.ndarray
    sums: np.ndarray
    in_floats: bool  # any sum of these is a whole number below 2 ** 53, so exact in floating point


def _sites(q: np.ndarray, weight: np.ndarray, with_squares: bool) -> Level:
    """The lowest level."""
    values = [weight, *(weight * q[:, i] for i in range(q.shape[1]))]
    if with_squares:
        square = (q * q).sum(axis=1)
        values += [weight * (square >> 24), weight * (square & 0xFFFFFF)]
    sums = np.stack(values, axis=1)
    in_floats = bool(np.abs(sums.astype(float)).sum(axis=0).max(initial=0) < 2.0 ** 52)
    return Level(q.astype(float), np.zeros(len(q)), sums.astype(float) if in_floats else sums, in_floats)


def _levels(q: np.ndarray, weight: np.ndarray, with_squares: bool) -> list[Level]:
    """The sites and, above them, blocks of BLOCK blocks each, up to at most TOP_BLOCKS."""
    levels = [_sites(q, weight, with_squares)]
    sums, low, high, in_floats = levels[0].sums, q, q, levels[0].in_floats
    while len(sums) > TOP_BLOCKS:
        first = np.arange(0, len(sums), BLOCK)
        sums, low, high = np.add.reduceat(sums, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
        box = (high - low).astype(float) / 2
        levels.append(Level((low + high) / 2.0, np.sqrt((box * box).sum(axis=1)), sums, in_floats))
    return levels


def _far(middle: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each centre from each place, less that of the origin."""
    return (centres * centres).sum(axis=1)[:, None] - 2 * (centres @ middle.T)


def _nearest_two(middle: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each place the nearest centre, the first of equals, and its and the next one's squared distance less that of the origin."""
    far, at = _far(middle, centres), np.arange(len(middle))
    nearest = far.argmin(axis=0)
    least = far[nearest, at]
    far[nearest, at] = np.inf
    return nearest, least, far.min(axis=0)


def _add_up(total: np.ndarray, level: Level, at: np.ndarray, nearest: np.ndarray) -> None:
    if level.in_floats:
        held = nearest == np.arange(len(total))[:, None]
        total += (held.astype(float) @ level.sums[at]).astype(np.int64)
    else:
        np.add.at(total, nearest, level.sums[at])


def _add_nearest(total: np.ndarray, sites: Level, at: np.ndarray | slice, place: np.ndarray) -> None:
    """Add sites to the sums of their nearest centres, the first of equals."""
    far = _far(sites.middle[at], place)
    held = far == far.min(axis=0)
    if sites.in_floats and np.count_nonzero(held) == far.shape[1]:
        total += (held.astype(float) @ sites.sums[at]).astype(np.int64)
    else:
        _add_up(total, sites, at, far.argmin(axis=0))


def _gap(middle: np.ndarray, least: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How much nearer the nearest centre is than the next one."""
    origin = (middle * middle).sum(axis=1)
    return np.sqrt(np.maximum(second + origin, 0)) - np.sqrt(np.maximum(least + origin, 0))


def _descend(levels: list[Level], centres: np.ndarray, total: np.ndarray, ways: np.ndarray | None = None, most: int = 0) -> tuple[np.ndarray, float]:
    """Add the sums of all sites to those of their nearest centres.

    A block whose nearest centre is nearer by more than twice its reach than any other is nearest for all its sites, so it
    counts whole; any other is looked at part by part. Only blocks that a border between clusters crosses come down to sites.

    With the ``ways`` that the centres may go, the sites that could then have another nearest centre are returned instead of
    added. If these are more than ``most`` it is as many of them, those that shorter ways would do for, with the part of the
    ways up to which there are no others.
    """
    place = centres.astype(float)
    at = np.arange(len(levels[-1].sums))
    for depth in range(len(levels) - 1, 0, -1):
        level = levels[depth]
        middle = level.middle[at]
        if ways is None:
            nearest, least, second = _nearest_two(middle, place)
            lead = _gap(middle, least, second)
        else:
            nearest, gaps = _gaps(middle, place)
            lead = (gaps - ways[:, None]).min(axis=0) - ways[nearest]
        whole = lead > 2 * level.reach[at] + ROUNDING
        _add_up(total, level, at[whole], nearest[whole])
        at = (at[~whole, None] * BLOCK + np.arange(BLOCK)).ravel()
        at = at[at < len(levels[depth - 1].sums)]
    sites, left = levels[0], []
    for first in range(0, len(at), SITE_BLOCK):
        own = at[first:first + SITE_BLOCK]
        if ways is None:
            _add_nearest(total, sites, own, place)
            continue
        nearest, gaps = _gaps(sites.middle[own], place)
        part = ((gaps - ROUNDING) / (ways[:, None] + ways[nearest])).min(axis=0)
        near = part <= 1
        left.append((own[near], nearest[near], part[near]))
        _add_up(total, sites, own[~near], nearest[~near])
    if not left:
        return np.zeros(0, np.int64), 1.0
    own, nearest, part = (np.concatenate(c) for c in zip(*left))
    reached = 1.0
    if len(own) > most:
        order = np.argpartition(part, most)
        reached = max(float(part[order[most]]), 0.0)
        _add_up(total, sites, own[order[most:]], nearest[order[most:]])
        own = own[order[:most]]
    return own, reached


def _gaps(middle: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each place the nearest centre, the first of equals, and how much farther each other one is; infinite for itself."""
    far, at = _far(middle, centres), np.arange(len(middle))
    nearest = far.argmin(axis=0)
    far = np.sqrt(np.maximum(far + (middle * middle).sum(axis=1), 0))
    gaps = far - far[nearest, at]
    gaps[nearest, at] = np.inf
    return nearest, gaps


def _blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Coordinates and weights of a task's sites, TASK_SITES or a few more at once."""
    held, rows = [], 0

    def joined():
        table = pa.Table.from_batches(held)
        return np.stack([table.column(f"q{i}").to_numpy() for i in range(dims)], axis=1), table.column("weight").to_numpy()

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= TASK_SITES:
            yield joined()
            held, rows = [], 0
    if rows:
        yield joined()


def _sums(models: list[np.ndarray], dims: int, with_squares: bool, ways: list[np.ndarray] | None = None, most: int = 0):
    """Partial sums of a task by model and cluster: weight, coordinates and, if wanted, squared lengths in two limbs. With the
    ``ways`` of models that have any, also the sites next to their borders (OPEN: weight and coordinates of all, one after
    another) and the part of the ways that these last for (REACHED)."""
    width = 1 + dims + 2 * with_squares

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(m), m.shape[1], width), np.int64) for m in models]
        for q, weight in _blocks(batches, dims):
            levels = _levels(q, weight, with_squares)
            for group, (total, centres) in enumerate(zip(totals, models)):
                marks, values = [], []
                for run in range(len(centres)):
                    way = ways[group][run] if ways and ways[group][run].any() else None
                    at, reached = _descend(levels, centres[run], total[run], way, most)
                    if way is not None:
                        marks += [(group, run, OPEN), (group, run, REACHED)]
                        values += [np.column_stack([weight[at], q[at]]).ravel(), np.array([int(reached * REACH_UNIT)])]
                if marks:
                    yield _rows(np.array(marks), np.concatenate(values), [len(v) for v in values])
        for group, total in enumerate(totals):
            at = np.argwhere(total[:, :, 0] > 0)
            yield _rows(np.column_stack([np.full(len(at), group), at]), total[at[:, 0], at[:, 1]].ravel(), [width] * len(at))

    return added, width


def _rows(marks: np.ndarray, values: np.ndarray, lengths: list[int]) -> pa.RecordBatch:
    """Rows of group, model, cluster or mark, and a list of whole numbers."""
    ends = pa.array(np.cumsum([0, *lengths]).astype(np.int32))
    return pa.RecordBatch.from_arrays([*[pa.array(marks[:, i].astype(np.int32)) for i in range(3)],
                                       pa.ListArray.from_arrays(ends, pa.array(values))], ["group", "model", "cluster", "sums"])


@dataclass(frozen=True)
class Border:
    """Sites of a run that its pass left open; all others keep their clusters while no centre is farther from its place than it may be."""
    sites: Level
    ways: np.ndarray


def _pass(sites: DataFrame, models: list[np.ndarray], dims: int, with_squares: bool = False, tasks: int | None = None,
          ways: list[np.ndarray] | None = None, most: int = 0) -> tuple[list[np.ndarray], dict[tuple[int, int], Border]]:
    """Sums of all sites by model and cluster, and the border of each run that has ways. Those of ``tasks`` tasks meet at the
    driver where they are at most DRIVER_ROWS rows, as a shuffle of a few rows takes longer than the pass itself; more are added
    up by Spark first, without borders."""
    shuffled = tasks is None or tasks * sum(m.shape[0] * m.shape[1] for m in models) > DRIVER_ROWS
    added, width = _sums(models, dims, with_squares, None if shuffled else ways, most)
    parts = sites.mapInArrow(added, "group int, model int, cluster int, sums array<bigint>")
    if shuffled:
        parts = parts.groupBy("group", "model", "cluster").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
    rows = parts.toArrow()
    totals = [np.zeros((len(m), m.shape[1], width), object) for m in models]
    at = np.stack([rows.column(c).to_numpy() for c in ("group", "model", "cluster")], axis=1)
    sums = rows.filter(pa.array(at[:, 2] >= 0)).column("sums").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    added_at = at[at[:, 2] >= 0]
    for group, total in enumerate(totals):
        own = added_at[:, 0] == group
        np.add.at(total, (added_at[own, 1], added_at[own, 2]), sums[own].astype(object))
    open_, reached = {}, {}
    marks = rows.filter(pa.array(at[:, 2] < 0)).column("sums")
    for (group, model, mark), values in zip(at[at[:, 2] < 0].tolist(), marks):
        values = values.values.to_numpy(zero_copy_only=False)
        if mark == OPEN:
            open_.setdefault((group, model), []).append(values.reshape(-1, 1 + dims))
        else:
            reached[group, model] = min(reached.get((group, model), 1.0), int(values[0]) / REACH_UNIT)
    borders = {}
    for run, found in open_.items():
        found = np.concatenate(found)
        borders[run] = Border(_sites(found[:, 1:], found[:, 0], False), ways[run[0]][run[1]] * reached[run])
    return totals, borders


def _moved(total: np.ndarray, old: np.ndarray) -> np.ndarray:
    """The rounded means of clusters; one without sites keeps its centre."""
    n = np.maximum(total[:, :1], 1)
    return np.where(total[:, :1] > 0, (2 * total[:, 1:] + n) // (2 * n), old).astype(np.int64)


def _steps(total: np.ndarray, border: Border | None, centres: np.ndarray, most: int) -> tuple[np.ndarray, int, np.ndarray]:
    """Steps of a run from one pass, at most ``most``: its centres, the number of steps and how far the last one moved each.

    Two centres that are d and e from their places in the pass change no difference of their distances by more than d + e. So
    no site but those of the border can change its cluster while they are as near as the border's ways.
    """
    old, done = centres, 0
    sites = border.sites if border and len(border.sites.sums) else None
    if (sites is None or sites.in_floats) and max(map(abs, total.flat)) < 1 << 60:
        total = total.astype(np.int64)
    while True:
        step = total
        if sites:
            own = np.zeros(total.shape, np.int64)
            _add_nearest(own, sites, slice(None), old.astype(float))
            step = total + own
        new = _moved(step, old)
        far = _lengths(new - old)
        old, done = new, done + 1
        if not far.any() or done == most or not border or (_lengths(old - centres) > border.ways).any():
            return old, done, far


def _lengths(moves: np.ndarray) -> np.ndarray:
    return np.sqrt((moves.astype(float) ** 2).sum(axis=1))


def _curve(dims: int):
    """Place of a site on a curve that keeps near sites together: the leading bits of its coordinates in turn."""
    bits = min(16, 63 // dims)

    def placed(*columns: pa.Array) -> pa.Array:
        code = np.zeros(len(columns[0]), np.int64)
        for i, column in enumerate(columns):
            cell = np.clip((column.to_numpy(zero_copy_only=False) >> (24 - bits)) + (1 << bits - 1), 0, (1 << bits) - 1)
            for bit in range(bits):
                code |= (cell >> bit & 1) << (bit * dims + i)
        return pa.array(code)

    return arrow_udf(placed, "bigint")(*[F.col(f"q{i}") for i in range(dims)])


def spread(sites: DataFrame, dims: int = len(FEATURES)) -> DataFrame:
    """Sites dealt evenly over at least as many tasks as there are cores, near ones to the same task and side by side.

    Adaptive execution merges a shuffle of few bytes into one task, but a pass costs far more time than its bytes tell.
    """
    tasks = max(sites.sparkSession.sparkContext.defaultParallelism, -(-sites.count() // TASK_SITES))
    columns = [f"q{i}" for i in range(dims)]
    return sites.withColumn("curve", _curve(dims)).repartitionByRange(tasks, "curve", *columns).sortWithinPartitions(
        "curve", *columns).drop("curve")


def kmeans(sites: DataFrame, ks: Sequence[int], restarts: int, max_iter: int, dims: int = len(FEATURES)) -> dict[int, list[Fit]]:
    """``restarts`` Lloyd runs for each K, all side by side; no entry without sites.

    A site goes to its nearest centre, the first of equals; a cluster without sites keeps its centre. A run ends when none
    of its centres moves, or after ``max_iter``. With fewer sites than K every site is a centre.
    """
    sites = spread(sites, dims).persist()
    try:
        tasks = sites.rdd.getNumPartitions()
        starts = starting_sites(sites, restarts, max(ks), dims)
        if not any(starts.values()):
            return {}
        # One array for each K: restarts x clusters x coordinates.
        centres = {k: np.array([starts[r][:k] for r in range(restarts)], np.int64) for k in ks}
        left = {k: np.full(restarts, max_iter) for k in ks}
        # The last step of each centre, and the way of the fastest that one site of a task would last for; neither is known at first.
        far, each = {k: np.zeros(centres[k].shape[:2]) for k in ks}, {k: np.full(restarts, np.inf) for k in ks}
        while True:
            runs = {k: np.flatnonzero(left[k]) for k in ks if left[k].any()}
            if not runs:
                break
            most = max(OPEN_SITES // (tasks * sum(map(len, runs.values()))), 1)
            ways = []
            for k, at in runs.items():
                fastest = far[k][at].max(axis=1)
                ahead = np.minimum(STEPS_AHEAD * fastest, each[k][at] * most)
                ahead = np.where(ahead > fastest, ahead, 0) / np.maximum(fastest, 1)  # else it would not last for a step
                ways.append(np.maximum(far[k][at], SLOWEST * fastest[:, None]) * ahead[:, None])
            totals, borders = _pass(sites, [centres[k][at] for k, at in runs.items()], dims, tasks=tasks, ways=ways, most=most)
            for group, (k, at) in enumerate(runs.items()):
                for i, run in enumerate(at):
                    border = borders.get((group, i))
                    if border:
                        wide, wanted = float(border.ways.max()), float(ways[group][i].max())
                        each[k][run] = max(wide, 1.0) / most if wide < wanted else max(each[k][run], 2 * wide / most)
                    centres[k][run], done, far[k][run] = _steps(totals[group][i], border, centres[k][run], left[k][run])
                    left[k][run] = left[k][run] - done if far[k][run].any() else 0
        totals, _ = _pass(sites, [centres[k] for k in ks], dims, with_squares=True, tasks=tasks)
        return {k: [_fit(model, sums, dims) for model, sums in zip(centres[k].tolist(), total.tolist())] for k, total in zip(ks, totals)}
    finally:
        sites.unpersist()


def _fit(centres: list[list[int]], totals: list[list[int]], dims: int) -> Fit:
    weights, sums = [t[0] for t in totals], [tuple(t[1:1 + dims]) for t in totals]
    squares = [(t[-2] << 24) + t[-1] for t in totals]
    cost = sum(q + sum(n * x * x - 2 * x * t for x, t in zip(c, s)) for c, n, s, q in zip(centres, weights, sums, squares))
    return Fit(tuple(map(tuple, centres)), tuple(weights), tuple(sums), tuple(squares), cost)


def _nearest(q: Sequence[Column], centres: Sequence[Sequence[int]]) -> Column:
    """Number of the nearest centre, as an expression over whole coordinates."""
    square = lambda c: reduce(lambda a, b: a + b, [(x - F.lit(v)) * (x - F.lit(v)) for x, v in zip(q, c)])
    return F.array_min(F.array(*[F.struct(square(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]))["i"]


def assign(scaled: DataFrame, fit: Fit, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Customers with the number of their nearest centre, in a plain projection."""
    return scaled.withColumn("cluster", _nearest([_unit(c) for c in columns], fit.centres))


def _silhouettes(fits: dict[int, Fit], dims: int):
    """Sums of a task by K and cluster: silhouettes, and distances from the cluster's mean."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {k: np.zeros((len(f.centres), 2)) for k, f in fits.items()}
        for batch in batches:
            rows = np.stack([batch.column(f"q{i}").to_numpy() for i in range(dims)], axis=1).astype(float)
            weights = batch.column("weight").to_numpy()
            for first in range(0, len(rows), SITE_BLOCK):
                x, w = rows[first:first + SITE_BLOCK], weights[first:first + SITE_BLOCK]
                for k, fit in fits.items():
                    centres, n = np.array(fit.centres, float), np.array(fit.weights, float)
                    own = ((centres * centres).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)
                    sums, at = np.array(fit.sums, float) / UNIT, np.arange(len(x))
                    y = x / UNIT
                    # Squared distances from each site to all customers of each cluster, summed.
                    total = n * (y * y).sum(axis=1)[:, None] - 2 * (y @ sums.T) + np.array([q / UNIT ** 2 for q in fit.squares])
                    inside = np.maximum(total[at, own], 0) / np.maximum(n[own] - 1, 1)
                    mean = np.where(n > 0, total / np.maximum(n, 1), np.inf)
                    mean[at, own] = np.inf
                    other = mean.min(axis=1)
                    most = np.maximum(inside, other)
                    s = np.where((n[own] == 1) | ~np.isfinite(other) | (most <= 0), 0.0, (other - inside) / np.where(most > 0, most, 1))
                    off = np.sqrt(((y - sums[own] / n[own][:, None]) ** 2).sum(axis=1))
                    for i, value in enumerate((s, off)):
                        found[k][:, i] += np.bincount(own, w * value, len(n))
        rows_ = [(k, c, *map(float, v)) for k, table in found.items() for c, v in enumerate(table)]
        yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows_)], ["k", "cluster", "s", "d"])

    return measured


def cluster_quality(sites: DataFrame, fits: dict[int, Fit], dims: int = len(FEATURES)) -> DataFrame:
    """Inertia, silhouette, Davies-Bouldin and Calinski-Harabasz of each K, one row each, from one pass over the sites.

    The silhouette takes squared Euclidean distances, which need the sums of each cluster alone; a cluster of one
    customer counts 0. All but the inertia are computed from the clusters' true means; clusters without customers are left out.
    """
    rows = []
    if fits:
        found = sites.mapInArrow(_silhouettes(fits, dims), "k bigint, cluster bigint, s double, d double").groupBy("k", "cluster").agg(
            F.sum("s").alias("s"), F.sum("d").alias("d")).collect()
        told = {(r["k"], r["cluster"]): r for r in found}
        for k, fit in sorted(fits.items()):
            cs, total = [c for c, n in enumerate(fit.weights) if n], sum(fit.weights)
            centre = {c: [s / fit.weights[c] / UNIT for s in fit.sums[c]] for c in cs}
            wide = {c: told[k, c]["d"] / fit.weights[c] for c in cs}
            gap = {(p, r): sum((u - v) ** 2 for u, v in zip(centre[p], centre[r])) ** 0.5 for p in cs for r in cs if p != r}
            worst = [max(((wide[p] + wide[r]) / gap[p, r] for r in cs if r != p), default=0.0) for p in cs]
            middle = [sum(fit.sums[c][i] for c in cs) / total / UNIT for i in range(dims)]
            between = sum(fit.weights[c] * sum((u - v) ** 2 for u, v in zip(centre[c], middle)) for c in cs)
            within = sum(fit.squares[c] / UNIT ** 2 - fit.weights[c] * sum(v * v for v in centre[c]) for c in cs)
            ch = (between / (len(cs) - 1)) / (within / (total - len(cs))) if len(cs) > 1 and total > len(cs) and within > 0 else float("inf")
            silhouette = sum(told[k, c]["s"] for c in cs) / total
            rows.append((k, round(fit.cost / UNIT ** 2, 6), round(silhouette, 6), round(sum(worst) / len(cs), 6), round(ch, 3)))
    return literal_table(sites.sparkSession, ("k", "inertia", "silhouette", "davies_bouldin", "calinski_harabasz"), rows)


def k_sweep(scaled: DataFrame, runs: dict[int, list[Fit]], restarts: int = SWEEP_RESTARTS) -> DataFrame:
    """Quality of the best of the first ``restarts`` runs of every K: inertia, silhouette, Davies-Bouldin, Calinski-Harabasz."""
    return cluster_quality(sites_of(scaled), {k: best_of(r[:restarts]) for k, r in runs.items()})


def best_k(sweep: DataFrame, least: int = MIN_K) -> int:
    """K with the highest silhouette, but at least ``least``."""
    top = sweep.orderBy(F.desc("silhouette"), "k").first()
    return max(least, top["k"])


def cluster_profile(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("recency_days").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"), money_avg("monetary").alias("avg_monetary"))


def cluster_names(profile: DataFrame) -> DataFrame:
    """Name per cluster: rank by recency ascending plus frequency and monetary descending, average ranks on ties.

    Windows run over one row per cluster.
    """

    def average_rank(column: str, ascending: bool):
        order = Window.orderBy(F.col(column).asc() if ascending else F.col(column).desc())
        ties = F.count(F.lit(1)).over(Window.partitionBy(column))
        return F.rank().over(order) + (ties - 1) / 2.0

    ranked = profile.withColumn(
        "composite_rank",
        average_rank("avg_recency", True) + average_rank("avg_frequency", False) + average_rank("avg_monetary", False))
    place = F.row_number().over(Window.orderBy("composite_rank", "cluster"))
    names = F.element_at(F.array(*[F.lit(s) for s in SEGMENTS]), F.least(F.col("place"), F.lit(len(SEGMENTS))))
    return ranked.withColumn("place", place).select(
        "cluster", "composite_rank",
        F.when(F.col("place") <= len(SEGMENTS), names)
        .otherwise(F.concat(F.lit("Segment "), F.col("place").cast("string"))).alias("cluster_segment"))


def cluster_label(labelled: DataFrame) -> DataFrame:
    """Customers with their cluster and its business name; the name table has one row per cluster."""
    names = F.broadcast(cluster_names(cluster_profile(labelled)).select("cluster", "cluster_segment"))
    return labelled.join(names, "cluster")


def cluster_counts(named: DataFrame) -> DataFrame:
    return named.groupBy("cluster", "cluster_segment").agg(F.count(F.lit(1)).alias("customers"))


def segment_mean_median(df: DataFrame, columns: Sequence[str], by: str = "segment_label") -> DataFrame:
    """Mean and median of several columns per segment."""
    long = df.select(by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("x")) for c in columns])))
    medians = F.broadcast(group_quantiles(long, "x", {"median": 0.5}, [by, "metric"]).drop("n"))
    means = long.groupBy(by, "metric").agg(money_avg("x").alias("mean"))
    return means.join(medians, [by, "metric"]).select(
        by, "metric", round_to("mean", 1).alias("mean"), round_to(round_to("median", 4), 1).alias("median"))


def cluster_summary(df: DataFrame, by: str = "segment_label") -> DataFrame:
    whole = Window.partitionBy()
    grouped = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("customers"), round_to(F.avg("recency_days"), 1).alias("avg_recency"),
        round_to(F.avg("frequency"), 1).alias("avg_frequency"), round_to(money_avg("monetary"), 1).alias("avg_monetary"),
        money_sum("monetary").alias("rev"), round_to(F.avg("rfm_score"), 1).alias("avg_rfm_score"))
    return grouped.select(
        by, "customers", "avg_recency", "avg_frequency", "avg_monetary", round_to("rev", 1).alias("total_revenue"),
        "avg_rfm_score", share(F.col("customers"), F.sum("customers").over(whole), 1).alias("pct_customers"),
        share(F.col("rev"), F.sum("rev").over(whole), 1).alias("pct_revenue"))


def clv_by_segment(df: DataFrame, by: str = "segment_label") -> DataFrame:
    return df.groupBy(by).agg(round_to(money_avg("clv_estimate"), 2).alias("avg_clv"))


def pca_2d(scaled: DataFrame, columns: Sequence[str] = FEATURES) -> tuple[DataFrame, DataFrame]:
    """Two principal components per customer, and a one-row table of explained variance and loadings.

    One aggregate gives the covariance of the three features; its eigenvalues and eigenvectors follow in closed form (the
    trigonometric solution of a symmetric 3 x 3 matrix), so components are plain expressions. Features are taken as they
    are, without centring. The sign of a component is fixed by making its largest loading positive.
    """
    x = [F.col(c) for c in columns]
    pairs = [(0, 0), (1, 1), (2, 2), (0, 1), (0, 2), (1, 2)]
    row = scaled.agg(*[F.covar_samp(x[i], x[j]) for i, j in pairs]).first()
    matrix = np.zeros((3, 3))
    for (i, j), v in zip(pairs, row):
        matrix[i, j] = matrix[j, i] = v or 0.0
    values = symmetric_eigenvalues(matrix)
    loadings = [symmetric_eigenvector(matrix, v) for v in values[:2]]
    points = scaled.select("customer_id", *[reduce(lambda a, b: a + b, [c * F.lit(float(v)) for c, v in zip(x, load)]).alias(f"pc{j + 1}")
                                            for j, load in enumerate(loadings)])
    total = sum(values) or 1.0
    names, found = ["pc1_variance", "pc2_variance", "total_variance"], [values[0] / total, values[1] / total, (values[0] + values[1]) / total]
    for j, load in enumerate(loadings):
        names += [f"pc{j + 1}_{feature}" for feature in columns]
        found += [float(v) for v in load]
    return points.select("customer_id", round_to("pc1", 6).alias("pc1"), round_to("pc2", 6).alias("pc2")), literal_table(
        scaled.sparkSession, names, [[round(v, 6) for v in found]])


def symmetric_eigenvalues(m: np.ndarray) -> list[float]:
    """The three eigenvalues of a symmetric matrix, largest first."""
    mean = float(np.trace(m)) / 3
    off = m[0, 1] ** 2 + m[0, 2] ** 2 + m[1, 2] ** 2
    scale = (((m[0, 0] - mean) ** 2 + (m[1, 1] - mean) ** 2 + (m[2, 2] - mean) ** 2 + 2 * off) / 6) ** 0.5
    if scale == 0:
        return [mean] * 3
    half = float(np.linalg.det((m - mean * np.eye(3)) / scale)) / 2
    angle = np.arccos(min(max(half, -1.0), 1.0)) / 3
    first, last = mean + 2 * scale * np.cos(angle), mean + 2 * scale * np.cos(angle + 2 * np.pi / 3)
    return [float(first), float(3 * mean - first - last), float(last)]


def symmetric_eigenvector(m: np.ndarray, value: float) -> np.ndarray:
    """A unit vector that the matrix stretches by ``value``: the longest cross product of two rows of what is left."""
    rest = m - value * np.eye(3)
    crosses = [np.cross(rest[i], rest[j]) for i, j in ((0, 1), (0, 2), (1, 2))]
    longest = max(crosses, key=lambda c: float(c @ c))
    if not longest @ longest:
        longest = np.eye(3)[int(np.abs(rest).sum(axis=1).argmin())]
    unit = longest / (longest @ longest) ** 0.5
    return unit if unit[int(np.abs(unit).argmax())] > 0 else -unit
