import math

import numpy as np
import pytest

from patronscope.operators import neighbours

COLUMNS = ("x", "y", "z")


def clumpy(seed=0):
    """Tight clumps, repeated points, a chain and far outliers."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.02, (120, 3)), rng.normal((1, 1, 1), 0.3, (60, 3)), np.repeat([[2.0, 0.0, 0.0]], 40, axis=0),
             np.column_stack([np.linspace(3, 5, 60), np.zeros(60), np.zeros(60)]), rng.uniform(-9, 9, (12, 3))]
    return np.vstack(parts)


def frame(spark, points):
    return spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, x double, y double, z double").repartition(5)


def distances(points):
    return np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))


def brute_dbscan(points, eps, m):
    near = distances(points) <= eps
    core = near.sum(axis=1) >= m
    label = np.full(len(points), -1)
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        stack, label[i] = [i], i
        while stack:
            for j in np.flatnonzero(near[stack.pop()] & core):
                if label[j] < 0:
                    label[j] = i
                    stack.append(j)
    order = {root: n for n, root in enumerate(sorted({int(label[i]) for i in np.flatnonzero(core)}))}
    result = []
    for i in range(len(points)):
        if core[i]:
            result.append(order[int(label[i])])
        else:
            touching = [order[int(label[j])] for j in np.flatnonzero(near[i] & core)]
            result.append(min(touching) if touching else -1)
    return result


def test_kth_distance_matches_brute_force(spark):
    points = clumpy()
    got = {r["id"]: r["distance"] for r in neighbours.kth_distance(frame(spark, points), "id", COLUMNS, 5).collect()}
    wanted = np.sort(distances(points), axis=1)[:, 4]
    assert len(got) == len(points)
    assert max(abs(got[i] - wanted[i]) for i in range(len(points))) < 1e-9


@pytest.mark.parametrize("budget", [64, 0])
def test_dbscan_matches_brute_force(spark, monkeypatch, budget):
    monkeypatch.setattr(neighbours, "PAIRS_PER_SITE", budget)
    points = clumpy(1)
    got = {r["id"]: r["dbscan_cluster"] for r in neighbours.dbscan(frame(spark, points), "id", COLUMNS, 0.12).collect()}
    assert [got[i] for i in range(len(points))] == brute_dbscan(points, 0.12, 5)
    assert len(set(got.values())) > 3 and -1 in got.values()


def test_too_few_points_have_no_distance(spark):
    rows = neighbours.kth_distance(frame(spark, np.zeros((3, 3))), "id", COLUMNS, 5).collect()
    assert [r["distance"] for r in rows] == [None] * 3


def test_connected_components_of_a_long_chain(spark):
    nodes = spark.range(60).toDF("node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 59)], "u long, v long")
    labels = {r["node"]: r["label"] for r in neighbours.connected_components(nodes, edges).collect()}
    assert all(labels[i] == 0 for i in range(41)) and labels[59] == 50 and labels[45] == 45
    assert math.isclose(len(labels), 60)


def test_dbscan_without_radius_takes_full_places(spark):
    rows = [(i, float(i % 10), 0.0, 0.0) for i in range(100)] + [(200, 5.5, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, c double")
    for eps in (0.0, None):
        found = {r["customer_id"]: r["dbscan_cluster"] for r in neighbours.dbscan(df, "customer_id", ["a", "b", "c"], eps).collect()}
        assert all(found[i] == i % 10 for i in range(100)) and found[200] == -1


def test_components_end_without_the_constraints_of_their_rounds(spark):
    nodes = spark.range(60).toDF("node")
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long")
    labels = neighbours.connected_components(nodes, edges)
    assert labels._jdf.queryExecution().analyzed().constraints().size() == 0


def test_visits_to_cubes_are_not_broadcast(spark, capsys):
    df = frame(spark, clumpy())
    placed = neighbours.sites(df, "id", COLUMNS)
    neighbours._near(placed, placed, 1.0, 2, 1.7).explain()
    assert "Broadcast" not in capsys.readouterr().out
