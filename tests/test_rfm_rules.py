"""Invariants of cleaning, scoring, labels, scaling, clusters, cohorts and repeatability."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronscope.functions.segments import SEGMENTS, churn_probability, segment_label
from patronscope.operators import anomalies, cleaning, clustering, clv, cohorts, quality, rfm


@pytest.fixture(scope="module")
def lines(spark):
    """500 one-line invoices of 50 customers on 500 different days."""
    rng = np.random.default_rng(0)
    start = datetime.datetime(2023, 1, 1)
    days = rng.permutation(500)
    rows = [(f"INV{i:05d}", f"P{i % 40:05d}", f"item {i % 40}", int(rng.integers(1, 20)), start + datetime.timedelta(days=int(days[i])),
             float(np.round(rng.lognormal(4.0, 0.8), 2)), str(1001 + int(rng.integers(0, 50))), ["United Kingdom", "Germany", "France"][i % 3])
            for i in range(500)]
    return spark.createDataFrame(rows, "invoice string, stock_code string, description string, quantity int, invoice_date timestamp_ntz, "
                                       "unit_price double, customer_id string, country string").repartition(4).cache()


@pytest.fixture(scope="module")
def clean(lines):
    return cleaning.clean_sql_rules(lines)


@pytest.fixture(scope="module")
def summary(clean, lines):
    return cleaning.customer_summary(clean, cleaning.customers_dim(cleaning.valid_lines(lines))).cache()


@pytest.fixture(scope="module")
def raw(summary):
    return rfm.rfm_raw(summary, "exact")


@pytest.fixture(scope="module")
def seg(raw):
    return rfm.rfm_segments(raw, "qcut").cache()


def test_clean_lines_hold_the_rules(clean):
    assert clean.count() == 500
    assert clean.where("total_amount <= 0 OR quantity <= 0 OR customer_id IS NULL OR invoice_date IS NULL").count() == 0
    assert clean.select("customer_id").distinct().count() >= 10


def test_each_cleaning_rule_removes_its_row(spark):
    when = datetime.datetime(2023, 1, 1)
    good = ("1", " p00001", " lamp ", 2, when, 1.5, " 17850.0 ", " France ")
    bad = [("C1", *good[1:]), ("c1", *good[1:]), ("1", "POST", *good[2:]), ("1", "AB12", *good[2:]), (*good[:3], 0, *good[4:]),
           (*good[:5], 0.0, *good[6:]), (*good[:6], None, good[7]), (*good[:6], "  ", good[7]), (*good[:6], "abc", good[7])]
    df = spark.createDataFrame([good, *bad], "invoice string, stock_code string, description string, quantity int, invoice_date timestamp_ntz, "
                                             "unit_price double, customer_id string, country string")
    rows = cleaning.clean_sql_rules(df).collect()
    assert len(rows) == 1
    assert (rows[0]["stock_code"], rows[0]["customer_id"], rows[0]["country"], rows[0]["total_amount"]) == ("P00001", 17850, "France", 3.0)
    assert cleaning.clean_py_rules(df).count() == 6  # services, short codes, 'c', blank and unreadable ids stay
    funnel = {r["step"]: r["row_count"] for r in quality.strict_funnel(df).collect()}
    assert funnel == {"1 no customer": 2, "2 cancelled": 2, "3 non-positive quantity": 1, "4 non-positive price": 1, "5 not a product": 2,
                      "6 kept": 2}


def test_first_country_and_first_product_win(spark):
    valid = spark.createDataFrame([(1, "Spain"), (1, "Austria"), (2, None)], "customer_id long, country string")
    assert {r[0]: r[1] for r in cleaning.customers_dim(valid).collect()} == {1: "Austria", 2: "Unknown"}
    codes = spark.createDataFrame([("A", None, 1.0), ("A", "z", 1.0), ("A", "b", 3.0), ("A", "b", 2.0), ("B", None, 1.0)],
                                  "stock_code string, description string, unit_price double")
    assert [tuple(r) for r in cleaning.products_dim(codes).collect()] == [("A", "b", 2.0)]


@pytest.mark.parametrize("n", [1, 10, 999, 1000, 1001, 2500])
def test_outlier_cap_is_the_kth_largest(spark, n):
    df = spark.range(1, n + 1).select(F.col("id").cast("double").alias("total_amount"))
    assert cleaning.outlier_cap_disc(df) == float(n - n // 1000)


def test_rfm_one_row_per_customer_and_ranges(raw, clean):
    assert raw.count() == clean.select("customer_id").distinct().count()
    assert raw.where("recency_days < 0 OR frequency < 1 OR monetary <= 0").count() == 0


def test_recency_by_hand(raw, clean):
    local = clean.toPandas()
    snapshot = local["invoice_date"].max() + datetime.timedelta(days=1)
    for customer, last in local.groupby("customer_id")["invoice_date"].max().items():
        assert raw.where(F.col("customer_id") == int(customer)).first()["recency_days"] == (snapshot - last).days


def test_snapshot_flavours_differ_for_the_latest_buyer(spark):
    at = datetime.datetime(2023, 5, 1, 12, 50)
    summary = spark.createDataFrame([(1, 1, 5.0, at)], "customer_id long, total_orders long, total_revenue double, last_purchase timestamp_ntz")
    assert rfm.rfm_raw(summary, "midnight").first()["recency_days"] == 0
    assert rfm.rfm_raw(summary, "exact").first()["recency_days"] == 1


@pytest.mark.parametrize("method", ["ntile", "qcut"])
def test_scores(raw, method):
    scored = rfm.rfm_score_code(rfm.rfm_scores(raw, method)).toPandas()
    for c in ("r_score", "f_score", "m_score"):
        assert set(scored[c]) == {1, 2, 3, 4, 5}
    assert (scored["rfm_score"] == scored["r_score"] + scored["f_score"] + scored["m_score"]).all()
    assert scored["rfm_score"].between(3, 15).all()
    assert (scored.nlargest(3, "recency_days")["r_score"] <= 2).all()
    assert (scored.nlargest(3, "monetary")["m_score"] >= 4).all()


def test_direction_as_written_reverses_spend(raw):
    best = rfm.rfm_scores(raw, direction="sql_as_written").orderBy(F.desc("monetary")).first()
    assert best["m_score"] == 1


def test_segments(seg):
    local = seg.toPandas()
    assert local["customer_id"].is_unique and local["segment_label"].notna().all()
    assert set(local["segment_label"]) <= set(SEGMENTS)
    assert (local[local["segment_label"] == "Champions"]["rfm_score"] >= 12).all()
    assert (local[local["segment_label"] == "Lost / Inactive"]["rfm_score"] <= 4).all()


@pytest.mark.parametrize("score,label", [(15, "Champions"), (12, "Champions"), (11, "Loyal Customers"), (9, "Loyal Customers"),
                                         (8, "Potential Loyal"), (7, "Potential Loyal"), (6, "At Risk"), (5, "At Risk"),
                                         (4, "Lost / Inactive"), (3, "Lost / Inactive")])
def test_label_edges(spark, score, label):
    assert spark.range(1).select(segment_label(F.lit(score))).first()[0] == label


def test_churn_edges(spark):
    df = spark.createDataFrame([(d,) for d in (0, 30, 31, 90, 91, 180, 181)], "d int")
    assert [r[0] for r in df.select(churn_probability("d")).collect()] == [0.05, 0.05, 0.25, 0.25, 0.60, 0.60, 0.85]


def test_scaling(seg):
    local = rfm.rfm_scaled(seg).select("r_scaled", "f_scaled", "m_scaled").toPandas()
    assert np.allclose(local.mean(), 0, atol=1e-10) and np.allclose(local.std(ddof=0), 1, atol=1e-10)
    assert len(local) == seg.count() and local.notna().all().all()


def plain_lloyd(points, weight, centres):
    """Lloyd's rounds in whole numbers, one model, without Spark."""
    while True:
        label = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = centres.copy()
        for c in range(len(centres)):
            if (n := int(weight[label == c].sum())):
                new[c] = [(2 * int((weight * points[:, i])[label == c].sum()) + n) // (2 * n) for i in range(points.shape[1])]
        if (new == centres).all():
            return centres, int((weight * ((points - centres[label]) ** 2).sum(axis=1)).sum())
        centres = new


def test_runs_against_plain_lloyd_for_any_partitioning(seg):
    import hashlib

    scaled = rfm.rfm_scaled(seg)
    sites = clustering.sites_of(scaled)
    runs = clustering.kmeans(sites.repartition(7), [2, 4, 5], 3, 500)
    assert runs == clustering.kmeans(sites.coalesce(1), [2, 4, 5], 3, 500)
    local = sites.toPandas()
    points, weight = local[["q0", "q1", "q2"]].to_numpy(), local["weight"].to_numpy()
    for r in range(3):
        order = sorted(range(len(local)), key=lambda i: hashlib.md5(f"{r}:{local['id'][i]}".encode()).hexdigest())
        for k in (2, 4, 5):
            centres, cost = plain_lloyd(points, weight, points[order[:k]])
            assert runs[k][r].centres == tuple(map(tuple, centres.tolist())) and runs[k][r].cost == cost
            assert sum(runs[k][r].weights) == seg.count()


def test_quality_against_plain_distances(seg):
    scaled = rfm.rfm_scaled(seg)
    sites = clustering.sites_of(scaled)
    fit = clustering.best_of(clustering.kmeans(sites, [4], 3, 500)[4])
    local = clustering.assign(scaled, fit).select(*clustering.FEATURES, "cluster").toPandas()
    x, label = local[list(clustering.FEATURES)].to_numpy(), local["cluster"].to_numpy()
    gaps = ((x[:, None, :] - x[None]) ** 2).sum(axis=2)
    s = []
    for i in range(len(x)):
        own = (label == label[i]).sum()
        a = gaps[i, label == label[i]].sum() / max(own - 1, 1)
        b = min(gaps[i, label == c].mean() for c in set(label) if c != label[i])
        s.append((b - a) / max(a, b) if own > 1 else 0)
    row = clustering.cluster_quality(sites, {4: fit}).first()
    assert abs(row["silhouette"] - np.mean(s)) < 2e-5
    assert abs(row["inertia"] - sum(((x[label == c] - x[label == c].mean(axis=0)) ** 2).sum() for c in set(label))) < 1e-3
    assert row["davies_bouldin"] > 0 and row["calinski_harabasz"] > 0


def test_cluster_names_and_odd_tables(spark, seg):
    scaled = rfm.rfm_scaled(seg)
    fit = clustering.best_of(clustering.kmeans(clustering.sites_of(scaled), [4], 2, 500)[4])
    assert clustering.cluster_label(clustering.assign(scaled, fit)).select("cluster_segment").distinct().count() == 4
    none = clustering.sites_of(scaled.limit(0))
    assert clustering.kmeans(none, [2, 3], 2, 10) == {}
    same = spark.createDataFrame([(i, 0.5, 0.5, -1.0) for i in range(50)] + [(99, 3.0, 3.0, 3.0)], "customer_id long, r_scaled double, f_scaled double, m_scaled double")
    runs = clustering.kmeans(clustering.sites_of(same), [2, 3], 2, 10)
    assert all(f.cost == 0 and sorted(f.weights) == [1, 50] for k in runs for f in runs[k])


def test_closed_form_components():
    rng = np.random.default_rng(8)
    for m in [np.cov(rng.normal(size=(3, 50)) * [[1], [2], [5]]), np.eye(3), np.diag([3.0, 2.0, 2.0]), np.ones((3, 3)), np.zeros((3, 3))]:
        values = clustering.symmetric_eigenvalues(m)
        assert np.allclose(values, np.linalg.eigvalsh(m)[::-1], atol=1e-9)
        for v in values[:2]:
            unit = clustering.symmetric_eigenvector(m, v)
            assert abs(unit @ unit - 1) < 1e-12 and np.allclose(m @ unit, v * unit, atol=1e-6)


def test_segments_repeat_exactly(summary):
    runs = [rfm.rfm_segments(rfm.rfm_raw(summary.repartition(n))).orderBy("customer_id").collect() for n in (2, 5)]
    assert runs[0] == runs[1]


def test_closed_form_value_is_not_negative(seg):
    assert clv.clv_fallback(seg).where("clv_predicted < 0 OR prob_alive NOT BETWEEN 0 AND 0.99").count() == 0


def test_cohorts(clean):
    assigned = cohorts.cohort_assign(clean)
    assert assigned.where("cohort_index < 0").count() == 0 and assigned.count() == clean.count()
    months = cohorts.customer_months(clean)
    assert cohorts.retention_long(months).where("cohort_index = 0 AND retention <> 1").count() == 0
    assert cohorts.retention_long(months).where("retention NOT BETWEEN 0 AND 1").count() == 0


def test_forest_finds_planted_outliers_whatever_the_partitioning(spark):
    rng = np.random.default_rng(2)
    points = np.vstack([rng.normal(0, 1, (600, 3)), [[9, 9, 9], [-9, 8, -9], [0, 0, 12]]])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "customer_id long, a double, b double, c double")
    scores = []
    for parts in (2, 6):
        spread = df.repartition(parts)
        forest = anomalies.iforest_fit(spread, ("a", "b", "c"), ("customer_id",), 60)
        assert forest.select("tree").distinct().count() == 60
        scored = anomalies.iforest_score(spread, forest, ("a", "b", "c"))
        flagged = anomalies.anomaly_flag(scored, 0.03)
        assert abs(flagged.where("is_anomaly").count() - 0.03 * 603) <= 2
        scores.append(flagged.orderBy("customer_id").select("anomaly_score", "is_anomaly").collect())
    assert scores[0] == scores[1]
    assert all(r["is_anomaly"] for r in scores[0][600:]) and all(-1 <= r["anomaly_score"] <= 0 for r in scores[0])


def test_a_pass_of_kmeans_is_dealt_over_the_cores(spark, monkeypatch):
    points = spark.range(5000).selectExpr("id AS customer_id", *[f"cast(id % {p} as double) / {p} AS {c}" for p, c in zip((17, 19, 23), clustering.FEATURES)])
    tasks = []
    whole = clustering._pass
    monkeypatch.setattr(clustering, "_pass", lambda sites, *a, **k: tasks.append(sites.rdd.getNumPartitions()) or whole(sites, *a, **k))
    clustering.kmeans(clustering.sites_of(points), [3], 2, 1)
    assert min(tasks) >= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("weight", [3, 1 << 25])
def test_sums_of_a_pass_are_whole_numbers(weight):
    import numpy as np
    import pyarrow as pa

    q = np.random.default_rng(1).integers(-4_000_000, 4_000_000, (5000, 3))
    batch = pa.RecordBatch.from_arrays([*map(pa.array, q.T), pa.array(np.full(5000, weight))], ["q0", "q1", "q2", "weight"])
    centres = q[:8].reshape(2, 4, 3)
    added, _ = clustering._sums([centres], 3, False)
    found = {(m, c): s for out in added(iter([batch])) for m, c, s in zip(*[out.column(n).to_pylist() for n in ("model", "cluster", "sums")])}
    for m in range(2):
        own = ((q[:, None, :] - centres[m]) ** 2).sum(axis=2).argmin(axis=1)
        for c in range(4):
            assert found[m, c] == [weight * int((own == c).sum()), *(weight * int(x) for x in q[own == c].sum(axis=0))]


@pytest.mark.parametrize("with_squares", [False, True])
def test_blocks_with_one_nearest_centre_are_added_whole(monkeypatch, with_squares):
    import numpy as np
    import pyarrow as pa

    grid = np.stack(np.meshgrid(*[np.arange(32) * 100_000] * 3, indexing="ij"), axis=-1).reshape(8, 4, 8, 4, 8, 4, 3)
    q = grid.transpose(0, 2, 4, 1, 3, 5, 6).reshape(-1, 3)  # cubes of 4 x 4 x 4 sites one after another
    weight = np.arange(len(q)) % 7 + 1
    centres = np.array([[[0, 0, 0], [3_100_000, 3_100_000, 3_100_000], [0, 0, 0]]])  # the third equals the first and stays empty
    looked_at = []
    nearest = clustering._nearest_two
    monkeypatch.setattr(clustering, "_nearest_two", lambda middle, place: looked_at.append(len(middle)) or nearest(middle, place))
    added, width = clustering._sums([centres[:, :2], centres], 3, with_squares)
    batches = [pa.RecordBatch.from_arrays([*map(pa.array, q[i:i + 5000].T), pa.array(weight[i:i + 5000])], ["q0", "q1", "q2", "weight"])
               for i in range(0, len(q), 5000)]
    found = {(g, c): s for out in added(iter(batches)) for g, c, s in zip(*[out.column(n).to_pylist() for n in ("group", "cluster", "sums")])}
    own = ((q[:, None, :] - centres[0]) ** 2).sum(axis=2).argmin(axis=1)
    square = (q * q).sum(axis=1)
    values = np.column_stack([weight, weight[:, None] * q, weight * (square >> 24), weight * (square & 0xFFFFFF)])[:, :width]
    assert found == {(g, c): values[own == c].sum(axis=0).tolist() for g in range(2) for c in range(2)}
    monkeypatch.undo()
    looked_at.clear()
    monkeypatch.setattr(clustering, "_nearest_two", lambda middle, place: looked_at.append(len(middle)) or nearest(middle, place))
    list(clustering._sums([centres[:, :2]], 3, with_squares)[0](iter(batches)))
    assert sum(looked_at) < len(q) / 2


def test_sums_of_tasks_are_the_same_with_and_without_a_shuffle(spark, monkeypatch):
    points = spark.range(3000).selectExpr("id AS customer_id", *[f"cast(id % {p} as double) / {p} AS {c}" for p, c in zip((17, 19, 23), clustering.FEATURES)])
    runs = clustering.kmeans(clustering.sites_of(points), [2, 3], 2, 20)
    monkeypatch.setattr(clustering, "DRIVER_ROWS", 0)
    assert clustering.kmeans(clustering.sites_of(points), [2, 3], 2, 20) == runs


def counted(spark, df):
    """The same rows, and an accumulator of how many rows were made for all who read them."""
    made = spark.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            made.add(len(batch))
            yield batch

    return df.mapInPandas(passed, df.schema), made


def test_funnel_reads_its_source_once(spark):
    lines = spark.range(200).selectExpr("IF(id < 20, NULL, '1') AS customer_id", "IF(id < 50, 'C1', '1') AS invoice", "cast(id AS int) AS quantity", "id / 7.0D AS unit_price")
    raw, made = counted(spark, lines)
    found = {r["step"]: r["row_count"] for r in quality.cleaning_funnel(raw, 0.9).collect()}
    assert found == {"1 null customer": 20, "2 cancelled": 30, "5 outlier": 15, "6 kept": 135}
    assert made.value == 200


def test_sample_pool_groups_its_rows_once(spark):
    rows, made = counted(spark, spark.range(900).selectExpr("id % 300 AS id", "cast(id % 300 as double) AS x"))
    assert anomalies.sample_pool(rows, ["x"], ["id"], 2, 42).count() == 512
    assert made.value == 900


def test_orders_meet_customers_before_lines(w):
    joins = [line for line in w.raw._jdf.queryExecution().analyzed().toString().splitlines() if "Join" in line]
    assert "l_partkey" in joins[0] and "l_orderkey" in joins[1]


def test_lines_by_order_are_the_same_lines(w):
    from patronscope.sources import retail_feed

    joins = [line for line in retail_feed.raw_transactions(w.spark, w.folder, by_order=True)._jdf.queryExecution().analyzed().toString().splitlines() if "Join" in line]
    assert "l_orderkey" in joins[0] and "l_partkey" in joins[1]
    by_order = retail_feed.raw_transactions(w.spark, w.folder, by_order=True)
    assert by_order.exceptAll(w.raw).count() == 0 and w.raw.exceptAll(by_order).count() == 0
    assert w.sold.exceptAll(w.transactions.select(w.sold.columns)).count() == 0 and w.sold.count() == w.transactions.count()


def test_customer_tables_need_no_product_texts(spark):
    from conftest import FOLDER
    from patronscope.plans.workspace import Workspace

    fresh = Workspace(spark, FOLDER)
    assert fresh.summary.count() and fresh.clv_summary.count()
    assert "valid_lines" not in fresh.stage._tables


def test_first_country_without_sorting_lines(spark):
    lines = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, None), (2, "Z"), (3, None), (None, "c")], "customer_id long, country string")
    found = cleaning.customers_dim(lines)
    assert sorted((r["customer_id"] or 0, r["country"]) for r in found.collect()) == [(0, "c"), (1, "a"), (2, "Unknown"), (3, "Unknown")]
    steps = [line for line in found._jdf.queryExecution().sparkPlan().toString().splitlines() if "Aggregate" in line]
    assert "HashAggregate" in steps[-1]  # the one that reads the lines


def test_a_pass_of_kmeans_lasts_for_several_steps(spark, monkeypatch):
    points = spark.range(4000).selectExpr("id AS customer_id", *[f"(crc32(cast(concat(id, '{c}') as binary)) % 1000003) / 250000.0 AS {c}" for c in clustering.FEATURES])
    sites = clustering.sites_of(points).persist()
    local = sites.toPandas()
    place, weight = local[["q0", "q1", "q2"]].to_numpy(), local["weight"].to_numpy()
    starts = clustering.starting_sites(sites, 2, 6, 3)
    passes = []
    whole = clustering._pass
    monkeypatch.setattr(clustering, "_pass", lambda *a, **k: passes.append(1) or whole(*a, **k))
    runs = clustering.kmeans(sites, [3, 6], 2, 500)
    several = len(passes)
    for k in (3, 6):
        for r in range(2):
            centres, cost = plain_lloyd(place, weight, np.array(starts[r][:k]))
            assert runs[k][r].centres == tuple(map(tuple, centres.tolist())) and runs[k][r].cost == cost
    passes.clear()
    stopped = clustering.kmeans(sites, [6], 2, 13)  # most runs are not at their end
    for name, value in (("OPEN_SITES", 100), ("OPEN_SITES", 0), ("STEPS_AHEAD", 0)):
        with monkeypatch.context() as m:
            m.setattr(clustering, name, value)
            assert clustering.kmeans(sites, [6], 2, 13) == stopped
    passes.clear()
    monkeypatch.setattr(clustering, "STEPS_AHEAD", 0)
    assert clustering.kmeans(sites, [3, 6], 2, 500) == runs
    assert several < len(passes) / 2


def test_only_borders_of_centres_that_move_are_left_open():
    q = np.random.default_rng(3).integers(-4_000_000, 4_000_000, (6000, 3))
    q[:, 1:] //= 100  # nearly a line
    weight = np.ones(len(q), np.int64)
    centres = np.array([[-3_000_000, 0, 0], [0, 0, 0], [3_000_000, 0, 0]])
    ways = np.array([1_000.0, 1_000.0, 100_000.0])
    order = np.argsort(q[:, 0])
    q, total = q[order], np.zeros((3, 4), np.int64)
    at, reached = clustering._descend(clustering._levels(q, weight, False), centres, total, ways, len(q))
    assert reached == 1 and total[:, 0].sum() + len(at) == len(q)
    assert (q[at, 0] > 1_000_000).sum() > 10 * (q[at, 0] < -1_000_000).sum()
    owner = lambda c: ((q[:, None, :] - c) ** 2).sum(axis=2).argmin(axis=1)
    for move in ([1000, 0, 0], [-1000, 0, 0]), ([1000, 0, 0], [-100_000, 0, 0]), ([-1000, 0, 0], [100_000, 0, 0]):
        changed = np.flatnonzero(owner(centres) != owner(centres + np.array([move[0], move[0], move[1]])))
        assert set(changed) <= set(at)
    few, part = clustering._descend(clustering._levels(q, weight, False), centres, np.zeros((3, 4), np.int64), ways, len(at) // 4)
    assert len(few) == len(at) // 4 and 0 < part < 1 and set(few) <= set(at)
    nearer = owner(centres + np.array([[0, 0, 0], [0, 0, 0], [-int(100_000 * part), 0, 0]]))
    assert set(np.flatnonzero(owner(centres) != nearer)) <= set(few)
