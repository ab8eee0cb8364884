"""Distributed selection and numbering against plain windows and numpy, ties and skew included."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronscope.operators import numbering, order_stats, rfm


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; another part is continuous; some are NULL."""
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(1000, 5.0), rng.lognormal(1, 1, 1500), rng.integers(0, 9, 500).astype(float)])
    rng.shuffle(values)
    rows = [(i, float(v), "a" if i % 3 else "b") for i, v in enumerate(values)] + [(10_000 + i, None, "a") for i in range(20)]
    return spark.createDataFrame(rows, "customer_id long, v double, g string").repartition(6).cache(), values


def test_order_statistics_match_sorting(skewed):
    df, values = skewed
    ranks = [1, 2, 37, 999, 1500, 2222, len(values) - 1, len(values)]
    found = order_stats.order_statistics(df, "v", {f"k{r}": str(r) for r in ranks} | {"none": "n + 1", "zero": "0"}).collect()
    ordered = np.sort(values)
    got = {r["stat"]: r for r in found}
    assert set(got) == {f"k{r}" for r in ranks}
    for r in ranks:
        assert got[f"k{r}"]["value"] == ordered[r - 1]
        assert got[f"k{r}"]["below"] == int((ordered < ordered[r - 1]).sum())


def test_group_quantiles_match_numpy(skewed):
    df, _ = skewed
    local = df.where("v IS NOT NULL").toPandas()
    for row in order_stats.group_quantiles(df, "v", {"q1": 0.25, "med": 0.5, "hi": 0.999}, ["g"]).collect():
        wanted = np.quantile(local[local["g"] == row["g"]]["v"], [0.25, 0.5, 0.999])
        assert np.allclose([row["q1"], row["med"], row["hi"]], wanted, rtol=1e-12)


def test_empty_input_gives_nothing(spark):
    empty = spark.createDataFrame([], "v double, customer_id long")
    assert order_stats.order_statistics(empty, "v", {"a": "1"}).count() == 0
    assert order_stats.quantiles(empty, "v", {"a": 0.5}) == {"a": None}


def test_top_sums_with_ties(skewed):
    df, values = skewed
    values = np.round(values, 4)
    df = df.withColumn("v", F.round("v", 4))
    row = order_stats.top_sums(df, "v", {"top": "n div 2"}).first()
    assert row["k"] == len(values) // 2
    assert abs(row["top_sum"] - np.sort(values)[::-1][: row["k"]].sum()) < 1e-6
    assert abs(row["total_sum"] - values.sum()) < 1e-6


@pytest.mark.parametrize("n", [5, 7, 23, 48])
def test_ntile_by_cut_points_equals_window(spark, n):
    buckets = 5
    rng = np.random.default_rng(n)
    df = spark.createDataFrame([(i, int(rng.integers(0, 4))) for i in range(n)], "customer_id long, v long")
    cuts = order_stats.key_cuts(df, {"v": "v"}, "customer_id", order_stats.ntile_ranks(buckets))
    both = df.withColumn("mine", order_stats.bucket_by_cuts("v", "customer_id", cuts)).withColumn(
        "theirs", F.expr(f"ntile({buckets}) OVER (ORDER BY v, customer_id)"))
    assert both.where("mine <> theirs").count() == 0


@pytest.mark.parametrize("sql,ranks", [
    ("SELECT 7.0D AS v FROM range(1)", {"1": 7.0}),
    ("SELECT 3.0D AS v FROM range(1000000)", {"1": 3.0, "500000": 3.0, "n": 3.0}),
    ("SELECT CAST(id * id AS DOUBLE) AS v FROM range(300000)", {"1": 0.0, "150001": 150000.0 ** 2, "n": 299999.0 ** 2}),
    ("SELECT IF(id < 99999, exp(-id / 1000D), 1e300) AS v FROM range(100000)", {"n": 1e300, "n - 1": 1.0}),
])
def test_selection_of_one_row_equal_rows_and_distinct_rows(spark, sql, ranks):
    found = order_stats.order_statistics(spark.sql(sql), "v", {f"k{i}": r for i, r in enumerate(ranks)}).collect()
    assert {r["stat"]: r["value"] for r in found} == {f"k{i}": v for i, v in enumerate(ranks.values())}


def test_qcut_sizes_follow_interpolated_edges(spark):
    """Seven rows: quintiles of row numbers hold 2, 1, 1, 1, 2."""
    raw = spark.createDataFrame([(i, i, 10 - i, float(i)) for i in range(1, 8)],
                                "customer_id long, recency_days int, frequency long, monetary double")
    sizes = [r["count"] for r in rfm.rfm_scores(raw, "qcut").groupBy("r_score").count().orderBy(F.desc("r_score")).collect()]
    assert sizes == [2, 1, 1, 1, 2]


def test_number_rows_and_running_total(skewed):
    df, _ = skewed
    base = df.where("v IS NOT NULL").withColumn("units", F.floor(F.col("v") * 100))
    numbered = numbering.number_rows(base, [F.col("v").desc(), F.col("customer_id")], running=F.col("units"), partitions=7)
    checked = numbered.withColumns({
        "rn2": F.expr("row_number() OVER (ORDER BY v DESC, customer_id)"),
        "sum2": F.expr("sum(units) OVER (ORDER BY v DESC, customer_id ROWS UNBOUNDED PRECEDING)")})
    assert checked.where("rn <> rn2 OR running_total <> sum2").count() == 0
    assert checked.count() == 3000


@pytest.mark.parametrize("ascending", [True, False])
def test_rank_values_equal_windows(skewed, ascending):
    df, _ = skewed
    order = "ASC" if ascending else "DESC"
    wanted = df.where("v IS NOT NULL").selectExpr(
        "v", f"rank() OVER (ORDER BY v {order}) AS r", f"dense_rank() OVER (ORDER BY v {order}) AS d").distinct()
    got = numbering.rank_values(df, "v", ascending)
    joined = got.join(wanted, "v")
    assert joined.count() == wanted.count() == got.count()
    assert joined.where("rank <> r OR dense_rank <> d").count() == 0


def test_scores_plan_has_no_single_partition_window(w):
    plan = rfm.rfm_scores(w.rfm_raw)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


HEAVY = ("SELECT CASE WHEN id = 7 THEN 1e300D WHEN id % 3 = 0 THEN 2.5D ELSE exp(12 * (pmod(xxhash64(id), 100003) / 100003D - 0.5)) "
         "* IF(id % 5 = 0, -1, 1) END AS v, IF(id % 2 = 0, 'a', 'b') AS g FROM range(200000)")


def test_heavy_tails_take_few_rounds_and_few_counters(spark, monkeypatch):
    """A third of the rows share a value, the rest spans many powers of ten of both signs, one value is 1e300."""
    df = spark.sql(HEAVY).repartition(6).cache()
    ordered = np.sort(np.array([r["v"] for r in df.collect()]))
    sizes, plain = [], order_stats._parts

    def counted(*args):
        found = plain(*args)
        sizes.append(found.groupBy("_x").count().agg({"count": "max"}).first()[0])
        return found

    monkeypatch.setattr(order_stats, "_parts", counted)
    ranks = [1, 2, 1000, 100_000, 133_333, 190_000, 199_999, 200_000]
    found = order_stats.order_statistics(df, "v", {str(r): str(r) for r in ranks}).collect()
    assert {int(r["stat"]): (r["value"], r["below"]) for r in found} == {r: (ordered[r - 1], int((ordered < ordered[r - 1]).sum())) for r in ranks}
    assert len(sizes) <= 4 and max(sizes) <= 1 << order_stats.DIGIT_BITS
    grouped = order_stats.group_quantiles(df, "v", {"half": 0.5, "all": 1.0}, ["g"]).collect()
    local = df.toPandas()
    assert {r["g"]: (r["half"], r["all"]) for r in grouped} == {g: (np.quantile(x, 0.5), x.max()) for g, x in local.groupby("g")["v"]}


@pytest.mark.parametrize("sql", [
    "SELECT * FROM VALUES (-9223372036854775808L), (9223372036854775807L), (0L), (-1L), (5L) AS t(v)",
    "SELECT * FROM VALUES (double('-inf')), (double('inf')), (0D), (-0D), (5e-324D), (-5e-324D), (2.2250738585072014e-308D), (1.7976931348623157e308D) AS t(v)",
    "SELECT * FROM VALUES (1.25BD), (-3.50BD), (1.26BD), (1.25BD) AS t(v)",
    "SELECT * FROM VALUES (DATE'2020-01-31'), (DATE'1969-12-31'), (DATE'2020-02-01') AS t(v)",
    "SELECT CAST(v AS SMALLINT) AS v FROM VALUES (3), (-3), (3), (300) AS t(v)",
    "SELECT CAST(v AS FLOAT) AS v FROM VALUES (1.1), (-1.1), (1.1000001) AS t(v)",
])
def test_selection_by_every_kind_of_value(spark, sql):
    df = spark.sql(sql)
    ordered = sorted(r["v"] for r in df.collect())
    found = order_stats.order_statistics(df, "v", {str(i): str(i) for i in range(1, len(ordered) + 1)})
    assert found.schema["value"].dataType == df.schema["v"].dataType
    assert [r["value"] for r in found.orderBy("rank").collect()] == ordered
