"""Every query by name: a function of the workspace."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import (anomalies, audience, cleaning, clustering, clv, cohorts, experiment, explore, insights, neighbours,
                         quality, rfm)
from ..operators import segment_questions as ask
from ..sources import tables, transactions as source
from ..streaming import refresh
from .workspace import Workspace, workspace

Build = Callable[[Workspace], DataFrame]
QUERIES: dict[str, Build] = {}

COHORT_COLUMNS = 80
PROFILE_COLUMNS = ("customer_id", "segment_label", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
                   "rfm_score", "clv_estimate", "churn_probability", "country")
DESCRIBED = ("recency_days", "frequency", "monetary")
PROFILED = ("recency_days", "frequency", "monetary", "rfm_score", "r_score", "f_score", "m_score")
AUDIENCE = {"segments": ("Champions", "Loyal Customers", "At Risk"), "recency": (0, 400), "monetary": (100.0, 5_000_000.0)}


def query(name: str):
    def register(build: Build) -> Build:
        QUERIES[name] = build
        return build
    return register


def add(name: str, build: Build) -> None:
    QUERIES[name] = build


# Sources, schema, sinks

def _fresh(w: Workspace, name: str) -> str:
    return w.stage.path(f"{name}-{uuid.uuid4().hex[:8]}")


def _source_file(w: Workspace, fmt: str) -> str:
    """Raw lines written once in a file format, to be read back by the readers."""
    def write() -> str:
        path = _fresh(w, f"raw_{fmt}")
        tables.write_tables({"raw": w.raw}, path, fmt)
        return f"{path}/raw"
    return w.once(f"raw_{fmt}", write)


@query("read_transactions")
def _(w):
    return source.read_transactions(w.spark, _source_file(w, "parquet"))


@query("read_transactions_csv")
def _(w):
    return source.read_transactions(w.spark, _source_file(w, "csv"), "csv")


@query("read_intermediate")
def _(w):
    return tables.read_intermediate(w.spark, w.stage.path("no_such_table"), w.stage.path(w.stage_name("customer_summary")))


@query("conform_columns")
def _(w):
    styled = w.raw.withColumnsRenamed({
        "invoice": "Invoice", "stock_code": "StockCode", "quantity": "Quantity", "invoice_date": "InvoiceDate",
        "unit_price": "Price", "customer_id": "Customer ID", "country": "Country", "description": "Description"})
    return source.conform_columns(styled)


@query("normalise_dates")
def _(w):
    text = w.raw.withColumn("invoice_date", F.when(F.col("quantity") != 13, F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss"))
                            .otherwise("not a date"))
    return source.normalise_dates(text).select("invoice", "stock_code", "quantity", "customer_id", "invoice_date", "invoice_date_text")


@query("stage_table")
def _(w):
    staged = tables.stage_table(w.products, _fresh(w, "staging"))
    return staged.select("stock_code", "description", "unit_price")


@query("query_views")
def _(w):
    return tables.query_views(w.spark, {"rfm_segments": w.segments}, """
        SELECT segment_label, count(*) AS customers FROM rfm_segments WHERE monetary > 1000 GROUP BY segment_label""")


@query("write_tables")
def _(w):
    written = tables.write_tables({"segments": w.segments, "customers": w.customers}, _fresh(w, "export"))
    return quality.dq_table_counts({name: w.spark.read.parquet(path) for name, path in written.items()})


@query("write_tables_csv")
def _(w):
    written = tables.write_tables({"customers": w.customers}, _fresh(w, "export_csv"), "csv")
    return w.spark.read.schema(w.customers.schema).options(**source.CSV_READ).csv(written["customers"])


@query("export_bi_bundle")
def _(w):
    bundle = insights.bi_bundle(w.segments, ask.segment_summary(w.segments))
    written = tables.write_tables(bundle, _fresh(w, "bundle"))
    return quality.dq_table_counts({name: w.spark.read.parquet(path) for name, path in written.items()})


add("generated_columns", lambda w: w.summary.select("customer_id", "total_orders", "total_revenue", "avg_order_value"))


@query("idempotent_overwrite")
def _(w):
    path = _fresh(w, "monthly")
    by_month = w.sold.groupBy(ask.month().alias("year_month")).agg(
        ask.rows().alias("lines"), F.sum("quantity").alias("items"))
    tables.overwrite_partitions(by_month, path, ["year_month"])
    tables.overwrite_partitions(by_month.where("year_month >= '2000-01'"), path, ["year_month"])
    schema = "lines bigint, items bigint, year_month string"
    return w.spark.read.schema(schema).parquet(path)


# Data quality and cleaning

add("dq_raw_report", lambda w: quality.dq_raw_report(w.raw))
add("dq_nulls", lambda w: quality.dq_nulls(w.raw))
add("dq_profile", lambda w: quality.dq_profile(w.raw))
add("dq_bad_rows", lambda w: quality.dq_bad_rows(w.raw))
add("cleaning_funnel", lambda w: quality.cleaning_funnel(w.raw))
add("strict_funnel", lambda w: quality.strict_funnel(w.raw))
add("dq_constraints", lambda w: quality.dq_constraints(w.products, w.customers, w.transactions, w.summary, w.segments))
add("dq_table_counts", lambda w: quality.dq_table_counts({
    "transactions": w.transactions, "customers": w.customers, "products": w.products, "customer_summary": w.summary}))
add("dq_revenue_sanity", lambda w: quality.dq_revenue_sanity(w.sold))
add("describe_table", lambda w: explore.describe_table(w.segments, DESCRIBED))
add("clean_sql_rules", lambda w: cleaning.clean_sql_rules(w.raw))
add("clean_py_rules", lambda w: cleaning.clean_py_rules(w.raw))
add("outlier_cut_disc", lambda w: w.transactions)
add("outlier_cut_interp", lambda w: w.retail.drop("year", "month", "day_of_week", "hour", "year_month"))
add("products_dim", lambda w: w.products)
add("customers_dim", lambda w: w.customers)
add("time_features", lambda w: w.retail.select("invoice", "invoice_date", "year", "month", "day_of_week", "hour", "year_month"))
add("customer_summary", lambda w: w.summary)

# RFM

add("rfm_snapshot", lambda w: rfm.rfm_snapshot(w.sold))
add("rfm_raw", lambda w: w.rfm_raw)
add("rfm_raw_exact", lambda w: rfm.rfm_raw(w.summary, "exact"))
add("rfm_ranks", lambda w: rfm.rfm_ranks(w.rfm_raw))
add("rfm_ntile_scores", lambda w: rfm.rfm_scores(w.rfm_raw))
add("rfm_ntile_scores_sql", lambda w: rfm.rfm_scores(w.rfm_raw, direction="sql_as_written"))
add("rfm_qcut_scores", lambda w: rfm.rfm_scores(rfm.rfm_raw(w.summary, "exact"), method="qcut"))
add("rfm_score_code", lambda w: rfm.rfm_score_code(rfm.rfm_scores(w.rfm_raw)))
add("segment_label", lambda w: w.segments.select("customer_id", "rfm_score", "segment_label"))
add("churn_probability", lambda w: w.segments.select("customer_id", "recency_days", "churn_probability"))
add("clv_proxy", lambda w: w.segments.select("customer_id", "monetary", "recency_days", "clv_estimate"))
add("rfm_scores", lambda w: rfm.rfm_score_code(rfm.rfm_scores(w.rfm_raw, direction="sql_as_written")))
add("rfm_segments", lambda w: w.segments)
add("rfm_segments_sql", lambda w: rfm.rfm_segments(w.rfm_raw, direction="sql_as_written"))
add("rfm_segments_qcut", lambda w: rfm.rfm_segments(rfm.rfm_raw(w.summary, "exact"), method="qcut"))
add("rfm_scaled", lambda w: w.scaled.select("customer_id", *[ask.round_to(c, 6).alias(c) for c in clustering.FEATURES]))
add("rfm_distribution", lambda w: rfm.rfm_distribution(w.segments))
add("segment_counts", lambda w: rfm.segment_counts(w.segments))

# Questions

for _name in ("seg_customer_share", "seg_profile", "pareto", "pareto_rows", "churn_by_segment", "churn_bands", "rf_heatmap",
              "kpi_summary", "segment_pivot", "buyer_types", "monetary_percentiles", "segment_summary", "seg_revenue"):
    add(_name, lambda w, f=getattr(ask, _name): f(w.segments))
for _name in ("top_champions", "winback_list", "geo_segments", "rfm_export"):
    add(_name, lambda w, f=getattr(ask, _name): f(w.profile))
for _name in ("mom_revenue", "running_revenue", "monthly_activity"):
    add(_name, lambda w, f=getattr(ask, _name): f(w.sold))
for _name in ("product_affinity", "product_affinity_topk"):
    add(_name, lambda w, f=getattr(ask, _name): f(w.segments, w.transactions, w.products))
add("cohort_segment_mix", lambda w: ask.cohort_segment_mix(w.segments, w.summary))
add("purchase_gaps", lambda w: ask.purchase_gaps(w.sold, w.segments))
add("transaction_export", lambda w: ask.transaction_export(w.transactions, w.profile, w.products))
add("top_customers", lambda w: ask.top_customers(w.summary))
add("top_countries", lambda w: ask.top_countries(w.sold, w.customers))

# Exploration

for _name in ("monthly_revenue_peak", "country_revenue", "order_value_hist", "purchase_frequency", "dow_revenue", "top_products"):
    add(_name, lambda w, f=getattr(explore, _name): f(w.retail))
for _name in ("rfm_score_hist", "segment_box", "recency_frequency_density", "segment_radar"):
    add(_name, lambda w, f=getattr(explore, _name): f(w.segments))

# Insights

for _name in ("strategy_dim", "revenue_opportunity", "segment_treemap", "churn_risk_band", "churn_risk_customers",
              "revenue_by_risk_band", "revenue_at_risk", "avg_churn"):
    add(_name, lambda w, f=getattr(insights, _name): f(w.segments))

# Audience

add("filter_customers", lambda w: audience.filter_customers(w.profile, **AUDIENCE).select(*PROFILE_COLUMNS))
add("filter_bounds", lambda w: audience.filter_bounds(w.profile))
add("segment_metrics", lambda w: audience.segment_metrics_report(w.profile))
add("segment_metrics_filtered", lambda w: audience.segment_metrics_report(audience.filter_customers(w.profile, **AUDIENCE)))
for _name in ("pareto_top20", "winback_projection", "potential_projection", "loyal_gap", "lost_projection", "action_priority",
              "geo_top10", "country_breakdown", "segment_table"):
    add(_name, lambda w, f=getattr(audience, _name): f(w.profile))
add("explore_sorted", lambda w: audience.explore_sorted(w.profile, PROFILE_COLUMNS, "monetary"))

# Cohorts

add("cohort_assign", lambda w: cohorts.cohort_assign(w.transactions).select(
    "customer_id", "invoice", "stock_code", "order_month", "cohort_month", "cohort_index"))
for _name in ("cohort_counts", "cohort_sizes", "cohort_extent", "retention_table", "retention_curve", "retention_kpis",
              "biggest_drop"):
    add(_name, lambda w, f=getattr(cohorts, _name): f(w.customer_months))
for _name in ("cohort_matrix", "retention_matrix", "revenue_cohort", "revenue_cohort_per_customer"):
    add(_name, lambda w, f=getattr(cohorts, _name): f(w.customer_months, at_least=COHORT_COLUMNS))

# Experiment

add("ab_assign", lambda w: experiment.ab_assign(w.segments, "rfm_score"))
add("ab_describe", lambda w: experiment.ab_describe_report(w.experiment))
for _name in ("ab_lift", "ab_ztest", "ab_welch", "ab_cohens_d", "ab_mannwhitney", "ab_chi2", "ab_bonferroni", "ab_impact",
              "ab_decision", "ab_summary", "ab_revenue_hist"):
    add(_name, lambda w, f=getattr(experiment, _name): f(w.experiment))
add("ab_sample_size", lambda w: experiment.ab_sample_size(experiment.score_baselines(w.scored_experiment)))

# Lifetime value

add("clv_summary", lambda w: w.clv_summary)
add("clv_repeaters", lambda w: clv.clv_repeaters(w.clv_summary))
add("freq_value_corr", lambda w: clv.freq_value_corr(w.clv_summary))
add("bgnbd_fit", lambda w: clv.parameter_row(w.clv_summary, w.bgnbd))
add("gamma_gamma_fit", lambda w: clv.parameter_row(w.clv_summary, w.gamma_gamma))
add("prob_alive", lambda w: w.clv_summary.select("customer_id", clv.round_to(clv.prob_alive(w.bgnbd), 4).alias("prob_alive")))
add("expected_purchases", lambda w: w.clv_summary.select(
    "customer_id", clv.round_to(clv.expected_purchases(w.bgnbd), 2).alias("predicted_purchases_12m")))
add("expected_order_value", lambda w: w.clv_summary.where("frequency > 0").select(
    "customer_id", clv.round_to(clv.expected_order_value(w.gamma_gamma), 2).alias("predicted_avg_order")))
add("clv_predicted", lambda w: w.clv_predicted)
add("clv_predicted_tiers", lambda w: clv.clv_tier_table(w.clv_predicted))
add("clv_predicted_segments", lambda w: clv.clv_segment_table(clv.clv_join_segments(w.clv_predicted, w.segments)))
add("clv_predicted_headline", lambda w: clv.clv_headline(w.clv_predicted))
add("clv_fallback", lambda w: w.clv_fallback)
add("clv_join_segments", lambda w: clv.clv_join_segments(w.clv_fallback, w.segments).select(
    "customer_id", "clv_predicted", "prob_alive", "segment"))
add("clv_tiers", lambda w: clv.clv_tiers(w.clv_fallback).select("customer_id", "clv_predicted", "clv_tier"))
add("clv_tier_table", lambda w: clv.clv_tier_table(w.clv_fallback))
add("clv_segment_table", lambda w: clv.clv_segment_table(clv.clv_join_segments(w.clv_fallback, w.segments)))
for _name in ("clv_headline", "alive_grid", "clv_hist", "alive_hist"):
    add(_name, lambda w, f=getattr(clv, _name): f(w.clv_fallback))

# Clustering

add("k_sweep", lambda w: w.k_sweep)
add("silhouette", lambda w: w.k_sweep.select("k", "silhouette"))
add("davies_bouldin", lambda w: w.k_sweep.select("k", "davies_bouldin"))
add("calinski_harabasz", lambda w: w.k_sweep.select("k", "calinski_harabasz"))
add("kmeans_fit", lambda w: w.clusters.select("customer_id", "cluster"))
add("cluster_profile", lambda w: clustering.cluster_profile(w.clusters))
add("cluster_names", lambda w: clustering.cluster_names(clustering.cluster_profile(w.clusters)))
add("cluster_label", lambda w: clustering.cluster_label(w.clusters).select("customer_id", "cluster", "cluster_segment"))
add("cluster_counts", lambda w: clustering.cluster_counts(clustering.cluster_label(w.clusters)))
add("knn_distance", lambda w: w.knn_distance.select("customer_id", ask.round_to("distance", 6).alias("distance")))
add("dbscan", lambda w: w.dbscan)
add("dbscan_summary", lambda w: neighbours.dbscan_summary(w.dbscan))
add("pca_2d", lambda w: clustering.pca_2d(w.scaled)[0])
add("pca_variance", lambda w: clustering.pca_2d(w.scaled)[1])
add("segment_mean_median", lambda w: clustering.segment_mean_median(w.segments, PROFILED))
add("cluster_summary", lambda w: clustering.cluster_summary(w.segments))
add("kmeans_segment_summary", lambda w: clustering.cluster_summary(clustering.cluster_label(w.clusters), "cluster_segment"))
add("clv_by_segment", lambda w: clustering.clv_by_segment(w.segments))

# Anomalies

def _score():
    return ask.round_to("anomaly_score", 9).alias("anomaly_score")


add("tx_features", lambda w: anomalies.tx_features(w.lines).select(
    "invoice", "stock_code", ask.round_to("implied_unit_price", 4).alias("implied_unit_price"),
    *[ask.round_to(c, 6).alias(c) for c in anomalies.TX_SCALED]))
add("iforest_fit", lambda w: w.tx_forest.withColumn("threshold", ask.round_to("threshold", 3)))
add("iforest_score", lambda w: w.tx_scored.select("invoice", "stock_code", "total_amount", _score()))
add("tx_anomaly_flag", lambda w: w.tx_flagged.select("invoice", "stock_code", "total_amount", "is_anomaly"))
add("tx_anomaly_type", lambda w: anomalies.type_counts(anomalies.tx_anomaly_type(w.tx_flagged)))
add("tx_anomaly_thresholds", lambda w: w.tx_thresholds)
add("cust_features", lambda w: anomalies.cust_features(w.segments).select(
    "customer_id", *[ask.round_to(c, 6).alias(c) for c in anomalies.CUSTOMER_SCALED]))
add("cust_anomaly_flag", lambda w: w.cust_flagged.select("customer_id", _score(), "is_anomaly"))
add("cust_anomaly_type", lambda w: anomalies.type_counts(anomalies.cust_anomaly_type(w.cust_flagged)))
add("anomaly_profile", lambda w: anomalies.anomaly_profile(w.cust_flagged))
add("anomaly_rate_by_segment", lambda w: anomalies.anomaly_rate_by_segment(w.cust_flagged))
add("anomaly_revenue", lambda w: anomalies.anomaly_revenue(w.tx_flagged))
add("top_anomalies", lambda w: anomalies.top_anomalies(w.tx_flagged).select(
    "invoice", "stock_code", "quantity", "total_amount", "implied_unit_price", _score()))
add("exclude_anomalies", lambda w: anomalies.exclude_anomalies(w.cust_flagged).select("customer_id", *DESCRIBED))
add("anomaly_score_hist", lambda w: anomalies.anomaly_score_hist(w.tx_flagged))


# Streaming

#: Files of a micro-batch, few enough that a refresh takes several.
STREAM_FILES = 4


@query("stream_clean")
def _(w):
    out = _fresh(w, "stream_clean")
    refresh.refresh_lines(refresh.raw_stream(w.spark, _source_file(w, "parquet"), STREAM_FILES), out, _fresh(w, "stream_clean-checkpoint"))
    return w.spark.read.parquet(out).drop(refresh.DAY).withColumn("invoice_date", F.col("invoice_date").cast("timestamp_ntz"))


@query("stream_revenue")
def _(w):
    out = _fresh(w, "stream_revenue")
    refresh.refresh_revenue(refresh.raw_stream(w.spark, _source_file(w, "parquet"), STREAM_FILES), out, _fresh(w, "stream_revenue-checkpoint"))
    return refresh.daily_revenue(w.spark, out)


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(build: Build, spark: SparkSession, folder: str) -> DataFrame:
        return build(workspace(spark, folder))

    return {name: partial(run, build) for name, build in QUERIES.items()}
