"""The tables behind every question, built once per input folder."""

from __future__ import annotations

from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import anomalies, cleaning, clustering, clv, cohorts, neighbours, rfm
from ..sources import retail_feed
from ..sources.tables import Stage


class Workspace:
    """Lazy access to the base tables of one input folder.

    Tables that many questions share are staged as Parquet (cleaned lines, dimensions, customer summary, segments); the
    rest are plans over them.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.stage = Stage(spark, folder)
        self._made: dict[str, Any] = {}

    def once(self, name: str, make) -> Any:
        """Result of ``make``, computed on first use."""
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def stage_name(self, name: str) -> str:
        """Make sure a staged table is written, and return its name."""
        {"customer_summary": lambda: self.summary, "rfm_segments": lambda: self.segments}[name]()
        return name

    def source(self, name: str) -> DataFrame:
        return retail_feed.table(self.spark, self.folder, name)

    @cached_property
    def raw(self) -> DataFrame:
        return retail_feed.raw_transactions(self.spark, self.folder)

    @cached_property
    def valid(self) -> DataFrame:
        return self.stage.table("valid_lines", lambda: cleaning.valid_lines(self.raw))

    @cached_property
    def lines(self) -> DataFrame:
        """Cleaned product lines before the outlier cut."""
        return self.valid.where("is_product").drop("is_product")

    @cached_property
    def transactions(self) -> DataFrame:
        return cleaning.outlier_cut_disc(self.lines)

    @cached_property
    def sales(self) -> DataFrame:
        """Valid lines without what tells products apart, for all that is asked of customers and orders: narrower than
        ``valid``, and written order by order."""
        return self.stage.table("sale_lines", lambda: cleaning.valid_lines(
            retail_feed.raw_transactions(self.spark, self.folder, by_order=True)).drop("stock_code", "description", "unit_price"))

    @cached_property
    def sold(self) -> DataFrame:
        """``transactions`` with the columns of ``sales``."""
        return cleaning.outlier_cut_disc(self.sales.where("is_product").drop("is_product"))

    @cached_property
    def retail(self) -> DataFrame:
        """Lines under the lenient rules with calendar features, used by the exploratory charts."""
        return self.stage.table(
            "retail_lines",
            lambda: cleaning.time_features(cleaning.outlier_cut_interp(
                self.stage.table("lenient_lines", lambda: cleaning.clean_py_rules(self.raw)))))

    @cached_property
    def products(self) -> DataFrame:
        return self.stage.table("products", lambda: cleaning.products_dim(self.lines))

    @cached_property
    def customers(self) -> DataFrame:
        return cleaning.customers_dim(self.sales)

    @cached_property
    def summary(self) -> DataFrame:
        return self.stage.table(
            "customer_summary", lambda: cleaning.customer_summary(self.sold, self.customers))

    @cached_property
    def rfm_raw(self) -> DataFrame:
        return rfm.rfm_raw(self.summary)

    @cached_property
    def segments(self) -> DataFrame:
        return self.stage.table("rfm_segments", lambda: rfm.rfm_segments(self.rfm_raw))

    @cached_property
    def profile(self) -> DataFrame:
        """Segments with the customer's country, which the staged summary already carries."""
        return self.segments.join(self.summary.select("customer_id", "country"), "customer_id")

    @cached_property
    def scaled(self) -> DataFrame:
        return self.stage.table("rfm_scaled", lambda: rfm.rfm_scaled(self.segments))

    @cached_property
    def experiment(self) -> DataFrame:
        return retail_feed.experiment(self.spark, self.folder)

    @cached_property
    def scored_experiment(self) -> DataFrame:
        """With RFM scores, which only the sample sizes by score need."""
        return retail_feed.experiment(self.spark, self.folder, self.segments)

    # --- cohorts, value, clusters, anomalies

    @cached_property
    def customer_months(self) -> DataFrame:
        return self.stage.table("customer_months", lambda: cohorts.customer_months(self.sold))

    @cached_property
    def clv_summary(self) -> DataFrame:
        return self.stage.table("clv_summary", lambda: clv.clv_summary(self.sold))

    @cached_property
    def clv_fallback(self) -> DataFrame:
        return clv.clv_fallback(self.segments)

    @cached_property
    def bgnbd(self) -> dict[str, float]:
        return clv.bgnbd_fit(self.clv_summary)

    @cached_property
    def gamma_gamma(self) -> dict[str, float]:
        return clv.gamma_gamma_fit(self.clv_summary)

    @cached_property
    def clv_predicted(self) -> DataFrame:
        return self.stage.table(
            "clv_predicted", lambda: clv.clv_predicted(self.clv_summary, self.bgnbd, self.gamma_gamma))

    @cached_property
    def kmeans_runs(self) -> dict[int, list[clustering.Fit]]:
        return clustering.kmeans(clustering.sites_of(self.scaled), clustering.K_RANGE, clustering.RESTARTS, clustering.ITERATIONS)

    @cached_property
    def k_sweep(self) -> DataFrame:
        return clustering.k_sweep(self.scaled, self.kmeans_runs)

    @cached_property
    def clusters(self) -> DataFrame:
        k = clustering.best_k(self.k_sweep)
        return self.stage.table("clusters", lambda: clustering.assign(self.scaled, clustering.best_of(self.kmeans_runs[k])))

    @cached_property
    def knn_distance(self) -> DataFrame:
        return self.stage.table("knn_distance", lambda: neighbours.kth_distance(
            self.scaled, "customer_id", clustering.FEATURES))

    @cached_property
    def dbscan(self) -> DataFrame:
        return self.stage.table("dbscan", lambda: neighbours.dbscan(
            self.scaled, "customer_id", clustering.FEATURES, neighbours.knn_eps(self.knn_distance)))

    @cached_property
    def tx_featured(self) -> DataFrame:
        return self.stage.table("tx_features", lambda: anomalies.tx_features(self.lines))

    @cached_property
    def tx_forest(self) -> DataFrame:
        return self.stage.table("tx_forest", lambda: anomalies.iforest_fit(
            self.tx_featured, anomalies.TX_SCALED, ("invoice", "stock_code", "invoice_date", "quantity", "total_amount"),
            anomalies.TX_TREES))

    @cached_property
    def tx_scored(self) -> DataFrame:
        return self.stage.table("tx_scored", lambda: anomalies.iforest_score(
            self.tx_featured, self.tx_forest, anomalies.TX_SCALED))

    @cached_property
    def tx_flagged(self) -> DataFrame:
        return anomalies.anomaly_flag(self.tx_scored, anomalies.TX_CONTAMINATION)

    @cached_property
    def tx_thresholds(self) -> DataFrame:
        total, price = anomalies.tx_thresholds(self.tx_featured)
        return self.spark.range(1).select(F.lit(total).alias("extreme_total"), F.lit(price).alias("unusual_price"))

    @cached_property
    def cust_flagged(self) -> DataFrame:
        scored = self.stage.table("cust_scored", lambda: anomalies.iforest_score(
            self.scaled, anomalies.iforest_fit(
                self.scaled, anomalies.CUSTOMER_SCALED, ("customer_id",), anomalies.CUSTOMER_TREES),
            anomalies.CUSTOMER_SCALED))
        return anomalies.anomaly_flag(scored, anomalies.CUSTOMER_CONTAMINATION)


_workspaces: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """The workspace of a folder in the running application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _workspaces:
        _workspaces[key] = Workspace(spark, folder)
    return _workspaces[key]


def forget(spark: SparkSession, folder: str) -> None:
    """Drop the handle, so the next call builds every table again from the source files."""
    _workspaces.pop((spark.sparkContext.applicationId, folder), None)
