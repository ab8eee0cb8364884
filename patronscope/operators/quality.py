"""Data-quality reports, each from as few scans as possible."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import count_where, money_sum, round_to, share
from ..session import written
from .cleaning import has_customer, is_cancelled, is_product
from .order_stats import quantiles


def _as_rows(one: DataFrame, labels: Mapping[str, str], name: str = "metric", value: str = "value") -> DataFrame:
    """One wide row to (name, value) rows."""
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias(name), F.col(c).cast("bigint").alias(value)) for c, label in labels.items()])))


def dq_raw_report(raw: DataFrame) -> DataFrame:
    """Seven counts over the raw table in one scan.

    Lines collapse to one row per (customer, country) before the two distinct counts expand them.
    """
    pairs = raw.groupBy(F.when(has_customer(), F.col("customer_id")).alias("customer_id"), "country").agg(
        F.count(F.lit(1)).alias("a"),
        count_where(~F.coalesce(has_customer(), F.lit(False))).alias("b"),
        count_where(is_cancelled()).alias("c"),
        count_where(F.col("quantity") <= 0).alias("d"),
        count_where(F.col("unit_price") <= 0).alias("e"),
    )
    one = pairs.agg(*[F.sum(c).alias(c) for c in "abcde"], F.count_distinct("customer_id").alias("f"),
                    F.count_distinct("country").alias("g"))
    return _as_rows(one, {
        "a": "Total raw records", "b": "Null customer_id", "c": "Cancelled invoices (C...)",
        "d": "Non-positive quantity rows", "e": "Non-positive price rows", "f": "Unique customers (raw)",
        "g": "Unique countries",
    })


def dq_nulls(df: DataFrame) -> DataFrame:
    """Null count and percentage of every column that has nulls."""
    one = df.agg(F.count(F.lit(1)).alias("_all"), *[count_where(F.col(c).isNull()).alias(c) for c in df.columns])
    long = one.select("_all", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns])))
    return long.where(F.col("null_count") > 0).select(
        "column_name", "null_count", share(F.col("null_count"), F.col("_all"), 2).alias("null_pct"))


def dq_profile(df: DataFrame) -> DataFrame:
    """Row count, dates and distinct counts. Rows first collapse to distinct ids on the map side, so that distinct counts
    do not multiply the raw lines."""
    counted = {"customer_id": "customers", "stock_code": "products", "country": "countries"}
    ids = df.groupBy(*counted).agg(F.count(F.lit(1)).alias("n"), F.min("invoice_date").alias("a"), F.max("invoice_date").alias("z"))
    return ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.min("a").alias("first_date"),
        F.max("z").alias("last_date"),
        *[F.count_distinct(c).alias(name) for c, name in counted.items()],
    )


def dq_bad_rows(raw: DataFrame) -> DataFrame:
    one = raw.agg(
        F.count(F.lit(1)).alias("_all"),
        count_where(F.col("quantity") < 0).alias("negative_quantity"),
        count_where(F.col("invoice").startswith("C")).alias("cancelled"),
        count_where(F.col("unit_price") <= 0).alias("non_positive_price"),
    )
    checks = ("negative_quantity", "cancelled", "non_positive_price")
    long = one.select("_all", F.inline(F.array(*[
        F.struct(F.lit(c).alias("issue"), F.col(c).alias("row_count")) for c in checks])))
    return long.select("issue", "row_count", share(F.col("row_count"), F.col("_all"), 1).alias("pct"))


def cleaning_funnel(raw: DataFrame, p: float = 0.999) -> DataFrame:
    """Rows removed by every lenient cleaning step, in order.

    Each row is tagged with the first rule it fails, so one aggregation replaces a count per step. The tagged rows, two
    columns, are written once: the rounds of the quantile read them and do not join the source tables again.
    """
    total = F.col("quantity") * F.col("unit_price")
    rule = (
        F.when(F.col("customer_id").isNull(), "1 null customer")
        .when(F.col("invoice").startswith("C"), "2 cancelled")
        .when(F.col("quantity") <= 0, "3 non-positive quantity")
        .when(F.col("unit_price") <= 0, "4 non-positive price")
    )
    tagged = written(raw.select(rule.alias("step"), total.alias("total_amount")))
    cap = quantiles(tagged.where("step IS NULL"), "total_amount", {"cap": p})["cap"]
    step = F.coalesce("step", F.when(F.col("total_amount") > F.lit(cap), "5 outlier").otherwise("6 kept"))
    return tagged.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("row_count"))


def strict_funnel(raw: DataFrame) -> DataFrame:
    """Rows removed by each strict rule, in order, before the outlier cut."""
    rule = (
        F.when(~F.coalesce(has_customer(), F.lit(False)), "1 no customer")
        .when(is_cancelled(), "2 cancelled")
        .when(F.col("quantity") <= 0, "3 non-positive quantity")
        .when(F.col("unit_price") <= 0, "4 non-positive price")
        .when(~is_product(), "5 not a product")
        .otherwise("6 kept")
    )
    return raw.groupBy(rule.alias("step")).agg(F.count(F.lit(1)).alias("row_count"))


def unique_violations(df: DataFrame, key: str, name: str) -> DataFrame:
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("constraint_name"), "violations")


def reference_violations(child: DataFrame, key: str, parent: DataFrame, name: str) -> DataFrame:
    """Child rows without a parent; children are counted per key first, so a frequent key is one row in the join."""
    keys = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    orphans = keys.join(parent.select(key), key, "left_anti")
    return orphans.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("violations")).select(
        F.lit(name).alias("constraint_name"), "violations")


def check_violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows failing each condition (NULL counts as failing), all in one scan."""
    one = df.agg(*[count_where(~F.coalesce(ok, F.lit(False))).alias(f"c{i}") for i, ok in enumerate(checks.values())])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("constraint_name"), F.col(f"c{i}").alias("violations"))
        for i, name in enumerate(checks)])))


def dq_constraints(products: DataFrame, customers: DataFrame, transactions: DataFrame, summary: DataFrame,
                   segments: DataFrame) -> DataFrame:
    """Violations of every declared key, reference, NOT NULL and range rule."""
    scores = {f"segments.{c} in 1..5": F.col(c).between(1, 5) for c in ("r_score", "f_score", "m_score")}
    reports = [
        unique_violations(products, "stock_code", "products.stock_code unique"),
        unique_violations(customers, "customer_id", "customers.customer_id unique"),
        unique_violations(summary, "customer_id", "customer_summary.customer_id unique"),
        unique_violations(segments, "customer_id", "segments.customer_id unique"),
        reference_violations(transactions, "stock_code", products, "transactions.stock_code in products"),
        reference_violations(transactions, "customer_id", customers, "transactions.customer_id in customers"),
        check_violations(products, {
            "products.description not null": F.col("description").isNotNull(),
            "products.unit_price >= 0": F.col("unit_price") >= 0,
        }),
        check_violations(transactions, {
            "transactions.invoice not null": F.col("invoice").isNotNull(),
            "transactions.invoice_date not null": F.col("invoice_date").isNotNull(),
            "transactions.quantity > 0": F.col("quantity") > 0,
            "transactions.unit_price > 0": F.col("unit_price") > 0,
        }),
        check_violations(segments, {"segments.segment_label not null": F.col("segment_label").isNotNull(), **scores}),
    ]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def dq_table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    result = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        result = one if result is None else result.unionByName(one)
    return result


def dq_revenue_sanity(transactions: DataFrame) -> DataFrame:
    total = money_sum("total_amount")
    return transactions.agg(
        round_to(total, 2).alias("total_revenue"),
        round_to(total / F.count(F.lit(1)), 2).alias("avg_line_item"),
        round_to(F.min("total_amount"), 2).alias("min_line_item"),
        round_to(F.max("total_amount"), 2).alias("max_line_item"),
    )


