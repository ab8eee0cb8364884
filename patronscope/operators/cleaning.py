"""Cleaning rules and dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .order_stats import order_statistics, quantiles

# Stock codes that are services, not products, and the shortest product code.
SERVICE_CODES = ("POST", "DOT", "M", "BANK CHARGES", "PADS", "D")
MIN_CODE_LENGTH = 5
OUTLIER_SHARE = 0.001
UNKNOWN_COUNTRY = "Unknown"


def has_customer() -> Column:
    return F.col("customer_id").isNotNull() & (F.trim("customer_id") != "")


def is_cancelled(case_sensitive: bool = False) -> Column:
    first = F.substring("invoice", 1, 1)
    return (first if case_sensitive else F.upper(first)) == "C"


def is_product() -> Column:
    """Long enough once trimmed, and not a service code as written (the list is tested on the untrimmed code)."""
    return (F.length(F.trim("stock_code")) >= MIN_CODE_LENGTH) & ~F.col("stock_code").isin(*SERVICE_CODES)


def is_sale() -> Column:
    return (F.col("quantity") > 0) & (F.col("unit_price") > 0)


def customer_number() -> Column:
    """Numeric id from text; '17850.0' reads as 17850, text that is no number gives NULL."""
    text = F.trim("customer_id")
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def valid_lines(raw: DataFrame) -> DataFrame:
    """Lines of known customers that are real sales, typed and trimmed, with the product rule kept as a flag.

    Both the fact table (products only) and the customer dimension (all lines) come from this one scan.
    """
    return (
        raw.where(has_customer() & ~is_cancelled() & is_sale())
        .select(
            F.trim("invoice").alias("invoice"),
            F.upper(F.trim("stock_code")).alias("stock_code"),
            F.trim("description").alias("description"),
            F.col("quantity").cast("int").alias("quantity"),
            "invoice_date",
            "unit_price",
            customer_number().alias("customer_id"),
            F.trim("country").alias("country"),
            (F.col("quantity") * F.col("unit_price")).alias("total_amount"),
            is_product().alias("is_product"),
        )
        .where(F.col("customer_id").isNotNull())
    )


def clean_sql_rules(raw: DataFrame) -> DataFrame:
    """The strict rule set: known customer, not cancelled, positive amounts, a product."""
    return valid_lines(raw.where(is_product())).drop("is_product")


def clean_py_rules(raw: DataFrame) -> DataFrame:
    """The lenient rule set: non-null customer, no 'C' invoice (case-sensitive), positive amounts; services stay."""
    return raw.where(
        F.col("customer_id").isNotNull() & ~F.col("invoice").startswith("C") & is_sale()
    ).withColumn("total_amount", F.col("quantity") * F.col("unit_price"))


def outlier_cap_disc(lines: DataFrame, value: str = "total_amount", top_share: float = OUTLIER_SHARE) -> float:
    """The (floor(share * n) + 1)-th largest value."""
    found = order_statistics(lines, value, {"cap": f"n - floor(n * {top_share!r}D)"}).first()
    return found["value"] if found else float("inf")


def outlier_cut_disc(lines: DataFrame, value: str = "total_amount", cap: float | None = None) -> DataFrame:
    """Drop the most extreme lines; the cap becomes a literal, so the filter reaches the scan."""
    return lines.where(F.col(value) <= F.lit(outlier_cap_disc(lines, value) if cap is None else cap))


def outlier_cut_interp(lines: DataFrame, value: str = "total_amount", p: float = 1 - OUTLIER_SHARE) -> DataFrame:
    """Keep values up to the interpolated quantile."""
    cap = quantiles(lines, value, {"cap": p})["cap"]
    return lines if cap is None else lines.where(F.col(value) <= F.lit(cap))


def products_dim(lines: DataFrame) -> DataFrame:
    """One row per stock code: the smallest (description, price) pair; codes without any description are left out."""
    first = F.min(F.struct("description", "unit_price"))
    return (
        lines.where(F.col("description").isNotNull())
        .groupBy("stock_code").agg(first.alias("first"))
        .select("stock_code", "first.description", "first.unit_price")
    )


def customers_dim(valid: DataFrame) -> DataFrame:
    """One row per customer with the alphabetically first country.

    Spark finds a smallest text by sorting, so lines collapse to the countries of a customer first, which takes a hash table.
    The optimizer would drop a plain ``distinct`` below a minimum; it keeps a count that is asked for.
    """
    country = F.coalesce("country", F.lit(UNKNOWN_COUNTRY)).alias("country")
    lived = valid.groupBy("customer_id", country).agg(F.count(F.lit(1)).alias("lines")).where("lines > 0")
    return lived.groupBy("customer_id").agg(F.min("country").alias("country"))


def time_features(df: DataFrame, column: str = "invoice_date") -> DataFrame:
    return df.withColumns({
        "year": F.year(column),
        "month": F.month(column),
        "day_of_week": F.date_format(column, "EEEE"),
        "hour": F.hour(column),
        "year_month": F.date_format(column, "yyyy-MM"),
    })


def customer_summary(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, items, revenue and purchase span per customer.

    Lines are aggregated before the dimension is joined: one row per customer meets one row per customer. The distinct
    invoice count is planned on (customer, invoice) first, so a very large customer is spread over many tasks.
    """
    from ..functions.numeric import money_sum, round_to

    per_customer = transactions.groupBy("customer_id").agg(
        F.count_distinct("invoice").alias("total_orders"),
        F.sum("quantity").alias("total_items"),
        round_to(money_sum("total_amount"), 2).alias("total_revenue"),
        F.min("invoice_date").alias("first_purchase"),
        F.max("invoice_date").alias("last_purchase"),
    )
    return with_order_value(per_customer.join(customers, "customer_id"))


def with_order_value(summary: DataFrame) -> DataFrame:
    """Generated column: average order value, 0 when there are no orders."""
    return summary.withColumn(
        "avg_order_value",
        F.when(F.col("total_orders") > 0, F.col("total_revenue") / F.col("total_orders")).otherwise(0.0),
    )


def with_line_total(lines: DataFrame) -> DataFrame:
    """Generated column: line total."""
    return lines.withColumn("total_amount", F.col("quantity") * F.col("unit_price"))
