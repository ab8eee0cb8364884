"""Business questions asked of the segment table and the clean transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import amount, count_where, money_avg, money_sum, round_to, share, units
from ..functions.segments import SEGMENTS, buyer_type, churn_band
from .numbering import number_rows
from .order_stats import order_statistics, top_sums
from .rfm import days_between

# Shares of customers reported by the concentration question.
PARETO_LEVELS = (10, 20, 30, 50)
# Percentiles reported for customer value.
VALUE_PERCENTILES = (10, 25, 50, 75, 90, 95, 99)
BEST_SEGMENTS = ("Champions", "Loyal Customers")
RISK_SEGMENTS = ("At Risk", "Lost / Inactive")
HIGH_CHURN = 0.60


def rows() -> Column:
    return F.count(F.lit(1))


def over_all(column) -> Column:
    """Total over a result that is already a handful of rows."""
    return F.sum(column).over(Window.partitionBy())


def month(column: str = "invoice_date"):
    return F.date_format(column, "yyyy-MM")


def seg_customer_share(seg: DataFrame) -> DataFrame:
    counted = seg.groupBy("segment_label").agg(rows().alias("customer_count"))
    return counted.withColumn("pct_of_total", share(F.col("customer_count"), over_all("customer_count"), 1))


def seg_profile(seg: DataFrame) -> DataFrame:
    return seg.groupBy("segment_label").agg(
        round_to(F.avg("recency_days"), 1).alias("avg_recency_days"),
        round_to(F.avg("frequency"), 1).alias("avg_frequency"),
        round_to(money_avg("monetary"), 0).alias("avg_monetary"),
        round_to(F.avg("rfm_score"), 1).alias("avg_rfm_score"),
        rows().alias("customers"),
    )


def pareto(seg: DataFrame) -> DataFrame:
    """Revenue share of the top 10/20/30/50 % of customers, at the last row whose rounded percentage is the level."""
    # round(100 * rn / n) = level  <=>  level - 0.5 <= 100 * rn / n < level + 0.5
    sizes = {str(p): f"ceil((2 * {p} + 1) * n / 200) - 1" for p in PARETO_LEVELS}
    first = " ".join(f"WHEN '{p}' THEN ceil((2 * {p} - 1) * n / 200)" for p in PARETO_LEVELS)
    sums = top_sums(seg, "monetary", sizes).where(f"k >= CASE stat {first} END")
    return sums.select(
        F.col("stat").cast("int").alias("top_n_pct_customers"),
        share(F.col("top_sum"), F.col("total_sum"), 1).alias("pct_revenue_captured"),
    )


def pareto_rows(seg: DataFrame) -> DataFrame:
    """Every customer rank whose rounded percentage is a reported level, with the cumulative revenue share there."""
    numbered = number_rows(seg.select("customer_id", "monetary"), [F.col("monetary").desc(), F.col("customer_id")],
                           running=units("monetary"))
    totals = F.broadcast(seg.agg(F.sum(units("monetary")).alias("total"), rows().alias("n")))
    pct = round_to(F.col("rn") * 100.0 / F.col("n"), 0)
    return (
        numbered.join(totals)
        .withColumn("pct", pct).where(F.col("pct").isin(*[float(p) for p in PARETO_LEVELS]))
        .select("rn", F.col("pct").cast("int").alias("top_n_pct_customers"),
                share(amount(F.col("running_total")), amount(F.col("total")), 1).alias("pct_revenue_captured"))
    )


def churn_by_segment(seg: DataFrame) -> DataFrame:
    return seg.groupBy("segment_label", churn_band("churn_probability").alias("churn_risk_band")).agg(
        rows().alias("customers"), round_to(money_sum("monetary"), 0).alias("revenue_at_risk"))


def churn_bands(seg: DataFrame) -> DataFrame:
    return seg.groupBy(churn_band("churn_probability").alias("churn_risk")).agg(
        rows().alias("customers"), round_to(money_sum("monetary"), 0).alias("revenue_at_risk"))


def top_champions(profile: DataFrame, k: int = 10) -> DataFrame:
    return (
        profile.where(F.col("segment_label") == SEGMENTS[0])
        .select("customer_id", "country", "recency_days", "frequency", "monetary", "rfm_score", "clv_estimate",
                "segment_label")
        .orderBy(F.desc("monetary"), "customer_id").limit(k)
    )


def monthly_activity(transactions: DataFrame) -> DataFrame:
    """Invoices, customers and revenue per month.

    Lines collapse to (month, customer, invoice) first; the two distinct counts then come from that much smaller table
    through one more level each instead of expanding every line twice.
    """
    return _monthly(transactions).select(
        "year_month", "invoices", "customers", round_to("revenue", 0).alias("revenue"))


def _monthly(transactions: DataFrame) -> DataFrame:
    visits = transactions.groupBy(month().alias("year_month"), "customer_id", "invoice").agg(
        F.sum(units("total_amount")).alias("u"))
    return visits.groupBy("year_month").agg(
        F.count_distinct("invoice").alias("invoices"),
        F.count_distinct("customer_id").alias("customers"),
        amount(F.sum("u")).alias("revenue"),
    )


def mom_revenue(transactions: DataFrame) -> DataFrame:
    """Month-over-month change; the window runs over one row per month."""
    months = Window.orderBy("year_month")
    before = F.lag("revenue").over(months)
    change = (F.col("revenue") - before) / F.nullif(before, F.lit(0.0)) * 100.0
    return _monthly(transactions).select(
        "year_month", F.col("invoices").alias("orders"), F.col("customers").alias("active_customers"),
        round_to("revenue", 0).alias("revenue"), round_to(change, 1).alias("mom_growth_pct"))


def running_revenue(transactions: DataFrame) -> DataFrame:
    monthly = transactions.groupBy(month().alias("year_month")).agg(F.sum(units("total_amount")).alias("u"))
    so_far = Window.orderBy("year_month").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select(
        "year_month", round_to(amount(F.col("u")), 0).alias("monthly_revenue"),
        round_to(amount(F.sum("u").over(so_far)), 0).alias("cumulative_revenue"))


def cohort_segment_mix(seg: DataFrame, summary: DataFrame) -> DataFrame:
    first = summary.select("customer_id", month("first_purchase").alias("acquisition_cohort"))
    return seg.join(first, "customer_id").groupBy("acquisition_cohort", "segment_label").agg(
        rows().alias("customers"), round_to(money_avg("monetary"), 0).alias("avg_spend"))


def rf_heatmap(seg: DataFrame) -> DataFrame:
    return seg.groupBy("r_score", "f_score").agg(
        rows().alias("customers"), round_to(money_avg("monetary"), 0).alias("avg_monetary"),
        round_to(F.avg("m_score"), 1).alias("avg_m_score"))


def winback_list(profile: DataFrame, k: int = 50) -> DataFrame:
    priority = round_to(F.col("monetary") * F.col("churn_probability"), 0).alias("win_back_priority_score")
    return (
        profile.where(F.col("segment_label") == "At Risk")
        .select("customer_id", "country", "recency_days", "frequency", "monetary", "clv_estimate",
                "churn_probability", priority)
        .orderBy(F.desc("win_back_priority_score"), "customer_id").limit(k)
    )


def _affinity(seg: DataFrame, transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Lines and revenue per segment and product.

    The line table is reduced to (segment, stock code) before descriptions are joined, so the product table meets one row
    per product and segment rather than every line.
    """
    best = seg.where(F.col("segment_label").isin(*BEST_SEGMENTS)).select("customer_id", "segment_label")
    by_code = (
        transactions.select("customer_id", "stock_code", "total_amount").join(best, "customer_id")
        .groupBy("segment_label", "stock_code").agg(rows().alias("c"), F.sum(units("total_amount")).alias("u"))
    )
    return (
        by_code.join(products.select("stock_code", "description"), "stock_code")
        .groupBy("segment_label", "description")
        .agg(F.sum("c").alias("purchase_count"), round_to(amount(F.sum("u")), 0).alias("revenue"))
    )


def product_affinity(seg: DataFrame, transactions: DataFrame, products: DataFrame, k: int = 20) -> DataFrame:
    return _affinity(seg, transactions, products).orderBy("segment_label", F.desc("revenue"), "description").limit(k)


def product_affinity_topk(seg: DataFrame, transactions: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    best = Window.partitionBy("segment_label").orderBy(F.desc("revenue"), "description")
    return _affinity(seg, transactions, products).withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k)


def kpi_summary(seg: DataFrame) -> DataFrame:
    champion = F.col("segment_label") == SEGMENTS[0]
    risky = F.col("churn_probability") >= HIGH_CHURN
    at_risk = money_sum(F.when(risky, F.col("monetary")).otherwise(0.0))
    return seg.agg(
        rows().alias("total_customers"),
        round_to(money_sum("monetary"), 0).alias("total_revenue"),
        round_to(F.avg("recency_days"), 1).alias("avg_recency_days"),
        round_to(F.avg("frequency"), 1).alias("avg_frequency"),
        round_to(money_avg("monetary"), 0).alias("avg_monetary"),
        round_to(money_avg("clv_estimate"), 0).alias("avg_clv_estimate"),
        count_where(champion).alias("champion_count"),
        round_to(money_sum(F.when(champion, F.col("monetary")).otherwise(0.0)), 0).alias("champion_revenue"),
        round_to(at_risk, 0).alias("revenue_at_high_churn_risk"),
        share(at_risk, money_sum("monetary"), 1).alias("pct_revenue_at_risk"),
    )


def column_name(segment: str) -> str:
    return segment.lower().replace(" / ", "_").replace(" ", "_")


def segment_pivot(seg: DataFrame) -> DataFrame:
    """Six metrics by segment from one aggregation: rows become metrics, columns become segments."""
    metrics = {
        "Customer Count": "customers", "Total Revenue": "revenue", "Avg Recency (days)": "recency",
        "Avg Orders": "orders", "Avg Monetary": "monetary", "Avg CLV Estimate": "clv",
    }
    by_segment = seg.groupBy("segment_label").agg(
        rows().cast("double").alias("customers"),
        round_to(money_sum("monetary"), 0).alias("revenue"),
        round_to(F.avg("recency_days"), 1).alias("recency"),
        round_to(F.avg("frequency"), 1).alias("orders"),
        round_to(money_avg("monetary"), 0).alias("monetary"),
        round_to(money_avg("clv_estimate"), 0).alias("clv"),
    )
    long = by_segment.select("segment_label", F.inline(F.array(*[
        F.struct(F.lit(label).alias("metric"), F.col(c).alias("v")) for label, c in metrics.items()])))
    wide = long.groupBy("metric").pivot("segment_label", list(SEGMENTS)).agg(F.max("v"))
    additive = F.col("metric").isin("Customer Count", "Total Revenue")
    return wide.select("metric", *[
        F.when(additive, F.coalesce(F.col(f"`{s}`"), F.lit(0.0))).otherwise(F.col(f"`{s}`")).alias(column_name(s))
        for s in SEGMENTS
    ])


def buyer_types(seg: DataFrame) -> DataFrame:
    grouped = seg.groupBy(buyer_type("frequency").alias("buyer_type")).agg(
        rows().alias("customers"), money_sum("monetary").alias("revenue"), money_avg("monetary").alias("spend"))
    return grouped.select(
        "buyer_type", "customers",
        share(F.col("customers"), over_all("customers"), 1).alias("pct_customers"),
        round_to("revenue", 0).alias("total_revenue"),
        share(F.col("revenue"), over_all("revenue"), 1).alias("pct_revenue"),
        round_to("spend", 0).alias("avg_spend_per_customer"),
    )


def geo_segments(profile: DataFrame, min_customers: int = 5, k: int = 15) -> DataFrame:
    return (
        profile.groupBy("country").agg(
            rows().alias("customers"),
            round_to(money_sum("monetary"), 0).alias("total_revenue"),
            round_to(F.avg("rfm_score"), 1).alias("avg_rfm_score"),
            count_where(F.col("segment_label") == SEGMENTS[0]).alias("champions"),
            count_where(F.col("segment_label").isin(*RISK_SEGMENTS)).alias("high_risk_customers"),
        )
        .where(F.col("customers") >= min_customers)
        .orderBy(F.desc("total_revenue"), "country").limit(k)
    )


def monetary_percentiles(seg: DataFrame) -> DataFrame:
    """Customer value standing at row floor(p * n) in ascending order; no row where that is row 0."""
    ranks = {str(p): f"({p} * n) div 100" for p in VALUE_PERCENTILES}
    return order_statistics(seg, "monetary", ranks).select(
        F.col("stat").cast("int").alias("percentile"), round_to("value", 2).alias("monetary_value"))


def purchase_gaps(transactions: DataFrame, seg: DataFrame) -> DataFrame:
    """Days between consecutive purchases of a customer, per segment; gaps under one day do not count.

    Two purchases on the same calendar day are always less than a day apart, so only the first and last purchase of a
    day matter. One row per customer and day bounds the window however many lines a customer has.
    """
    days = transactions.groupBy("customer_id", F.col("invoice_date").cast("date").alias("day")).agg(
        F.min("invoice_date").alias("first_at"), F.max("invoice_date").alias("last_at"))
    previous = F.lag("last_at").over(Window.partitionBy("customer_id").orderBy("day"))
    gaps = (
        days.withColumn("gap", days_between(F.col("first_at"), previous))
        .where(F.col("gap") > 0)
        .groupBy("customer_id")
        .agg(F.sum("gap").alias("s"), rows().alias("c"), F.min("gap").alias("lo"), F.max("gap").alias("hi"))
    )
    return gaps.join(seg.select("customer_id", "segment_label"), "customer_id").groupBy("segment_label").agg(
        round_to(F.sum("s") / F.sum("c"), 1).alias("avg_days_between_orders"),
        F.min("lo").alias("min_days_between"), F.max("hi").alias("max_days_between"),
        rows().alias("customers_with_repeat_orders"))


def rfm_export(profile: DataFrame) -> DataFrame:
    return profile.select(
        "customer_id", "country", F.col("recency_days").alias("recency"), "frequency", "monetary", "r_score", "f_score",
        "m_score", "rfm_score", "rfm_segment_code", F.col("segment_label").alias("segment"), "churn_probability",
        "clv_estimate")


def segment_summary(seg: DataFrame) -> DataFrame:
    grouped = seg.groupBy(F.col("segment_label").alias("segment")).agg(
        rows().alias("customers"),
        round_to(F.avg("recency_days"), 1).alias("avg_recency"),
        round_to(F.avg("frequency"), 1).alias("avg_frequency"),
        round_to(money_avg("monetary"), 0).alias("avg_monetary"),
        money_sum("monetary").alias("revenue"),
        round_to(money_avg("clv_estimate"), 0).alias("avg_clv"),
        money_avg("churn_probability").alias("churn"),
    )
    return grouped.select(
        "segment", "customers", "avg_recency", "avg_frequency", "avg_monetary",
        round_to("revenue", 0).alias("total_revenue"), "avg_clv",
        round_to("churn", 2).alias("avg_churn_probability"),
        round_to(F.col("churn") * 100.0, 1).alias("avg_churn_pct"),
        share(F.col("customers"), over_all("customers"), 1).alias("pct_customers"),
        share(F.col("revenue"), over_all("revenue"), 1).alias("pct_revenue"),
    )


def transaction_export(transactions: DataFrame, profile: DataFrame, products: DataFrame) -> DataFrame:
    """Line-level export with country, segment and product name.

    Country and segment share the customer key and arrive in one join; an oversized customer's lines are split by the
    adaptive skew join.
    """
    buyer = profile.select("customer_id", "country", "segment_label")
    item = products.select("stock_code", F.col("description").alias("product"))
    lines = transactions.select("invoice", "invoice_date", "customer_id", "stock_code", "quantity", "unit_price", "total_amount")
    return lines.join(buyer, "customer_id").join(item, "stock_code").select(
        "invoice", F.date_format("invoice_date", "yyyy-MM-dd").alias("invoice_date"), month().alias("year_month"),
        "customer_id", "country", "segment_label", "product", "quantity", "unit_price",
        round_to("total_amount", 2).alias("line_total"))


def seg_revenue(seg: DataFrame) -> DataFrame:
    return seg.groupBy("segment_label").agg(
        round_to(money_sum("monetary"), 0).alias("total_revenue"),
        round_to(money_avg("monetary"), 0).alias("avg_monetary"))


def top_customers(summary: DataFrame, k: int = 5) -> DataFrame:
    return summary.select("customer_id", "total_orders", "total_revenue", "country").orderBy(
        F.desc("total_revenue"), "customer_id").limit(k)


def top_countries(transactions: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    """Customers and revenue per country; lines collapse to one row per customer before the join."""
    spend = transactions.groupBy("customer_id").agg(F.sum(units("total_amount")).alias("u"))
    return spend.join(customers, "customer_id").groupBy("country").agg(
        rows().alias("customers"), round_to(amount(F.sum("u")), 0).alias("revenue")
    ).orderBy(F.desc("revenue"), "country").limit(k)
