"""Marketing strategy, revenue opportunity and churn insight tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numeric import money_avg, money_sum, round_to, share
from ..functions.segments import dashboard_band, dashboard_band_order

# Attributes of the strategy table, then one row of texts per segment.
STRATEGY_COLUMNS = ("segment", "emoji", "channel", "message", "offer", "goal", "kpi", "urgency", "budget_allocation",
                    "expected_roi", "risk")
STRATEGY = (
    ("Champions", "🏆", "Email + Loyalty App + VIP SMS",
     "You are our top customer — get early access and exclusive rewards",
     "Loyalty points × 2, Early access to new products, Free shipping", "Retain & upsell — grow basket size",
     "Repeat purchase rate, Average Order Value", "Low — they buy without prompting", "15% of marketing budget",
     "5–8× spend", "Low churn risk — focus on maintaining relationship"),
    ("Loyal Customers", "⭐", "Email + Push notifications",
     "Thank you for your loyalty — here is something special for you",
     "10% loyalty discount, Referral programme, Birthday reward", "Move to Champions tier",
     "Purchase frequency increase, NPS score", "Medium — nurture relationship", "25% of marketing budget",
     "3–5× spend", "Medium — could slip to At Risk without engagement"),
    ("Potential Loyal", "🌱", "Email + Retargeting ads",
     "We noticed you liked X — here are things you might love",
     "Free shipping on next order, 15% off second purchase", "Increase purchase frequency",
     "Second purchase rate, Email open rate", "High — window of opportunity before they forget brand",
     "25% of marketing budget", "2–3× spend", "Medium-high — haven't proven loyalty yet"),
    ("At Risk", "⚠️", "Win-back email sequence + Paid retargeting",
     "We miss you! Here is an exclusive offer to come back",
     "20% discount, Free gift with purchase, Extended return window", "Re-activate lapsed customers",
     "Reactivation rate, Revenue recovered", "Very High — every week of inaction = lower recovery probability",
     "25% of marketing budget", "1.5–2.5× spend", "High — act within 60 days or likely lost permanently"),
    ("Lost / Inactive", "💤", "Last-chance email, Survey",
     "Is everything OK? We would love to know what went wrong",
     "30% discount (last attempt), Feedback survey with incentive",
     "Minimal spend — identify reactivation vs write-off", "Response rate, Survey completion, Revenue per email sent",
     "Low priority for spend — focus budget on higher segments", "10% of marketing budget", "0.5–1.5× spend",
     "Very High — most will not reactivate"),
)
# Expected revenue uplift by segment, and for any other segment.
UPLIFT = {"Champions": 0.10, "Loyal Customers": 0.20, "Potential Loyal": 0.35, "At Risk": 0.15, "Lost / Inactive": 0.05}
DEFAULT_UPLIFT = 0.10
TOTAL = "Total Opportunity"
# Right-closed upper edges of the customer churn bands.
CUSTOMER_BANDS = (("Low", 0.10), ("Medium", 0.30), ("High", 0.65), ("Critical", 1.00))


def literal_table(spark: SparkSession, columns, rows) -> DataFrame:
    """A fixed lookup table as a plan of literals."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def strategy_dim(seg: DataFrame) -> DataFrame:
    """The strategy of every segment with its customers and revenue; a segment without customers shows 0."""
    held = seg.groupBy(F.col("segment_label").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), round_to(money_sum("monetary"), 0).alias("revenue"))
    plan = literal_table(seg.sparkSession, STRATEGY_COLUMNS, STRATEGY)
    return plan.join(held, "segment", "left").select(
        *STRATEGY_COLUMNS, F.coalesce("customers", F.lit(0)).alias("customers"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"))


def revenue_opportunity(seg: DataFrame) -> DataFrame:
    """Projected uplift per segment and a total row."""
    grouped = seg.groupBy(F.col("segment_label").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers"), money_sum("monetary").alias("revenue"),
        money_avg("monetary").alias("avg_revenue"), money_avg("clv_estimate").alias("avg_clv"))
    uplift = literal_table(seg.sparkSession, ("segment", "uplift"), list(UPLIFT.items()))
    pct = F.coalesce("uplift", F.lit(DEFAULT_UPLIFT))
    per_segment = grouped.join(F.broadcast(uplift), "segment", "left").select(
        "segment", "customers", round_to("revenue", 2).alias("total_revenue"),
        round_to("avg_revenue", 2).alias("avg_revenue"), round_to("avg_clv", 2).alias("avg_clv"),
        pct.alias("uplift_pct"), round_to(F.col("revenue") * pct, 0).alias("revenue_opportunity"))
    total = per_segment.agg(F.sum("customers").alias("customers"), F.sum("revenue_opportunity").alias("revenue_opportunity"))
    return per_segment.unionByName(
        total.withColumn("segment", F.lit(TOTAL)), allowMissingColumns=True)


def segment_treemap(seg: DataFrame) -> DataFrame:
    """Revenue and revenue-weighted mean score."""
    return seg.groupBy("segment_label").agg(
        round_to(money_sum("monetary"), 2).alias("revenue"),
        round_to(money_sum(F.col("monetary") * F.col("rfm_score")) / money_sum("monetary"), 4).alias("weighted_score"))


def customer_band(probability: str = "churn_probability"):
    expression = None
    for name, high in CUSTOMER_BANDS:
        test = F.col(probability) <= high
        expression = F.when(test, name) if expression is None else expression.when(test, name)
    return expression


def churn_risk_band(seg: DataFrame) -> DataFrame:
    return seg.groupBy("segment_label", customer_band().alias("churn_risk")).agg(F.count(F.lit(1)).alias("customers"))


def churn_risk_customers(seg: DataFrame) -> DataFrame:
    return seg.select("customer_id", "segment_label", "recency_days", "monetary", "churn_probability",
                      customer_band().alias("churn_risk"))


def revenue_by_risk_band(seg: DataFrame) -> DataFrame:
    return seg.groupBy(dashboard_band_order("churn_probability").alias("band_no"),
                       dashboard_band("churn_probability").alias("risk_band")).agg(
        round_to(money_sum("monetary"), 2).alias("revenue"))


def revenue_at_risk(seg: DataFrame, threshold: float = 0.60) -> DataFrame:
    risky = money_sum(F.when(F.col("churn_probability") >= threshold, F.col("monetary")).otherwise(0.0))
    return seg.agg(round_to(risky, 0).alias("revenue_at_risk"), share(risky, money_sum("monetary"), 1).alias("pct_of_revenue"))


def avg_churn(seg: DataFrame) -> DataFrame:
    return seg.groupBy("segment_label").agg(round_to(money_avg("churn_probability") * 100.0, 1).alias("avg_churn_pct"))


def bi_bundle(seg: DataFrame, summary: DataFrame) -> dict[str, DataFrame]:
    """The five related tables handed to reporting tools."""
    return {
        "customer_rfm": seg,
        "segment_summary": summary,
        "marketing_strategy": literal_table(seg.sparkSession, STRATEGY_COLUMNS, STRATEGY).drop("emoji"),
        "revenue_opportunity": revenue_opportunity(seg),
        "churn_risk": churn_risk_customers(seg),
    }


