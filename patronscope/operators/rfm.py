"""Recency, frequency and monetary scores, segments and scaled features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import equal_width_bin, money_avg, round_to, share
from ..functions.segments import churn_probability, clv_proxy, segment_label
from .numbering import rank_values
from .order_stats import bucket_by_cuts, group_quantiles, key_cuts, ntile_ranks, quantile_cut_ranks

SCORES = 5
METRICS = ("recency_days", "frequency", "monetary")
_DAY = 86_400


def _epoch(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp"))


def _snapshot(last: Column, flavour: str) -> Column:
    if flavour == "midnight":
        return F.date_add(last.cast("date"), 1).cast("timestamp_ntz")
    if flavour == "exact":
        return F.timestamp_add("DAY", F.lit(1), last)
    raise ValueError(f"unknown snapshot {flavour!r}")


def rfm_snapshot(transactions: DataFrame) -> DataFrame:
    """Both reference dates: midnight after the last purchase, and the last purchase plus one day."""
    last = transactions.agg(F.max("invoice_date").alias("last_purchase"))
    return last.select(
        "last_purchase",
        _snapshot(F.col("last_purchase"), "midnight").alias("midnight"),
        _snapshot(F.col("last_purchase"), "exact").alias("exact"),
    )


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days elapsed, counted in seconds: 23 hours are 0 days even across midnight."""
    return F.floor((_epoch(later) - _epoch(earlier)) / _DAY).cast("int")


def rfm_raw(summary: DataFrame, snapshot: str = "midnight") -> DataFrame:
    """Recency, frequency and monetary value of customers with at least one order and positive revenue.

    The reference date is fetched first (one value), so the table itself is a plain projection of the summary.
    """
    at = summary.agg(_snapshot(F.max("last_purchase"), snapshot).cast("string").alias("at")).first()["at"]
    return (
        summary.where((F.col("total_orders") >= 1) & (F.col("total_revenue") > 0))
        .select(
            "customer_id",
            days_between(F.lit(at).cast("timestamp_ntz"), F.col("last_purchase")).alias("recency_days"),
            F.col("total_orders").alias("frequency"),
            F.col("total_revenue").alias("monetary"),
        )
    )


def rfm_ranks(raw: DataFrame) -> DataFrame:
    """RANK of recency (ascending) and monetary (descending), DENSE_RANK of frequency (descending), customer total.

    Ranks are computed over distinct values and joined back by value. Recency and frequency have few distinct values, so
    their tables are broadcast when small; a value shared by very many customers is split by the adaptive skew join.
    """
    recency = rank_values(raw, "recency_days").select("recency_days", F.col("rank").alias("recency_rank"))
    orders = rank_values(raw, "frequency", ascending=False).select("frequency", F.col("dense_rank").alias("frequency_rank"))
    spend = rank_values(raw, "monetary", ascending=False).select("monetary", F.col("rank").alias("monetary_rank"))
    total = F.broadcast(raw.agg(F.count(F.lit(1)).alias("total_customers")))
    return raw.join(recency, "recency_days").join(orders, "frequency").join(spend, "monetary").join(total).select(
        "customer_id", *METRICS, "recency_rank", "frequency_rank", "monetary_rank", "total_customers")


def rfm_scores(raw: DataFrame, method: str = "ntile", direction: str = "best_high") -> DataFrame:
    """Scores 1-5 for each metric.

    ``method``: ``ntile`` (larger buckets first) or ``qcut`` (row numbers cut at interpolated quintiles).
    ``direction``: ``best_high`` gives the best customer 5 throughout; ``sql_as_written`` ranks frequency and monetary
    descending and keeps the bucket number, so the best customer gets 1 there.
    Ties are ordered by customer id. Twelve cut points are selected exactly, then each score is a comparison with
    literals: no shuffle and no global window touches the customer rows.
    """
    ranks = {"ntile": ntile_ranks, "qcut": quantile_cut_ranks}[method](SCORES)
    as_written = direction == "sql_as_written"
    if direction not in ("best_high", "sql_as_written"):
        raise ValueError(f"unknown direction {direction!r}")
    # qcut numbers rows from the best down; ntile in the stated order of each metric.
    falling = as_written or method == "qcut"
    sign = "-" if falling else ""
    order = {"recency_days": "recency_days", "frequency": f"{sign}frequency", "monetary": f"{sign}monetary"}
    cuts = key_cuts(raw, order, "customer_id", ranks)
    buckets = {
        metric: bucket_by_cuts(expression, "customer_id", [c for c in cuts if c["metric"] == metric])
        for metric, expression in order.items()
    }
    reverse = SCORES + 1
    spending = (lambda b: b) if as_written or not falling else (lambda b: reverse - b)
    return raw.withColumns({
        "r_score": (reverse - buckets["recency_days"]).cast("int"),
        "f_score": spending(buckets["frequency"]).cast("int"),
        "m_score": spending(buckets["monetary"]).cast("int"),
    })


def rfm_score_code(scored: DataFrame) -> DataFrame:
    """Total score and three-digit code; rows with a score outside 1-5 are dropped."""
    parts = ("r_score", "f_score", "m_score")
    valid = scored
    for part in parts:
        valid = valid.where(F.col(part).between(1, SCORES))
    return valid.withColumns({
        "rfm_score": F.col("r_score") + F.col("f_score") + F.col("m_score"),
        "rfm_segment_code": F.concat(*[F.col(p).cast("string") for p in parts]),
    })


def rfm_segments(raw: DataFrame, method: str = "ntile", direction: str = "best_high") -> DataFrame:
    """The main table: one row per customer with scores, segment, churn probability and value estimate."""
    coded = rfm_score_code(rfm_scores(raw, method, direction))
    return coded.select(
        "customer_id", "recency_days", "frequency", round_to("monetary", 2).alias("monetary"),
        "r_score", "f_score", "m_score", "rfm_score", "rfm_segment_code",
        segment_label("rfm_score").alias("segment_label"),
        churn_probability("recency_days").alias("churn_probability"),
        clv_proxy("monetary", "recency_days").alias("clv_estimate"),
    )


def rfm_scaled(rfm: DataFrame, columns: Sequence[str] = METRICS, names: Sequence[str] = ("r_scaled", "f_scaled", "m_scaled"),
               log: bool = True) -> DataFrame:
    """log1p, then zero mean and unit population standard deviation; the two parameters per column are one broadcast row."""
    value = {c: F.log1p(F.col(c)) if log else F.col(c).cast("double") for c in columns}
    fitted = F.broadcast(rfm.agg(
        *[F.avg(v).alias(f"_mean_{c}") for c, v in value.items()],
        *[F.stddev_pop(v).alias(f"_std_{c}") for c, v in value.items()],
    ))

    def scaled(c: str) -> Column:
        spread = F.when(F.col(f"_std_{c}") == 0, 1.0).otherwise(F.col(f"_std_{c}"))
        return (value[c] - F.col(f"_mean_{c}")) / spread

    return rfm.join(fitted).select(*rfm.columns, *[scaled(c).alias(n) for c, n in zip(columns, names)])


def rfm_distribution(rfm: DataFrame, bins: int = 40, columns: Sequence[str] = METRICS) -> DataFrame:
    """Histogram of every metric with its mean and median; empty bins are not listed."""
    long = rfm.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("x")) for c in columns])))
    limits = F.broadcast(long.groupBy("metric").agg(
        F.min("x").alias("low"), F.max("x").alias("high"), money_avg("x").alias("mean")))
    median = F.broadcast(group_quantiles(long, "x", {"median": 0.5}, ["metric"]).drop("n"))
    return (
        long.join(limits, "metric")
        .groupBy("metric", "low", "high", "mean", equal_width_bin(F.col("x"), F.col("low"), F.col("high"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("customers"))
        .join(median, "metric")
        .select("metric", "bin", "customers", round_to("mean", 4).alias("mean"), round_to("median", 4).alias("median"))
    )


def segment_counts(rfm: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    counted = rfm.groupBy("segment_label").agg(F.count(F.lit(1)).alias("customers"))
    return counted.withColumn("pct", share(F.col("customers"), F.sum("customers").over(Window.partitionBy()), 1))
