"""Exploratory aggregates: the numbers behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import amount, equal_width_bin, money_avg, money_sum, round_to, units
from .order_stats import group_quantiles
from .rfm import METRICS

# Weekdays in calendar order.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def histogram(df: DataFrame, value: Column, bins: int, by: Sequence[str] = (), count: str = "n") -> DataFrame:
    """Equal-width histogram between the minimum and maximum of each group: group, bin, lower edge, count."""
    keys = list(by)
    rows = df.select(*keys, value.cast("double").alias("_x")).where("_x IS NOT NULL")
    limits = F.broadcast(rows.groupBy(*keys).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
    joined = rows.join(limits, keys) if keys else rows.join(limits)
    edge = F.col("_lo") + F.col("bin") * ((F.col("_hi") - F.col("_lo")) / float(bins))
    return (
        joined.groupBy(*keys, "_lo", "_hi", equal_width_bin(F.col("_x"), F.col("_lo"), F.col("_hi"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias(count))
        .select(*keys, "bin", round_to(edge, 4).alias("bin_start"), count)
    )


def monthly_revenue_peak(retail: DataFrame) -> DataFrame:
    monthly = retail.groupBy("year_month").agg(money_sum("total_amount").alias("revenue"))
    best = Window.orderBy(F.desc("revenue"), "year_month")
    return monthly.select("year_month", round_to("revenue", 2).alias("revenue"),
                          (F.row_number().over(best) == 1).alias("is_peak"))


def _top_revenue(retail: DataFrame, key: str, k: int) -> DataFrame:
    return (
        retail.where(F.col(key).isNotNull()).groupBy(key)
        .agg(round_to(money_sum("total_amount"), 2).alias("revenue"))
        .orderBy(F.desc("revenue"), key).limit(k)
    )


def country_revenue(retail: DataFrame, k: int = 10) -> DataFrame:
    return _top_revenue(retail, "country", k)


def top_products(retail: DataFrame, k: int = 10) -> DataFrame:
    return _top_revenue(retail, "description", k)


def order_value_hist(retail: DataFrame, bins: int = 50, cap: float = 500.0) -> DataFrame:
    """Two histograms of revenue per invoice: values up to ``cap``, and log1p of all values."""
    orders = retail.groupBy("invoice").agg(amount(F.sum(units("total_amount"))).alias("v"))
    views = F.array(
        F.struct(F.lit("capped").alias("scale"), F.when(F.col("v") <= cap, F.col("v")).alias("x")),
        F.struct(F.lit("log1p").alias("scale"), F.log1p("v").alias("x")),
    )
    return histogram(orders.select(F.inline(views)), F.col("x"), bins, ["scale"], "orders")


def purchase_frequency(retail: DataFrame, bins: int = 30, cap: int = 30) -> DataFrame:
    """Orders per customer: histogram up to ``cap`` orders, with mean and median over all customers."""
    per_customer = retail.groupBy("customer_id").agg(F.count_distinct("invoice").alias("orders"))
    overall = F.broadcast(
        per_customer.agg(F.avg("orders").alias("mean")).join(
            F.broadcast(group_quantiles(per_customer, "orders", {"median": 0.5}).drop("n"))))
    bars = histogram(per_customer.where(F.col("orders") <= cap), F.col("orders"), bins, count="customers")
    return bars.join(overall).select(
        "bin", "bin_start", "customers", round_to("mean", 4).alias("mean"), F.col("median").cast("double").alias("median"))


def dow_revenue(retail: DataFrame) -> DataFrame:
    """Revenue per weekday, Monday first; a weekday without sales keeps NULL."""
    week = retail.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(d) for d in WEEKDAYS])).alias("day_no", "day_of_week"))
    sales = retail.groupBy("day_of_week").agg(round_to(money_sum("total_amount"), 2).alias("revenue"))
    return week.join(sales, "day_of_week", "left").select("day_no", "day_of_week", "revenue")


def rfm_score_hist(seg: DataFrame) -> DataFrame:
    return seg.groupBy("rfm_score", "segment_label").agg(F.count(F.lit(1)).alias("customers"))


def segment_box(seg: DataFrame, columns: Sequence[str] = METRICS) -> DataFrame:
    """Box-plot numbers per segment and metric: quartiles, whiskers at 1.5 inter-quartile ranges, mean."""
    long = seg.select("segment_label", F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("x")) for c in columns])))
    keys = ["segment_label", "metric"]
    boxes = F.broadcast(group_quantiles(long, "x", {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside_low, inside_high = F.col("x") >= F.col("q1") - reach, F.col("x") <= F.col("q3") + reach
    return (
        long.join(boxes, keys).groupBy(*keys, "q1", "median", "q3")
        .agg(F.min(F.when(inside_low, F.col("x"))).alias("low"), F.max(F.when(inside_high, F.col("x"))).alias("high"),
             money_avg("x").alias("mean"))
        .select(*keys, *[round_to(c, 4).alias(c) for c in ("q1", "median", "q3", "low", "high", "mean")])
    )


def recency_frequency_density(seg: DataFrame, recency_bins: int = 20, frequency_bins: int = 15) -> DataFrame:
    limits = F.broadcast(seg.agg(
        F.min("recency_days").alias("r0"), F.max("recency_days").alias("r1"),
        F.min("frequency").alias("f0"), F.max("frequency").alias("f1")))
    return seg.join(limits).groupBy(
        equal_width_bin(F.col("recency_days"), F.col("r0"), F.col("r1"), recency_bins).alias("recency_bin"),
        equal_width_bin(F.col("frequency"), F.col("f0"), F.col("f1"), frequency_bins).alias("frequency_bin"),
    ).agg(F.count(F.lit(1)).alias("customers"))


def segment_radar(seg: DataFrame) -> DataFrame:
    return seg.groupBy("segment_label").agg(*[
        round_to(F.avg(c), 4).alias(f"avg_{c}") for c in ("r_score", "f_score", "m_score")])


def describe_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of numeric columns, one row per column."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in columns])))
    boxes = F.broadcast(group_quantiles(long, "x", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ["column_name"]).drop("n"))
    basic = long.groupBy("column_name").agg(
        F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"), F.max("x").alias("max"))
    return basic.join(boxes, "column_name", "left").select(
        "column_name", "n", *[round_to(c, 4).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


