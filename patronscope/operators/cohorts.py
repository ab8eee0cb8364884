"""Cohort retention.

Everything but the row-level assignment starts from one row per customer and active month. However many lines a customer
has, that is at most one row per calendar month, so the per-customer window stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import amount, round_to, units


def _month_start(column: str) -> Column:
    return F.trunc(column, "MM")


def _offset(later: str, earlier: str) -> Column:
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("int")


def customer_months(transactions: DataFrame) -> DataFrame:
    """One row per customer and active month with lines, revenue units, cohort month and month offset."""
    active = transactions.groupBy("customer_id", _month_start("invoice_date").alias("order_month")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(units("total_amount")).alias("revenue_units"))
    first = F.min("order_month").over(Window.partitionBy("customer_id"))
    return active.withColumn("cohort_month", first).withColumn("cohort_index", _offset("order_month", "cohort_month"))


def cohort_assign(transactions: DataFrame) -> DataFrame:
    """Every line with its order month, the customer's first month and the offset between them.

    The first month is a map-side combined aggregate joined back, not a window over a customer's lines; an oversized
    customer's lines are split by the adaptive skew join.
    """
    first = transactions.groupBy("customer_id").agg(_month_start(F.min("invoice_date")).alias("cohort_month"))
    return (
        transactions.withColumn("order_month", _month_start("invoice_date"))
        .join(first, "customer_id")
        .withColumn("cohort_index", _offset("order_month", "cohort_month"))
    )


def cohort_counts(months: DataFrame) -> DataFrame:
    """Customers per cohort and offset; a customer has one row per month, so a plain count is distinct."""
    return months.groupBy("cohort_month", "cohort_index").agg(F.count(F.lit(1)).alias("customers"))


def _pivot(long: DataFrame, value: str, at_least: int) -> DataFrame:
    """Cohorts as rows, offsets as columns m0, m1, ...; a cell without customers stays NULL.

    Every offset in the data gets a column; ``at_least`` asks for more, for a stable schema.
    """
    last = long.agg(F.max("cohort_index")).first()[0]
    offsets = list(range(max(at_least, (last if last is not None else -1) + 1)))
    wide = long.groupBy(F.date_format("cohort_month", "yyyy-MM").alias("cohort")).pivot("cohort_index", offsets).agg(F.max(value))
    return wide.withColumnsRenamed({str(i): f"m{i}" for i in offsets})


def cohort_matrix(months: DataFrame, at_least: int = 0) -> DataFrame:
    return _pivot(cohort_counts(months), "customers", at_least)


def cohort_sizes(months: DataFrame) -> DataFrame:
    return cohort_counts(months).where(F.col("cohort_index") == 0).select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort"), F.col("customers").alias("size"))


def cohort_extent(months: DataFrame) -> DataFrame:
    return months.agg(F.count_distinct("cohort_month").alias("cohorts"), F.max("cohort_index").alias("max_index"))


def retention_long(months: DataFrame) -> DataFrame:
    """Retention per cohort and offset, four decimals; the cohort's own size is its offset-0 count."""
    size = F.max(F.when(F.col("cohort_index") == 0, F.col("customers"))).over(Window.partitionBy("cohort_month"))
    return cohort_counts(months).withColumn("retention", round_to(F.col("customers") / size, 4))


def retention_matrix(months: DataFrame, at_least: int = 0) -> DataFrame:
    return _pivot(retention_long(months), "retention", at_least)


def retention_table(months: DataFrame) -> DataFrame:
    return retention_long(months).select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort"), "cohort_index", "customers", "retention")


def _revenue(months: DataFrame, divisor: str) -> DataFrame:
    by_cell = months.groupBy("cohort_month", "cohort_index").agg(
        F.sum("revenue_units").alias("u"), F.sum("lines").alias("lines"), F.count(F.lit(1)).alias("customers"))
    return by_cell.withColumn("revenue", round_to(amount(F.col("u")) / F.col(divisor), 2))


def revenue_cohort(months: DataFrame, at_least: int = 0) -> DataFrame:
    """Mean line amount per cohort and offset."""
    return _pivot(_revenue(months, "lines"), "revenue", at_least)


def revenue_cohort_per_customer(months: DataFrame, at_least: int = 0) -> DataFrame:
    """Mean revenue per active customer per cohort and offset."""
    return _pivot(_revenue(months, "customers"), "revenue", at_least)


def retention_curve(months: DataFrame) -> DataFrame:
    """Mean and sample deviation of retention over cohorts at every offset, in percent, with a clipped band.

    Rates have four decimals, so sums and sums of squares are exact integers and do not depend on row order.
    """
    rate = F.floor(F.col("retention") * 10_000 + 0.5)
    sums = retention_long(months).groupBy("cohort_index").agg(
        F.count(F.lit(1)).alias("n"), F.sum(rate).alias("s"), F.sum(rate * rate).alias("q"))
    mean = F.col("s") / F.col("n") / 100.0
    variance = (F.col("q") - F.col("s").cast("double") * F.col("s") / F.col("n")) / F.nullif(F.col("n") - 1, F.lit(0))
    spread = F.sqrt(F.greatest(variance, F.lit(0.0))) / 100.0
    return sums.select(
        "cohort_index", F.col("n").alias("cohorts"), round_to(mean, 4).alias("avg_retention"),
        round_to(F.when(F.col("n") > 1, spread), 4).alias("std_retention"),
        round_to(F.when(F.col("n") > 1, F.greatest(mean - spread, F.lit(0.0))), 4).alias("band_low"),
        round_to(F.when(F.col("n") > 1, F.least(mean + spread, F.lit(100.0))), 4).alias("band_high"))


def retention_kpis(months: DataFrame) -> DataFrame:
    """Mean retention one and three months in, and the best and worst cohort at month three (earliest on a tie)."""
    cell = retention_long(months)
    label = F.date_format("cohort_month", "yyyy-MM")
    third = F.col("cohort_index") == 3
    rate = F.floor(F.col("retention") * 10_000 + 0.5)

    def mean(i: int) -> Column:
        at = F.col("cohort_index") == i
        return F.sum(F.when(at, rate)) / F.nullif(F.count_if(at), F.lit(0)) / 100.0

    best = F.min(F.when(third, F.struct((-F.col("retention")).alias("r"), label.alias("c"))))
    worst = F.min(F.when(third, F.struct(F.col("retention").alias("r"), label.alias("c"))))
    return cell.agg(mean(1).alias("m1"), mean(3).alias("m3"), best.alias("b"), worst.alias("w")).select(
        round_to("m1", 2).alias("month1_retention"), round_to("m3", 2).alias("month3_retention"),
        F.col("b.c").alias("best_cohort"), round_to(-F.col("b.r") * 100.0, 2).alias("best_retention"),
        F.col("w.c").alias("worst_cohort"), round_to(F.col("w.r") * 100.0, 2).alias("worst_retention"))


def biggest_drop(months: DataFrame, horizon: int = 12) -> DataFrame:
    """Offset with the largest absolute step in the mean curve up to ``horizon`` months; the window has one row per offset."""
    curve = retention_curve(months).where(F.col("cohort_index") <= horizon)
    step = F.abs(F.col("avg_retention") - F.lag("avg_retention").over(Window.orderBy("cohort_index")))
    return curve.withColumn("step", round_to(step, 4)).where("step IS NOT NULL").orderBy(
        F.desc("step"), "cohort_index").limit(1).select("cohort_index", "avg_retention", "step")
