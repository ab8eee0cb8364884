"""Parameterised questions over a filtered set of customers.

``audience`` filters the customer table; every other function takes the filtered frame. Projections use Python-style
half-to-even rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numeric import money_avg, money_sum, round_even, round_to, share
from ..functions.segments import SEGMENTS
from .insights import literal_table
from .order_stats import top_sums

CHAMPIONS, LOYAL, POTENTIAL, AT_RISK, LOST = SEGMENTS
# Effort of a campaign (1 easy - 5 hard) and its label.
EFFORT = ((CHAMPIONS, 1, "VIP loyalty programme"), (LOYAL, 2, "Referral + loyalty discount"),
          (POTENTIAL, 3, "2nd purchase incentive"), (AT_RISK, 4, "Win-back 20% discount"),
          (LOST, 5, "Last-chance 30% email"))


def filter_customers(profile: DataFrame, segments: Sequence[str] | None = None,
                     recency: tuple[float, float] | None = None, monetary: tuple[float, float] | None = None,
                     country: str | None = None) -> DataFrame:
    """Customers in the chosen segments, ranges and country; every test can reach the scan."""
    kept = profile
    if segments is not None:
        kept = kept.where(F.col("segment_label").isin(*segments))
    if recency is not None:
        kept = kept.where(F.col("recency_days").between(*recency))
    if monetary is not None:
        kept = kept.where(F.col("monetary").between(*monetary))
    if country is not None:
        kept = kept.where(F.col("country") == country)
    return kept


def filter_bounds(profile: DataFrame) -> DataFrame:
    """What a filter can range over: segments, countries and both numeric ranges."""
    return profile.agg(
        F.array_join(F.array_sort(F.collect_set("segment_label")), "|").alias("segments"),
        F.array_join(F.array_sort(F.collect_set("country")), "|").alias("countries"),
        F.min("recency_days").alias("min_recency"), F.max("recency_days").alias("max_recency"),
        F.floor(F.min("monetary")).alias("min_monetary"), F.floor(F.max("monetary")).alias("max_monetary"))


def segment_metrics(people: DataFrame) -> DataFrame:
    """Size, revenue and averages of all five segments, zeros for an absent one."""
    names = literal_table(people.sparkSession, ("segment_no", "segment"), list(enumerate(SEGMENTS)))
    grouped = people.groupBy(F.col("segment_label").alias("segment")).agg(
        F.count(F.lit(1)).alias("n"), money_sum("monetary").alias("rev"), money_avg("monetary").alias("avg_mon"),
        F.avg("recency_days").alias("avg_rec"), F.avg("frequency").alias("avg_frq"),
        money_avg("clv_estimate").alias("avg_clv"), money_avg("churn_probability").alias("avg_churn"))
    numbers = ("rev", "avg_mon", "avg_rec", "avg_frq", "avg_clv", "avg_churn")
    return names.join(grouped, "segment", "left").select(
        "segment_no", "segment", F.coalesce("n", F.lit(0)).alias("n"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in numbers])


def _side_by_side(people: DataFrame) -> DataFrame:
    """One row with every segment's metrics as a struct column named after the segment."""
    metrics = segment_metrics(people)
    names = ("champ", "loyal", "pot", "atrisk", "lost")
    return metrics.agg(*[
        F.max(F.when(F.col("segment_no") == i, F.struct("n", "rev", "avg_mon", "avg_rec", "avg_frq", "avg_clv", "avg_churn")))
        .alias(name) for i, name in enumerate(names)])


def segment_metrics_report(people: DataFrame) -> DataFrame:
    return segment_metrics(people).select(
        "segment", "n", *[round_to(c, 4).alias(c) for c in ("rev", "avg_mon", "avg_rec", "avg_frq", "avg_clv", "avg_churn")])


def pareto_top20(people: DataFrame) -> DataFrame:
    """Revenue share of the top fifth of spenders (at least one), and the share held by Champions."""
    top = top_sums(people, "monetary", {"top": "greatest(1, n div 5)"}).select(
        "k", share(F.col("top_sum"), F.col("total_sum"), 1).alias("top20_revenue_pct"))
    champion = F.col("segment_label") == CHAMPIONS
    held = people.agg(
        share(money_sum(F.when(champion, F.col("monetary")).otherwise(0.0)), money_sum("monetary"), 1)
        .alias("champion_revenue_pct"),
        share(F.count_if(champion), F.count(F.lit(1)), 1).alias("champion_customer_pct"))
    return top.join(F.broadcast(held)).select(
        F.col("k").alias("top20_customers"), "top20_revenue_pct", "champion_revenue_pct", "champion_customer_pct")


def _roi(gain: Column, cost: Column) -> Column:
    return round_even((gain - cost) / F.greatest(F.lit(1.0), cost) * 100)


def _winback(m: DataFrame) -> DataFrame:
    mails = F.col("atrisk.n")
    return m.withColumn("wb_n", round_even(mails * 0.08 * 0.18)).withColumns({
        "wb_revenue": round_even(F.col("wb_n") * F.col("atrisk.avg_mon") * 0.80),
        "wb_cost": round_even(mails * 0.15),
    }).withColumn("wb_roi", _roi(F.col("wb_revenue"), F.col("wb_cost")))


def _potential(m: DataFrame) -> DataFrame:
    return m.withColumn("pot_n", round_even(F.col("pot.n") * 0.12)).withColumns({
        "pot_revenue": round_even(F.col("pot_n") * F.col("loyal.avg_mon")),
        "pot_cost": round_even(F.col("pot.n") * 0.50),
    }).withColumn("pot_roi", _roi(F.col("pot_revenue"), F.col("pot_cost")))


def _lost(m: DataFrame) -> DataFrame:
    return m.withColumn("lost_n", round_even(F.col("lost.n") * 0.05)).withColumn(
        "lost_revenue", round_even(F.col("lost_n") * F.col("lost.avg_mon") * 0.70))


def winback_projection(people: DataFrame) -> DataFrame:
    return _winback(_side_by_side(people)).select(
        F.col("atrisk.n").alias("emails"), F.col("wb_n").alias("recovered"), F.col("wb_revenue").alias("revenue"),
        F.col("wb_cost").alias("cost"), F.col("wb_roi").alias("roi_pct"))


def potential_projection(people: DataFrame) -> DataFrame:
    return _potential(_side_by_side(people)).select(
        F.col("pot.n").alias("customers"), F.col("pot_n").alias("converted"), F.col("pot_revenue").alias("revenue"),
        F.col("pot_cost").alias("cost"), F.col("pot_roi").alias("roi_pct"))


def loyal_gap(people: DataFrame) -> DataFrame:
    return _side_by_side(people).select(
        round_to(F.col("champ.avg_frq") - F.col("loyal.avg_frq"), 1).alias("order_gap"),
        round_even(F.col("loyal.n") * F.col("loyal.avg_mon") * 0.05).alias("uplift_5pct"))


def lost_projection(people: DataFrame) -> DataFrame:
    return _lost(_side_by_side(people)).select(
        F.col("lost.n").alias("customers"), F.col("lost_n").alias("recovered"), F.col("lost_revenue").alias("revenue"))


def action_priority(people: DataFrame) -> DataFrame:
    """Effort, opportunity and ROI per present segment, ranked by ROI."""
    m = _lost(_potential(_winback(_side_by_side(people))))

    def simple_roi(seg: str, gain: float) -> Column:
        spend = F.col(f"{seg}.n") * F.col(f"{seg}.avg_mon") * gain
        return round_even(spend / F.greatest(F.lit(1.0), F.col(f"{seg}.n") * 0.80))

    mailing = F.col("lost.n") * 0.15
    outcome = {
        "champ": (round_even(F.col("champ.rev") * 0.10), simple_roi("champ", 0.10)),
        "loyal": (round_even(F.col("loyal.n") * F.col("loyal.avg_mon") * 0.08), simple_roi("loyal", 0.08)),
        "pot": (F.col("pot_revenue"), F.col("pot_roi")),
        "atrisk": (F.col("wb_revenue"), F.col("wb_roi")),
        "lost": (F.col("lost_revenue"),
                 round_even((F.col("lost_revenue") - mailing) / F.greatest(F.lit(1.0), mailing))),
    }
    structs = [
        F.struct(F.lit(name).alias("segment"), F.lit(effort).alias("effort"), F.lit(action).alias("action"),
                 F.col(f"{alias}.n").alias("n"), outcome[alias][0].alias("opportunity"),
                 round_to(F.col(f"{alias}.avg_clv"), 4).alias("avg_clv"), outcome[alias][1].alias("roi"))
        for alias, (name, effort, action) in zip(outcome, EFFORT)
    ]
    best = Window.orderBy(F.desc("roi"), "effort")
    return m.select(F.inline(F.array(*structs))).where(F.col("n") > 0).withColumn("priority", F.row_number().over(best))


def _by_country(people: DataFrame) -> DataFrame:
    return people.groupBy("country").agg(
        F.count(F.lit(1)).alias("customers"), money_sum("monetary").alias("rev"),
        money_avg("monetary").alias("spend"), F.avg("rfm_score").alias("score"))


def geo_top10(people: DataFrame, k: int = 10) -> DataFrame:
    return _by_country(people).select(
        "country", "customers", round_to("rev", 2).alias("revenue"), round_to("score", 4).alias("avg_rfm")
    ).orderBy(F.desc("revenue"), "country").limit(k)


def country_breakdown(people: DataFrame) -> DataFrame:
    return _by_country(people).select(
        "country", "customers", round_to("spend", 0).alias("avg_spend"), round_to("score", 1).alias("avg_rfm"),
        round_to("rev", 2).alias("revenue"),
        share(F.col("rev"), F.sum("rev").over(Window.partitionBy()), 1).alias("revenue_pct"))


def explore_sorted(people: DataFrame, columns: Sequence[str], sort_by: str, ascending: bool = False) -> DataFrame:
    order = F.col(sort_by).asc() if ascending else F.col(sort_by).desc()
    return people.select(*columns).orderBy(order, "customer_id")


def segment_table(people: DataFrame) -> DataFrame:
    grouped = people.groupBy(F.col("segment_label").alias("segment")).agg(
        F.count(F.lit(1)).alias("n"), money_avg("monetary").alias("spend"), F.avg("recency_days").alias("rec"),
        F.avg("frequency").alias("ord"), money_sum("monetary").alias("rev"))
    return grouped.select(
        "segment", "n", round_to("spend", 0).alias("avg_spend"), round_to("rec", 0).alias("avg_recency"),
        round_to("ord", 1).alias("avg_orders"), round_to("rev", 2).alias("revenue"),
        share(F.col("rev"), F.sum("rev").over(Window.partitionBy()), 1).alias("revenue_pct"))
