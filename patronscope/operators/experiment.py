"""A/B test analysis. The customer rows are aggregated once; every test is an expression on the resulting row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import equal_width_bin, money_avg, money_sum, round_to
from ..functions.statistics import chi2_sf_1df, normal_quantile, normal_sf, student_t_sf
from .numbering import number_rows, rank_values

CONTROL, TREATMENT = "Control", "Treatment"
ALPHA = 0.05
TESTS = 4
CI_Z = 1.96
# Assumptions of the roll-out projection.
ROLLOUT = {"customers": 800, "discount_share": 0.20, "cost_per_email": 0.50}


def ab_assign(population: DataFrame, stratum: str, seed: int = 42, key: str = "customer_id") -> DataFrame:
    """Reproducible 50/50 split inside every stratum.

    Customers are ordered by a hash within their stratum and alternate between groups. The global numbering spreads even
    one huge stratum over all range partitions; its first row number, one row per stratum, gives the local position.
    """
    hashed = population.select(key, stratum, F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))).alias("h"))
    numbered = number_rows(hashed, [F.col(stratum), F.col("h"), F.col(key)])
    start = numbered.groupBy(stratum).agg(F.min("rn").alias("first_rn"))
    return numbered.join(start, stratum).select(
        key, stratum, F.when((F.col("rn") - F.col("first_rn")) % 2 == 0, CONTROL).otherwise(TREATMENT).alias("grp"))


def ab_describe(experiment: DataFrame) -> DataFrame:
    """Size, conversions and revenue measures per group."""
    converter = F.col("converted") == 1
    return experiment.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(converter).alias("n_converted"),
        (F.count_if(converter) / F.count(F.lit(1))).alias("conv_rate"),
        money_avg("revenue").alias("rev_per_user"),
        (money_sum(F.when(converter, F.col("revenue"))) / F.nullif(F.count_if(converter), F.lit(0))).alias("rev_per_converter"),
        F.avg(F.when(converter, F.col("aov"))).alias("aov"),
        money_sum("revenue").alias("total_revenue"),
        F.var_samp("revenue").alias("var_samp"),
        F.var_pop("revenue").alias("var_pop"),
    )


def ab_describe_report(experiment: DataFrame) -> DataFrame:
    numbers = ("conv_rate", "rev_per_user", "rev_per_converter", "aov", "total_revenue")
    return ab_describe(experiment).select("grp", "n", "n_converted", *[round_to(c, 4).alias(c) for c in numbers])


def both_groups(experiment: DataFrame) -> DataFrame:
    """One row with structs ``c`` (control) and ``t`` (treatment)."""
    stats = ab_describe(experiment)
    fields = [c for c in stats.columns if c != "grp"]
    return stats.agg(
        F.max(F.when(F.col("grp") == CONTROL, F.struct(*fields))).alias("c"),
        F.max(F.when(F.col("grp") == TREATMENT, F.struct(*fields))).alias("t"))


def _some(divisor: Column) -> Column:
    """NULL for a divisor of zero: an experiment without conversions or revenue has no test result."""
    return F.nullif(divisor.cast("double"), F.lit(0.0))


def _lift(field: str) -> Column:
    return (F.col(f"t.{field}") - F.col(f"c.{field}")) / F.nullif(F.col(f"c.{field}"), F.lit(0.0))


def ab_lift(experiment: DataFrame) -> DataFrame:
    return both_groups(experiment).select(
        round_to(_lift("conv_rate"), 6).alias("lift_conversion"), round_to(_lift("rev_per_user"), 6).alias("lift_revenue"))


def _z(m: DataFrame) -> DataFrame:
    n1, n2, p1, p2 = F.col("c.n"), F.col("t.n"), F.col("c.conv_rate"), F.col("t.conv_rate")
    pool = (F.col("c.n_converted") + F.col("t.n_converted")) / (n1 + n2)
    return m.withColumns({
        "diff": p2 - p1,
        "z": (p2 - p1) / _some(F.sqrt(pool * (1 - pool) * (1.0 / n1 + 1.0 / n2))),
        "se_diff": F.sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2),
    }).withColumn("z_p", normal_sf(F.col("z")))


def _welch(m: DataFrame) -> DataFrame:
    a, b = F.col("t.var_samp") / F.col("t.n"), F.col("c.var_samp") / F.col("c.n")
    return m.withColumns({
        "t_stat": (F.col("t.rev_per_user") - F.col("c.rev_per_user")) / _some(F.sqrt(a + b)),
        "df": (a + b) * (a + b) / _some(a * a / _some(F.col("t.n") - 1) + b * b / _some(F.col("c.n") - 1)),
    }).withColumn("t_p", student_t_sf(F.col("t_stat"), F.col("df")))


def _chi2(m: DataFrame) -> DataFrame:
    """2x2 chi-square with Yates correction: |ad - bc| shrinks by N/2, not below zero."""
    a, c = F.col("c.n_converted"), F.col("t.n_converted")
    b, d = F.col("c.n") - a, F.col("t.n") - c
    n = (F.col("c.n") + F.col("t.n")).cast("double")
    gap = F.greatest(F.abs(a.cast("double") * d - b.cast("double") * c) - n / 2, F.lit(0.0))
    below = F.col("c.n").cast("double") * F.col("t.n") * (a + c) * (b + d)
    return m.withColumn("chi2", n * gap * gap / _some(below)).withColumn("chi2_p", chi2_sf_1df(F.col("chi2")))


def ab_ztest(experiment: DataFrame) -> DataFrame:
    """Pooled two-proportion z, one-tailed p, unpooled 95 % interval."""
    m = _z(both_groups(experiment))
    half = CI_Z * F.col("se_diff")
    return m.select(
        round_to("c.conv_rate", 6).alias("p_control"), round_to("t.conv_rate", 6).alias("p_treatment"),
        round_to("diff", 6).alias("diff"), round_to("z", 6).alias("z"), round_to("z_p", 6).alias("p_value"),
        round_to(F.col("diff") - half, 6).alias("ci_low"), round_to(F.col("diff") + half, 6).alias("ci_high"),
        (F.col("z_p") < ALPHA).alias("significant"))


def ab_welch(experiment: DataFrame) -> DataFrame:
    """Welch t on revenue with one-tailed p."""
    return _welch(both_groups(experiment)).select(
        round_to("t_stat", 6).alias("t_stat"), round_to("df", 4).alias("df"), round_to("t_p", 6).alias("p_value"),
        (F.col("t_p") < ALPHA).alias("significant"))


def ab_cohens_d(experiment: DataFrame) -> DataFrame:
    """Effect size with population deviations, its name, and the interval of the mean difference."""
    m = both_groups(experiment)
    diff = F.col("t.rev_per_user") - F.col("c.rev_per_user")
    d = diff / _some(F.sqrt((F.col("c.var_pop") + F.col("t.var_pop")) / 2))
    half = CI_Z * F.sqrt(F.col("c.var_pop") / F.col("c.n") + F.col("t.var_pop") / F.col("t.n"))
    return m.select(
        round_to(d, 6).alias("cohens_d"),
        F.when(F.abs(d) < 0.3, "small").when(F.abs(d) < 0.5, "medium").otherwise("large").alias("effect"),
        round_to(diff, 4).alias("diff_mean"), round_to(diff - half, 4).alias("ci_low"), round_to(diff + half, 4).alias("ci_high"))


def mann_whitney(experiment: DataFrame) -> DataFrame:
    """U of treatment over control with tie and continuity corrections, from counts per distinct revenue."""
    values = rank_values(experiment, "revenue", carry=[F.count_if(F.col("grp") == TREATMENT).alias("n_t")])
    middle = F.col("rank") + (F.col("ties") - 1) / 2.0
    ties = F.col("ties").cast("double")
    sums = values.agg(
        F.sum("ties").cast("double").alias("n"), F.sum("n_t").cast("double").alias("n2"),
        F.sum(F.col("n_t") * middle).alias("r2"), F.sum(ties * ties * ties - ties).alias("tie_term"))
    n, n2 = F.col("n"), F.col("n2")
    n1 = n - n2
    spread = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("tie_term") / _some(n * (n - 1))))
    return sums.withColumn("u", F.col("r2") - n2 * (n2 + 1) / 2.0).withColumn(
        "u_z", (F.col("u") - n1 * n2 / 2.0 - 0.5) / _some(spread)).withColumn("u_p", normal_sf(F.col("u_z")))


def ab_mannwhitney(experiment: DataFrame) -> DataFrame:
    return mann_whitney(experiment).select(
        round_to("u", 1).alias("u_stat"), round_to("u_z", 6).alias("z"), round_to("u_p", 6).alias("p_value"),
        (F.col("u_p") < ALPHA).alias("significant"))


def ab_chi2(experiment: DataFrame) -> DataFrame:
    return _chi2(both_groups(experiment)).select(
        round_to("chi2", 6).alias("chi2"), F.lit(1).alias("dof"), round_to("chi2_p", 6).alias("p_value"),
        (F.col("chi2_p") < ALPHA).alias("significant"))


def _all_tests(experiment: DataFrame) -> DataFrame:
    tested = _chi2(_welch(_z(both_groups(experiment))))
    return tested.join(F.broadcast(mann_whitney(experiment).select("u_p")))  # one row each


def ab_bonferroni(experiment: DataFrame) -> DataFrame:
    """P-value per test, and the decision at the plain and the corrected level."""
    tests = {"Z-test (conversion)": "z_p", "Welch t (revenue)": "t_p", "Mann-Whitney U (revenue)": "u_p",
             "Chi-square (conversion)": "chi2_p"}
    long = _all_tests(experiment).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("test"), F.col(p).alias("p")) for name, p in tests.items()])))
    return long.select(
        "test", round_to("p", 6).alias("p_value"), (F.col("p") < ALPHA).alias("significant"),
        F.lit(ALPHA / TESTS).alias("corrected_alpha"), (F.col("p") < ALPHA / TESTS).alias("significant_corrected"))


def ab_sample_size(baselines: DataFrame, mde: float = 0.05, alpha: float = ALPHA, power: float = 0.80) -> DataFrame:
    """Customers needed per group for every baseline ``p_control`` (one-tailed)."""
    z = normal_quantile(1 - alpha) + normal_quantile(power)
    p = F.col("p_control")
    variance = p * (1 - p) + (p + mde) * (1 - (p + mde))
    needed = F.ceil(F.lit(z * z) * variance / (mde * mde)).cast("bigint")
    return baselines.withColumn("n_per_group", needed).withColumn("n_total", F.col("n_per_group") * 2)


def score_baselines(experiment: DataFrame) -> DataFrame:
    """Observed control conversion per RFM score."""
    return (
        experiment.where(F.col("grp") == CONTROL).groupBy("rfm_score")
        .agg((F.sum("converted") / F.count(F.lit(1))).alias("p_control"))
    )


def ab_impact(experiment: DataFrame, customers: int = ROLLOUT["customers"], discount: float = ROLLOUT["discount_share"],
              mail: float = ROLLOUT["cost_per_email"]) -> DataFrame:
    """Projection of a roll-out: conversions, revenue, cost, return."""
    m = both_groups(experiment).select(
        F.floor(customers * F.col("c.conv_rate")).alias("control_conversions"),
        F.floor(customers * F.col("t.conv_rate")).alias("treatment_conversions"),
        F.col("c.rev_per_converter").alias("rc"), F.col("t.rev_per_converter").alias("rt"))
    m = m.withColumns({
        "incremental": F.col("treatment_conversions") - F.col("control_conversions"),
        "control_revenue": F.col("control_conversions") * F.col("rc"),
        "gross": F.col("treatment_conversions") * F.col("rt"),
    })
    cost = F.col("gross") * discount + F.lit(customers * mail)
    extra = F.col("gross") - cost - F.col("control_revenue")
    return m.select(
        "control_conversions", "treatment_conversions", F.col("incremental").alias("incremental_conversions"),
        round_to("control_revenue", 2).alias("control_revenue"), round_to("gross", 2).alias("gross_revenue"),
        round_to(F.col("gross") * discount, 2).alias("discount_cost"), F.lit(customers * mail).alias("email_cost"),
        round_to(F.col("gross") - cost, 2).alias("net_revenue"), round_to(extra, 2).alias("incremental_revenue"),
        round_to(extra / cost * 100.0, 2).alias("roi_pct"),
        round_to(cost / F.greatest(F.col("incremental"), F.lit(1)), 2).alias("cost_per_conversion"))


def ab_decision(experiment: DataFrame) -> DataFrame:
    """Launch when conversion is significant and revenue is by either test."""
    z, t, u = (F.col(c) < ALPHA for c in ("z_p", "t_p", "u_p"))
    return _all_tests(experiment).select(
        z.alias("conversion_significant"), t.alias("welch_significant"), u.alias("mannwhitney_significant"),
        (z & (t | u)).alias("launch"))


def ab_summary(experiment: DataFrame) -> DataFrame:
    """Final table, numbers instead of formatted text."""
    m = _welch(_z(both_groups(experiment)))
    rows = (("Conversion Rate", "conv_rate", "z_p", 100.0), ("Revenue / Customer", "rev_per_user", "t_p", 1.0),
            ("Rev / Converter", "rev_per_converter", None, 1.0), ("Avg Order Value", "aov", None, 1.0))
    none = F.lit(None).cast("double")
    return m.select(F.inline(F.array(*[
        F.struct(
            F.lit(label).alias("metric"),
            round_to(F.col(f"c.{c}") * scale, 4).alias("control"), round_to(F.col(f"t.{c}") * scale, 4).alias("treatment"),
            round_to((F.col(f"t.{c}") - F.col(f"c.{c}")) * scale, 4).alias("absolute_lift"),
            (round_to(_lift(c) * 100.0, 4) if p else none).alias("relative_lift_pct"),
            (round_to(p, 6) if p else none).alias("p_value"),
            ((F.col(p) < ALPHA) if p else F.lit(None).cast("boolean")).alias("significant"))
        for label, c, p, scale in rows])))


def ab_revenue_hist(experiment: DataFrame, bins: int = 59) -> DataFrame:
    """Density of converter revenue per group over bins from 0 to 1.1 times the control maximum."""
    buyers = experiment.where(F.col("revenue") > 0).select("grp", "revenue")
    top = F.broadcast(experiment.where(F.col("grp") == CONTROL).agg((F.max("revenue") * 1.1).alias("top")))
    inside = buyers.join(top).where(F.col("revenue") <= F.col("top"))
    counted = inside.groupBy("grp", "top", equal_width_bin(F.col("revenue"), F.lit(0.0), F.col("top"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("customers"))
    totals = F.broadcast(counted.groupBy("grp").agg(F.sum("customers").alias("all")))
    return counted.join(totals, "grp").select(
        "grp", "bin", "customers",
        round_to(F.col("customers") / (F.col("all") * (F.col("top") / float(bins))), 8).alias("density"))
