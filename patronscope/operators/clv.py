"""Customer lifetime value: repeat-purchase summary, model predictions, tiers and reports.

BG/NBD follows Fader, Hardie and Lee (2005), Gamma-Gamma Fader and Hardie (2013).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import amount, equal_width_bin, money_avg, money_sum, round_to, share, units
from ..session import enable_checkpoints
from .order_stats import group_quantiles, quantiles, top_sums

TIERS = ("Bronze", "Silver", "Gold", "Platinum")
# Penalties, horizon in weeks, months, yearly discount and weeks per month of the value model.
BGNBD_PENALTY, GAMMA_PENALTY = 1.0, 0.01
HORIZON_WEEKS, MONTHS, YEARLY_DISCOUNT, WEEKS_PER_MONTH = 52.0, 12, 0.10, 4.345
#: Decimals of fitted parameters; their standard errors are far larger. Largest gradient of a certified optimum.
PARAMETER_DIGITS, GRADIENT = 4, 1e-9
#: Lower bound of every parameter: data without drop-outs drive some of them towards 0.
LEAST_PARAMETER = 1e-3
#: Double-exponential rule: nodes on either side and their distance; rows that a task integrates at once.
NODES, NODE_STEP = 80, 0.08
QUADRATURE_ROWS = 4096
# Closed-form approximation.
FALLBACK = {"one_time_alive": 0.30, "max_alive": 0.99, "value_drift": 1.05, "margin": 0.65, "weeks": 52}
# Right-closed bins of the alive grid.
FREQUENCY_EDGES, RECENCY_EDGES = (0, 1, 3, 5, 10, 30), (0, 10, 20, 30, 40, 52)


# Summaries

def clv_summary(transactions: DataFrame) -> DataFrame:
    """Weekly repeat frequency, recency, age T and mean value of repeat weeks, one row per customer.

    Lines collapse to (customer, week) with map-side combining, so a customer with a third of all lines becomes one row per
    week before the per-customer aggregate.
    """
    weeks = transactions.groupBy("customer_id", F.date_trunc("WEEK", "invoice_date").cast("date").alias("week")).agg(
        F.sum(units("total_amount")).alias("u"))
    end = F.broadcast(transactions.agg(F.date_trunc("WEEK", F.max("invoice_date")).cast("date").alias("end_week")))
    per_customer = weeks.groupBy("customer_id").agg(
        (F.count(F.lit(1)) - 1).alias("frequency"), F.min("week").alias("w0"), F.max("week").alias("w1"),
        F.sum("u").alias("u"), F.min_by("u", "week").alias("u0"))
    later = amount(F.col("u") - F.col("u0")) / F.nullif(F.col("frequency"), F.lit(0))
    return per_customer.join(end).select(
        "customer_id", "frequency",
        (F.datediff("w1", "w0") / 7.0).alias("recency"), (F.datediff("end_week", "w0") / 7.0).alias("t"),
        F.coalesce(later, F.lit(0.0)).alias("monetary_value"))


def clv_repeaters(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("frequency") > 0).alias("repeaters"),
        F.count_if(F.col("frequency") == 0).alias("one_time"),
        share(F.count_if(F.col("frequency") > 0), F.count(F.lit(1)), 1).alias("repeat_pct"))


def freq_value_corr(summary: DataFrame) -> DataFrame:
    """Frequency and value should be nearly independent among repeat buyers."""
    c = F.corr("frequency", "monetary_value")
    return summary.where(F.col("frequency") > 0).agg(
        round_to(c, 6).alias("correlation"), (F.abs(c) < 0.3).alias("independent"))


# Model fitting

def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after moving the argument up by eight."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        shift += np.log(y)
        y += 1.0
    inv = 1.0 / y
    series = inv * (1 / 12 - inv**2 * (1 / 360 - inv**2 * (1 / 1260 - inv**2 / 1680)))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of ``log_gamma``: the asymptotic series after moving the argument up by eight."""
    y, shift = np.asarray(x, dtype=float) + 0.0, 0.0
    for _ in range(8):
        shift = shift + 1.0 / y
        y = y + 1.0
    inv = 1.0 / y**2
    return np.log(y) - 0.5 / y - inv * (1 / 12 - inv * (1 / 120 - inv * (1 / 252 - inv / 240))) - shift


def trigamma(x: np.ndarray) -> np.ndarray:
    """Second derivative of ``log_gamma``."""
    y, shift = np.asarray(x, dtype=float) + 0.0, 0.0
    for _ in range(8):
        shift = shift + 1.0 / y**2
        y = y + 1.0
    inv = 1.0 / y**2
    return 1.0 / y + 0.5 * inv + inv / y * (1 / 6 - inv * (1 / 30 - inv * (1 / 42 - inv / 30))) + shift


class Derivatives:
    """Value, gradient and curvature of a function of a few parameters at many rows, put together from its terms."""

    def __init__(self, size: int, rows: int):
        self.value, self.slope, self.bend = np.zeros(rows), np.zeros((rows, size)), np.zeros((rows, size, size))

    def add(self, value, slope: dict[int, np.ndarray], bend: dict[tuple[int, int], np.ndarray] | None = None) -> Derivatives:
        self.value += value
        for i, v in slope.items():
            self.slope[:, i] += v
        for (i, j), v in (bend or {}).items():
            self.bend[:, i, j] += v
            if i != j:
                self.bend[:, j, i] += v
        return self

    def add_log_gamma(self, argument: np.ndarray, by: dict[int, np.ndarray | float], sign: float = 1.0) -> Derivatives:
        """``sign`` times log gamma of an argument that is linear in the parameters, with these coefficients."""
        first, second = digamma(argument), trigamma(argument)
        return self.add(sign * log_gamma(argument), {i: sign * first * c for i, c in by.items()},
                        {(i, j): sign * second * by[i] * by[j] for i in by for j in by if i <= j})

    def add_log_sum(self, one: Derivatives, other: Derivatives, both: np.ndarray) -> Derivatives:
        """Log of the sum of two exponentials; the second one counts where ``both``."""
        total = np.where(both, np.logaddexp(one.value, other.value), one.value)
        p = np.exp(one.value - total)
        q = np.where(both, 1 - p, 0.0)
        mean = p[:, None] * one.slope + q[:, None] * other.slope
        outer = lambda s: s[:, :, None] * s[:, None, :]
        self.value += total
        self.slope += mean
        self.bend += p[:, None, None] * (one.bend + outer(one.slope)) + q[:, None, None] * (other.bend + outer(other.slope)) - outer(mean)
        return self


def bgnbd_derivatives(params: np.ndarray, x: np.ndarray, tx: np.ndarray, t: np.ndarray) -> Derivatives:
    """Log-likelihood per row with its derivatives by r, alpha, a, b; the log of a sum keeps the survival terms in range."""
    r, alpha, a, b = params
    n, one = len(x), np.ones(len(x))
    found = Derivatives(4, n).add_log_gamma(r + x, {0: one}).add_log_gamma(r * one, {0: one}, -1.0)
    found.add(r * np.log(alpha), {0: np.log(alpha), 1: r / alpha}, {(0, 1): 1 / alpha, (1, 1): -r / alpha**2})
    found.add_log_gamma((a + b) * one, {2: one, 3: one}).add_log_gamma(b + x, {3: one}).add_log_gamma(b * one, {3: one}, -1.0)
    found.add_log_gamma(a + b + x, {2: one, 3: one}, -1.0)
    alive, gone = Derivatives(4, n), Derivatives(4, n)
    for part, age in ((alive, t), (gone, tx)):
        y = alpha + age
        part.add(-(r + x) * np.log(y), {0: -np.log(y), 1: -(r + x) / y}, {(0, 1): -1 / y, (1, 1): (r + x) / y**2})
    left = b + np.maximum(x, 1) - 1
    gone.add(np.log(a) - np.log(left), {2: 1 / a, 3: -1 / left}, {(2, 2): -1 / a**2, (3, 3): 1 / left**2})
    return found.add_log_sum(alive, gone, x > 0)


def gamma_gamma_derivatives(params: np.ndarray, x: np.ndarray, m: np.ndarray) -> Derivatives:
    """Log-likelihood per row with its derivatives by p, q, v."""
    p, q, v = params
    one = np.ones(len(x))
    found = Derivatives(3, len(x)).add_log_gamma(p * x + q, {0: x, 1: one}).add_log_gamma(p * x, {0: x}, -1.0).add_log_gamma(q * one, {1: one}, -1.0)
    found.add(q * np.log(v), {1: np.log(v), 2: q / v}, {(1, 2): 1 / v, (2, 2): -q / v**2})
    found.add((p * x - 1) * np.log(m) + p * x * np.log(x), {0: x * (np.log(m) + np.log(x))})
    y = x * m + v
    return found.add(-(p * x + q) * np.log(y), {0: -x * np.log(y), 1: -np.log(y), 2: -(p * x + q) / y},
                     {(0, 2): -x / y, (1, 2): -1 / y, (2, 2): (p * x + q) / y**2})


def bgnbd_loglik(params: np.ndarray, x: np.ndarray, tx: np.ndarray, t: np.ndarray) -> np.ndarray:
    return bgnbd_derivatives(params, x, tx, t).value


def _pass(table: DataFrame, columns: list[str], derivatives: Callable, points: np.ndarray, full: bool) -> np.ndarray:
    """Weighted means of log-likelihood at every point and, if ``full``, of gradient and curvature there, from one
    distributed pass; partitions return partial sums."""
    size = points.shape[1]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(points), 1 + (size + size * size) * full))
        weight = 0.0
        for batch in batches:
            arrays = [batch[c].to_numpy(dtype=float) for c in columns]
            w = batch["weight"].to_numpy(dtype=float)
            weight += w.sum()
            for i, point in enumerate(points):
                with np.errstate(all="ignore"):
                    d = derivatives(np.exp(point), *arrays)
                parts = [d.value[:, None], *([d.slope, d.bend.reshape(len(w), -1)] if full else [])]
                sums[i] += w @ np.concatenate(parts, axis=1)
        yield pd.DataFrame({"i": range(len(points)), "s": list(sums), "w": weight})

    width = 1 + (size + size * size) * full
    rows = table.mapInPandas(partial, "i int, s array<double>, w double").groupBy("i").agg(
        *[F.sum(F.col("s")[k]).alias(f"s{k}") for k in range(width)], F.sum("w").alias("w")).collect()
    result = np.empty((len(points), width))
    for row in rows:
        result[row["i"]] = np.array([row[f"s{k}"] for k in range(width)], float) / (row["w"] or 1.0)
    return result


@dataclass(frozen=True)
class Optimum:
    """Parameters and their certificate: the largest entry of the objective's gradient there, by the logs of the parameters that
    are not at their lower bound."""
    params: tuple[float, ...]
    gradient: float


def maximise(table: DataFrame, columns: list[str], derivatives: Callable, size: int, penalty: float,
             start: float = 0.1, rounds: int = 60) -> Optimum:
    """Damped Newton ascent on log-parameters with the analytic gradient and curvature; none falls below LEAST_PARAMETER.

    A round is two passes: one sums value, gradient and curvature, one the values along a ladder of step lengths. The driver sees
    a few numbers a point. It ends where the gradient is at most GRADIENT, and never elsewhere: if no step helps, or the
    rounds are used up, an error is raised.
    """
    here, low = np.full(size, start), np.log(LEAST_PARAMETER)
    ladder = np.array([1.0, 0.5, 0.25, 0.1, 0.03, 0.01, 0.001])
    for _ in range(rounds):
        sums = _pass(table, columns, derivatives, here[None], full=True)[0]
        params = np.exp(here)
        value = -sums[0] + penalty * params @ params
        slope, bend = -sums[1:1 + size], -sums[1 + size:].reshape(size, size)
        # By the logs of the parameters, with the penalty.
        gradient = params * slope + 2 * penalty * params**2
        curvature = np.outer(params, params) * bend + np.diag(params * slope + 4 * penalty * params**2)
        if not np.isfinite(value):
            raise RuntimeError("the likelihood is not finite")
        # At its lower bound a parameter that would still fall is settled; the others are free.
        free = (here > low) | (gradient < 0)
        size_of = float(np.abs(gradient[free]).max()) if free.any() else 0.0
        if size_of <= GRADIENT:
            return Optimum(tuple(map(float, params)), size_of)
        values, vectors = np.linalg.eigh(curvature[np.ix_(free, free)])
        step = np.zeros(size)
        step[free] = -vectors @ ((vectors.T @ gradient[free]) / np.maximum(np.abs(values), 1e-6))
        step *= min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
        points = np.maximum(here + np.outer(ladder, step), low)
        tried = -_pass(table, columns, derivatives, points, full=False)[:, 0] + penalty * np.sum(np.exp(points) ** 2, axis=1)
        tried = np.where(np.isfinite(tried), tried, np.inf)
        best = int(np.argmin(tried))
        if tried[best] >= value:
            # Near the optimum the value no longer tells steps apart; the gradient still does.
            if size_of > 1e-5:
                raise RuntimeError(f"no step helps at gradient {size_of:.3g}")
            best = 0
        here = points[best]
    raise RuntimeError(f"no maximum found in {rounds} rounds")


def bgnbd_optimum(summary: DataFrame) -> tuple[Optimum, float]:
    """The fit on time scaled to a longest age of 1, because the penalty acts on the scaled parameters; and that age.

    Weeks are whole numbers, so customers collapse to distinct (frequency, recency, T) with a weight.
    """
    enable_checkpoints(summary.sparkSession)
    longest = summary.agg(F.max("t")).first()[0] or 1.0
    table = summary.groupBy("frequency", "recency", "t").agg(F.count(F.lit(1)).alias("weight")).select(
        "frequency", (F.col("recency") / longest).alias("tx"), (F.col("t") / longest).alias("age"), "weight").checkpoint()
    return maximise(table, ["frequency", "tx", "age"], bgnbd_derivatives, 4, BGNBD_PENALTY), longest


def bgnbd_fit(summary: DataFrame) -> dict[str, float]:
    """Parameters r, alpha, a, b, to PARAMETER_DIGITS decimals; an error where no certified optimum is found."""
    found, longest = bgnbd_optimum(summary)
    r, alpha, a, b = found.params
    return {k: round(v, PARAMETER_DIGITS) for k, v in {"r": r, "alpha": alpha * longest, "a": a, "b": b}.items()}


def gamma_gamma_fit(summary: DataFrame) -> dict[str, float]:
    """Parameters p, q, v from repeat buyers, to PARAMETER_DIGITS decimals; an error where no certified optimum is found."""
    enable_checkpoints(summary.sparkSession)
    table = summary.where((F.col("frequency") > 0) & (F.col("monetary_value") > 0)).groupBy(
        "frequency", "monetary_value").agg(F.count(F.lit(1)).alias("weight")).checkpoint()
    found = maximise(table, ["frequency", "monetary_value"], gamma_gamma_derivatives, 3, GAMMA_PENALTY)
    return {k: round(v, PARAMETER_DIGITS) for k, v in zip("pqv", found.params)}


def parameter_row(summary: DataFrame, params: dict[str, float]) -> DataFrame:
    return summary.sparkSession.range(1).select(*[F.lit(v).alias(k) for k, v in params.items()])


# Predictions

def prob_alive(params: dict[str, float]) -> Column:
    """Probability that a customer has not dropped out, as a column expression."""
    r, alpha, a, b = (F.lit(params[k]) for k in ("r", "alpha", "a", "b"))
    x, tx, t = F.col("frequency"), F.col("recency"), F.col("t")
    odds = a / (b + F.greatest(x, F.lit(1)) - 1) * F.pow((alpha + t) / (alpha + tx), r + x)
    return 1.0 / (1.0 + F.when(x > 0, odds).otherwise(0.0))


def quadrature() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of the double-exponential rule on (0, 1): log p, log(1 - p) and log of dp / (p (1 - p))."""
    u = np.arange(-NODES, NODES + 1) * NODE_STEP
    spread = np.pi * np.sinh(u)
    return -np.logaddexp(0.0, -spread), -np.logaddexp(0.0, spread), np.log(np.pi * np.cosh(u))


def _expected(params: dict[str, float], x, tx, t, horizon: float) -> np.ndarray:
    """Purchases expected within ``horizon``: the chance of being alive times an integral over the drop-out probability p.

    An alive customer's p has the density of Beta(a, b + x), and a rate of Gamma(r + x, alpha + T) gives
    (1 - (1 + p h / (alpha + T)) ** -(r + x)) / p purchases. That is smooth, so fixed nodes do for any horizon and
    parameters, also where the equivalent hypergeometric series hardly converges. NaN gives NaN.
    """
    r, alpha, a, b = (params[k] for k in ("r", "alpha", "a", "b"))
    log_p, log_rest, log_step = quadrature()
    result = np.empty(len(x))
    for first in range(0, len(x), QUADRATURE_ROWS):
        own = slice(first, first + QUADRATURE_ROWS)
        s, k = (r + x[own])[:, None], (horizon / (alpha + t[own]))[:, None]
        weight = a * log_p + (b + x[own])[:, None] * log_rest + log_step
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        p = np.exp(log_p)
        with np.errstate(all="ignore"):
            bought = np.where(p * k > 1e-12, -np.expm1(-s * np.log1p(p * k)) / p, s * k)
        result[own] = (weight * bought).sum(axis=1) / weight.sum(axis=1)
    odds = np.where(x > 0, a / (b + np.maximum(x, 1) - 1) * ((alpha + t) / (alpha + tx)) ** (r + x), 0.0)
    return result / (1 + odds)


def expected_purchases(params: dict[str, float], horizon: float = HORIZON_WEEKS) -> Column:
    """Purchases expected in the next ``horizon`` weeks (Arrow batches; the integral has no built-in form)."""

    @F.pandas_udf("double")
    def predict(x: pd.Series, tx: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series(_expected(params, x.to_numpy(float), tx.to_numpy(float), t.to_numpy(float), horizon))

    return predict("frequency", "recency", "t")


def expected_order_value(params: dict[str, float]) -> Column:
    p, q, v = (F.lit(params[k]) for k in ("p", "q", "v"))
    x = F.col("frequency")
    return p * (v + x * F.col("monetary_value")) / (p * x + q - 1)


def discounted_value(bgnbd: dict[str, float], months: int = MONTHS, discount: float = YEARLY_DISCOUNT / 12) -> Column:
    """Discounted expected purchases over monthly steps; multiplied by order value it is the lifetime value."""

    @F.pandas_udf("double")
    def total(x: pd.Series, tx: pd.Series, t: pd.Series) -> pd.Series:
        args = x.to_numpy(float), tx.to_numpy(float), t.to_numpy(float)
        before, result = np.zeros(len(x)), np.zeros(len(x))
        for month in range(1, months + 1):
            now = _expected(bgnbd, *args, month * WEEKS_PER_MONTH)
            result += (now - before) / (1 + discount) ** month
            before = now
        return pd.Series(result)

    return total("frequency", "recency", "t")


def clv_predicted(summary: DataFrame, bgnbd: dict[str, float], gamma: dict[str, float]) -> DataFrame:
    """P(alive), expected purchases, order value and 12-month value of repeat buyers."""
    return (
        summary.where(F.col("frequency") > 0)
        .withColumns({
            "prob_alive": round_to(prob_alive(bgnbd), 4),
            "predicted_purchases_12m": round_to(expected_purchases(bgnbd), 2),
            "predicted_avg_order": round_to(expected_order_value(gamma), 2),
            "clv_predicted": round_to(discounted_value(bgnbd) * expected_order_value(gamma), 2),
        })
    )


def clv_fallback(seg: DataFrame) -> DataFrame:
    """Closed-form approximation straight from the segment table, for customers with at least one repeat order."""
    weeks = float(FALLBACK["weeks"])
    base = seg.select(
        "customer_id", (F.col("frequency") - 1).alias("frequency"),
        ((365 - F.col("recency_days")) / 7.0).alias("recency"), F.lit(weeks).alias("t"),
        (F.col("monetary") / F.col("frequency")).alias("monetary_value"))
    x = F.col("frequency")
    grown = F.col("recency") / F.col("t") * (1 + x * 0.1)
    alive = F.when(x == 0, FALLBACK["one_time_alive"]).otherwise(
        F.least(F.greatest(grown, F.lit(0.0)), F.lit(FALLBACK["max_alive"])))
    return (
        base.where(x >= 0)
        .withColumn("prob_alive", round_to(alive, 4))
        .withColumn("predicted_purchases_12m",
                    round_to(F.col("prob_alive") * (x + 1) * (52.0 / F.greatest(F.col("t"), F.lit(1.0))), 2))
        .where(x > 0)
        .withColumn("predicted_avg_order", F.col("monetary_value") * FALLBACK["value_drift"])
        .withColumn("clv_predicted", round_to(
            F.col("predicted_purchases_12m") * F.col("predicted_avg_order") * FALLBACK["margin"], 2))
    )


# Reports

def clv_join_segments(predictions: DataFrame, seg: DataFrame) -> DataFrame:
    labels = seg.select("customer_id", F.col("segment_label").alias("segment"))
    return predictions.join(labels, "customer_id", "left")


def clv_tiers(predictions: DataFrame) -> DataFrame:
    """Quartile tiers of the value clipped at 0; a value on an edge belongs to the lower tier."""
    value = F.greatest("clv_predicted", F.lit(0.0))
    edges = quantiles(predictions, value, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    if edges["q1"] is None:
        return predictions.withColumn("clv_tier", F.lit(None).cast("string"))
    tier = F.lit(TIERS[3])
    for name, edge in zip(reversed(TIERS[:3]), (edges["q3"], edges["q2"], edges["q1"])):
        tier = F.when(value <= F.lit(edge), name).otherwise(tier)
    return predictions.withColumn("clv_tier", tier)


def clv_tier_table(predictions: DataFrame) -> DataFrame:
    return clv_tiers(predictions).groupBy("clv_tier").agg(
        F.count(F.lit(1)).alias("customers"), round_to(money_avg("clv_predicted"), 2).alias("avg_clv"))


def clv_segment_table(joined: DataFrame) -> DataFrame:
    return joined.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"), round_to(money_avg("clv_predicted"), 2).alias("avg_clv"),
        round_to(money_sum("clv_predicted"), 2).alias("total_clv"), round_to(money_avg("prob_alive"), 2).alias("avg_prob_alive"),
        round_to(money_avg("predicted_purchases_12m"), 2).alias("avg_pred_orders"))


def clv_headline(predictions: DataFrame) -> DataFrame:
    """Total value, customers likely active, and what the top tenth holds."""
    top = top_sums(predictions, "clv_predicted", {"top": "n div 10"}).select("top_sum")
    base = predictions.agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("prob_alive") >= 0.5).alias("likely_active"),
        money_sum("clv_predicted").alias("total"))
    return base.join(F.broadcast(top), how="left").select(  # one row each
        "customers", "likely_active", round_to("total", 2).alias("total_clv"),
        round_to(F.coalesce("top_sum", F.lit(0.0)), 2).alias("top10_clv"),
        share(F.coalesce("top_sum", F.lit(0.0)), F.col("total"), 1).alias("top10_pct"))


def _bin_label(column: str, edges) -> Column:
    label = None
    for low, high in zip(edges, edges[1:]):
        test = (F.col(column) > low) & (F.col(column) <= high)
        label = F.when(test, f"({low}, {high}]") if label is None else label.when(test, f"({low}, {high}]")
    return label


def alive_grid(predictions: DataFrame) -> DataFrame:
    """Mean P(alive) over frequency bins (rows) and recency bins (columns)."""
    names = [f"({a}, {b}]" for a, b in zip(RECENCY_EDGES, RECENCY_EDGES[1:])]
    cells = predictions.select(
        _bin_label("frequency", FREQUENCY_EDGES).alias("f_bin"), _bin_label("recency", RECENCY_EDGES).alias("r_bin"), "prob_alive"
    ).where("f_bin IS NOT NULL AND r_bin IS NOT NULL")
    wide = cells.groupBy("f_bin").pivot("r_bin", names).agg(round_to(money_avg("prob_alive"), 4))
    return wide.withColumnsRenamed({n: f"r_{b}" for n, b in zip(names, RECENCY_EDGES[1:])})


def clv_hist(predictions: DataFrame, bins: int = 50) -> DataFrame:
    """Histogram of the value clipped to [0, 98th percentile], with mean and median of the clipped value."""
    cap = quantiles(predictions, "clv_predicted", {"cap": 0.98})["cap"]
    clipped = predictions.select(F.least(F.greatest("clv_predicted", F.lit(0.0)), F.lit(cap)).alias("x"))
    limits = F.broadcast(clipped.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), money_avg("x").alias("mean")).join(
        F.broadcast(group_quantiles(clipped, "x", {"median": 0.5}).drop("n"))))
    return clipped.join(limits).groupBy(
        equal_width_bin(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin"), "mean", "median"
    ).agg(F.count(F.lit(1)).alias("customers")).select(
        "bin", "customers", round_to("mean", 2).alias("mean"), round_to(round_to("median", 4), 2).alias("median"))


def alive_hist(predictions: DataFrame, bins: int = 40) -> DataFrame:
    """Histogram of P(alive) and the share at or above one half."""
    limits = F.broadcast(predictions.agg(
        F.min("prob_alive").alias("lo"), F.max("prob_alive").alias("hi"),
        share(F.count_if(F.col("prob_alive") >= 0.5), F.count(F.lit(1)), 1).alias("pct_alive")))
    return predictions.join(limits).groupBy(
        equal_width_bin(F.col("prob_alive"), F.col("lo"), F.col("hi"), bins).alias("bin"), "pct_alive"
    ).agg(F.count(F.lit(1)).alias("customers"))
