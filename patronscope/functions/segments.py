"""Business labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numeric import col, round_to

# Segment names, best first, and the lowest total score of each.
SEGMENTS = ("Champions", "Loyal Customers", "Potential Loyal", "At Risk", "Lost / Inactive")
SEGMENT_MIN_SCORE = {"Champions": 12, "Loyal Customers": 9, "Potential Loyal": 7, "At Risk": 5}
# Churn probability by days since the last purchase (more than this many days).
CHURN_STEPS = ((180, 0.85), (90, 0.60), (30, 0.25))
CHURN_FLOOR = 0.05
# Risk bands by churn probability (at least).
RISK_BANDS = (("Critical", 0.80), ("High", 0.55), ("Medium", 0.20))
# Dashboard risk bands, right-closed upper edges.
DASHBOARD_BANDS = (("Low (<25%)", 0.25), ("Medium (25–60%)", 0.60), ("High (60–85%)", 0.85),
                   ("Critical (85%+)", 1.01))
# Buyer types by number of orders (at most).
BUYER_TYPES = (("One-time Buyer", 1), ("Occasional (2–3 orders)", 3), ("Regular (4–9 orders)", 9))
BUYER_TYPE_REST = "Power Buyer (10+ orders)"


def _steps(pairs, test, default) -> Column:
    expression = None
    for result, edge in pairs:
        condition = test(edge)
        expression = F.when(condition, F.lit(result)) if expression is None else expression.when(condition, F.lit(result))
    return expression.otherwise(default)


def segment_label(score: Column | str) -> Column:
    return _steps(SEGMENT_MIN_SCORE.items(), lambda low: col(score) >= low, F.lit(SEGMENTS[-1]))


def segment_order(label: Column | str) -> Column:
    return _steps([(i, name) for i, name in enumerate(SEGMENTS)], lambda name: col(label) == name,
                  F.lit(len(SEGMENTS)))


def churn_probability(recency: Column | str) -> Column:
    return _steps([(p, days) for days, p in CHURN_STEPS], lambda days: col(recency) > days, F.lit(CHURN_FLOOR))


def churn_band(probability: Column | str) -> Column:
    return _steps(RISK_BANDS, lambda low: col(probability) >= low, F.lit("Low"))


def dashboard_band(probability: Column | str) -> Column:
    return _steps(DASHBOARD_BANDS, lambda high: col(probability) <= high, F.lit(None).cast("string"))


def dashboard_band_order(probability: Column | str) -> Column:
    return _steps([(i, high) for i, (_, high) in enumerate(DASHBOARD_BANDS)], lambda high: col(probability) <= high,
                  F.lit(None).cast("int"))


def buyer_type(orders: Column | str) -> Column:
    return _steps(BUYER_TYPES, lambda most: col(orders) <= most, F.lit(BUYER_TYPE_REST))


def clv_proxy(monetary: Column | str, recency: Column | str) -> Column:
    """Yearly spend rate: historical value per day since the last purchase, times 365."""
    return round_to(col(monetary) / F.greatest(col(recency), F.lit(1)) * 365.0, 2)
