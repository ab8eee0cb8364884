"""Distribution tails as column expressions, for tables of a few rows."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, functions as F

# Abramowitz & Stegun 7.1.26, absolute error below 1.5e-7.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
SIMPSON_STEPS = 2000
#: Standard widths of the density beyond which nothing is left in double precision.
TAIL_WIDTHS = 12.0
HALF_PI = 1.5707963267948966


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def normal_sf(z: Column) -> Column:
    """P(Z > z)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1.0 / (1.0 + ERF_P * x)
    poly = F.lit(0.0)
    for a in reversed(ERF_A):
        poly = (poly + a) * t
    tail = 0.5 * poly * F.exp(-x * x)
    return F.when(z >= 0, tail).otherwise(1.0 - tail)


def chi2_sf_1df(x: Column) -> Column:
    """P(chi-square with one degree of freedom > x)."""
    return 2.0 * normal_sf(F.sqrt(x))


def _simpson(low: Column, high: Column, f) -> Column:
    n = SIMPSON_STEPS
    step = (high - low) / float(n)

    def add(total: Column, i: Column) -> Column:
        weight = F.when((i == 0) | (i == n), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
        return total + weight * f(low + step * i)

    return F.aggregate(F.sequence(F.lit(0), F.lit(n)), F.lit(0.0), add) * step / 3.0


def student_t_sf(t: Column, df: Column) -> Column:
    """P(T > t) by integrating the density; no gamma function is needed because both integrals share its constant."""
    size = F.abs(t)
    angle = F.atan(size / F.sqrt(df))

    def curve(theta: Column) -> Column:
        return F.pow(F.greatest(F.cos(theta), F.lit(0.0)), df - 1.0)

    # The density is about 1 / sqrt(df) wide; the grid follows it, so any number of degrees of freedom is resolved.
    reach = F.lit(TAIL_WIDTHS) / F.sqrt(F.greatest(df, F.lit(1.0)))
    tail = _simpson(angle, F.least(F.lit(HALF_PI), angle + reach), curve) / (
        2.0 * _simpson(F.lit(0.0), F.least(F.lit(HALF_PI), reach), curve))
    return F.when(t >= 0, tail).otherwise(1.0 - tail)
