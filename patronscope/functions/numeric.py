"""Exact money sums and rounding.

A sum of doubles depends on the order in which partitions arrive. Money is therefore summed in whole ten-thousandths:
a BIGINT addition is exact, order free and stays inside generated code, and ANSI mode raises instead of wrapping around.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS = 10_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(c: Column | str) -> Column:
    """Amount in whole ten-thousandths."""
    return F.floor(col(c) * UNITS + 0.5)


def amount(total_units: Column) -> Column:
    return total_units / F.lit(float(UNITS))


def money_sum(c: Column | str) -> Column:
    return amount(F.sum(units(c)))


def money_avg(c: Column | str) -> Column:
    return money_sum(c) / F.count(col(c))


def round_to(c: Column | str, digits: int = 0) -> Column:
    """Round half away from zero on the binary value itself, the same in every engine."""
    scale = 10.0**digits
    value = col(c).cast("double")
    return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale


def round_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even."""
    scale = 10.0**digits
    return F.rint(col(c) * scale) / scale


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """Percentage of a whole, NULL when the whole is zero."""
    return round_to(part * 100.0 / F.nullif(whole, F.lit(0)), digits)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based histogram bin; the last bin is closed on the right, a zero-width range falls into bin 0."""
    width = (high - low) / float(bins)
    return (
        F.when(width == 0, F.lit(0))
        .otherwise(F.least(F.floor((value - low) / width), F.lit(bins - 1)))
        .cast("int")
    )
