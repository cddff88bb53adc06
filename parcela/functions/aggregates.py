"""Aggregate expressions whose result does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_quotient(total: Column, n: Column, digits: int = 2) -> Column:
    """``ROUND(total / n, digits)`` of a decimal sum and a count, half away from zero, as a double.

    The rounding is one integer division, so ties are exact.
    """
    n = n.cast("decimal(20,0)")
    doubled = F.abs(total) * F.lit(2 * 10**digits) + n
    rounded = F.call_function("div", doubled, F.nullif(n * 2, F.lit(0).cast("decimal(20,0)")))
    return F.signum(total.cast("double")) * rounded / F.lit(float(10**digits))


def mean_rounded(c: Column, digits: int = 2, scale: int = 2) -> Column:
    """``ROUND(AVG(c), digits)``; the sum is a decimal, so no order of the input can change it."""
    return rounded_quotient(F.sum(c.cast(f"decimal(18,{scale})")), F.count(c), digits)


def share_of(part: Column, total: Column, digits: int = 2) -> Column:
    """Percentage of two counts, rounded half up, as a double; null for an empty total."""
    scaled = part.cast("decimal(20,0)") * F.lit(200 * 10**digits) + total
    halves = F.nullif(total.cast("decimal(20,0)") * 2, F.lit(0).cast("decimal(20,0)"))
    return F.call_function("div", scaled, halves) / F.lit(float(10**digits))


def as_double(c: Column) -> Column:
    return c.cast("double")
