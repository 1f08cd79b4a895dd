"""Deterministic numeric helpers.

Rules: sums that must not depend on partitioning are taken as integers of
10^-scale units and turned into a double once; one-decimal rounding is half-even (``rint``), matching
the published scores.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

MICROS_PER_DAY = 86_400_000_000


def round1(c: str | Column) -> Column:
    """Half-even rounding to one decimal: 6.25 -> 6.2."""
    return F.rint(col_(c) * F.lit(10.0)) / F.lit(10.0)


def clamp(c: Column, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), c))


def scaled(c: str | Column, scale: int) -> Column:
    """A value with at most ``scale`` decimals as an exact integer count of 10^-scale units."""
    return F.round(col_(c) * F.lit(float(10 ** scale))).cast("long")


def exact_sum(c: str | Column, scale: int) -> Column:
    """Order-independent sum of values with at most ``scale`` decimals, as double.

    Summed as a 64-bit integer of 10^-scale units: exact, partition-order
    free, a fixed-width (hash-aggregate) buffer, and no overflow below
    ~9e18 units — unlike a DECIMAL(p,s) sum, whose result precision caps it.
    """
    return F.sum(scaled(c, scale)) / F.lit(float(10 ** scale))


def exact_mean(c: str | Column, scale: int) -> Column:
    """Mean whose numerator is an exact scaled-integer sum (null when no values)."""
    x = col_(c)
    return exact_sum(x, scale) / F.count(x)


def floor_days(start: str | Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end`` rounded toward minus infinity.

    ``timestamp_diff(MICROSECOND, ...)`` on TIMESTAMP_NTZ is zone independent.
    """
    micros = F.timestamp_diff("MICROSECOND", col_(start), end)
    return F.floor(micros / F.lit(MICROS_PER_DAY))
