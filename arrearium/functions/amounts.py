"""Safe ratios, conversion and conditional sums."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = Decimal("0")


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(ZERO))


def ratio(num: Column, den: Column, scale: int, factor: int = 1) -> Column:
    """``factor * num / den`` rounded half-up; null when the divisor is zero or null."""
    d = F.nullif(den.cast("double"), F.lit(0.0))
    return F.round((F.lit(float(factor)) * num.cast("double") / d).cast("decimal(28,10)"), scale)


def converted(amount: Column, rate: Decimal, scale: int = 0) -> Column:
    """An amount divided by a fixed exchange rate (divide after summing, then round)."""
    return F.round(amount / F.lit(rate), scale)


def sum_if(cond: Column, amount: Column) -> Column:
    """Sum over matching rows; null when none matches."""
    return F.sum(F.when(cond, amount))


def sum_or_zero(cond: Column, amount: Column) -> Column:
    """Sum that counts every other row as 0."""
    return F.sum(F.when(cond, amount).otherwise(F.lit(ZERO)))


def mean_of(c: Column, scale: int) -> Column:
    """Average of the non-null values, rounded half-up."""
    return ratio(F.sum(c), F.count(c), scale)


def mean_if(cond: Column, c: Column, scale: int) -> Column:
    return mean_of(F.when(cond, c), scale)
