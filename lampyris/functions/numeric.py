"""Exact sums and guarded arithmetic shared by summaries and marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as decimals with 18 places, so small amounts count and totals
# do not depend on the order in which partitions are combined.
MONEY = "decimal(38,18)"


def cost_units(usd: Column) -> Column:
    return usd.cast(MONEY)


def usd(units: Column) -> Column:
    return units.cast("double")


def ratio(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """``numerator / denominator`` or NULL when the denominator is not positive."""
    value = numerator / F.when(denominator > 0, denominator)
    return value if digits is None else F.round(value, digits)


def safe_divide(numerator: Column, denominator: Column, digits: int | None = None) -> Column:
    """``numerator / denominator`` or NULL when the denominator is zero."""
    value = numerator / F.nullif(denominator, F.lit(0))
    return value if digits is None else F.round(value, digits)


def exact_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded ratio of decimal-valued doubles, computed in decimals.

    Half-way cases round up as written, which binary division can miss.
    NULL when the denominator is not positive.
    """
    wide = numerator.cast("decimal(28,12)")
    return F.round(wide / F.when(denominator > 0, denominator), digits).cast("double")


def flag(metric: Column, predicate: Column) -> Column:
    """``predicate`` where the metric is known, else NULL."""
    return F.when(metric.isNotNull(), predicate)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def or_unknown(text: Column, fallback: str = "unknown") -> Column:
    """Text, or the fallback where it is NULL or blank."""
    return F.when(is_blank(text), F.lit(fallback)).otherwise(text)


def is_failed(status: Column) -> Column:
    return F.lower(F.coalesce(status, F.lit(""))).isin("error", "failed", "timeout")
