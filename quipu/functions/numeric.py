"""Ratios and rounding, kept in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PERCENT = "decimal(20,2)"


def percent(part: Column, whole: Column) -> Column:
    """`part / whole * 100` at two decimals, half away from zero; NULL over zero."""
    exact = part.cast("decimal(20,0)") / F.nullif(whole, F.lit(0))
    return F.round(exact * 100, 2).cast(PERCENT)


def money_percent(part: Column, whole: Column) -> Column:
    """`percent` for decimal amounts."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, 2).cast(PERCENT)


def divide(part: Column, whole: Column, otherwise: float = 0.0) -> Column:
    """Ratio as a double; `otherwise` when the divisor is zero or missing."""
    ratio = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.coalesce(ratio, F.lit(float(otherwise)))


def positive_part(number: Column) -> Column:
    return F.greatest(number, F.lit(0))


def flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)
