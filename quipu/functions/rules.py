"""Business rules of the mart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .dates import day_gap
from .numeric import flag

# fixed values: channels, tariffs and the idle limit
DIRECT, RETAIL = "DIRECTO", "PDV"
DIRECT_TARIFF, RETAIL_TARIFF = "220.00", "160.00"
ADVISOR = "Asesor"
SOLD = "VENDIDO"
IDLE_LIMIT_DAYS = 90
CLEAN_TABLE_MARK = "SI, SOY LA TABLA LIMPIA"


def tariff(amount: str) -> Column:
    return F.lit(amount).cast("decimal(5,2)")


def channel_amount(channel: Column, amount: Column) -> Column:
    """Tariff of the two known channels; the recorded amount for any other."""
    return (
        F.when(channel == DIRECT, tariff(DIRECT_TARIFF))
        .when(channel == RETAIL, tariff(RETAIL_TARIFF))
        .otherwise(amount)
    )


def channel_amount_or_zero(channel: Column) -> Column:
    """Documented variant: `Asesor` names the direct channel, others earn nothing."""
    return (
        F.when(channel == ADVISOR, tariff(DIRECT_TARIFF))
        .when(channel == RETAIL, tariff(RETAIL_TARIFF))
        .otherwise(F.lit("0.00").cast("decimal(5,2)"))
    )


def stock_at_risk(idle_days: Column, state: Column) -> Column:
    """Idle beyond the limit and not sold; false when either is unknown."""
    return F.coalesce((idle_days > IDLE_LIMIT_DAYS) & (state != SOLD), F.lit(False))


def sold_late(sold_on: Column, received_on: Column) -> Column:
    return flag(day_gap(sold_on, received_on) > IDLE_LIMIT_DAYS)


def activation_pct(active: Column) -> Column:
    """Activation of one sale as 0.00 or 100.00."""
    return (active * F.lit("100.00").cast("decimal(5,2)")).cast("decimal(16,2)")


def goal_light(ratio: Column) -> Column:
    return (
        F.when(ratio >= 1, "Meta Cumplida").when(ratio >= 0.8, "En Riesgo").otherwise("Critico")
    )
