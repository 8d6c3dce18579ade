"""Shares of a total."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import money_percent


def share_of_total(df: DataFrame, by: list[str], amount: str, name: str) -> DataFrame:
    """Per group: its sum and its percentage of the overall sum.

    The overall sum is a scalar subquery over the grouped sums, so the rows are
    aggregated once before anything moves.
    """
    groups = df.groupBy(*by).agg(F.sum(amount).alias("_part"))
    total = groups.agg(F.sum("_part")).scalar()
    return groups.withColumn(name, money_percent(F.col("_part"), total)).withColumnRenamed(
        "_part", f"{amount}_total"
    )


def share_within(df: DataFrame, all_over: list[str], within: list[str], amount: Column) -> DataFrame:
    """Group value against the same value with the `all_over` columns unfiltered."""
    groups = df.groupBy(*within, *all_over).agg(amount.alias("valor"))
    totals = groups.groupBy(*within).agg(F.sum("valor").alias("valor_total"))
    if not within:
        return groups.withColumn("valor_total", groups.agg(F.sum("valor")).scalar())
    return groups.join(totals, within)
