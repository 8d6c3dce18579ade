"""Hierarchy drill-down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def drill(df: DataFrame, levels: list[str], measures: list[Column]) -> DataFrame:
    """Subtotals along a hierarchy, with `nivel` = number of levels kept."""
    rolled = df.rollup(*levels).agg(F.grouping_id().alias("_mask"), *measures)
    depth = F.lit(len(levels)) - F.bit_count("_mask")
    return rolled.withColumn("nivel", depth.cast("int")).drop("_mask")
