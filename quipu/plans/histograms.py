"""Days as histograms, so that medians and quantiles add up along any hierarchy.

A histogram has one row for each group and number of days. Histograms of loads are added
like sums, and every level of a drill follows from them without the facts: means cannot be
averaged over groups and medians cannot be added, but counts by day can.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.subtotals import drill

DAYS, ROWS = "dias", "filas"


def day_histogram(rows: DataFrame, by: list[Column], days: Column, weight: Column | None = None) -> DataFrame:
    """Rows (or their weights) by group and number of days; unknown days count nowhere."""
    counts = rows.groupBy(*by, days.alias(DAYS)).agg(F.sum(weight if weight is not None else F.lit(1)).alias(ROWS))
    return counts.filter((F.col(ROWS) > 0) & F.col(DAYS).isNotNull())


def added(histograms: list[DataFrame]) -> DataFrame:
    """One histogram of several loads."""
    both = reduce(DataFrame.unionByName, histograms)
    return both.groupBy(*[c for c in both.columns if c != ROWS]).agg(F.sum(ROWS).alias(ROWS))


def day_measures() -> list[Column]:
    """Kits, mean, median and 90 % point; a group holds as many numbers as it has different days."""
    points = F.percentile(F.col(DAYS), F.array(F.lit(0.5), F.lit(0.9)), F.col(ROWS))
    return [
        F.sum(ROWS).alias("kits"),
        (F.sum(F.col(DAYS) * F.col(ROWS)).cast("double") / F.sum(ROWS)).alias("dias_promedio"),
        points[0].alias("dias_mediana"),
        points[1].alias("dias_p90"),
    ]


def day_drill(histogram: DataFrame, levels: list[str]) -> DataFrame:
    """The measures at every level of the hierarchy, from the histogram alone."""
    return drill(histogram, levels, day_measures())
