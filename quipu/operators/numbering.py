"""Global row numbers and best-row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import checkpointed
from .names import free, own

ROW_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def number_rows(df: DataFrame, order: list[Column], name: str, start: Column | None = None) -> DataFrame:
    """Add 1..n in `order` without sorting everything in one task.

    Rows are range-partitioned and sorted, written once to the shared folder, and
    numbered as (rows in earlier partitions) + (index in the own partition). `order`
    must be total: only equal sort keys are kept in one partition.
    """
    base = start if start is not None else F.lit(0)
    placed = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order))
    at, part, before = (free(stem, placed, [name]) for stem in ("at", "part", "before"))
    placed = placed.withColumn(at, F.monotonically_increasing_id())
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the frame and the broadcast hold at most shuffle.partitions rows
    offsets = (
        placed.groupBy(F.shiftright(at, ROW_BITS).alias(part))
        .agg(F.count("*").alias(before))
        .select(part, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before))
    )
    index = F.col(at).bitwiseAND((1 << ROW_BITS) - 1)
    return (
        placed.join(F.broadcast(offsets), F.shiftright(at, ROW_BITS) == F.col(part))
        .withColumn(name, base + F.col(before) + index + 1)
        .drop(at, part, before)
    )


def keep_best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of each key in `order`.

    Catalyst puts a WindowGroupLimit before the exchange, so each map task sends at
    most one row per key and a hot key never gathers in one task.
    """
    place = free("place", df)
    ranked = df.withColumn(place, F.row_number().over(Window.partitionBy(*map(own, keys)).orderBy(*order)))
    return ranked.filter(F.col(place) == 1).drop(place)


def first_writer(streams: list[DataFrame], keys: list[str]) -> DataFrame:
    """Insert-ignore: the earliest stream that brings a key keeps it."""
    order = free("turn", *streams)
    tagged = [s.withColumn(order, F.lit(turn)) for turn, s in enumerate(streams)]
    rows = tagged[0]
    for stream in tagged[1:]:
        rows = rows.unionByName(stream, allowMissingColumns=True)
    return keep_best(rows, keys, [F.col(order)]).drop(order)
