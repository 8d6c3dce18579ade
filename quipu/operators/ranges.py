"""Ranges of keys that Spark chooses and expressions can find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .names import own

MOST_RANGES = 1 << 16  # starts of ranges stand in one array
SAMPLED_KEYS = 100  # for each range


def range_starts(keys: DataFrame, n: int) -> DataFrame:
    """One row with `starts`: the first keys of about `n` ranges of equal weight, in order.

    A key is the struct of all columns of `keys`, of any orderable types; NULLs come first.
    The least key is the first start, equal keys share a range, and without rows the array
    is empty. Only the keys are shuffled.
    """
    if not 1 <= n <= MOST_RANGES:
        raise ValueError(f"the number of ranges must lie in 1..{MOST_RANGES}")
    dealt = keys.select(F.struct(*[F.col(f"`{c}`") for c in keys.columns]).alias("key")).repartitionByRange(n, "key")
    firsts = written(dealt.groupBy(F.spark_partition_id().alias("at")).agg(F.min("key").alias("key")), "range-starts")
    return written(firsts.agg(F.sort_array(F.collect_set("key")).alias("starts")), "range-starts")


def with_range(df: DataFrame, key: Column, starts: DataFrame, name: str, most: int = MOST_RANGES) -> DataFrame:
    """`df` with the number of the key's range in `name`: how many starts lie at or below it, less one.

    A key below all starts has range -1. The starts, at most `most`, come as one array, in
    which each row's place is found by halving; no row moves. Filters on the range stay
    above the search: pushed below they would repeat its steps in each other.
    """
    held = starts.scalar()
    out = df.withColumn(name, F.lit(0))
    for i in range(most.bit_length() - 1, -1, -1):
        at, step = F.col(f"`{name}`"), 1 << i
        out = out.withColumn(name, F.when(F.get(held, at + (step - 1)) <= key, at + step).otherwise(at))
    kept_apart = F.spark_partition_id() * 0  # not deterministic for the optimizer
    return out.withColumn(name, F.col(f"`{name}`") - 1 + kept_apart)


def key_ranges(df: DataFrame, keys: list[str], rows_per_range: int | None = None, ranges: int = 1) -> tuple[DataFrame, int]:
    """Starts of ranges of about so many rows, or of so many ranges, and how many they are at most.

    They come from a sample of the distinct keys.
A key never spans two ranges, so the rows of a very frequent key are one range.
    """
    rows = df.count()
    n = max(1, min(MOST_RANGES, -(-rows // rows_per_range) if rows_per_range else ranges))
    cells = [own(k) for k in keys]
    share = min(1.0, SAMPLED_KEYS * n / max(rows, 1))
    drawn = F.pmod(F.xxhash64(*cells, *[c.isNull() for c in cells]), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    picked = df.select(*[c.alias(f"k{i}") for i, c in enumerate(cells)], drawn.alias("drawn")).filter("drawn").drop("drawn").distinct()
    return range_starts(picked, n), n


def key_of(keys: list[str]) -> Column:
    return F.struct(*[own(k).alias(f"k{i}") for i, k in enumerate(keys)])


def placed(df: DataFrame, keys: list[str], starts: DataFrame, most: int, name: str) -> DataFrame:
    """`df` with the range of its key in `name`; keys below all starts are in the first."""
    return with_range(df, key_of(keys), starts, name, most).withColumn(name, F.greatest(own(name), F.lit(0)))
