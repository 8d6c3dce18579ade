"""Joins that hold up when one key carries a third of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed
from .names import free, own


def lookup(fact: DataFrame, dim: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Star join to a written dimension; Catalyst and AQE broadcast it where its bytes allow."""
    return fact.join(dim, on, how)


def left_join_unique(
    left: DataFrame, right: DataFrame, key: str, spread_by: list[str] | None = None
) -> DataFrame:
    """Left join to a side whose key is unique.

    A hot left key is split by AQE, which can cut the left side of a left join freely.
    With `spread_by`, rows whose key is NULL get a second join value from those columns:
    they match nothing, so they may go to any task instead of all hashing to one.
    """
    if spread_by is None:
        return left.join(right, key, "left")
    # always 0, but not a constant the optimizer would fold out of the join keys
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    scattered = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*spread_by), F.lit(1 << 20)))
    beside = free("spread", left, right)
    spread = left.withColumn(beside, scattered.otherwise(zero))
    return spread.join(right.withColumn(beside, zero), [key, beside], "left").drop(beside)


def hot_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """Keys with more rows than an average one of `parts` partitions, and their share in partitions.

    Fewer than `parts` keys can hold that many rows, which bounds the list.
    """
    counts = df.select(own(key).alias("_key")).filter("_key is not null").groupBy("_key").agg(F.count("*").alias("_n"))
    limit = counts.agg(F.greatest(F.ceil(F.sum("_n") / parts), F.lit(1))).scalar()
    splits = F.ceil(F.col("_n") / limit).cast("int")
    return counts.select(F.col("_key").alias("_hot"), splits.alias("_splits")).filter("_splits > 1")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    parts: int | None = None,
    right_keys: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on one column where the right side may repeat a key without bound.

    AQE can cut the left side of a left join but never the right. A right key with more
    rows than a partition should hold (all rows / `parts`, by default the session's
    shuffle partitions) is split by a hash of the row into as many pieces as it fills, and
    the left rows of that key are repeated once per piece. The hot list is counted with
    map-side combining and written once. `right_keys` may name a cheaper frame with the
    same keys.
    """
    if how not in ("left", "inner"):
        raise ValueError("skew_join does inner and left joins")
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = checkpointed(hot_keys(right_keys if right_keys is not None else right, key, parts))
    if hot.isEmpty():
        return left.join(right, key, how)

    names = {stem: free(stem, left, right) for stem in ("hot", "splits", "salt", "found")}
    hot = hot.withColumnsRenamed({"_hot": names["hot"], "_splits": names["splits"]})
    hot_key, splits, salt, found = (F.col(names[x]) for x in ("hot", "splits", "salt", "found"))
    is_hot = hot_key.isNotNull()
    spread = F.array(F.pmod(F.xxhash64(*map(own, left.columns)), F.lit(parts)).cast("int"))
    own_right = F.pmod(F.xxhash64(*map(own, right.columns)), splits).cast("int")
    split_right = (
        right.join(F.broadcast(hot), own(key) == hot_key, "left")
        .withColumn(names["salt"], F.when(is_hot, own_right).otherwise(0))
        .withColumn(names["found"], F.lit(True))
        .drop(names["hot"], names["splits"])
    )
    repeated_left = left.join(F.broadcast(hot), own(key) == hot_key, "left").withColumn(
        names["salt"],
        F.explode(
            F.when(is_hot, F.sequence(F.lit(0), splits - 1))
            .when(own(key).isNull(), spread)
            .otherwise(F.array(F.lit(0)))
        ),
    )
    joined = repeated_left.join(split_right, [key, names["salt"]], how)
    # a repeated left row has a match in some piece; drop its empty pieces
    return joined.filter(~is_hot | found.isNotNull()).drop(*names.values())


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys where NULL equals NULL; semi and anti joins included.

    The right keys are renamed first, so two versions of one table never confuse their
    columns; the result has the left keys.
    """
    theirs: dict[str, str] = {}
    for k in keys:
        theirs[k] = free(f"r_{k}", left, right, theirs.values())
    condition = reduce(Column.__and__, [own(k).eqNullSafe(own(theirs[k])) for k in keys])
    return left.join(right.withColumnsRenamed(theirs), condition, how).drop(*theirs.values())
