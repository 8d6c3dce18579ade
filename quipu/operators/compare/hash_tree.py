"""Range hash trees: which key ranges of two tables differ, without moving their rows.

A table's rows fall into ranges of a key. A range's hash is the sum of 128-bit row hashes,
so rows count as often as they occur, their order does not matter, and hashes of ranges
add up to those of nodes above, to one root. Equal nodes hold equal rows (but for a chance
of 2^-128 or so), so a comparison descends from the root and reads only ranges that differ.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ...session import written
from ..names import free, own
from ..ranges import key_ranges, placed

FANOUT = 256  # 65,536 ranges at most, so a root, 256 nodes and the ranges
LEVELS = 3
ROWS_PER_RANGE = 1_000_000
#: parts of a 64-bit hash whose sums over two million million rows stay whole numbers of 64 bits
PARTS = ((0, 22), (22, 21), (43, 21))
SUMS = ["n", *[f"h{i}" for i in range(2 * len(PARTS))]]


def row_sums(columns: list[str]) -> list[Column]:
    """Number and hash sums of a group of rows; NULL is told from any value and from its place."""
    cells = [x for c in columns for x in (own(c), own(c).isNull())]
    hashes = [F.xxhash64(F.lit(seed), *cells) for seed in (1, 2)]
    parts = [F.shiftrightunsigned(h, at).bitwiseAND((1 << bits) - 1) for h in hashes for at, bits in PARTS]
    return [F.count("*").alias("n"), *[F.sum(p).alias(name) for p, name in zip(parts, SUMS[1:])]]


def range_hashes(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One row for each range (`node`); only these sums are shuffled."""
    return df.groupBy(own(name).alias("node")).agg(*row_sums(columns))


def unlike_nodes(a: DataFrame, b: DataFrame) -> list[int]:
    """Nodes with other sums, or on one side only; at most MOST_RANGES numbers."""
    theirs = b.select("node", F.struct(*SUMS).alias("theirs"))
    both = a.select("node", F.struct(*SUMS).alias("ours")).join(theirs, "node", "full")
    return [r.node for r in both.filter(~F.col("ours").eqNullSafe(F.col("theirs"))).select("node").collect()]


def aligned(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Both frames with the same columns and types, or None where their columns differ."""
    if sorted(a.columns) != sorted(b.columns) or len(set(a.columns)) < len(a.columns):
        return None
    kinds = a.limit(0).unionByName(b.limit(0)).schema
    cast = lambda df: df.select(*[own(f.name).cast(f.dataType).alias(f.name) for f in kinds])
    return cast(a), cast(b)


def unlike_rows(a: DataFrame, b: DataFrame, keys: list[str], rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables, of the same columns, in the key ranges where they differ.

    The tables are read twice and only keys' samples and ranges' sums are shuffled. What is
    left out is equal on both sides, repeats counted.
    """
    name = free("range", a, b)
    starts, most = key_ranges(a, keys, rows_per_range)
    sides = [placed(x, keys, starts, most, name) for x in (a, b)]
    wanted = unlike_nodes(*[range_hashes(x, a.columns, name) for x in sides])
    return tuple(x.filter(own(name).isin(wanted)).drop(name) for x in sides)


# -- stored tables


@dataclass(frozen=True)
class HashedTable:
    """A table stored by key ranges, with its tree beside it."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: StructType
    range_name: str
    most: int

    @staticmethod
    def store(
        df: DataFrame, path: str, keys: list[str], like: HashedTable | None = None, rows_per_range: int = ROWS_PER_RANGE
    ) -> HashedTable:
        """Write `df` by ranges of `keys`, one folder each, and its tree.

        Tables can be compared where one was stored `like` the other, by the same ranges.
        """
        spark, name = df.sparkSession, like.range_name if like else free("range", df)
        if like is not None and (like.keys != tuple(keys) or name in df.columns):
            raise ValueError("a table stored like another needs its keys and a free column for the range")
        starts, most = (like.starts(), like.most) if like else key_ranges(df, keys, rows_per_range)
        by_range = placed(df, keys, starts, most, name)
        # Spark splits the rows of a very large range over several files
        by_range.hint("rebalance", own(name)).write.partitionBy(name).parquet(f"{path}/rows")
        starts.write.parquet(f"{path}/starts")
        stored = spark.read.schema(by_range.schema).parquet(f"{path}/rows")
        leaves = written(range_hashes(stored, df.columns, name), "range-hashes")
        levels = [
            leaves.groupBy(F.floor(F.col("node") / F.lit(FANOUT**up)).cast("int").alias("node")).agg(*[F.sum(s).alias(s) for s in SUMS]).withColumn("level", F.lit(LEVELS - 1 - up))
            for up in range(LEVELS)
        ]
        reduce(DataFrame.unionByName, levels).repartition(1).write.partitionBy("level").parquet(f"{path}/tree")
        about = spark.createDataFrame([(list(keys), by_range.schema.json(), name, most)], "keys array<string>, schema string, name string, most int")
        about.write.parquet(f"{path}/about")  # last: a table without it is not whole
        return HashedTable.open(spark, path)

    @staticmethod
    def open(spark: SparkSession, path: str) -> HashedTable:
        about = spark.read.parquet(f"{path}/about").first()
        return HashedTable(spark, path, tuple(about["keys"]), StructType.fromJson(json.loads(about["schema"])), about["name"], about["most"])

    @property
    def columns(self) -> list[str]:
        return [c for c in self.schema.names if c != self.range_name]

    def starts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/starts")

    def level(self, level: int) -> DataFrame:
        sums = ", ".join(f"{s} long" for s in SUMS)
        return self.spark.read.schema(f"node int, {sums}, level int").parquet(f"{self.path}/tree").filter(F.col("level") == level).drop("level")

    def rows(self, ranges: list[int] | None = None) -> DataFrame:
        """All rows, or those of the given ranges, from their folders alone."""
        reader, folders = self.spark.read.schema(self.schema), [f"{self.path}/rows"]
        if ranges is not None:
            there = {r.node for r in self.level(LEVELS - 1).select("node").collect()}
            folders = [f"{self.path}/rows/{self.range_name}={r}" for r in sorted(there.intersection(ranges))]
            if not folders:
                return self.spark.createDataFrame([], self.schema).select(*map(own, self.columns))
        return reader.option("basePath", f"{self.path}/rows").parquet(*folders).select(*map(own, self.columns))

    def unlike(self, other: HashedTable) -> list[int]:
        """Ranges whose rows differ, found from the root down; equal tables compare two rows."""
        if self.starts().first() != other.starts().first() or self.keys != other.keys or set(self.columns) != set(other.columns):
            raise ValueError("only tables stored by the same ranges, keys and columns can be compared")
        nodes: list[int] = []
        for level in range(LEVELS):
            sides = [t.level(level) for t in (self, other)]
            if level:
                sides = [s.filter(F.floor(F.col("node") / F.lit(FANOUT)).isin(nodes)) for s in sides]
            nodes = unlike_nodes(*sides)
            if not nodes:
                return []
        return sorted(nodes)

    def unlike_rows(self, other: HashedTable) -> tuple[DataFrame, DataFrame]:
        """Rows of both tables in the ranges that differ; no other range is read."""
        ranges = self.unlike(other)
        return self.rows(ranges), other.rows(ranges)
