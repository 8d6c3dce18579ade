"""Tables kept by key ranges, where a change rewrites only the ranges that it touches.

The rows of a range lie in a folder of their own. A manifest names the live folder of each
range with its number of rows and its greatest surrogate key. A change writes new folders
for its ranges and then the next manifest, which takes effect as a whole; all other folders
stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.names import free, own
from ..operators.ranges import key_ranges, placed
from ..operators.upsert import upsert
from .versions import drop_folder, numbered_folders

ROWS_PER_RANGE = 1_000_000
KEPT_MANIFESTS = 2


@dataclass(frozen=True)
class Part:
    """The live rows of one key range."""

    range: int
    folder: str
    rows: int
    top: int


def parts(spark: SparkSession, root: str) -> list[Part]:
    """Live ranges by the newest whole manifest, at most as many as there are ranges."""
    versions = numbered_folders(spark, f"{root}/manifest", "version")
    if not versions:
        raise ValueError(f"no table below {root}")
    rows = spark.read.parquet(f"{root}/manifest/version={versions[-1]}").collect()
    return [Part(r["range"], r["folder"], r["rows"], r["top"]) for r in rows]


def read(spark: SparkSession, root: str, live: list[Part] | None = None) -> DataFrame:
    """The rows of the given ranges, of all by default."""
    live = parts(spark, root) if live is None else live
    schema = spark.read.parquet(f"{root}/empty").schema
    if not live:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{p.folder}" for p in live])


def _write(df: DataFrame, root: str, version: int, keys: list[str], surrogate: str) -> list[Part]:
    starts = df.sparkSession.read.parquet(f"{root}/ranges")
    name, folder = free("range", df), f"rows/version={version}"
    by_range = placed(df, keys, starts, max(1, starts.select(F.size("starts")).first()[0]), name)
    by_range.hint("rebalance", own(name)).write.mode("overwrite").partitionBy(name).parquet(f"{root}/{folder}")
    stored = df.sparkSession.read.schema(by_range.schema).parquet(f"{root}/{folder}")
    sums = stored.groupBy(own(name).alias("range")).agg(F.count("*").alias("rows"), F.max(own(surrogate)).cast("long").alias("top"))
    return [Part(r["range"], f"{folder}/{name}={r['range']}", r["rows"], r["top"] or 0) for r in sums.collect()]


def _publish(spark: SparkSession, root: str, version: int, live: list[Part]) -> None:
    rows = [(p.range, p.folder, p.rows, p.top) for p in live]
    manifest = spark.createDataFrame(rows, "range int, folder string, rows long, top long")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={version}")
    for old in numbered_folders(spark, f"{root}/manifest", "version")[:-KEPT_MANIFESTS]:
        drop_folder(spark, f"{root}/manifest/version={old}")


def store(df: DataFrame, root: str, keys: list[str], surrogate: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Write a table by ranges of `keys`; later upserts keep these ranges."""
    spark = df.sparkSession
    starts, _ = key_ranges(df, keys, rows_per_range)
    starts.write.parquet(f"{root}/ranges")
    df.limit(0).write.parquet(f"{root}/empty")
    _publish(spark, root, 0, _write(df, root, 0, keys, surrogate))
    return read(spark, root)


def upsert_ranges(
    spark: SparkSession,
    root: str,
    source: DataFrame,
    keys: list[str],
    surrogate: str,
    update_cols: list[str] | None = None,
    last: list[Column] | None = None,
    number_by: list[Column] | None = None,
) -> list[Part]:
    """`operators.upsert.upsert` on a stored table; returns the ranges that were rewritten.

    Only ranges that hold a key of the source are read and written. New keys go to the
    range that they belong to, and are numbered after the greatest surrogate of all.
    """
    live = parts(spark, root)
    starts = spark.read.parquet(f"{root}/ranges")
    name = free("range", source)
    most = max(1, starts.select(F.size("starts")).first()[0])
    touched = {r[0] for r in placed(source.select(*map(own, keys)), keys, starts, most, name).select(own(name)).distinct().collect()}
    if not touched:
        return []
    here = [p for p in live if p.range in touched]
    target = read(spark, root, here)
    top = max((p.top for p in live), default=0)
    version = numbered_folders(spark, f"{root}/manifest", "version")[-1] + 1
    changed = upsert(target, source, keys, surrogate, update_cols, last, number_by, after=top)
    made = _write(changed.select(*map(own, target.columns)), root, version, keys, surrogate)
    _publish(spark, root, version, [*[p for p in live if p.range not in touched], *made])
    return made
