"""Tables that are replaced as a whole or not at all.

Each version of a table is a folder `version=<n>` of its own. Spark's commit marks it as
whole, and from then on readers take it; a job that dies on the way leaves the version before
as the one to read, and the next try writes over what it left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

KEPT_VERSIONS = 2  # the current one, and the one that running readers may still hold


def _files(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def numbered_folders(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers n of the whole folders `root/name=n`, in order."""
    path, files = _files(spark, root)
    if not files.exists(path):
        return []
    found = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith(f"{name}=")]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done)


def drop_folder(spark: SparkSession, root: str) -> None:
    path, files = _files(spark, root)
    files.delete(path, True)


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None, kept: int = KEPT_VERSIONS) -> DataFrame:
    """Write `df` as the next version, then drop all but the last `kept`; returns the new version's rows.

    The rows may be read from an earlier version of the same table. Writers must not run at
    the same time.
    """
    spark = df.sparkSession
    done = numbered_folders(spark, root, "version")
    path = f"{root}/version={done[-1] + 1 if done else 0}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    for old in done[: max(0, len(done) + 1 - kept)]:
        drop_folder(spark, f"{root}/version={old}")
    return spark.read.parquet(path)


def published(spark: SparkSession, root: str) -> DataFrame:
    """The last whole version."""
    done = numbered_folders(spark, root, "version")
    if not done:
        raise ValueError(f"no whole version below {root}")
    return spark.read.parquet(f"{root}/version={done[-1]}")
