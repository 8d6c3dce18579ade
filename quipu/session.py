"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

DRIVER_THREADS = 4

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot partition even when the split costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # joins here can multiply their rows, so small inputs still get a task per core
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128KB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(app: str = "quipu", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings the jobs expect; `settings` use `__` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in `spark.checkpoint.dir`.

    Only a local session without that setting falls back to a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="quipu-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote below `scratch_path`, when its results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/scratch")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def at_once(*jobs: Callable[[], DataFrame | None]) -> list[DataFrame | None]:
    """What jobs that do not need each other return, run from a few driver threads."""
    with ThreadPoolExecutor(DRIVER_THREADS) as pool:
        return list(pool.map(lambda job: job(), jobs))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder, keeping its partitions and row order."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as a table in the shared folder and read it back.

    For intermediates that several jobs read: columns prune, and the file sizes tell
    Catalyst whether a side is small.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
