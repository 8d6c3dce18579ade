"""Incremental append by cursor, as a batch or as a stream over arriving files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import null_safe
from ..operators.names import own
from ..sources.sinks import append_load, with_load_id


def newer_than(source: DataFrame, cursor: str, last: object | None) -> DataFrame:
    """Rows at or past the last cursor value, or without one; the filter reaches the file scan."""
    if last is None:
        return source
    return source.filter((own(cursor) >= F.lit(last)) | own(cursor).isNull())


def append_newer(
    spark: SparkSession, source: DataFrame, path: str, cursor: str, keys: list[str], load_id: int
) -> DataFrame:
    """Append to `path`, under `load_id`, the source rows it does not hold; returns the target.

    Rows past the last cursor value are new. Rows that share it, or have none, are new if
    their key is not among the loaded rows of that value. A load that runs again replaces
    its own partition. Loads must come in the order of their ids.
    """
    held = with_load_id(source.schema)
    by_load = held.names[-1]
    try:
        loaded = spark.read.schema(held).parquet(path).filter(F.col(by_load) < load_id)
        last = loaded.agg(F.max(own(cursor))).first()[0]
    except AnalysisException as error:  # the first load finds no table
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        loaded, last = None, None
    rows = newer_than(source, cursor, last)
    if loaded is not None:
        tied = loaded.filter((own(cursor) == F.lit(last)) | own(cursor).isNull() if last is not None else F.lit(True))
        same = list(dict.fromkeys([*keys, cursor]))
        rows = null_safe(rows, tied.select(*map(own, same)), same, "left_anti")
    append_load(rows, path, load_id)
    return spark.read.schema(held).parquet(path).drop(by_load)


def append_stream(
    spark: SparkSession, src: str, schema: str, path: str, checkpoint: str, transform=lambda df: df
) -> DataFrame:
    """Load the files not loaded yet and stop; a rerun loads only what is new."""
    arriving = spark.readStream.schema(schema).parquet(src)
    query = (
        transform(arriving)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(path)
