"""Small helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed, or sent with `--py-files`.
    """
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = paths.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        paths["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not have in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cuts lineage, prunes columns."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_of(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A small table from rows at hand, as literals of the plan: no Python workers read it."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return spark.createDataFrame(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=fields), schema)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def by_bytes(values: Iterable, most: int, size=len) -> Iterator[list]:
    """Lists of values whose sizes sum to about `most`; one larger value is a list of its own."""
    held, total = [], 0
    for value in values:
        n = size(value)
        if held and total + n > most:
            yield held
            held, total = [], 0
        held.append(value)
        total += n
    if held:
        yield held
