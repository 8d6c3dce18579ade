"""Writing models: materialisation, load modes, typing."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.text import FOLDED
from ..operators.names import unless_taken
from ..session import at_once
from .schemas import MART_DEFAULTS, MART_SCHEMAS
from .versions import publish


def resolve_schema(custom: str | None, default: str) -> str:
    """A model's own schema name is used as it is, without a prefix."""
    return custom.strip() if custom is not None else default


def model_path(root: str, schema: str, name: str) -> str:
    return f"{root}/{schema}/{name}"


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Materialise as a view: the definition is stored, rows are read at use."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Materialise as a table: replaced in full or not at all, so a rerun leaves the same rows.

    Read it later with `versions.published`.
    """
    return publish(df, path, partition_by)


def append_load(df: DataFrame, path: str, load_id: int) -> DataFrame:
    """Append under a load id.

    The load is its own partition and only that partition is replaced, so running the
    same load again does not duplicate rows. The id's column is `load_id`, with `_` before it
    where the source has a column of that name.
    """
    held = with_load_id(df.schema)
    name = held.names[-1]
    (
        df.withColumn(name, F.lit(load_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(name)
        .parquet(path)
    )
    return df.sparkSession.read.schema(held).parquet(path)


def with_load_id(schema: StructType) -> StructType:
    """A source's columns, and last the one that holds the load id."""
    return StructType([*schema.fields, StructField(unless_taken("load_id", schema.names), IntegerType())])


def snapshot_copy(tables: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Copy whole tables into a mirror folder."""
    return {name: as_table(df, f"{root}/{name}") for name, df in tables.items()}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select, cast and default the columns a mart table declares.

    A declared column the input lacks takes its default; auto-numbered keys stay out.
    """
    schema = StructType.fromDDL(MART_SCHEMAS[table])
    defaults = MART_DEFAULTS.get(table, {})
    cells = []
    for f in schema.fields:
        if f.name.endswith("_key") and f.name not in df.columns:
            continue
        cell = F.col(f.name) if f.name in df.columns else F.lit(defaults.get(f.name))
        cells.append(cell.cast(f.dataType).alias(f.name))
    return df.select(*cells)


def fill_defaults(df: DataFrame, table: str) -> DataFrame:
    """`conform`, with missing cells filled too, for loads that leave them out."""
    typed = conform(df, table)
    defaults = MART_DEFAULTS.get(table, {})
    return typed.select(
        *[
            F.coalesce(F.col(f.name), F.lit(defaults[f.name]).cast(f.dataType)).alias(f.name)
            if f.name in defaults
            else F.col(f.name)
            for f in typed.schema.fields
        ]
    )


def collate_text(df: DataFrame, collation: str = FOLDED) -> DataFrame:
    """Give every text column a collation, so later joins and groups use it."""
    return df.select(
        *[
            F.col(f.name).cast(StringType(collation)).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def recreate(spark: SparkSession, root: str, tables: list[str]) -> dict[str, DataFrame]:
    """Replace target tables by empty ones of their declared schema."""
    empty = lambda name: as_table(spark.createDataFrame([], MART_SCHEMAS[name]), f"{root}/{name}")
    return dict(zip(tables, at_once(*[partial(empty, name) for name in tables])))
