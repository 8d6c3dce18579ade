"""Registration of queries beside their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..plans.mart import Mart
from .oracle import with_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(mart)` under `name`; `sql` may use any table of `oracle.TABLES`."""

    def register(fn: Callable[[Mart], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, root: fn(Mart(spark, root))
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return register
