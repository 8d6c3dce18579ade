"""Helper columns that never meet a column of the caller's."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def free(stem: str, *taken: DataFrame | Iterable[str]) -> str:
    """A column name that none of the frames or name lists has, in any letter case."""
    held = {c.lower() for x in taken for c in (x.columns if isinstance(x, DataFrame) else x)}
    name = f"_{stem}"
    while name.lower() in held:
        name = f"_{name}"
    return name


def unless_taken(name: str, *taken: DataFrame | Iterable[str]) -> str:
    """`name` itself where it is free, else with as many `_` before it as make it so."""
    held = {c.lower() for x in taken for c in (x.columns if isinstance(x, DataFrame) else x)}
    while name.lower() in held:
        name = f"_{name}"
    return name


def own(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")
