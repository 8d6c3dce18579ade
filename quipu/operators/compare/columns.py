"""Schema-level comparison and change."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class ColumnPlan:
    """How the columns of two tables correspond, by their name in the new table."""

    common: tuple[str, ...]
    added: tuple[str, ...]
    dropped: tuple[str, ...]
    renamed: tuple[tuple[str, str], ...] = ()


def column_plan(a: DataFrame, b: DataFrame, renames: dict[str, str] | None = None) -> ColumnPlan:
    renames = renames or {}
    old = [renames.get(c, c) for c in a.columns]
    return ColumnPlan(
        common=tuple(c for c in old if c in b.columns),
        added=tuple(c for c in b.columns if c not in old),
        dropped=tuple(c for c in old if c not in b.columns),
        renamed=tuple((o, n) for o, n in renames.items() if o in a.columns and n in b.columns),
    )


def schema_diff(
    a: DataFrame, b: DataFrame, renames: dict[str, str] | None = None
) -> list[tuple[str, str, str | None, str | None]]:
    """Rows (code, column, type before, type after).

    Codes: `+++` added, `---` removed, `(old)` renamed from old, `:` moved among
    the common columns, `type` same name with another type, empty when unchanged.
    """
    plan = column_plan(a, b, renames)
    before_name = {new: old for old, new in plan.renamed}
    old_order = list(plan.common)
    new_order = [c for c in b.columns if c in plan.common]
    moved = {n for o, n in zip(old_order, new_order) if o != n}
    rows = []
    for c in b.columns:
        after = b.schema[c].dataType.simpleString()
        if c in plan.added:
            rows.append(("+++", c, None, after))
            continue
        before = a.schema[before_name.get(c, c)].dataType.simpleString()
        if c in before_name:
            code = f"({before_name[c]})"
        elif before != after:
            code = "type"
        else:
            code = ":" if c in moved else ""
        rows.append((code, c, before, after))
    for c in plan.dropped:
        rows.append(("---", c, a.schema[c].dataType.simpleString(), None))
    return rows


def type_diff(a: DataFrame, b: DataFrame, keys_a: list[str], keys_b: list[str]) -> list[tuple]:
    """Rows (column, property, before, after) for type and key changes of common columns."""
    rows = []
    for c in a.columns:
        if c not in b.columns:
            continue
        for prop, old, new in (
            ("type", a.schema[c].dataType.simpleString(), b.schema[c].dataType.simpleString()),
            ("key", str(c in keys_a).lower(), str(c in keys_b).lower()),
        ):
            if old != new:
                rows.append((c, prop, old, new))
    return rows


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    """Same names in the same order, none repeated."""
    return a.columns == b.columns and len(set(a.columns)) == len(a.columns)


def alter_columns(
    df: DataFrame, changes: list[tuple[str | None, str | None, dict[str, str]]]
) -> DataFrame:
    """Apply (old name, new name, properties) in order, in one projection.

    No old name adds a column, no new name or not being listed drops it, two names
    rename it; the list order is the new column order and `type` casts.
    """
    cells = []
    for old, new, props in changes:
        if new is None:
            continue
        cell = F.col(old) if old is not None else F.lit(None).cast(props.get("type", "string"))
        if old is not None and "type" in props:
            cell = cell.cast(props["type"])
        cells.append(cell.alias(new))
    return df.select(*cells)


def rename_keys(df: DataFrame, names: list[str], to: list[str]) -> DataFrame:
    """Give key columns the names of another role's key columns."""
    return df.withColumnsRenamed(dict(zip(names, to)))
