"""Parent, local and remote: difference and merge.

Truth table over presence (parent, local, remote):

    remote only                 insert            merge keeps the remote row
    local only                  nothing           merge keeps the local row
    local and remote            update if unlike  merge keeps the local row
    parent and local            delete            merge removes the row
    parent and remote           conflict if the remote row was edited; merge removes it
    parent only                 nothing           merge removes the row
    all three                   cell rules below

Cell rules when all three are present: remote as parent -> local stands; local as
parent -> remote stands; both edited alike -> that value; edited unlike -> conflict.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.cells import EXACT, CellRules, same_cell
from ..joins import null_safe
from .rows import CONFLICT, DELETE, FILL, INSERT, UPDATE, collate_versions, repeated_keys, repeated_rows


def _sides(p: DataFrame, l: DataFrame, r: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Versions by key where every key is unique, and all rows of the other keys."""
    sides = {"p": p, "l": l, "r": r}
    repeated = repeated_keys(list(sides.values()), keys)
    single = {s: null_safe(df, repeated, keys, "left_anti") for s, df in sides.items()}
    rows = collate_versions(single, keys)
    return rows.withColumns({f"in_{s}": F.col(f"n_{s}") > 0 for s in "plr"}), repeated_rows(sides, repeated, keys)


def _any(conditions: list[Column]) -> Column:
    return reduce(Column.__or__, conditions, F.lit(False))


def diff3(
    parent: DataFrame,
    local: DataFrame,
    remote: DataFrame,
    keys: list[str],
    rules: CellRules = EXACT,
) -> tuple[DataFrame, DataFrame]:
    """(what the remote brings to the local table, rejects).

    A key that repeats in a version cannot be compared: all rows with it, of every version,
    are rejects with their `side` (p, l or r).

    Each cell is `struct<before, ours, after>`: the parent (or local) value, the local
    value where both sides edited it, and the remote value where it changed.
    """
    shared = [c for c in parent.columns if c in local.columns and c in remote.columns]
    shared = [c for c in shared if c not in keys]
    new = [c for c in remote.columns if c not in parent.columns and c not in local.columns]
    p, l, r = F.col("p"), F.col("l"), F.col("r")
    in_p, in_l, in_r = F.col("in_p"), F.col("in_l"), F.col("in_r")
    rows, rejects = _sides(parent, local, remote, keys)

    def remote_edit(c: str) -> Column:
        by_parent = in_p & in_r & ~same_cell(p[c], r[c], rules)
        return by_parent | (~in_p & in_l & in_r & ~same_cell(l[c], r[c], rules))

    def both_edit(c: str) -> Column:
        return in_p & remote_edit(c) & ~same_cell(p[c], l[c], rules)

    def clash(c: str) -> Column:
        return both_edit(c) & ~same_cell(l[c], r[c], rules)

    filled = [r[c].isNotNull() & (r[c].cast("string") != "") for c in new]
    action = (
        F.when(~in_p & ~in_l, INSERT)
        .when(in_p & in_l & ~in_r, DELETE)
        .when(_any([clash(c) for c in shared]), CONFLICT)
        .when(_any([remote_edit(c) for c in shared]), UPDATE)
        .when(in_l & in_r & _any(filled), FILL)
        .otherwise("")
    )
    cells = []
    for c in shared:
        before = F.when(in_p, F.when(remote_edit(c) | ~in_r | ~in_l, p[c]).otherwise(l[c]))
        cells.append(
            F.struct(
                F.when(in_p, before).otherwise(l[c]).alias("before"),
                F.when(clash(c), l[c]).alias("ours"),
                F.when(remote_edit(c) | (~in_p & ~in_l), r[c]).alias("after"),
            ).alias(c)
        )
    for c in new:
        none = F.lit(None).cast(remote.schema[c].dataType)
        cells.append(F.struct(none.alias("before"), none.alias("ours"), r[c].alias("after")).alias(c))
    return rows.select(*keys, action.alias("action"), *cells).filter(F.col("action") != ""), rejects


def _merge_columns(parent: DataFrame, local: DataFrame, remote: DataFrame, keys: list[str]):
    """(kept from local, cell-merged, added by remote), in output order."""
    merged, own, added = [], [], []
    for c in local.columns:
        if c in keys:
            continue
        if c not in parent.columns:
            own.append(c)
        elif c in remote.columns:
            merged.append(c)
    added = [c for c in remote.columns if c not in parent.columns and c not in local.columns]
    return own, merged, added


def merge3(
    parent: DataFrame,
    local: DataFrame,
    remote: DataFrame,
    keys: list[str],
    conflict_text: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(merged table, conflicts, rejects).

    A key that repeats in a version cannot be merged: all rows with it, of every version,
    are rejects with their `side` (p, l or r) and are not in the merged table.

    Local wins unless only the remote edited a cell. Rows and columns removed on one
    side are removed even if the other edited them. Conflicting cells keep the local
    value, or with `conflict_text` the text `((( parent ))) local /// remote`, for
    which the merged columns become text.
    """
    own, merged, added = _merge_columns(parent, local, remote, keys)
    p, l, r = F.col("p"), F.col("l"), F.col("r")
    in_p, in_l, in_r = F.col("in_p"), F.col("in_l"), F.col("in_r")
    rows, rejects = _sides(parent, local, remote, keys)
    all_three = in_p & in_l & in_r

    def clash(c: str) -> Column:
        return (
            all_three
            & ~r[c].eqNullSafe(p[c])
            & ~l[c].eqNullSafe(p[c])
            & ~l[c].eqNullSafe(r[c])
        )

    def text(cell: Column) -> Column:
        return F.coalesce(cell.cast("string"), F.lit("null"))

    cells = []
    for c in local.columns:
        if c in keys:
            continue
        if c in merged:
            value = (
                F.when(~in_l, r[c])
                .when(all_three & l[c].eqNullSafe(p[c]), r[c])
                .otherwise(l[c])
            )
            if conflict_text:
                note = F.concat(
                    F.lit("((( "), text(p[c]), F.lit(" ))) "), text(l[c]), F.lit(" /// "), text(r[c])
                )
                value = F.when(clash(c), note).otherwise(value.cast("string"))
            cells.append(value.alias(c))
        elif c in own:
            shared_new = c in remote.columns
            value = F.when(in_l, l[c])
            cells.append((value.otherwise(r[c]) if shared_new else value).alias(c))
    cells += [F.when(in_r, r[c]).alias(c) for c in added]
    stays = (in_p & in_l & in_r) | ~in_p
    table = rows.filter(stays).select(*keys, *cells)

    notes = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                p[c].cast("string").alias("parent"),
                l[c].cast("string").alias("local"),
                r[c].cast("string").alias("remote"),
                clash(c).alias("clash"),
            )
            for c in merged
        ]
    )
    conflicts = rows.filter(all_three).select(*keys, F.inline(notes)).filter("clash").drop("clash")
    return table, conflicts, rejects
