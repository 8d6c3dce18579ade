"""Row alignment and the two-way difference."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.cells import EXACT, CellRules, same_cell
from ...session import written
from ..joins import null_safe
from ..names import free, own, unless_taken
from .columns import column_plan
from .hash_tree import ROWS_PER_RANGE, HashedTable, aligned, unlike_rows
from .order import order_changed

INSERT, DELETE, UPDATE, FILL, MOVE, CONFLICT = "+++", "---", "->", "+", ":", "!->"


def repeated_keys(sides: list[DataFrame], keys: list[str]) -> DataFrame:
    """Keys that a side holds more than once, from the keys alone, written once."""
    side, n = free("side", keys), free("n", keys)
    tagged = [df.select(*map(own, keys), F.lit(i).alias(side)) for i, df in enumerate(sides)]
    counts = reduce(DataFrame.unionByName, tagged).groupBy(*map(own, keys), side).agg(F.count("*").alias(n))
    return written(counts.filter(F.col(n) > 1).select(*map(own, keys)).distinct(), "repeated-keys")


def repeated_rows(sides: dict[str, DataFrame], repeated: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key repeats on some side, with `side` and its other cells as a struct."""
    rows, tag = [], unless_taken("side", keys, sides)
    for side, df in sides.items():
        body = F.struct(*[own(c) for c in df.columns if c not in keys])
        found = null_safe(df, repeated, keys, "left_semi")
        rows.append(found.select(*map(own, keys), F.lit(side).alias(tag), body.alias(side)))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), rows)


def collate_versions(sides: dict[str, DataFrame], keys: list[str], repeated: DataFrame | None = None) -> DataFrame:
    """One row per key with each side's row as a struct and its row count.

    All sides are stacked and grouped by key: one exchange for any number of sides, NULL
    keys meet like any other. Where a key repeats on a side, that side's struct is NULL
    and its count tells. With `repeated`, rows of those keys meet no other row: each comes
    out by itself, as often as it was there, and spreads by its content. The names of the
    sides, and `n_` before them, must not be names of keys.
    """
    wide = [*keys, *sides, *[f"n_{s}" for s in sides]]
    if len({c.lower() for c in wide}) < len(wide):
        raise ValueError("a key has the name of a side")
    mark, tag, repeats, copy = (free(stem, wide, *sides.values()) for stem in ("own", "side", "repeats", "copy"))
    stacked = []
    for side, df in sides.items():
        body = F.struct(*[own(c) for c in df.columns if c not in keys])
        alone = F.lit(None).cast("struct<side:string,a:long,b:int>")
        rows = df
        if repeated is not None:
            rows = null_safe(df, repeated.withColumn(repeats, F.lit(True)), keys, "left")
            cells = [own(c) for c in df.columns]
            alone = F.when(F.col(repeats), F.struct(F.lit(side).alias("side"), F.xxhash64(*cells).alias("a"), F.hash(*cells).alias("b")))
        stacked.append(rows.select(*map(own, keys), alone.alias(mark), F.lit(side).alias(tag), body.alias(side)))
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), stacked)
    by = [*keys, mark] if repeated is not None else keys
    held = {s: free(s, wide, [mark, tag, copy]) for s in sides}
    grouped = rows.groupBy(*map(own, by)).agg(
        *[F.count_if(F.col(tag) == s).alias(f"n_{s}") for s in sides],
        *[F.any_value(own(s), F.lit(True)).alias(held[s]) for s in sides],
    )
    if repeated is not None:
        # equal rows of a repeating key were combined; bring each back
        alone = F.col(mark).isNotNull()
        times = F.when(alone, F.greatest(*[F.col(f"n_{s}") for s in sides], F.lit(1))).otherwise(1)
        grouped = grouped.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), times.cast("long"))))
        grouped = grouped.withColumns({f"n_{s}": F.when(alone, F.least(F.col(f"n_{s}"), F.lit(1))).otherwise(F.col(f"n_{s}")) for s in sides})
    bodies = [F.when(F.col(f"n_{s}") == 1, own(held[s])).alias(s) for s in sides]
    return grouped.select(*map(own, keys), *[f"n_{s}" for s in sides], *bodies)


def side_names(keys: list[str]) -> tuple[str, str]:
    """Names of the two sides of a comparison: `l` and `r`, with `_` before them where a key needs it."""
    left, right = "l", "r"
    while {left, right, f"n_{left}", f"n_{right}"} & {k.lower() for k in keys}:
        left, right = f"_{left}", f"_{right}"
    return left, right


def align_by_key(a: DataFrame, b: DataFrame, keys: list[str], unique_keys: bool = False) -> DataFrame:
    """Keys with struct `l` and `r`; either is NULL where that side has no row.

    A key that repeats on a side links nothing: its rows come out one by one as left-only
    and right-only rows. `unique_keys=True` declares that no key repeats, and a key that
    does is an error. Where a key has the name of a side, both sides get a `_` in front.
    """
    left, right = side_names(keys)
    sides = {left: a, right: b}
    if unique_keys:
        pairs = collate_versions(sides, keys)
        wrong = (F.col(f"n_{left}") > 1) | (F.col(f"n_{right}") > 1)
        checked = lambda c: F.when(wrong, F.raise_error(F.lit("a key declared unique repeats"))).otherwise(F.col(c)).alias(c)
        return pairs.select(*map(own, keys), checked(left), checked(right))
    repeated = repeated_keys([a, b], keys)
    return collate_versions(sides, keys, repeated).select(*map(own, keys), left, right)


def link_unique(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Only the keys that occur exactly once on both sides, with both rows."""
    left, right = side_names(keys)
    pairs = collate_versions({left: a, right: b}, keys)
    return pairs.filter((F.col(f"n_{left}") == 1) & (F.col(f"n_{right}") == 1)).select(*map(own, keys), left, right)


def _is_filled(cell: Column) -> Column:
    return cell.isNotNull() & (cell.cast("string") != "")


def row_diff(
    a: DataFrame,
    b: DataFrame,
    keys: list[str],
    rules: CellRules = EXACT,
    renames: dict[str, str] | None = None,
    actions: Iterable[str] | None = None,
    unique_keys: bool = False,
    keep_unchanged: bool = False,
    ordered: str | None = None,
) -> DataFrame:
    """One row per changed key: keys, `action`, and `struct<before, after>` per column.

    Actions: insert, delete, update, `+` where only a new column is filled, and an
    empty action for unchanged rows when those are kept. `ordered` names a column with
    the row's position (distinct on a side); an otherwise unchanged row that now stands
    above one it used to follow gets `:` (moved). Where a column of the tables is named
    `action`, the diff's has `_` before it (see `action_of`).
    """
    a = a.drop(*rules.ignore_columns).withColumnsRenamed(renames or {})
    b = b.drop(*rules.ignore_columns)
    plan = column_plan(a, b)
    common = [c for c in plan.common if c not in keys and c != ordered]
    rows = align_by_key(a, b, keys, unique_keys)
    left, right = map(F.col, side_names(keys))
    verdict = unless_taken("action", a, b)

    def changed(c: str) -> Column:
        typed = a.schema[c].dataType == b.schema[c].dataType
        return ~same_cell(left[c], right[c], rules, typed)

    any_change = reduce(Column.__or__, [changed(c) for c in common], F.lit(False))
    any_fill = reduce(Column.__or__, [_is_filled(right[c]) for c in plan.added], F.lit(False))
    code = (
        F.when(left.isNull(), INSERT)
        .when(right.isNull(), DELETE)
        .when(any_change, UPDATE)
        .when(any_fill, FILL)
        .otherwise("")
    )
    cells = []
    for c in [*common, *plan.added, *plan.dropped]:
        before = left[c] if c in a.columns else F.lit(None).cast(b.schema[c].dataType)
        after = right[c] if c in b.columns else F.lit(None).cast(a.schema[c].dataType)
        cells.append(F.struct(before.alias("before"), after.alias("after")).alias(c))
    old, new = free("old", a, b, [verdict]), free("new", a, b, [verdict])
    places = [left[ordered].alias(old), right[ordered].alias(new)] if ordered else []
    out = rows.select(*map(own, keys), code.alias(verdict), *cells, *places)
    action = F.col(verdict)
    if ordered:
        placed = written(out, "placed")  # read twice: the linked rows in their order, and the others
        both = F.col(old).isNotNull() & F.col(new).isNotNull()
        flag = free("moved", placed)
        moved = order_changed(placed.filter(both), old, new, name=flag)
        moved = moved.withColumn(verdict, F.when((action == "") & F.col(flag), MOVE).otherwise(action))
        out = moved.drop(flag).unionByName(placed.filter(~both)).drop(old, new)
    if not keep_unchanged:
        out = out.filter(action != "")
    return out.filter(action.isin(list(actions))) if actions is not None else out


def action_of(diff: DataFrame, keys: list[str]) -> str:
    """The diff's column of action codes: the one that is neither a key nor a struct of cells."""
    (name,) = [f.name for f in diff.schema.fields if f.name not in keys and f.dataType.typeName() != "struct"]
    return name


def flat_cells(diff: DataFrame) -> DataFrame:
    """`<column>_before` / `<column>_after` instead of structs."""
    cells = []
    for f in diff.schema.fields:
        if f.dataType.typeName() != "struct":
            cells.append(own(f.name))
            continue
        for part in f.dataType.names:
            cells.append(own(f.name)[part].alias(f"{f.name}_{part}"))
    return diff.select(*cells)


def changed_cells(diff: DataFrame, keys: list[str], rules: CellRules = EXACT) -> DataFrame:
    """Long form: one row per changed cell, both values as text.

    Beside the keys stand the action code, `column`, `before` and `after`; where a key has one
    of these names, the latter get `_` in front.
    """
    names = [f.name for f in diff.schema.fields if f.dataType.typeName() == "struct" and f.name not in keys]
    parts = [unless_taken(n, diff.select(*map(own, keys), action_of(diff, keys))) for n in ("column", "before", "after", "changed")]
    cells = F.array(
        *[
            F.struct(
                *[
                    value.alias(part)
                    for value, part in zip(
                        (
                            F.lit(c),
                            own(c)["before"].cast("string"),
                            own(c)["after"].cast("string"),
                            ~same_cell(own(c)["before"], own(c)["after"], rules),
                        ),
                        parts,
                    )
                ]
            )
            for c in names
        ]
    )
    long = diff.select(*map(own, keys), action_of(diff, keys), F.inline(cells))
    return long.filter(F.col(parts[-1])).drop(parts[-1])


def inserts(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return null_safe(b, a.select(*keys), keys, "left_anti")


def deletes(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return null_safe(a, b.select(*keys), keys, "left_anti")


def updates(a: DataFrame, b: DataFrame, keys: list[str], unique_keys: bool = True) -> DataFrame:
    return row_diff(a, b, keys, actions=[UPDATE, FILL], unique_keys=unique_keys)


def diff_summary(a: DataFrame, b: DataFrame, keys: list[str], **options) -> DataFrame:
    """One row of counts: rows and columns inserted, deleted, updated, and `different`."""
    plan = column_plan(a, b, options.get("renames"))
    rows = row_diff(a, b, keys, keep_unchanged=True, **options)
    action = F.col(action_of(rows, keys))
    names = [f.name for f in rows.schema.fields if f.dataType.typeName() == "struct" and f.name not in keys]
    both = [c for c in names if c in plan.common]
    matched = ~action.isin(INSERT, DELETE)
    rules = options.get("rules", EXACT)
    touched = [
        F.max((matched & ~same_cell(own(c)["before"], own(c)["after"], rules)).cast("int"))
        for c in both
    ]
    col_updates = reduce(Column.__add__, touched, F.lit(0))
    counts = rows.agg(
        F.count_if(action == INSERT).alias("row_inserts"),
        F.count_if(action == DELETE).alias("row_deletes"),
        F.count_if(action == UPDATE).alias("row_updates"),
        F.count_if(action != INSERT).alias("row_count_initial"),
        F.count_if(action != DELETE).alias("row_count_final"),
        F.coalesce(col_updates, F.lit(0)).cast("long").alias("col_updates"),
    )
    added, dropped = len(plan.added), len(plan.dropped)
    counts = counts.withColumns(
        {
            "col_inserts": F.lit(added).cast("long"),
            "col_deletes": F.lit(dropped).cast("long"),
            "col_renames": F.lit(len(plan.renamed)).cast("long"),
        }
    )
    moving = ["row_inserts", "row_deletes", "row_updates", "col_updates"]
    moving += ["col_inserts", "col_deletes", "col_renames"]
    total = reduce(Column.__add__, [F.col(c) for c in moving])
    return counts.withColumn("different", total > 0)


def tables_equal(a: DataFrame | HashedTable, b: DataFrame | HashedTable, **options) -> bool:
    """Same columns and the same rows, repeats counted; row order does not matter."""
    return tuple(a.columns) == tuple(b.columns) and equality_report(a, b, **options).first()["iguales"]


def equality_report(
    a: DataFrame | HashedTable, b: DataFrame | HashedTable, keys: list[str] | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Rows found on one side only, and the verdict; equal rows are netted by count.

    Only rows of key ranges whose hashes differ are netted, so equal tables exchange none.
    `keys`, by default the first column, make the ranges of two frames. Two stored tables
    are compared by their trees, and only ranges that differ are read.
    """
    if isinstance(a, HashedTable):
        a, b = a.unlike_rows(b)
    elif (pair := aligned(a, b)) is not None:
        a, b = unlike_rows(*pair, keys or a.columns[:1], rows_per_range)
    side, net = free("side", a, b), free("net", a, b)
    tagged = a.withColumn(side, F.lit(1)).unionByName(b.withColumn(side, F.lit(-1)))
    counts = tagged.groupBy(*[own(c) for c in a.columns]).agg(F.sum(own(side)).alias(net))
    return counts.agg(
        F.coalesce(F.sum(F.greatest(own(net), F.lit(0))), F.lit(0)).alias("solo_a"),
        F.coalesce(F.sum(F.greatest(-own(net), F.lit(0))), F.lit(0)).alias("solo_b"),
        (F.count_if(own(net) != 0) == 0).alias("iguales"),
    )


def changed_only(a: DataFrame, b: DataFrame, keys: list[str], rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, DataFrame]:
    """Both tables without the key ranges whose rows are equal; whole where columns or types differ."""
    if a.columns != b.columns or a.dtypes != b.dtypes:
        return a, b
    return unlike_rows(a, b, keys, rows_per_range)


def diff_many(
    old: dict[str, DataFrame | HashedTable],
    new: dict[str, DataFrame | HashedTable],
    keys: dict[str, list[str]],
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Action counts per table over a set of tables; a missing side counts as empty.

    Of a table on both sides only the key ranges that differ are compared row by row: an
    equal range holds no change, repeated keys in it or not. A pair of stored tables is
    compared by its trees.
    """
    parts = []
    for name in sorted({*old, *new}):
        a, b = old.get(name), new.get(name)
        if isinstance(a, HashedTable) and isinstance(b, HashedTable):
            a, b = a.unlike_rows(b)
        else:
            a, b = (x.rows() if isinstance(x, HashedTable) else x for x in (a, b))
            if a is not None and b is not None:
                a, b = changed_only(a, b, keys[name], rows_per_range)
        a, b = (b.limit(0) if a is None else a), (a.limit(0) if b is None else b)
        state = "added" if name not in old else "dropped" if name not in new else "kept"
        diff = row_diff(a, b, keys[name])
        counts = diff.groupBy(F.col(action_of(diff, keys[name])).alias("action")).agg(F.count("*").alias("rows"))
        parts.append(counts.select(F.lit(name).alias("table_name"), F.lit(state).alias("state"), "action", "rows"))
    return reduce(DataFrame.unionByName, parts)
