"""Applying recorded changes to a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ...session import written
from ..joins import null_safe
from ..names import free, own
from .rows import DELETE, FILL, INSERT, UPDATE, action_of, repeated_keys


def _cells(diff: DataFrame, keys: list[str]) -> list[str]:
    return [f.name for f in diff.schema.fields if f.name not in keys and f.dataType.typeName() == "struct"]


def apply_patch(
    source: DataFrame,
    diff: DataFrame,
    keys: list[str],
    added: list[str] | None = None,
    dropped: list[str] | None = None,
    renames: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(patched table, rejects) from the output of `row_diff`.

    Deletes and updates find their rows by key, NULL keys included. Rejects, which change
    nothing, are all changes of a key that several changes name, changes that find no row,
    and inserts whose key is there already; so a patch never multiplies a row. Conflicting
    cells (those with an `ours` part) are left as they are. `added`, `dropped` and `renames`
    carry the schema part of the patch.
    """
    source = source.withColumnsRenamed(renames or {})
    gone, new = set(dropped or []), list(added or [])
    kept = [c for c in source.columns if c not in keys and c not in gone]
    patched = {c for c in _cells(diff, keys) if c in kept or c in new}
    verdict = action_of(diff, keys)
    action = own(verdict)

    changes = written(diff.filter(action.isin(INSERT, DELETE, UPDATE, FILL)), "patch")  # read several times
    base = source.select(*map(own, keys), *map(own, kept))
    repeated = repeated_keys([changes], keys)
    single = null_safe(changes, repeated, keys, "left_anti")
    edits, inserts = single.filter(action != INSERT), single.filter(action == INSERT)
    rejects = [
        null_safe(changes, repeated, keys, "left_semi"),
        null_safe(edits, base.select(*map(own, keys)), keys, "left_anti"),
        null_safe(inserts, base.select(*map(own, keys)), keys, "left_semi"),
    ]

    held = free("change", base, diff)
    change = edits.select(*map(own, keys), F.struct(action.alias("action"), F.struct(*map(own, sorted(patched)) if patched else [F.lit(1)]).alias("cells")).alias(held))
    joined = null_safe(base, change, keys, "left")
    hit, found = F.coalesce(F.col(held)["action"], F.lit("")), F.col(held)["cells"]
    cells = []
    for c in kept:
        if c not in patched:
            cells.append(own(c))
            continue
        take = hit == UPDATE
        if "ours" in diff.schema[c].dataType.names:
            take = take & found[c]["ours"].isNull()
        cells.append(F.when(take, found[c]["after"]).otherwise(own(c)).alias(c))
    for c in new:
        cells.append(F.when(hit.isin(UPDATE, FILL), found[c]["after"]).alias(c))
    survivors = joined.filter(hit != DELETE).select(*map(own, keys), *cells)
    fresh = null_safe(inserts, base.select(*map(own, keys)), keys, "left_anti").select(
        *map(own, keys),
        *[
            (own(c)["after"] if c in patched else F.lit(None).cast(base.schema[c].dataType)).alias(c)
            for c in [*kept, *new]
        ],
    )
    return survivors.unionByName(fresh), reduce(DataFrame.unionByName, rejects)


def apply_row_changes(
    target: DataFrame, changes: DataFrame, cond: list[str], values: list[str], keys: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(changed table, rejects) from generic row changes: columns `action`, `cond_<c>`, `val_<c>`.

    A change may list the columns that it is bound by in `conds` (array of names) and those
    that it sets in `vals`; without these columns, or where they are NULL, it is all of `cond`
    and all of `values`. So a NULL in a listed condition asks for NULL, which matches NULL
    only, and an unlisted one asks nothing; a listed NULL value sets NULL. An update or delete
    applies to every row that meets all its conditions, by the values before any change. A
    `+` counts as an update when it brings a value. Inserts add their values.

    Rejects, which change nothing: updates and deletes without a condition, with the same
    conditions as another, that meet no row, or that meet a row which another one meets too;
    and, where `keys` name the target's key, inserts whose key is there already or repeats.
    """
    listed = set(changes.columns)
    number = free("change", target, changes)
    all_of = lambda column, names: F.coalesce(own(column), F.array(*map(F.lit, names))) if column in listed else F.array(*map(F.lit, names))
    prepared = changes.select(
        own("action").alias("action"),
        F.array_sort(F.array_distinct(all_of("conds", cond))).alias("conds"),
        all_of("vals", values).alias("vals"),
        F.struct(*[(own(f"cond_{c}") if f"cond_{c}" in listed else F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in cond]).alias("cond"),
        F.struct(*[(own(f"val_{c}") if f"val_{c}" in listed else F.lit(None).cast(target.schema[c].dataType)).alias(c) for c in values]).alias("val"),
        F.struct(*map(own, changes.columns)).alias("whole"),
    )
    brings = reduce(Column.__or__, [F.col("val")[c].isNotNull() & F.array_contains("vals", c) for c in values], F.lit(False))
    prepared = prepared.withColumn("action", F.when((F.col("action") == FILL) & brings, UPDATE).otherwise(F.col("action")))
    held = written(prepared.withColumn(number, F.monotonically_increasing_id()), "row-changes")

    # cells that are no condition do not tell two changes apart
    asked = F.struct(*[F.when(F.array_contains("conds", c), F.col("cond")[c]).alias(c) for c in cond])
    edits = held.filter(F.col("action").isin(UPDATE, DELETE)).withColumn("asked", asked)
    repeated = repeated_keys([edits.select("conds", "asked")], ["conds", "asked"])
    usable = null_safe(edits, repeated, ["conds", "asked"], "left_anti").filter(F.size("conds") > 0)
    groups = [r["conds"] for r in usable.select("conds").distinct().collect()]  # sets of condition columns

    def matched(rows: DataFrame, of: DataFrame, payload: list[Column], name: str) -> DataFrame:
        """`rows` with one struct column for each set of conditions: the change that each row meets."""
        for i, names in enumerate(groups):
            wanted = of.filter(F.col("conds") == F.array(*map(F.lit, names)))
            mine = {c: free(f"c{i}_{k}", rows, [name]) for k, c in enumerate(names)}
            side = wanted.select(*[F.col("asked")[c].alias(m) for c, m in mine.items()], F.struct(number, *payload).alias(f"{name}{i}"))
            same = reduce(Column.__and__, [own(c).eqNullSafe(F.col(m)) for c, m in mine.items()])
            rows = rows.join(side, same, "left").drop(*mine.values())
        return rows

    found = free("found", target, changes)
    hits = F.filter(F.array(*[F.col(f"{found}{i}") for i in range(len(groups))]), lambda x: x.isNotNull()) if groups else None
    met = target.select(*map(own, cond)) if groups else None
    if groups:
        # from the condition columns alone: which changes meet a row, and which share one
        numbers = matched(met, usable, [], found).select(F.transform(hits, lambda x: x[number]).alias("met")).filter(F.size("met") > 0)
        counts = numbers.select(F.explode("met").alias(number), (F.size("met") > 1).alias("shared")).groupBy(number).agg(F.max("shared").alias("shared"))
        counts = written(counts, "changes-met")
        good = usable.join(counts.filter(~F.col("shared")), number, "left_semi")
    else:
        good = usable
    rejects = [held.filter(F.col("action").isin(UPDATE, DELETE)).join(good.select(number), number, "left_anti").select("whole.*")]

    applied = target
    if groups:
        joined = matched(target, good, [F.col("action"), F.col("vals"), F.col("val")], found)
        change = F.get(hits, F.lit(0))
        hit = F.coalesce(change["action"], F.lit(""))
        applied = joined.filter(hit != DELETE).select(
            *[
                F.when((hit == UPDATE) & F.array_contains(change["vals"], c), change["val"][c]).otherwise(own(c)).cast(target.schema[c].dataType).alias(c)
                if c in values
                else own(c)
                for c in target.columns
            ]
        )
    inserts = held.filter(F.col("action") == INSERT)
    row = [
        (F.when(F.array_contains("vals", c), F.col("val")[c]) if c in values else F.lit(None)).cast(target.schema[c].dataType).alias(c)
        for c in target.columns
    ]
    fresh = inserts.select(number, F.col("whole").alias(found), *row)
    if keys:
        again = repeated_keys([fresh.select(*map(own, keys))], keys)
        taken = again.unionByName(null_safe(fresh, target.select(*map(own, keys)), keys, "left_semi").select(*map(own, keys)))
        rejects.append(null_safe(fresh, taken, keys, "left_semi").select(f"{found}.*"))
        fresh = null_safe(fresh, taken, keys, "left_anti")
    return applied.unionByName(fresh.select(*map(own, target.columns))), reduce(DataFrame.unionByName, rejects)
