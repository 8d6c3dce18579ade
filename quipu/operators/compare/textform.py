"""Change tables as text, written and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.cells import same_cell
from ...functions.text import null_as_text, text_as_null
from .rows import CONFLICT, UPDATE


def _longest(texts: list[Column], pattern: str, tail: int) -> Column:
    """Longest run of leading dashes before the mark, over several text cells."""
    runs = [
        F.array_max(
            F.transform(
                F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(pattern), F.lit(0)),
                lambda m: F.length(m) - tail,
            )
        )
        for t in texts
    ]
    return F.coalesce(F.max(F.greatest(*runs, F.lit(-1), F.lit(-1))), F.lit(-1))


def separators(*tables: DataFrame) -> tuple[str, str]:
    """(change, conflict) separators that occur in no cell and no column name.

    `->` gains dashes until it is absent: one more than the longest run of dashes
    before a `>` anywhere. One aggregate per table, one row back.
    """
    arrow, bang = 0, -1
    for df in tables:
        texts = [F.col(c).cast("string") for c in df.columns]
        row = df.agg(_longest(texts, "-+>", 1).alias("a"), _longest(texts, "-*!", 1).alias("b")).first()
        arrow, bang = max(arrow, row.a), max(bang, row.b)
        for name in df.columns:
            for run in range(arrow + 1, len(name)):
                arrow = run if "-" * run + ">" in name else arrow
            for run in range(bang + 1, len(name)):
                bang = run if "-" * run + "!" in name else bang
    change = "-" * (arrow + 1) + ">"
    return change, "-" * (bang + 1) + "!" + change


def as_text(diff: DataFrame, keys: list[str], change: str = "->", conflict: str = "!->") -> DataFrame:
    """`old->new` cells; conflicts read `parent!->ours!->theirs`; equal cells stay plain.

    The row code takes the separator actually used.
    """
    cells = []
    for f in diff.schema.fields:
        if f.dataType.typeName() != "struct":
            continue
        c = F.col(f.name)
        before, after = null_as_text(c["before"]), null_as_text(c["after"])
        edited = F.col("action").isin(UPDATE, CONFLICT)
        text = F.when(F.col("action") == "---", c["before"].cast("string"))
        text = text.when(F.col("action") == "+++", c["after"].cast("string"))
        if "ours" in f.dataType.names:
            shown = [F.coalesce(x.cast("string"), F.lit("null")) for x in (c["before"], c["ours"], c["after"])]
            text = text.when(
                (F.col("action") == CONFLICT) & c["ours"].isNotNull(), F.concat_ws(conflict, *shown)
            )
            edited = edited & c["after"].isNotNull()
        text = text.when(edited & ~same_cell(c["before"], c["after"]), F.concat(before, F.lit(change), after))
        text = text.otherwise(F.coalesce(c["after"], c["before"]).cast("string"))
        cells.append(text.alias(f.name))
    code = F.when(F.col("action") == UPDATE, change).when(F.col("action") == CONFLICT, conflict)
    return diff.select(code.otherwise(F.col("action")).alias("action"), *keys, *cells)


def parse_change_text(df: DataFrame, code: str, cells: list[str], keep: list[str]) -> DataFrame:
    """Text change table to one row per cell: category and old, new, parent values.

    The row code says which separator its cells use (`->`, `-->`, `!->` ...). An
    inserted row has only a new value, a deleted row only an old one.
    """
    row = F.col(code)
    full = F.when(row.contains("->"), row)
    part = F.when(row.contains("!"), F.regexp_extract(row, "!(.*)$", 1)).otherwise(full)
    long = df.select(
        *keep,
        row.alias("_code"),
        full.alias("_full"),
        part.alias("_part"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("_text"))
                    for c in cells
                ]
            )
        ),
    )
    text = F.coalesce(F.col("_text"), F.lit(""))
    conflicted = (F.col("_full") != F.col("_part")) & text.contains(F.col("_full"))
    modified = F.col("_full").isNotNull() & text.contains(F.col("_part"))
    category = (
        F.when(F.col("_code") == "!", "spec")
        .when(F.col("_code") == "@@", "header")
        .when(F.col("_code") == "...", "gap")
        .when(F.col("_code") == "+++", "add")
        .when(F.col("_code") == "---", "remove")
        .when(modified & conflicted, "conflict")
        .when(modified, "modify")
        .when(F.col("_code") == ":", "move")
        .otherwise("")
    )
    full_parts = F.split(text, F.concat(F.lit(r"\Q"), F.col("_full"), F.lit(r"\E")))
    part_parts = F.split(text, F.concat(F.lit(r"\Q"), F.col("_part"), F.lit(r"\E")))
    cat = F.col("category")
    piece = lambda parts, i: text_as_null(F.get(parts, F.lit(i)))
    return long.withColumn("category", category).select(
        *keep,
        F.col("column"),
        cat,
        F.when(cat == "conflict", piece(full_parts, 1))
        .when(cat == "modify", piece(part_parts, 0))
        .when(cat == "remove", F.col("_text"))
        .alias("old_value"),
        F.when(cat == "conflict", piece(full_parts, 2))
        .when(cat == "modify", piece(part_parts, 1))
        .when(cat == "add", F.col("_text"))
        .alias("new_value"),
        F.when(cat == "conflict", piece(full_parts, 0)).alias("parent_value"),
    )
