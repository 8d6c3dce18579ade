"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FOLDED = "UNICODE_CI_AI_RTRIM"
BLANKS = " \t\n\r\u000b\f"
# fixed values: texts that count as an empty cell inside a composite key
EMPTY_CELL_TEXTS = ["", "null", "undefined"]


def squeeze_blanks(text: Column) -> Column:
    """Remove every blank, tab and line break."""
    return F.regexp_replace(text, r"\s+", "")


def clean_serie(serie: Column) -> Column:
    return squeeze_blanks(F.upper(serie))


def has_serie(serie: Column) -> Column:
    return serie.isNotNull() & (squeeze_blanks(serie) != "")


def letters_without_first_other(text: Column) -> Column:
    """Upper case, then drop only the first character that is not A..Z."""
    return F.regexp_replace(F.upper(text), "^([A-Z]*)[^A-Z]", "$1")


def folded(text: Column) -> Column:
    """Text that compares without case, accents and trailing blanks."""
    return F.collate(text, FOLDED)


def pad2(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def key_text(*cells: Column) -> Column:
    """Composite key text; NULL and empty-like cells all become empty."""
    parts = [
        F.when(cell.cast("string").isin(EMPTY_CELL_TEXTS), "").otherwise(
            F.coalesce(cell.cast("string"), F.lit(""))
        )
        for cell in cells
    ]
    return F.concat_ws(" // ", *parts)


def null_as_text(cell: Column) -> Column:
    """NULL becomes `NULL`; a literal `NULL` (underscored or not) gains a `_`."""
    text = cell.cast("string")
    return (
        F.when(text.isNull(), "NULL")
        .when(text.rlike("^_*NULL$"), F.concat(F.lit("_"), text))
        .otherwise(text)
    )


def text_as_null(text: Column) -> Column:
    """Reverse of `null_as_text`."""
    return (
        F.when(text == "NULL", F.lit(None).cast("string"))
        .when(text.rlike("^_+NULL$"), F.substring(text, 2, 2147483647))
        .otherwise(text)
    )
