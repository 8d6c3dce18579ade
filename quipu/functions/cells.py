"""How two cells of a table comparison are matched."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from .text import BLANKS


@dataclass(frozen=True)
class CellRules:
    """Options under which two cells count as equal."""

    ignore_whitespace: bool = False
    ignore_case: bool = False
    epsilon: float | None = None
    ignore_columns: tuple[str, ...] = field(default=())

    @property
    def plain(self) -> bool:
        return not (self.ignore_whitespace or self.ignore_case or self.epsilon is not None)


EXACT = CellRules()


def comparable(cell: Column, rules: CellRules) -> Column:
    """Cell text after the whitespace and case options."""
    text = cell.cast("string")
    if rules.ignore_whitespace:
        text = F.btrim(text, F.lit(BLANKS))
    if rules.ignore_case:
        text = F.lower(text)
    return text


def same_cell(left: Column, right: Column, rules: CellRules = EXACT, typed: bool = True) -> Column:
    """True when the cells match; NULL matches NULL only.

    `typed` says both sides have one type, so equality needs no text form.
    """
    if rules.plain and typed:
        return left.eqNullSafe(right)
    equal = comparable(left, rules).eqNullSafe(comparable(right, rules))
    if rules.epsilon is None:
        return equal
    gap = F.abs(left.try_cast("double") - right.try_cast("double"))
    return F.coalesce(gap < F.lit(rules.epsilon), F.lit(False)) | equal
