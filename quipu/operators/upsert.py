"""Insert-or-update with stable surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .names import free, own
from .numbering import keep_best, number_rows


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    surrogate: str,
    update_cols: list[str] | None = None,
    last: list[Column] | None = None,
    number_by: list[Column] | None = None,
    after: int | None = None,
) -> DataFrame:
    """Rows of `target` keep their surrogate; new keys of `source` are numbered after it.

    Matched rows take `update_cols` (all non-key columns by default) from the source
    and keep the rest. Of source rows with one key a single one counts: the first in the
    order `last`, by default the one with the greatest values. New rows are numbered by
    `number_by`, by default in key order, after `after` or else the target's greatest number.
    """
    columns = [c for c in target.columns if c != surrogate]
    rest = [c for c in columns if c not in keys]
    source = keep_best(source, keys, last or [own(c).desc_nulls_last() for c in [*rest, *keys]])
    changed = set(update_cols if update_cols is not None else rest)
    new = free("new", target, source)
    fresh = source.select(*map(own, keys), F.struct(*[own(c) for c in rest] or [F.lit(1)]).alias(new))
    kept = target.join(fresh, keys, "left").select(
        own(surrogate),
        *[
            F.when(F.col(new).isNotNull(), F.col(new)[c]).otherwise(own(c)).alias(c)
            if c in changed
            else own(c)
            for c in columns
        ],
    )
    unseen = source.select(*map(own, columns)).join(target.select(*map(own, keys)), keys, "left_anti")
    top = F.lit(after) if after is not None else target.agg(F.coalesce(F.max(own(surrogate)), F.lit(0))).scalar()
    added = number_rows(unseen, number_by or [own(k) for k in keys], surrogate, start=top)
    return kept.unionByName(added.withColumn(surrogate, own(surrogate).cast(kept.schema[surrogate].dataType)))
