"""Row order: context around changes and the moved-row test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..names import free, own
from ..numbering import number_rows


def with_context(
    df: DataFrame, order: list[Column], changed: Column, around: int, bucket_rows: int = 1_000_000
) -> DataFrame:
    """Changed rows plus `around` rows on each side, by position in `order`.

    Adds `posicion` and `papel`: `cambio`, `contexto`, or `...` for the one marker row
    that stands for a run of hidden rows (placed at the run's last position). Positions
    come from distributed numbering. A window sees one range of positions; the rows beside
    a border are copied to the next range, so every row meets its neighbours.
    """
    placed = number_rows(df, order, "posicion").withColumn("_chg", F.coalesce(changed, F.lit(False)))
    ends = placed.agg(F.max("posicion").alias("last"), F.max("_chg").alias("any"))
    last, some = ends.select("last").scalar(), ends.select("any").scalar()
    reach, at = around + 1, F.col("posicion") - 1
    slots = [F.floor((at + shift) / F.lit(bucket_rows)) for shift in range(-reach, reach + 1, max(1, min(reach, bucket_rows)))]
    slots += [F.floor((at + reach) / F.lit(bucket_rows)), F.floor(at / F.lit(bucket_rows))]
    homes = placed.withColumn("_home", F.explode(F.array_distinct(F.array(*slots))))
    beside = Window.partitionBy("_home").orderBy("posicion")
    seen = homes.withColumns(
        {
            "_near": F.max("_chg").over(beside.rangeBetween(-around, around)),
            "_next": F.coalesce(F.max("_chg").over(beside.rangeBetween(1 - around, 1 + around)), F.lit(False)),
        }
    ).filter(F.col("_home") == F.floor(at / F.lit(bucket_rows)))
    ends_run = F.col("_next") | ((F.col("posicion") == last) & some)
    shown = seen.filter(F.col("_near") | ends_run)
    papel = F.when(F.col("_chg"), "cambio").when(F.col("_near"), "contexto").otherwise("...")
    cells = [F.when(F.col("_near"), F.col(c)).alias(c) for c in df.columns]
    return shown.select(*cells, "posicion", papel.alias("papel"))


def order_changed(pairs: DataFrame, old: str, new: str, bucket_rows: int = 1_000_000, name: str = "movida") -> DataFrame:
    """Matched rows whose new position lies below that of a row that came earlier, marked in `name`.

    `old` holds distinct positions. Rows fall into ranges of `bucket_rows` old
    positions; a range needs only the largest new position of the ranges before it,
    so no window spans more than one range.
    """
    slot, top, prior, inside = (free(stem, pairs, [name]) for stem in ("slot", "top", "prior", "inside"))
    rows = pairs.withColumn(slot, F.floor(own(old) / F.lit(bucket_rows)))
    before = Window.orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range of positions
    tops = rows.groupBy(slot).agg(F.max(own(new)).alias(top)).select(slot, F.max(top).over(before).alias(prior))
    earlier = Window.partitionBy(slot).orderBy(own(old)).rowsBetween(Window.unboundedPreceding, -1)
    highest = F.greatest(F.col(prior), F.col(inside))
    return (
        rows.withColumn(inside, F.max(own(new)).over(earlier))
        .join(tops, slot)
        .withColumn(name, F.coalesce(highest > own(new), F.lit(False)))
        .drop(slot, prior, inside)
    )


def active_columns(diff: DataFrame, keys: list[str]) -> list[str]:
    """Key columns and the columns with at least one changed cell, from one aggregate."""
    cells = [f.name for f in diff.schema.fields if f.dataType.typeName() == "struct"]
    row = diff.agg(
        *[F.max(~F.col(c)["before"].eqNullSafe(F.col(c)["after"])).alias(c) for c in cells]
    ).first()
    return [*keys, *[c for c in cells if row[c]]]
