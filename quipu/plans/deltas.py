"""Grouped facts kept up to date by what each load adds and takes away.

A load brings sales with their activations, and the old images of sales that it corrects or
deletes. Both are grouped as the facts need them, the old images with a minus, and only
these sums are stored. The facts follow from the sums of all loads, so a load reads its own
sales and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import rules
from ..functions.dates import month_start
from ..sources.versions import drop_folder, numbered_folders
from .layered import weighted_sales

GROUP = ["fecha_mes", "anio", "mes_num", "oficina_id", "vendedor_id", "asesor_pdv_id", "canal_venta"]
SUMS = ["ventas", "kits", "activos", "ingresos"]
Sales = tuple[DataFrame, DataFrame]


def grouped(sales: Sales, sign: int) -> DataFrame:
    """Sums of staged sales with the activations of just these sales, times `sign`."""
    rows, day = weighted_sales(*sales), F.col("fecha_venta")
    values = {"ventas": F.lit(1), "kits": F.col("_rows"), "activos": F.col("_active"), "ingresos": F.col("monto_calculado") * F.col("_rows")}
    kinds = dict.fromkeys(SUMS, "long") | {"ingresos": "decimal(38,2)"}
    return rows.groupBy(
        month_start(day).alias("fecha_mes"), F.year(day).alias("anio"), F.month(day).alias("mes_num"), *GROUP[3:]
    ).agg(*[(F.sum(v) * sign).cast(kinds[name]).alias(name) for name, v in values.items()])


def add_load(root: str, load: int, added: Sales, removed: Sales | None = None) -> None:
    """Store a load's sums; a load that runs again replaces its own.

    A corrected sale is in `removed` as it was, with its activations as they were, and in
    `added` as it is now. Loads come in the order of their numbers, and one that has been
    folded must not come again.
    """
    sums = grouped(added, 1)
    if removed is not None:
        sums = total(sums.unionByName(grouped(removed, -1)))
    sums.write.mode("overwrite").parquet(f"{root}/loads/load={load}")


def total(sums: DataFrame) -> DataFrame:
    """Groups that still have a sale, or whose sums do not cancel out."""
    added = sums.groupBy(*GROUP).agg(*[F.sum(s).cast(sums.schema[s].dataType).alias(s) for s in SUMS])
    return added.filter(" or ".join(f"{s} <> 0" for s in SUMS))


def stored_sums(spark: SparkSession, root: str) -> DataFrame:
    """Sums of all loads: the folded ones and those after."""
    folded = numbered_folders(spark, f"{root}/folded", "upto")[-1:]
    after = folded[0] if folded else -1
    loads = [n for n in numbered_folders(spark, f"{root}/loads", "load") if n > after]
    paths = [f"{root}/folded/upto={n}" for n in folded] + [f"{root}/loads/load={n}" for n in loads]
    if not paths:
        raise ValueError(f"no loads below {root}")
    return total(spark.read.parquet(*paths))


def fold(spark: SparkSession, root: str) -> None:
    """Add up all loads so far into one table; they are dropped once it is whole."""
    loads, folded = numbered_folders(spark, f"{root}/loads", "load"), numbered_folders(spark, f"{root}/folded", "upto")
    if loads and (not folded or loads[-1] > folded[-1]):
        stored_sums(spark, root).write.mode("overwrite").parquet(f"{root}/folded/upto={loads[-1]}")
    for n in folded[:-1] if folded else ():
        drop_folder(spark, f"{root}/folded/upto={n}")
    for n in loads:
        drop_folder(spark, f"{root}/loads/load={n}")


def channel_months(sums: DataFrame) -> DataFrame:
    """As `layered.channel_months`."""

    def of(channel: str, value: str) -> Column:
        return F.sum(F.when(F.col("canal_venta") == channel, F.col(value)).otherwise(0))

    return sums.groupBy("fecha_mes", "oficina_id").agg(
        of(rules.DIRECT, "kits").alias("kits_canal_directo"),
        of(rules.RETAIL, "kits").alias("kits_canal_pdv"),
        of(rules.DIRECT, "ingresos").cast("decimal(22,2)").alias("ingresos_directo"),
        of(rules.RETAIL, "ingresos").cast("decimal(22,2)").alias("ingresos_pdv"),
        F.sum("kits").alias("total_kits"),
    )


def seller_months(sums: DataFrame) -> DataFrame:
    """As `layered.seller_months`."""
    return sums.groupBy(*GROUP[:-1]).agg(
        F.sum("kits").alias("kits_por_asesor"),
        F.sum("activos").alias("kits_activos_asesor"),
        F.sum(F.col("kits") - F.col("activos")).alias("kits_inactivos_asesor"),
    )
