"""Measures: named expressions evaluated for any grouping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import month_start
from ..functions.numeric import divide, positive_part
from ..functions.rules import DIRECT, RETAIL, goal_light
from .layered import fact_metas_pedidos, weighted_sales

OFFICE = ["oficina_id", "nom_oficina", "departamento", "region", "zona"]


def sales_cube(ventas: DataFrame, activaciones: DataFrame) -> DataFrame:
    """Kits, active kits and income per office, day and channel.

    Every sales measure is a sum over these rows, which no longer grow with the number
    of sales of a day.
    """
    return (
        weighted_sales(ventas, activaciones)
        .groupBy("oficina_id", "fecha_venta", "canal_venta")
        .agg(
            F.sum("_rows").alias("kits"),
            F.sum("_active").alias("activos"),
            F.sum(F.col("_rows") * F.col("monto_calculado")).cast("decimal(30,2)").alias("ingresos"),
        )
    )


def goals_table(recepciones: DataFrame, metas: DataFrame) -> DataFrame:
    return fact_metas_pedidos(recepciones, metas)


def _calendar(day: str) -> dict[str, Column]:
    return {
        "anio": F.year(day),
        "trimestre": F.quarter(day),
        "mes": F.month(day),
        "dia": F.dayofmonth(day),
        "fecha_mes": month_start(F.col(day)),
    }


def with_attributes(rows: DataFrame, day: str, oficinas: DataFrame) -> DataFrame:
    """Office and calendar attributes; rows of unknown offices keep NULL names."""
    days = {n: c for n, c in _calendar(day).items() if n != day}
    return rows.withColumns(days).join(oficinas.select(*OFFICE), "oficina_id", "left")


def only(condition: Column, value: Column) -> Column:
    """A measure under a fixed filter."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0))


SALES_MEASURES: dict[str, Callable[[], Column]] = {
    "total_vendidos": lambda: total("kits"),
    "ventas_asesor": lambda: only(F.col("canal_venta") == DIRECT, F.col("kits")),
    "ventas_pdv": lambda: only(F.col("canal_venta") == RETAIL, F.col("kits")),
    "activaciones": lambda: total("activos"),
    "ingresos": lambda: total("ingresos"),
}
GOAL_MEASURES: dict[str, Callable[[], Column]] = {
    "total_pedidos": lambda: total("kits_recibidos"),
    "meta": lambda: total("meta_activacion"),
}
# measures built from other measures of the same group
DERIVED: dict[str, tuple[list[str], Callable[[], Column]]] = {
    "stock_actual": (
        ["total_pedidos", "total_vendidos"],
        lambda: F.col("total_pedidos") - F.col("total_vendidos"),
    ),
    "tasa_activacion": (
        ["activaciones", "total_vendidos"],
        lambda: divide(F.col("activaciones"), F.col("total_vendidos")),
    ),
    "brecha_meta": (
        ["meta", "activaciones"],
        lambda: positive_part(F.col("meta") - F.col("activaciones")),
    ),
    "semaforo": (
        ["activaciones", "meta"],
        lambda: goal_light(divide(F.col("activaciones"), F.col("meta"))),
    ),
    "ticket_promedio": (
        ["ingresos", "total_vendidos"],
        lambda: divide(F.col("ingresos"), F.col("total_vendidos")),
    ),
    "cumplimiento_meta": (
        ["total_vendidos", "meta"],
        lambda: divide(F.col("total_vendidos"), F.col("meta")),
    ),
}


def measure(
    sales: DataFrame,
    goals: DataFrame | None,
    names: list[str],
    by: list[str],
    where: Column | None = None,
) -> DataFrame:
    """The named measures per group.

    `sales` and `goals` carry the grouping attributes (`with_attributes`). The facts are
    aggregated apart and meet on the group, so neither multiplies the other; a group
    that only one fact knows counts as 0 in the other.
    """
    base: list[str] = []
    for name in names:
        for need in DERIVED[name][0] if name in DERIVED else [name]:
            if need not in base:
                base.append(need)
    parts = []
    for frame, known in ((sales, SALES_MEASURES), (goals, GOAL_MEASURES)):
        wanted = [n for n in base if n in known]
        if not wanted:
            continue
        rows = frame if where is None else frame.filter(where)
        parts.append(rows.groupBy(*by).agg(*[known[n]().alias(n) for n in wanted]))
    if len(parts) == 2 and by:
        both = parts[0].join(parts[1], by, "full")
    elif len(parts) == 2:
        left, right = parts
        both = left.select("*", *[right.select(c).scalar().alias(c) for c in right.columns])
    else:
        both = parts[0]
    filled = both.select(*by, *[F.coalesce(n, F.lit(0)).alias(n) for n in base])
    return filled.select(
        *by, *[(DERIVED[n][1]() if n in DERIVED else F.col(n)).alias(n) for n in names]
    )


def office_contribution(sales: DataFrame, within: list[str]) -> DataFrame:
    """Income of each office against the income of all offices in the same context."""
    groups = sales.groupBy(*within, "oficina_id").agg(F.sum("ingresos").alias("ingresos"))
    if within:
        totals = groups.groupBy(*within).agg(F.sum("ingresos").alias("_all"))
        groups = groups.join(totals, within)
    else:
        groups = groups.withColumn("_all", groups.agg(F.sum("ingresos")).scalar())
    return groups.withColumn("contribucion", divide(F.col("ingresos"), F.col("_all"))).drop("_all")
