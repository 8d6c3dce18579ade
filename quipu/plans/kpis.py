"""Documented KPIs and their interpretation bands."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import day_gap, days_since, month_start
from ..functions.numeric import money_percent, percent
from ..functions.rules import DIRECT, IDLE_LIMIT_DAYS, RETAIL, SOLD

# fixed values: KPI -> (band, lower limit, lower included, upper limit, upper included)
BANDS: dict[str, list[tuple[str, float | None, bool, float | None, bool]]] = {
    "tasa_activacion": [
        ("bajo", None, False, 80, False),
        ("esperado", 80, True, 90, False),
        ("alto", 90, True, None, False),
    ],
    "ingresos_presupuesto": [
        ("bajo", None, False, 80, False),
        ("esperado", 80, True, 100, False),
        ("alto", 100, True, None, False),
    ],
    "contribucion": [
        ("bajo", None, False, 5, False),
        ("esperado", 5, True, 15, True),
        ("alto", 15, False, None, False),
    ],
    "riesgo_pct": [
        ("bajo", 15, False, None, False),
        ("esperado", 5, True, 15, True),
        ("alto", None, False, 5, False),
    ],
    "dias_inactivo": [
        ("bajo", 60, False, None, False),
        ("esperado", 30, True, 60, True),
        ("alto", None, False, 30, False),
    ],
    "rotacion": [
        ("bajo", 45, False, None, False),
        ("esperado", 30, True, 45, True),
        ("alto", None, False, 30, False),
    ],
    "canal_unico": [("critico", 90, False, None, False), ("esperado", None, False, 90, True)],
    "cumplimiento_meta": [
        ("bajo", None, False, 80, False),
        ("esperado", 80, True, 100, False),
        ("alto", 100, True, None, False),
    ],
}


def band(kpi: str, value: Column) -> Column:
    """Band of a KPI value; NULL when the value is unknown."""
    out = None
    for name, low, low_in, high, high_in in BANDS[kpi]:
        inside = value.isNotNull()
        if low is not None:
            inside = inside & ((value >= low) if low_in else (value > low))
        if high is not None:
            inside = inside & ((value <= high) if high_in else (value < high))
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return out


def activation_of_received(sales: DataFrame, goals: DataFrame) -> DataFrame:
    """Active kits over received kits per office and month."""
    active = sales.groupBy("oficina_id", month_start(F.col("fecha_venta")).alias("fecha_mes")).agg(
        F.sum("activos").alias("kits_activos")
    )
    received = goals.select("oficina_id", "fecha_mes", "kits_recibidos")
    both = active.join(received, ["oficina_id", "fecha_mes"], "full").select(
        "oficina_id",
        "fecha_mes",
        F.coalesce("kits_activos", F.lit(0)).alias("kits_activos"),
        F.coalesce("kits_recibidos", F.lit(0)).alias("kits_recibidos"),
    )
    rate = percent(F.col("kits_activos"), F.col("kits_recibidos"))
    return both.withColumn("tasa_activacion_pct", rate)


def monthly_income(sales: DataFrame) -> DataFrame:
    return sales.groupBy("oficina_id", month_start(F.col("fecha_venta")).alias("fecha_mes")).agg(
        F.sum("ingresos").alias("ingresos")
    )


def contribution(sales: DataFrame) -> DataFrame:
    offices = sales.groupBy("oficina_id").agg(F.sum("ingresos").alias("ingresos"))
    total = offices.agg(F.sum("ingresos")).scalar()
    return offices.withColumn("contribucion_pct", money_percent(F.col("ingresos"), total))


def kits_at_risk(recepciones: DataFrame, as_of: dt.date, by: list[str]) -> DataFrame:
    """Unsold kits older than the limit on a given day, and their share of all kits."""
    risky = (days_since(F.col("fecha_recepcion"), as_of) > IDLE_LIMIT_DAYS) & (
        F.col("estado_recepcion") != SOLD
    )
    counts = recepciones.groupBy(*by).agg(
        F.count_if(risky).alias("kits_riesgo"), F.count("*").alias("kits")
    )
    return counts.withColumn("riesgo_pct", percent(F.col("kits_riesgo"), F.col("kits")))


def mean_idle_days(recepciones: DataFrame, as_of: dt.date, by: list[str]) -> DataFrame:
    idle = recepciones.filter(F.col("estado_recepcion") != SOLD)
    return idle.groupBy(*by).agg(
        F.avg(days_since(F.col("fecha_recepcion"), as_of)).alias("dias_inactivo_prom")
    )


def lot_rotation(receipts: DataFrame, active_sales: DataFrame, by: list[Column]) -> DataFrame:
    """Mean days from receipt to sale of active kits.

    `active_sales` has one row per sale (`recepcion_id`, `fecha_venta`, `pesos` = number
    of its active activations), so the mean is a weighted sum.
    """
    joined = receipts.join(active_sales, "recepcion_id")
    gap = day_gap(F.col("fecha_venta"), F.col("fecha_recepcion"))
    return joined.groupBy(*by).agg(
        (F.sum(gap * F.col("pesos")).cast("double") / F.sum("pesos")).alias("rotacion_prom")
    )


def channel_mix(sales: DataFrame, by: list[str]) -> DataFrame:
    """Share of each channel in the kits sold, and the larger of the two."""
    direct, retail = F.col("canal_venta") == DIRECT, F.col("canal_venta") == RETAIL
    counts = sales.groupBy(*by).agg(
        F.sum(F.when(direct, F.col("kits")).otherwise(0)).alias("kits_directo"),
        F.sum(F.when(retail, F.col("kits")).otherwise(0)).alias("kits_pdv"),
        F.sum("kits").alias("kits"),
    )
    return counts.withColumns(
        {
            "mix_pdv_pct": percent(F.col("kits_pdv"), F.col("kits")),
            "mix_directo_pct": percent(F.col("kits_directo"), F.col("kits")),
        }
    )


def goal_attainment(sales: DataFrame, goals: DataFrame) -> DataFrame:
    active = sales.groupBy("oficina_id", month_start(F.col("fecha_venta")).alias("fecha_mes")).agg(
        F.sum("activos").alias("kits_activos")
    )
    wanted = goals.select("oficina_id", "fecha_mes", F.col("meta_activacion").alias("meta"))
    both = active.join(wanted, ["oficina_id", "fecha_mes"], "left").withColumn(
        "meta", F.coalesce("meta", F.lit(0))
    )
    return both.withColumn(
        "cumplimiento_meta_pct", percent(F.col("kits_activos"), F.col("meta"))
    )


def seller_kits(months: DataFrame) -> DataFrame:
    """Kits and inactive share per seller over all months and offices."""
    sums = months.groupBy("vendedor_id", "asesor_pdv_id").agg(
        F.sum("kits_por_asesor").alias("kits"),
        F.sum("kits_inactivos_asesor").alias("kits_inactivos"),
    )
    return sums.withColumn("inactivos_pct", percent(F.col("kits_inactivos"), F.col("kits")))
