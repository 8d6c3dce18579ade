"""Report tables built from the measures and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import clean_serie
from ..operators.joins import left_join_unique
from ..operators.subtotals import drill
from .layered import resolve_seller
from .measures import measure, total

GEOGRAPHY = ["region", "departamento", "zona", "nom_oficina"]
CALENDAR = ["anio", "trimestre", "mes", "fecha_venta"]


def comparison_matrix(sales: DataFrame, goals: DataFrame) -> DataFrame:
    """One row per office: sales by channel, activations, goal and light."""
    names = ["ventas_asesor", "ventas_pdv", "activaciones", "meta", "semaforo"]
    return measure(sales, goals, names, ["nom_oficina"])


def region_sellers(months: DataFrame, oficinas: DataFrame, asesor: DataFrame) -> DataFrame:
    """Drill-through from a region to the sellers of its offices."""
    rows = resolve_seller(months, asesor).filter(F.col("dases_id").isNotNull())
    kits = rows.groupBy("oficina_id", "dases_id").agg(
        F.sum("kits_por_asesor").alias("kits"), F.sum("kits_activos_asesor").alias("kits_activos")
    )
    kits = kits.join(oficinas.select("oficina_id", "region"), "oficina_id")
    by_seller = kits.groupBy("region", "dases_id").agg(
        F.sum("kits").alias("kits"), F.sum("kits_activos").alias("kits_activos")
    )
    names = asesor.select("dases_id", "tipo_canal", "nom_cliente_pdv")
    return by_seller.join(names, "dases_id")


def yearly(sales: DataFrame, by: list[str]) -> DataFrame:
    return sales.groupBy(*by).agg(total("kits").alias("kits"), total("ingresos").alias("ingresos"))


def geography_drill(sales: DataFrame) -> DataFrame:
    return drill(sales, GEOGRAPHY, [total("kits").alias("kits"), total("ingresos").alias("ingresos")])


def calendar_drill(sales: DataFrame) -> DataFrame:
    """Kits and active kits down to the day, with the activation rate at each level."""
    rows = drill(sales, CALENDAR, [total("kits").alias("kits"), total("activos").alias("activos")])
    rate = F.col("activos").cast("double") / F.nullif(F.col("kits").cast("double"), F.lit(0.0))
    return rows.withColumn("tasa", F.coalesce(rate, F.lit(0.0)))


def seller_drill(months: DataFrame, asesor: DataFrame) -> DataFrame:
    """Channel, then seller."""
    rows = resolve_seller(months, asesor)
    names = asesor.select("dases_id", "tipo_canal", "nom_cliente_pdv")
    kits = rows.groupBy("dases_id").agg(F.sum("kits_por_asesor").alias("kits"))
    return drill(kits.join(names, "dases_id"), ["tipo_canal", "nom_cliente_pdv"], [F.sum("kits").alias("kits")])


def state_drill(estado: DataFrame) -> DataFrame:
    """Risk flag, then state."""
    return drill(estado, ["flag_riesgo_90d", "estado"], [F.count("*").alias("series")])


def risk_by_office(recepciones: DataFrame, oficinas: DataFrame) -> DataFrame:
    counts = recepciones.filter("flag_riesgo_90d").groupBy("oficina_id").agg(F.count("*").alias("kits_riesgo"))
    return counts.join(oficinas.select("oficina_id", "nom_oficina", "region"), "oficina_id")


def risk_detail(recepciones: DataFrame, productos: DataFrame) -> DataFrame:
    """Each kit at risk: series, lot, year and month received, days in stock."""
    series = productos.select("producto_id", "serie")
    risky = recepciones.filter("flag_riesgo_90d")
    rows = left_join_unique(risky, series, "producto_id", ["recepcion_id"])
    return rows.select(
        "recepcion_id",
        "serie",
        clean_serie(F.col("serie")).alias("lote_serie"),
        F.year("fecha_recepcion").alias("anio"),
        F.month("fecha_recepcion").alias("mes"),
        "dias_inactivo",
    )
