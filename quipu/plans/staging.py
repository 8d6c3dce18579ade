"""Staging: one function per raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import rules
from ..functions.dates import month_start_of
from ..functions.numeric import flag
from ..functions.text import letters_without_first_other
from ..operators.numbering import keep_best


def stg_ventas(raw: DataFrame) -> DataFrame:
    return raw.select(
        "venta_id",
        "oficina_id",
        "producto_id",
        "vendedor_id",
        "asesor_pdv_id",
        "canal_venta",
        "fecha_venta",
        "recepcion_id",
        F.col("monto_venta").alias("monto_original"),
        rules.channel_amount(F.col("canal_venta"), F.col("monto_venta")).alias("monto_calculado"),
    )


def stg_recepciones(raw: DataFrame) -> DataFrame:
    """The risk flag reads the raw idle days, before missing days become 0."""
    idle = F.col("dias_inactivo")
    return raw.select(
        "recepcion_id",
        "oficina_id",
        "producto_id",
        "fecha_recepcion",
        "estado_recepcion",
        F.coalesce(idle, F.lit(0)).alias("dias_inactivo"),
        rules.stock_at_risk(idle, F.col("estado_recepcion")).alias("flag_riesgo_90d"),
    )


def stg_activaciones(raw: DataFrame) -> DataFrame:
    return raw.select(
        "activacion_id",
        "venta_id",
        "fecha_activacion",
        flag(F.col("flag_activo")).alias("flag_activo"),
    )


def stg_metas(raw: DataFrame) -> DataFrame:
    return raw.select(
        "oficina_id",
        "anio",
        "mes_num",
        "meta_kits",
        month_start_of(F.col("anio"), F.col("mes_num")).alias("fecha_mes"),
    )


def stg_oficinas(raw: DataFrame) -> DataFrame:
    return raw.select("oficina_id", "nom_oficina", "departamento", "region", "zona")


def stg_productos(raw: DataFrame) -> DataFrame:
    return raw.select("producto_id", "serie", "descripcion", "precio_base", "activo")


def stg_vendedores(raw: DataFrame) -> DataFrame:
    return raw.select(
        "vendedor_id",
        "nom_vendedor",
        F.lit(rules.DIRECT).alias("tipo_canal"),
        rules.tariff(rules.DIRECT_TARIFF).alias("monto_asociado"),
    )


def stg_asesores(raw: DataFrame) -> DataFrame:
    return raw.select(
        "asesor_pdv_id",
        "nom_asesor_pdv",
        F.lit(rules.RETAIL).alias("tipo_canal"),
        rules.tariff(rules.RETAIL_TARIFF).alias("monto_asociado"),
    )


STAGING = {
    "ventas": stg_ventas,
    "recepciones": stg_recepciones,
    "activaciones": stg_activaciones,
    "metas": stg_metas,
    "oficinas": stg_oficinas,
    "productos": stg_productos,
    "vendedores": stg_vendedores,
    "asesores": stg_asesores,
}


def latest_sale_per_serie(df: DataFrame) -> DataFrame:
    """Documented staging form that keeps the latest sale of each series.

    Columns in: id_venta, lote_serie, monto, canal, fecha_venta, id_oficina,
    id_vendedor. Missing id, series and amount take defaults; the ranking still groups
    by the series as it came. Ties on the sale time go to the lowest id.
    """
    latest = keep_best(
        df, ["lote_serie"], [F.desc_nulls_first("fecha_venta"), F.asc_nulls_last("id_venta")]
    )
    return latest.select(
        F.coalesce("id_venta", F.lit(0)).alias("id_venta"),
        F.coalesce("lote_serie", F.lit("SIN_SERIE")).alias("lote_serie"),
        F.coalesce("monto", F.lit(0)).alias("monto_venta"),
        letters_without_first_other(F.col("canal")).alias("canal_venta"),
        F.col("fecha_venta").cast("timestamp_ntz").alias("fecha_venta"),
        "id_oficina",
        "id_vendedor",
    )
