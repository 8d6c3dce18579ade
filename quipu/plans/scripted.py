"""The scripted mart: views, upserted dimensions and typed facts.

Text meets under a collation that ignores case, accents and trailing blanks, offices
join strictly, and a sale carries the number of status rows of its series as a weight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import rules
from ..functions.dates import calendar_columns, date_key, day_gap, month_start, month_start_of
from ..functions.numeric import flag, money_percent, percent
from ..operators.folding import canonical_texts, equal_texts
from ..operators.joins import left_join_unique, lookup, skew_join
from ..operators.numbering import first_writer, number_rows
from ..operators.upsert import upsert
from ..session import written
from ..sources.schemas import MART_SCHEMAS
from ..sources.sinks import conform
from .layered import resolve_seller, weighted_sales
from .staging import stg_activaciones, stg_ventas


STATUS = ["dest_id", "n_estados"]  # what `join_status` adds


def _activation_rows(activaciones: DataFrame) -> DataFrame:
    return activaciones.select("venta_id", flag(F.col("flag_activo")).alias("_active"))


def vw_ventas_enriched(
    ventas: DataFrame, recepciones: DataFrame, activaciones: DataFrame, productos: DataFrame
) -> DataFrame:
    """Sales with receipt, activation and series; every sale stays.

    Products `with_status` bring the status columns of their series along.
    """
    receipts = recepciones.select(
        "recepcion_id", "fecha_recepcion", "estado_recepcion", "dias_inactivo",
        F.lit(True).alias("_received"),
    )
    status = [c for c in STATUS if c in productos.columns]
    series = productos.select("producto_id", F.col("serie").alias("serie_producto"), *status)
    rows = skew_join(ventas, _activation_rows(activaciones), "venta_id")
    rows = left_join_unique(rows, receipts, "recepcion_id", ["venta_id"])
    rows = left_join_unique(rows, series, "producto_id", ["venta_id"])
    at_risk = rules.stock_at_risk(F.col("dias_inactivo"), F.col("estado_recepcion"))
    return rows.select(
        "venta_id",
        "oficina_id",
        "producto_id",
        "vendedor_id",
        "asesor_pdv_id",
        "canal_venta",
        "fecha_venta",
        F.when(F.col("_received"), F.col("recepcion_id")).alias("recepcion_id"),
        "fecha_recepcion",
        "estado_recepcion",
        "dias_inactivo",
        rules.channel_amount(F.col("canal_venta"), F.col("monto_venta")).alias("monto_calculado"),
        day_gap(F.col("fecha_venta"), F.col("fecha_recepcion")).alias("dias_lead_time"),
        flag(at_risk).alias("flag_riesgo_90d"),
        F.coalesce("_active", F.lit(0)).alias("es_activacion"),
        "serie_producto",
        *status,
    )


def vw_ventas_received(ventas: DataFrame, recepciones: DataFrame, activaciones: DataFrame) -> DataFrame:
    """Sales that have a receipt, with the late-sale flag."""
    receipts = recepciones.select("recepcion_id", "fecha_recepcion")
    rows = ventas.join(receipts, "recepcion_id")
    rows = skew_join(rows, _activation_rows(activaciones), "venta_id")
    sold, received = F.col("fecha_venta"), F.col("fecha_recepcion")
    return rows.select(
        "venta_id",
        "oficina_id",
        "fecha_venta",
        "fecha_recepcion",
        rules.channel_amount(F.col("canal_venta"), F.col("monto_venta")).alias("monto_calculado"),
        day_gap(sold, received).alias("dias_rotacion"),
        rules.sold_late(sold, received).alias("es_riesgo"),
        F.coalesce("_active", F.lit(0)).alias("es_activacion"),
        "vendedor_id",
        "asesor_pdv_id",
        "canal_venta",
    )


def dim_tiempo(ventas: DataFrame, recepciones: DataFrame, metas: DataFrame) -> DataFrame:
    """Dates in load order: the first stream with a date also names where it came from."""
    day = F.col("fecha")
    sold = ventas.select(F.col("fecha_venta").alias("fecha")).distinct()
    received = recepciones.select(F.col("fecha_recepcion").alias("fecha")).distinct()
    goals = metas.select(month_start_of(F.col("anio"), F.col("mes_num")).alias("fecha")).distinct()
    none = F.lit(None).cast("date")
    streams = [
        df.filter(day.isNotNull()).select(
            *calendar_columns(day), got.alias("fecha_recepcion"), sale.alias("fecha_venta")
        )
        for df, got, sale in ((sold, none, day), (received, day, none), (goals, none, none))
    ]
    return conform(first_writer(streams, ["dtiem_id"]), "dim_tiempo")


def dim_estado(recepciones: DataFrame, productos: DataFrame) -> DataFrame:
    """Every distinct (state, idle days, risk, series); texts equal under the collation are one.

    States get their common text before the rows are made distinct, so all rows are exchanged
    once for that.
    """
    series = productos.select("producto_id", "serie").join(
        canonical_texts(productos, "serie", "lote_serie"), "serie"
    )
    names = written(canonical_texts(recepciones, "estado_recepcion", "estado"), "states")
    rows = left_join_unique(
        recepciones, series.select("producto_id", "lote_serie"), "producto_id", ["recepcion_id"]
    )
    at_risk = flag(rules.stock_at_risk(F.col("dias_inactivo"), F.col("estado_recepcion")))
    states = left_join_unique(rows, names, "estado_recepcion", ["recepcion_id"]).select(
        "estado", F.col("dias_inactivo").alias("dias_desde_recepcion"), at_risk.alias("flag_riesgo_90d"), "lote_serie"
    )
    order = ["estado", "lote_serie", "dias_desde_recepcion", "flag_riesgo_90d"]
    numbered = number_rows(states.distinct(), [F.asc_nulls_last(c) for c in order], "dest_id")
    return conform(numbered, "dim_estado")


def empty_dim(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], MART_SCHEMAS[name])


def dim_oficina(target: DataFrame, oficinas: DataFrame) -> DataFrame:
    return conform(upsert(target, oficinas, ["oficina_id"], "dofic_id"), "dim_oficina")


def dim_asesor_pdv(target: DataFrame, vendedores: DataFrame, asesores: DataFrame) -> DataFrame:
    """Both loads at once; a known seller gets the new name and keeps the recorded tariff.

    New sellers are numbered load by load. The channel is part of the key, so the loads
    never meet in one key.
    """
    loads = (
        (vendedores, "vendedor_id", "nom_vendedor", rules.DIRECT, rules.DIRECT_TARIFF),
        (asesores, "asesor_pdv_id", "nom_asesor_pdv", rules.RETAIL, rules.RETAIL_TARIFF),
    )
    rows = [
        raw.select(
            F.col(key).alias("origen_id"),
            F.col(name).alias("nom_cliente_pdv"),
            F.lit(channel).alias("tipo_canal"),
            F.lit(amount).cast("decimal(10,2)").alias("monto_asociado"),
        )
        for raw, key, name, channel, amount in loads
    ]
    turn = F.when(F.col("tipo_canal") == rules.DIRECT, 0).otherwise(1)
    loaded = upsert(
        target, rows[0].unionByName(rows[1]), ["origen_id", "tipo_canal"], "dases_id", ["nom_cliente_pdv"],
        number_by=[turn, F.col("origen_id")],
    )
    return written(conform(loaded, "dim_asesor_pdv"), "dim_asesor_pdv")


def join_status(
    rows: DataFrame, estado: DataFrame, serie: str, spread_by: list[str], texts: DataFrame | None = None
) -> DataFrame:
    """Each row with the least status key of its series and `n_estados`, how many it has.

    The series and the status rows meet under the collation. A series may own any share
    of the status rows, and rows are not repeated for them: sums take the number as a weight.
    The status rows are first summed up by their text, so the texts meet without them.
    `texts` may name a shorter table that holds every series of `rows`.
    """
    owned = estado.filter("lote_serie is not null").groupBy("lote_serie").agg(
        F.min("dest_id").alias("dest_id"), F.count("*").alias("n_estados")
    )
    owned = written(owned, "owned")
    known = equal_texts(rows if texts is None else texts, serie, owned, "lote_serie")
    states = known.join(owned, "lote_serie").groupBy(serie).agg(
        F.min("dest_id").alias("dest_id"), F.sum("n_estados").alias("n_estados")
    )
    joined = left_join_unique(rows, written(states, "status"), serie, spread_by)
    return joined.withColumn("n_estados", F.coalesce("n_estados", F.lit(0)))


def with_status(productos: DataFrame, estado: DataFrame) -> DataFrame:
    """Products with the status columns of their series, written once for the facts that read them.

    A fact that joins them by product needs no further exchange of its rows by series.
    """
    series = productos.select("producto_id", "serie")
    return written(join_status(series, estado, "serie", ["producto_id"]), "products")


def hecho_ventas(
    view: DataFrame, oficina: DataFrame, estado: DataFrame, productos: DataFrame
) -> DataFrame:
    """Typed sales fact, a row for each sale and activation; the office share is filled in from the loaded rows.

    `n_estados` is the number of status rows of the sale's series, and the weight of its
    income in the office share (1 where there is none). A view of products `with_status` has it
    already.
    """
    offices = oficina.select("dofic_id", F.col("oficina_id").alias("_of"))
    rows = lookup(view, offices, F.col("oficina_id") == F.col("_of"), "inner")
    if "n_estados" not in view.columns:
        texts = productos.select(F.col("serie").alias("serie_producto"))
        rows = join_status(rows, estado, "serie_producto", ["venta_id"], texts)
    rows = rows.select(
        date_key(F.col("fecha_venta")).alias("dtiem_id"),
        "dofic_id",
        "dest_id",
        F.coalesce("n_estados", F.lit(0)).alias("n_estados"),
        F.lit(1).alias("kits_vendidos"),
        F.col("es_activacion").alias("kits_activos"),
        rules.activation_pct(F.col("es_activacion")).alias("tasa_activacion_pct"),
        F.col("monto_calculado").alias("ingresos_s"),
        "venta_id",
        F.col("serie_producto").alias("serie"),
        "canal_venta",
    )
    return fill_contribution(written(conform(rows, "hecho_ventas"), "hecho_ventas"))


def fill_contribution(loaded: DataFrame) -> DataFrame:
    """Post-load update: each row takes its office's share of all loaded income."""
    weighted = F.col("ingresos_s") * F.greatest("n_estados", F.lit(1))
    offices = loaded.groupBy(F.col("dofic_id").alias("_of")).agg(F.sum(weighted).alias("_income"))
    total = offices.agg(F.sum("_income")).scalar()
    share = money_percent(F.col("_income"), total).cast("decimal(5,2)")
    shares = written(offices.select("_of", share.alias("_share")), "shares")
    joined = lookup(loaded, shares, F.col("dofic_id") == F.col("_of"))
    updated = F.when(F.col("_of").isNotNull(), F.col("_share")).otherwise(F.col("contribucion_pct"))
    return joined.withColumn("contribucion_pct", updated).select(loaded.columns)


def hecho_inventario(
    recepciones: DataFrame, productos: DataFrame, ventas: DataFrame, oficina: DataFrame, estado: DataFrame
) -> DataFrame:
    """Receipts of known products and offices, repeated per sale, with the number of status rows.

    The status comes with the product, see `with_status`.
    """
    offices = oficina.select("dofic_id", F.col("oficina_id").alias("_of"))
    goods = productos if "n_estados" in productos.columns else with_status(productos, estado)
    rows = recepciones.join(goods.select("producto_id", "serie", *STATUS), "producto_id")
    rows = lookup(rows, offices, F.col("oficina_id") == F.col("_of"), "inner")
    sold = ventas.filter(F.col("recepcion_id").isNotNull()).select("recepcion_id", "fecha_venta")
    rows = skew_join(rows, sold, "recepcion_id")
    at_risk = rules.stock_at_risk(F.col("dias_inactivo"), F.col("estado_recepcion"))
    return conform(
        rows.select(
            date_key(F.col("fecha_recepcion")).alias("dtiem_id"),
            "dofic_id",
            "dest_id",
            "n_estados",
            F.coalesce("dias_inactivo", F.lit(0)).alias("dias_inactivo"),
            flag(at_risk).alias("kits_riesgo_90d"),
            day_gap(F.col("fecha_venta"), F.col("fecha_recepcion")).alias("rotation_lote"),
            "serie",
        ),
        "hecho_inventario",
    )


def _office_sales(ventas: DataFrame, activaciones: DataFrame, oficina: DataFrame) -> DataFrame:
    """Sales of known offices with the row and activation counts of the enriched view.

    Receipts and products have unique keys, so only activations repeat a sale there.
    """
    sales = weighted_sales(stg_ventas(ventas), stg_activaciones(activaciones))
    offices = oficina.select("dofic_id", F.col("oficina_id").alias("_of"))
    return lookup(sales, offices, F.col("oficina_id") == F.col("_of"), "inner")


def hecho_canal(ventas: DataFrame, activaciones: DataFrame, oficina: DataFrame) -> DataFrame:
    """Month by office with one column per channel."""
    n, income = F.col("_rows"), F.col("_rows") * F.col("monto_calculado")
    direct, retail = F.col("canal_venta") == rules.DIRECT, F.col("canal_venta") == rules.RETAIL
    grouped = (
        _office_sales(ventas, activaciones, oficina)
        .groupBy(month_start(F.col("fecha_venta")).alias("_month"), "dofic_id")
        .agg(
            F.sum(F.when(direct, n).otherwise(0)).alias("kits_canal_directo"),
            F.sum(F.when(retail, n).otherwise(0)).alias("kits_canal_pdv"),
            F.sum(F.when(direct, income).otherwise(0)).alias("ingresos_directo"),
            F.sum(F.when(retail, income).otherwise(0)).alias("ingresos_pdv"),
            F.sum(n).alias("_all"),
        )
    )
    rows = grouped.withColumns(
        {
            "dtiem_id": date_key(F.col("_month")),
            "mix_canal_pct": percent(F.col("kits_canal_pdv"), F.col("_all")),
        }
    )
    return conform(rows, "hecho_canal")


def summed_goals(metas: DataFrame) -> DataFrame:
    return metas.groupBy("oficina_id", "anio", "mes_num").agg(F.sum("meta_kits").alias("_goal"))


def hecho_desempeno(
    ventas: DataFrame, activaciones: DataFrame, metas: DataFrame, oficina: DataFrame, asesor: DataFrame
) -> DataFrame:
    """Month, office and seller; the goal is the sum of the office's goals of the month.

    The per-row goal lookup is one grouped table joined on its three keys.
    """
    day = F.col("fecha_venta")
    grouped = (
        _office_sales(ventas, activaciones, oficina)
        .groupBy(
            F.year(day).alias("anio"),
            F.month(day).alias("mes_num"),
            "oficina_id",
            "dofic_id",
            "vendedor_id",
            "asesor_pdv_id",
        )
        .agg(
            F.sum("_rows").alias("kits_por_asesor"),
            F.sum("_active").alias("kits_activos_asesor"),
            F.sum(F.col("_rows") - F.col("_active")).alias("kits_inactivos_asesor"),
        )
    )
    rows = grouped.join(summed_goals(metas), ["oficina_id", "anio", "mes_num"], "left")
    rows = resolve_seller(rows, asesor).withColumn("meta_kits_mes", F.coalesce("_goal", F.lit(0)))
    rows = rows.withColumns(
        {
            "dtiem_id": date_key(F.make_date("anio", "mes_num", F.lit(1))),
            "cumplimiento_meta_pct": percent(F.col("kits_activos_asesor"), F.col("meta_kits_mes")),
            "kits_inactivos_pct": percent(F.col("kits_inactivos_asesor"), F.col("kits_por_asesor")),
        }
    )
    # an unknown ratio stays unknown: an explicit NULL is not a missing column
    return conform(rows, "hecho_desempeno")
