"""Dimensions and facts of the layered mart, rebuilt in full on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules
from ..functions.dates import calendar_columns, date_key, day_gap, month_start
from ..functions.numeric import money_percent, percent
from ..functions.text import clean_serie, has_serie
from ..operators.joins import left_join_unique, lookup, skew_join
from ..operators.numbering import keep_best, number_rows
from ..session import written

KITS = ["kits_por_asesor", "kits_activos_asesor", "kits_inactivos_asesor"]


# ---- dimensions ---------------------------------------------------------------


def dim_tiempo(ventas: DataFrame, recepciones: DataFrame, metas: DataFrame) -> DataFrame:
    """Every date seen in sales, receipts or goal months.

    One exchange for all three streams; each map task sends a date once at most.
    """
    day = F.col("fecha")
    sold = ventas.select(F.col("fecha_venta").alias("fecha"))
    received = recepciones.select(F.col("fecha_recepcion").alias("fecha"))
    goals = metas.select(F.col("fecha_mes").alias("fecha"))
    dates = sold.unionByName(received).unionByName(goals).filter(day.isNotNull()).distinct()
    return dates.select(*calendar_columns(day))


def dim_oficina(oficinas: DataFrame) -> DataFrame:
    numbered = number_rows(oficinas, [F.asc_nulls_last("oficina_id")], "dofic_id")
    return numbered.select("dofic_id", "oficina_id", "nom_oficina", "departamento", "region", "zona")


def sellers(vendedores: DataFrame, asesores: DataFrame) -> DataFrame:
    """Both seller populations under one set of names."""
    direct = vendedores.withColumnsRenamed({"vendedor_id": "origen_id", "nom_vendedor": "nom_cliente_pdv"})
    retail = asesores.withColumnsRenamed({"asesor_pdv_id": "origen_id", "nom_asesor_pdv": "nom_cliente_pdv"})
    return direct.unionByName(retail)


def dim_asesor_pdv(vendedores: DataFrame, asesores: DataFrame) -> DataFrame:
    order = [F.asc_nulls_last("tipo_canal"), F.asc_nulls_last("origen_id")]
    numbered = number_rows(sellers(vendedores, asesores), order, "dases_id")
    return numbered.select("dases_id", "origen_id", "nom_cliente_pdv", "tipo_canal", "monto_asociado")


def clean_states(recepciones: DataFrame, productos: DataFrame) -> DataFrame:
    """Receipts with a usable series, the series cleaned."""
    usable = productos.filter(has_serie(F.col("serie"))).select(
        "producto_id", clean_serie(F.col("serie")).alias("lote_serie")
    )
    return recepciones.join(usable, "producto_id").select(
        F.col("estado_recepcion").alias("estado"),
        F.col("dias_inactivo").alias("dias_desde_recepcion"),
        "flag_riesgo_90d",
        "lote_serie",
    )


def master_states(states: DataFrame) -> DataFrame:
    """The least idle receipt of each series, later state name first among equals."""
    return keep_best(
        states,
        ["lote_serie"],
        [F.asc_nulls_last("dias_desde_recepcion"), F.desc_nulls_first("estado")],
    )


def dim_estado(recepciones: DataFrame, productos: DataFrame) -> DataFrame:
    base = master_states(clean_states(recepciones, productos))
    numbered = number_rows(base, [F.asc_nulls_last("estado"), F.col("lote_serie")], "dest_id")
    return numbered.select(
        "dest_id",
        "estado",
        "dias_desde_recepcion",
        "flag_riesgo_90d",
        "lote_serie",
        F.lit(rules.CLEAN_TABLE_MARK).alias("tabla_viva_dbt"),
    )


# ---- enrichment ---------------------------------------------------------------


def with_activations(ventas: DataFrame, activaciones: DataFrame, dedupe: bool = False) -> DataFrame:
    """Sales with `es_activacion`, one row per sale and activation.

    A sale with several activations counts several times; `dedupe=True` keeps one row
    per sale, active when any activation is.
    """
    acts = activaciones.select("venta_id", F.col("flag_activo").alias("_active"))
    if dedupe:
        acts = acts.groupBy("venta_id").agg(F.max("_active").alias("_active"))
        rows = left_join_unique(ventas, acts, "venta_id")
    else:
        rows = skew_join(ventas, acts, "venta_id")
    return rows.withColumn("es_activacion", F.coalesce("_active", F.lit(0))).drop("_active")


def enrich_sales(ventas: DataFrame, activaciones: DataFrame, productos: DataFrame, dedupe: bool = False) -> DataFrame:
    """Sales with activation and series."""
    series = productos.select("producto_id", F.col("serie").alias("serie_producto"))
    rows = with_activations(ventas, activaciones, dedupe)
    return left_join_unique(rows, series, "producto_id", ["venta_id"])


def product_status(productos: DataFrame, estado: DataFrame, normalize_serie: bool = False) -> DataFrame:
    """Series and status key per product.

    A product has one series, so the status is looked up among the products and the
    facts then shuffle once, by product, instead of again by series.
    """
    rows = productos.select("producto_id", "serie")
    if not normalize_serie:
        return join_series(rows, estado, "serie", ["producto_id"])
    cleaned = rows.withColumn("_clean", clean_serie(F.col("serie")))
    return join_series(cleaned, estado, "_clean", ["producto_id"]).drop("_clean")


def activation_counts(activaciones: DataFrame) -> DataFrame:
    """Rows and active rows per sale, combined before any join."""
    return activaciones.groupBy("venta_id").agg(
        F.count("*").alias("_rows"), F.sum("flag_activo").alias("_active")
    )


def weighted_sales(ventas: DataFrame, activaciones: DataFrame) -> DataFrame:
    """Sales with `_rows`, the rows a join to the activations would give, and `_active`.

    Grouped facts need only these two numbers, so the fan-out is never materialised.
    """
    joined = left_join_unique(ventas, activation_counts(activaciones), "venta_id")
    return joined.withColumns(
        {
            "_rows": F.coalesce("_rows", F.lit(1)),
            "_active": F.coalesce("_active", F.lit(0)),
        }
    )


# ---- facts --------------------------------------------------------------------


def office_shares(enriched: DataFrame) -> DataFrame:
    """Revenue share of each office in all enriched sales."""
    offices = enriched.groupBy(F.col("oficina_id").alias("_office")).agg(
        F.sum("monto_calculado").alias("_income")
    )
    total = offices.agg(F.sum("_income")).scalar()
    return offices.select("_office", money_percent(F.col("_income"), total).alias("contribucion_pct"))


def join_series(fact: DataFrame, estado: DataFrame, serie: str, spread_by: list[str]) -> DataFrame:
    """Status key by series; the dimension's series are unique but may be many.

    Its series are never blank, so rows without a usable series match nothing and are
    scattered like those without any.
    """
    usable = F.when(has_serie(F.col(serie)), F.col(serie))
    keys = estado.select("dest_id", F.col("lote_serie").alias("_lote"))
    joined = left_join_unique(fact.withColumn("_lote", usable), keys, "_lote", spread_by)
    return joined.drop("_lote")


def fact_ventas(
    ventas: DataFrame,
    activaciones: DataFrame,
    productos: DataFrame,
    tiempo: DataFrame,
    oficina: DataFrame,
    estado: DataFrame,
    normalize_serie: bool = False,
    dedupe: bool = False,
) -> DataFrame:
    status = product_status(productos, estado, normalize_serie)
    enriched = left_join_unique(
        with_activations(ventas, activaciones, dedupe), status, "producto_id", ["venta_id"]
    )
    # read twice below (shares, rows), so the joins run once and are written
    facts = written(
        enriched.select(
            "venta_id", "oficina_id", "canal_venta", "fecha_venta", "monto_calculado",
            "es_activacion", "serie", "dest_id",
        ),
        "enriched",
    )
    shares = office_shares(facts)
    offices = oficina.select("dofic_id", F.col("oficina_id").alias("_of")).join(
        shares, F.col("_of") == F.col("_office"), "full"
    )
    offices = written(offices.withColumn("_of", F.coalesce("_of", "_office")).drop("_office"), "shares")
    days = tiempo.select(F.col("dtiem_id"))
    facts = lookup(facts, days, date_key(F.col("fecha_venta")) == F.col("dtiem_id"))
    # one row per office, from the two small office tables
    facts = lookup(facts, offices, F.col("oficina_id") == F.col("_of"))
    return facts.select(
        "dtiem_id",
        "dofic_id",
        "dest_id",
        "venta_id",
        "canal_venta",
        "serie",
        F.lit(1).alias("kits_vendidos"),
        F.col("es_activacion").alias("kits_activos"),
        rules.activation_pct(F.col("es_activacion")).alias("tasa_activacion_pct"),
        F.col("monto_calculado").alias("ingresos_s"),
        "contribucion_pct",
    )


def receipts_with_sale(recepciones: DataFrame, ventas: DataFrame, products: DataFrame) -> DataFrame:
    """Receipts with product columns and sale date; unsold receipts stay, repeated sales repeat."""
    rows = left_join_unique(recepciones, products, "producto_id", ["recepcion_id"])
    sold = ventas.filter(F.col("recepcion_id").isNotNull()).select("recepcion_id", "fecha_venta")
    joined = skew_join(rows, sold, "recepcion_id")
    gap = day_gap(F.col("fecha_venta"), F.col("fecha_recepcion"))
    return joined.withColumn("rotation_lote", F.when(F.col("fecha_venta").isNotNull(), gap))


def fact_inventario(
    recepciones: DataFrame,
    ventas: DataFrame,
    productos: DataFrame,
    tiempo: DataFrame,
    oficina: DataFrame,
    estado: DataFrame,
) -> DataFrame:
    rows = receipts_with_sale(recepciones, ventas, product_status(productos, estado))
    days = tiempo.select("dtiem_id")
    rows = lookup(rows, days, date_key(F.col("fecha_recepcion")) == F.col("dtiem_id"))
    offices = oficina.select("dofic_id", F.col("oficina_id").alias("_of"))
    rows = lookup(rows, offices, F.col("oficina_id") == F.col("_of"))
    return rows.select(
        "dtiem_id",
        "dofic_id",
        "dest_id",
        "serie",
        "dias_inactivo",
        F.col("flag_riesgo_90d").cast("int").alias("kits_riesgo_90d"),
        "rotation_lote",
    )


def channel_months(ventas: DataFrame, activaciones: DataFrame) -> DataFrame:
    """Kits and income of both channels per month and office."""
    sales = weighted_sales(ventas, activaciones)
    income = F.col("monto_calculado") * F.col("_rows")

    def of(channel: str, value: Column) -> Column:
        return F.sum(F.when(F.col("canal_venta") == channel, value).otherwise(0))

    return sales.groupBy(month_start(F.col("fecha_venta")).alias("fecha_mes"), "oficina_id").agg(
        of(rules.DIRECT, F.col("_rows")).alias("kits_canal_directo"),
        of(rules.RETAIL, F.col("_rows")).alias("kits_canal_pdv"),
        of(rules.DIRECT, income).cast("decimal(22,2)").alias("ingresos_directo"),
        of(rules.RETAIL, income).cast("decimal(22,2)").alias("ingresos_pdv"),
        F.sum("_rows").alias("total_kits"),
    )


def fact_canal(ventas: DataFrame, activaciones: DataFrame, tiempo: DataFrame, oficina: DataFrame) -> DataFrame:
    return canal_of_months(channel_months(ventas, activaciones), tiempo, oficina)


def canal_of_months(monthly: DataFrame, tiempo: DataFrame, oficina: DataFrame) -> DataFrame:
    """The channel fact of `channel_months`, however these were made."""
    key = date_key(F.col("fecha_mes"))
    monthly = lookup(monthly, tiempo.select("dtiem_id"), key == F.col("dtiem_id"))
    offices = oficina.select("dofic_id", F.col("oficina_id").alias("_of"))
    monthly = lookup(monthly, offices, F.col("oficina_id") == F.col("_of"))
    return monthly.select(
        F.coalesce("dtiem_id", key).alias("dtiem_id"),
        "dofic_id",
        "kits_canal_directo",
        "kits_canal_pdv",
        "ingresos_directo",
        "ingresos_pdv",
        percent(F.col("kits_canal_pdv"), F.col("total_kits")).alias("mix_canal_pct"),
    )


def seller_months(ventas: DataFrame, activaciones: DataFrame) -> DataFrame:
    """Kits per month, office and seller."""
    day = F.col("fecha_venta")
    return (
        weighted_sales(ventas, activaciones)
        .groupBy(
            month_start(day).alias("fecha_mes"),
            F.year(day).alias("anio"),
            F.month(day).alias("mes_num"),
            "oficina_id",
            "vendedor_id",
            "asesor_pdv_id",
        )
        .agg(
            F.sum("_rows").alias("kits_por_asesor"),
            F.sum("_active").alias("kits_activos_asesor"),
            F.sum(F.col("_rows") - F.col("_active")).alias("kits_inactivos_asesor"),
        )
    )


def resolve_seller(rows: DataFrame, asesor: DataFrame) -> DataFrame:
    """Seller key: the direct seller's when there is one, else the retail seller's.

    Each row lacks at least one of the two ids; rows without the id are scattered.
    """
    spread_by = list(rows.columns)
    for channel, source, name in (
        (rules.DIRECT, "vendedor_id", "_direct"),
        (rules.RETAIL, "asesor_pdv_id", "_retail"),
    ):
        role = asesor.filter(F.col("tipo_canal") == channel).select(
            F.col("origen_id").cast("long").alias(source), F.col("dases_id").alias(name)
        )
        rows = left_join_unique(rows, role, source, spread_by)
    return rows.withColumn("dases_id", F.coalesce("_direct", "_retail"))


def fact_desempeno(
    ventas: DataFrame,
    activaciones: DataFrame,
    metas: DataFrame,
    tiempo: DataFrame,
    oficina: DataFrame,
    asesor: DataFrame,
) -> DataFrame:
    """Several goals for one office and month repeat the row, as the goals are joined as they are."""
    return desempeno_of_months(seller_months(ventas, activaciones), metas, tiempo, oficina, asesor)


def desempeno_of_months(
    months: DataFrame, metas: DataFrame, tiempo: DataFrame, oficina: DataFrame, asesor: DataFrame
) -> DataFrame:
    """The performance fact of `seller_months`, however these were made."""
    goals = metas.select("oficina_id", "anio", "mes_num", "meta_kits")
    rows = months.join(goals, ["oficina_id", "anio", "mes_num"], "left")
    rows = rows.withColumn("meta_kits_mes", F.coalesce("meta_kits", F.lit(0)))
    rows = lookup(rows, tiempo.select("dtiem_id"), date_key(F.col("fecha_mes")) == F.col("dtiem_id"))
    offices = oficina.select("dofic_id", F.col("oficina_id").alias("_of"))
    rows = lookup(rows, offices, F.col("oficina_id") == F.col("_of"))
    rows = resolve_seller(rows, asesor)
    return rows.select(
        "dtiem_id",
        "dofic_id",
        "dases_id",
        *KITS,
        "meta_kits_mes",
        percent(F.col("kits_activos_asesor"), F.col("meta_kits_mes")).alias("cumplimiento_meta_pct"),
        percent(F.col("kits_inactivos_asesor"), F.col("kits_por_asesor")).alias("kits_inactivos_pct"),
    )


def fact_metas_pedidos(recepciones: DataFrame, metas: DataFrame) -> DataFrame:
    """Kits received and activation goal per month and office."""
    received = recepciones.groupBy(
        month_start(F.col("fecha_recepcion")).alias("fecha_mes"), "oficina_id"
    ).agg(F.count("*").alias("kits_recibidos"))
    goals = metas.groupBy("fecha_mes", "oficina_id").agg(F.sum("meta_kits").alias("meta_activacion"))
    both = received.join(goals, ["fecha_mes", "oficina_id"], "full")
    return both.select(
        "fecha_mes",
        "oficina_id",
        F.coalesce("kits_recibidos", F.lit(0)).alias("kits_recibidos"),
        F.coalesce("meta_activacion", F.lit(0)).alias("meta_activacion"),
    )
