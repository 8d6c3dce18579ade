"""Aggregations, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..operators.compare import infer
from ..operators.compare.order import order_changed, with_context
from ..operators.compare.rows import diff_summary, equality_report, row_diff
from ..operators.numbering import keep_best, number_rows
from ..operators.shares import share_of_total
from ..plans import layered, measures, reports, scripted
from ..plans.quality import reconcile_counts
from ..session import scratch_path
from ..sources.schemas import RAW_SCHEMAS
from ..sources.sinks import snapshot_copy
from .changes import ORDER_VERSIONS_SQL, diff_pair, order_versions
from .oracle import money_pct, month_of, pct, ratio
from .registry import query


@query("a1_sum_by_key", "select oficina_id, sum(monto_calculado)::decimal(22,2) as ingresos from enriched group by 1")
def a1(m):
    return m.enriched.groupBy("oficina_id").agg(F.sum("monto_calculado").alias("ingresos"))


@query("a2_global_sum", "select sum(monto_calculado)::decimal(22,2) as ingresos_total from enriched")
def a2(m):
    return m.enriched.agg(F.sum("monto_calculado").alias("ingresos_total"))


@query("a3_channel_pivot", "select * from canal_mes")
def a3(m):
    """Fixed pivot values, so no extra pass looks for them; other channels count in the total."""
    rows = layered.weighted_sales(m.stg("ventas"), m.stg("activaciones"))
    n, channel = F.col("_rows"), F.col("canal_venta")
    income = n * F.col("monto_calculado")
    pick = lambda name, v: F.sum(F.when(channel == name, v).otherwise(0))
    return rows.groupBy(F.trunc("fecha_venta", "month").alias("fecha_mes"), "oficina_id").agg(
        pick("DIRECTO", n).alias("kits_canal_directo"),
        pick("PDV", n).alias("kits_canal_pdv"),
        pick("DIRECTO", income).cast("decimal(22,2)").alias("ingresos_directo"),
        pick("PDV", income).cast("decimal(22,2)").alias("ingresos_pdv"),
        F.sum(n).alias("total_kits"),
    )


@query("a4_count_per_group", "select fecha_mes, oficina_id, vendedor_id, asesor_pdv_id, kits_por_asesor from seller_months")
def a4(m):
    rows = layered.seller_months(m.stg("ventas"), m.stg("activaciones"))
    return rows.select("fecha_mes", "oficina_id", "vendedor_id", "asesor_pdv_id", "kits_por_asesor")


@query("a5_complement_sum", "select oficina_id, sum(1 - es_activacion)::bigint as inactivos from enriched group by 1")
def a5(m):
    return m.enriched.groupBy("oficina_id").agg(F.sum(1 - F.col("es_activacion")).alias("inactivos"))


@query("a6_share_of_total", f"select oficina_id, ing::decimal(22,2) as monto_calculado_total, {money_pct('ing', 'todo')} as contribucion_pct from office_income")
def a6(m):
    return share_of_total(m.enriched, ["oficina_id"], "monto_calculado", "contribucion_pct")


@query("a7_mix_percent", f"select fecha_mes, oficina_id, {pct('kits_canal_pdv', 'total_kits')} as mix_canal_pct from canal_mes")
def a7(m):
    pdv = F.count_if(F.col("canal_venta") == "PDV")
    return m.enriched.groupBy(F.trunc("fecha_venta", "month").alias("fecha_mes"), "oficina_id").agg(
        percent(pdv, F.count("*")).alias("mix_canal_pct")
    )


@query("a8_goal_percent", f"select fecha_mes, oficina_id, {pct('sum(kits_activos_asesor)', 'any_value(meta)')} as cumplimiento_pct from seller_months left join goal_sums using (oficina_id, anio, mes_num) group by 1, 2")
def a8(m):
    months = layered.seller_months(m.stg("ventas"), m.stg("activaciones"))
    active = months.groupBy("fecha_mes", "anio", "mes_num", "oficina_id").agg(F.sum("kits_activos_asesor").alias("n"))
    rows = active.join(scripted.summed_goals(m.raw("metas")), ["oficina_id", "anio", "mes_num"], "left")
    return rows.select("fecha_mes", "oficina_id", percent(F.col("n"), F.col("_goal")).alias("cumplimiento_pct"))


@query("a9_inactive_percent", f"select oficina_id, {pct('sum(1 - es_activacion)', 'count(*)')} as inactivos_pct from enriched group by 1")
def a9(m):
    inactive = F.sum(1 - F.col("es_activacion"))
    return m.enriched.groupBy("oficina_id").agg(percent(inactive, F.count("*")).alias("inactivos_pct"))


@query("a10_group_by_expressions", f"select year(fecha_venta)::integer as anio, month(fecha_venta)::integer as mes, oficina_id, min({month_of('fecha_venta')}) as fecha_mes, count(*) as kits from ventas group by 1, 2, 3")
def a10(m):
    """The month start follows from the keys, so any row of the group gives it."""
    return m.raw("ventas").groupBy(F.year("fecha_venta").alias("anio"), F.month("fecha_venta").alias("mes"), "oficina_id").agg(
        F.any_value(F.trunc("fecha_venta", "month")).alias("fecha_mes"), F.count("*").alias("kits")
    )


@query("a11_group_by_month", f"select {month_of('fecha_venta')} as fecha_mes, count(*) as kits from ventas group by 1")
def a11(m):
    return m.raw("ventas").groupBy(F.trunc("fecha_venta", "month").alias("fecha_mes")).agg(F.count("*").alias("kits"))


@query("a12_distinct_tuples", "select distinct estado_recepcion, dias_inactivo, serie from recepciones left join productos using (producto_id)")
def a12(m):
    series = m.raw("productos").select("producto_id", "serie")
    rows = layered.left_join_unique(m.raw("recepciones"), series, "producto_id", ["recepcion_id"])
    return rows.select("estado_recepcion", "dias_inactivo", "serie").distinct()


@query("a13_goal_sums", "select * from goal_sums")
def a13(m):
    return scripted.summed_goals(m.raw("metas")).withColumnRenamed("_goal", "meta")


@query("a14_month_number_revenue", "select month(fecha_venta)::integer as mes, sum(monto_calculado)::decimal(22,2) as total_ingresos from enriched group by 1")
def a14(m):
    return m.enriched.groupBy(F.month("fecha_venta").alias("mes")).agg(F.sum("monto_calculado").alias("total_ingresos"))


@query("a15_row_count", "select count(*) as filas from ventas")
def a15(m):
    return m.raw("ventas").agg(F.count("*").alias("filas"))


def _sales(m):
    cube = measures.sales_cube(m.stg("ventas"), m.stg("activaciones"))
    return measures.with_attributes(cube, "fecha_venta", m.stg("oficinas"))


@query(
    "a16_geography_drill",
    "select region, departamento, zona, nom_oficina, sum(kits)::bigint as kits, sum(ingresos)::decimal(38,2) as ingresos, "
    "(4 - bit_count(grouping(region, departamento, zona, nom_oficina)))::integer as nivel from sales group by rollup (region, departamento, zona, nom_oficina)",
)
def a16(m):
    return reports.geography_drill(_sales(m))


@query(
    "a16_calendar_drill",
    f"select anio, trimestre, mes, fecha_venta, sum(kits)::bigint as kits, sum(activos)::bigint as activos, "
    f"(4 - bit_count(grouping(anio, trimestre, mes, fecha_venta)))::integer as nivel, {ratio('sum(activos)', 'sum(kits)')} as tasa from sales group by rollup (anio, trimestre, mes, fecha_venta)",
)
def a16_calendar(m):
    return reports.calendar_drill(_sales(m))


@query(
    "a16_seller_drill",
    "select tipo_canal, nom_cliente_pdv, sum(kits_por_asesor)::bigint as kits, (2 - bit_count(grouping(tipo_canal, nom_cliente_pdv)))::integer as nivel from sold_by join dim_asesor_pdv using (dases_id) group by rollup (tipo_canal, nom_cliente_pdv)",
)
def a16_sellers(m):
    return reports.seller_drill(layered.seller_months(m.stg("ventas"), m.stg("activaciones")), m.dim_asesor_pdv)


@query(
    "a16_state_drill",
    "select flag_riesgo_90d, estado, count(*) as series, (2 - bit_count(grouping(flag_riesgo_90d, estado)))::integer as nivel from dim_estado group by rollup (flag_riesgo_90d, estado)",
)
def a16_states(m):
    return reports.state_drill(m.dim_estado)


_DISTINCT = " union all ".join(
    f"select '{c}' as \"column\", (select count(distinct {c}) + max(({c} is null)::integer) from diff_a) + (select count(distinct {c}) + max(({c} is null)::integer) from diff_b) as distinct_values"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
)


@query("a17_column_distinct", f'select "column", distinct_values::bigint as distinct_values from ({_DISTINCT})')
def a17(m):
    a, b = diff_pair(m)
    return infer.distinct_counts(a, b, a.columns).select("column", "distinct_values")


@query(
    "a18_top_key_frequency",
    "select max(n) as mayor from (select count(*) as n from diff_a group by c_nationkey, c_mktsegment union all select count(*) from diff_b group by c_nationkey, c_mktsegment)",
)
def a18(m):
    a, b = diff_pair(m)
    key = ["c_nationkey", "c_mktsegment"]
    counts = infer.key_frequency(a, key).unionByName(infer.key_frequency(b, key))
    return counts.agg(F.max("n").alias("mayor"))


_MATCH = "select a.c_custkey as k, b.c_custkey as q, a.c_name is distinct from b.c_name as d1, a.c_nationkey is distinct from b.c_nationkey as d2, a.c_acctbal is distinct from b.c_acctbal as d3, a.c_mktsegment is distinct from b.c_mktsegment as d4 from diff_a a full join diff_b b on a.c_custkey = b.c_custkey"


@query(
    "a19_change_summary",
    "select count(*) filter (k is null) as row_inserts, count(*) filter (q is null) as row_deletes, count(*) filter (k is not null and q is not null and (d1 or d2 or d3 or d4)) as row_updates, "
    "count(k) as row_count_initial, count(q) as row_count_final, "
    "(max((d1 and k is not null and q is not null)::integer) + max((d2 and k is not null and q is not null)::integer) + max((d3 and k is not null and q is not null)::integer) + max((d4 and k is not null and q is not null)::integer))::bigint as col_updates, "
    f"0::bigint as col_inserts, 0::bigint as col_deletes, 0::bigint as col_renames, true as different from ({_MATCH})",
)
def a19(m):
    return diff_summary(*diff_pair(m), ["c_custkey"], unique_keys=True)


# ---- windows --------------------------------------------------------------------


@query("w1_global_numbering", "select row_number() over (order by monto_venta desc, venta_id) as puesto, venta_id, monto_venta from ventas")
def w1(m):
    """Range-partitioned numbering of the whole sales table."""
    rows = m.raw("ventas").select("venta_id", "monto_venta")
    return number_rows(rows, [F.desc_nulls_first("monto_venta"), F.asc("venta_id")], "puesto")


@query("w1_office_numbering", "select dofic_id, oficina_id from dim_oficina")
def w1_offices(m):
    return m.dim_oficina.select("dofic_id", "oficina_id")


@query("w2_keep_best", "select estado, dias_desde_recepcion, flag_riesgo_90d, lote_serie from master_states")
def w2(m):
    return layered.master_states(layered.clean_states(m.stg("recepciones"), m.stg("productos")))


@query(
    "w4_share_against_all",
    f"select anio, oficina_id, ingresos, {ratio('ingresos', 'todo')} as contribucion from (select anio, oficina_id, sum(ingresos)::decimal(38,2) as ingresos, sum(sum(ingresos)) over (partition by anio) as todo from sales group by 1, 2)",
)
def w4(m):
    return measures.office_contribution(_sales(m), ["anio"])


_CTX = (
    "with filas as (select row_number() over (order by fecha_venta, venta_id) as posicion, venta_id, canal_venta = 'ONLINE' as cambio from ventas), "
    "kept as (select posicion, venta_id, if(cambio, 'cambio', 'contexto') as papel from (select *, max(cambio::integer) over (order by posicion rows between 1 preceding and 1 following) as cerca from filas) where cerca = 1) "
    "select * from kept union all select posicion, null, '...' from filas f where not exists (select 1 from kept k where k.posicion = f.posicion) "
    "and (exists (select 1 from kept k where k.posicion = f.posicion + 1) or posicion = (select max(posicion) from filas))"
)


@query("w5_context_rows", _CTX)
def w5(m):
    rows = m.raw("ventas").select("venta_id", "fecha_venta", "canal_venta")
    order = [F.asc("fecha_venta"), F.asc("venta_id")]
    shown = with_context(rows, order, F.col("canal_venta") == "ONLINE", 1)
    return shown.select("posicion", "venta_id", "papel")


@query(
    "w6_order_changed",
    "select recepcion_id, ifnull(max(nueva) over (order by recepcion_id rows between unbounded preceding and 1 preceding) > nueva, false) as movida from (select recepcion_id, if(recepcion_id % 10 = 3, recepcion_id - 25, recepcion_id) as nueva from recepciones)",
)
def w6(m):
    rows = m.raw("recepciones").select(
        "recepcion_id",
        F.when(F.col("recepcion_id") % 10 == 3, F.col("recepcion_id") - 25).otherwise(F.col("recepcion_id")).alias("nueva"),
    )
    return order_changed(rows, "recepcion_id", "nueva", bucket_rows=10_000).select("recepcion_id", "movida")


# ---- ordering and limits ----------------------------------------------------------


@query(
    "o1_null_placement",
    "select row_number() over (order by dias_inactivo nulls last, recepcion_id) as asc_ultimo, row_number() over (order by dias_inactivo desc nulls first, recepcion_id) as desc_primero, recepcion_id from recepciones",
)
def o1(m):
    rows = m.raw("recepciones").select("recepcion_id", "dias_inactivo")
    up = number_rows(rows, [F.asc_nulls_last("dias_inactivo"), F.asc("recepcion_id")], "asc_ultimo")
    down = number_rows(rows, [F.desc_nulls_first("dias_inactivo"), F.asc("recepcion_id")], "desc_primero")
    both = up.join(down.select("recepcion_id", "desc_primero"), "recepcion_id")
    return both.select("asc_ultimo", "desc_primero", "recepcion_id")


@query("o2_scalar_limit", "select oficina_id, anio, mes_num, meta from goal_sums where meta = (select max(meta) from goal_sums limit 1)")
def o2(m):
    """The aggregate has one row already, so no limit is needed."""
    goals = scripted.summed_goals(m.raw("metas")).withColumnRenamed("_goal", "meta")
    return goals.filter(F.col("meta") == goals.agg(F.max("meta")).scalar())


@query(
    "o3_diff_ordering",
    "select row_number() over (order by c_custkey) as puesto, c_custkey, action from (select ifnull(k, q) as c_custkey, case when k is null then '+++' when q is null then '---' else '->' end as action from "
    f"({_MATCH}) where k is null or q is null or d1 or d2 or d3 or d4)",
)
def o3(m):
    diff = row_diff(*diff_pair(m), ["c_custkey"], unique_keys=True).select("c_custkey", "action")
    return number_rows(diff, [F.asc("c_custkey"), F.asc("action")], "puesto")


_ORDER_COLUMNS = ["custkey", "status", "total", "day", "priority", "clerk", "ship"]
_ORDER_DISTINCT = " union all ".join(
    f"select {i} as puesto, '{c}' as \"column\", (select count(distinct {c}) + max(({c} is null)::integer) from ord_a) + (select count(distinct {c}) + max(({c} is null)::integer) from ord_b) as n"
    for i, c in enumerate(_ORDER_COLUMNS)
)


@query("o4_top_columns", f'{ORDER_VERSIONS_SQL} select "column", n::bigint as distinct_values from ({_ORDER_DISTINCT}) order by n desc, puesto limit 5')
def o4(m):
    """A top-k report: the five most distinct columns of two versions of the orders."""
    return infer.top_columns(*order_versions(m), _ORDER_COLUMNS)


# ---- set operations -----------------------------------------------------------------


@query("u1_union_sellers", "select origen_id, nom_cliente_pdv, tipo_canal, monto_asociado from sellers")
def u1(m):
    return layered.sellers(m.stg("vendedores"), m.stg("asesores"))


@query("u2_union_distinct_dates", "select fecha from fechas where fecha is not null")
def u2(m):
    return layered.dim_tiempo(m.stg("ventas"), m.stg("recepciones"), m.stg("metas")).select("fecha")


@query("u3_two_populations", "select dases_id, origen_id, nom_cliente_pdv, tipo_canal, monto_asociado from a_dim_asesor")
def u3(m):
    empty = scripted.empty_dim(m.spark, "dim_asesor_pdv")
    return scripted.dim_asesor_pdv(empty, m.raw("vendedores"), m.raw("asesores"))


@query(
    "u4_table_equality",
    "select (select count(*) from (select * from diff_a except all select * from diff_b))::bigint as solo_a, (select count(*) from (select * from diff_b except all select * from diff_a))::bigint as solo_b, false as iguales",
)
def u4(m):
    return equality_report(*diff_pair(m))


@query(
    "q4_row_reconciliation",
    " union all ".join(f"select '{t}' as tabla, count(*) as origen, count(*) as destino, true as cuadra from {t}" for t in RAW_SCHEMAS)
    + " union all select 'pedidos', (select count(*) from orders), count(*), (select count(*) from orders) = count(*) from ventas",
)
def q4(m):
    """Every raw table against its mirror, and orders against the sales made of them."""
    m.land()
    copies = snapshot_copy({n: m.raw(n) for n in RAW_SCHEMAS}, scratch_path(m.spark, "mirror"))
    pairs = {n: (m.raw(n), copy) for n, copy in copies.items()}
    return reconcile_counts(pairs | {"pedidos": (m.sources.base("orders"), m.raw("ventas"))})


@query("w2_latest_activation", "select venta_id, activacion_id from activaciones qualify row_number() over (partition by venta_id order by fecha_activacion desc, activacion_id) = 1")
def w2_activation(m):
    order = [F.desc_nulls_first("fecha_activacion"), F.asc("activacion_id")]
    return keep_best(m.raw("activaciones"), ["venta_id"], order).select("venta_id", "activacion_id")


