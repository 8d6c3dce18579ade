"""Measures, KPIs, report pages and checks."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions.dates import day_gap, days_since
from ..functions.numeric import percent
from ..plans import histograms, kpis, layered, measures, quality, reports
from ..session import scratch_path
from ..sources.sinks import as_table, model_path, resolve_schema
from ..sources.versions import published
from .oracle import pct, ratio
from .registry import query
from .shaping import AS_OF


def sales_of(m):
    cube = measures.sales_cube(m.stg("ventas"), m.stg("activaciones"))
    return measures.with_attributes(cube, "fecha_venta", m.stg("oficinas"))


def goals_of(m):
    m.land()
    goals = measures.goals_table(m.stg("recepciones"), m.stg("metas"))
    return measures.with_attributes(goals, "fecha_mes", m.stg("oficinas"))


def _register(key: str, names: list[str], by: list[str], sql: str) -> None:
    needs_goals = any(
        n in measures.GOAL_MEASURES
        for name in names
        for n in (measures.DERIVED[name][0] if name in measures.DERIVED else [name])
    )
    query(key, sql)(
        lambda m: measures.measure(
            sales_of(m.land() if needs_goals else m), goals_of(m) if needs_goals else None, names, by
        )
    )


def _both(by: str, cols: str) -> str:
    """Sales and goals summed apart per group, joined on it."""
    keys = by.split(", ")
    on = " and ".join(f"s.{k} is not distinct from g.{k}" for k in keys)
    pick = ", ".join(f"coalesce(s.{k}, g.{k}) as {k}" for k in keys)
    return (
        f"with s as (select {by}, sum(kits)::bigint as kits, sum(activos)::bigint as activos, sum(ingresos)::decimal(38,2) as ingresos, "
        f"sum(kits) filter (canal_venta = 'DIRECTO')::bigint as asesor, sum(kits) filter (canal_venta = 'PDV')::bigint as pdv from sales group by {by}), "
        f"g as (select {by}, sum(kits_recibidos)::bigint as pedidos, sum(meta_activacion)::bigint as meta from goals group by {by}), "
        f"b as (select {pick}, ifnull(kits, 0) as kits, ifnull(activos, 0) as activos, ifnull(ingresos, 0)::decimal(38,2) as ingresos, ifnull(asesor, 0) as asesor, ifnull(pdv, 0) as pdv, ifnull(pedidos, 0) as pedidos, ifnull(meta, 0) as meta from s full join g on {on}) "
        f"select {by}, {cols} from b"
    )


def _sales_sql(by: str, cols: str) -> str:
    return f"select {by}, {cols} from sales group by {by}"


LIGHT = "case when {r} >= 1 then 'Meta Cumplida' when {r} >= 0.8 then 'En Riesgo' else 'Critico' end"

_register("m1_total_ordered", ["total_pedidos"], ["oficina_id", "anio"], "select oficina_id, anio, sum(kits_recibidos)::bigint as total_pedidos from goals group by 1, 2")
_register("m2_total_sold", ["total_vendidos"], ["region", "anio", "mes"], _sales_sql("region, anio, mes", "sum(kits)::bigint as total_vendidos"))
_register("m3_current_stock", ["stock_actual"], ["oficina_id"], _both("oficina_id", "pedidos - kits as stock_actual"))
_register("m4_advisor_sales", ["ventas_asesor"], ["nom_oficina"], _sales_sql("nom_oficina", "ifnull(sum(kits) filter (canal_venta = 'DIRECTO'), 0)::bigint as ventas_asesor"))
_register("m5_retail_sales", ["ventas_pdv"], ["nom_oficina"], _sales_sql("nom_oficina", "ifnull(sum(kits) filter (canal_venta = 'PDV'), 0)::bigint as ventas_pdv"))
_register("m6_activations", ["activaciones"], ["zona", "anio"], _sales_sql("zona, anio", "sum(activos)::bigint as activaciones"))
_register("m7_activation_rate", ["tasa_activacion"], ["oficina_id", "fecha_mes"], _sales_sql("oficina_id, fecha_mes", f"{ratio('sum(activos)', 'sum(kits)')} as tasa_activacion"))
_register("m8_goal_gap", ["brecha_meta"], ["oficina_id", "fecha_mes"], _both("oficina_id, fecha_mes", "greatest(meta - activos, 0) as brecha_meta"))
_register("m9_goal_light", ["semaforo"], ["oficina_id", "fecha_mes"], _both("oficina_id, fecha_mes", LIGHT.format(r=ratio("activos", "meta")) + " as semaforo"))
_register("m10_total_income", ["ingresos"], ["departamento"], _sales_sql("departamento", "sum(ingresos)::decimal(38,2) as ingresos"))
_register("m11_average_ticket", ["ticket_promedio"], ["canal_venta"], _sales_sql("canal_venta", f"{ratio('sum(ingresos)', 'sum(kits)')} as ticket_promedio"))
_register("m12_goal_attainment", ["cumplimiento_meta"], ["oficina_id", "anio"], _both("oficina_id, anio", f"{ratio('kits', 'meta')} as cumplimiento_meta"))


@query("m13_office_contribution", f"select oficina_id, ingresos, {ratio('ingresos', 'todo')} as contribucion from (select oficina_id, sum(ingresos)::decimal(38,2) as ingresos, sum(sum(ingresos)) over () as todo from sales group by 1)")
def m13(m):
    return measures.office_contribution(sales_of(m), []).withColumn("ingresos", F.col("ingresos").cast("decimal(38,2)"))


_register(
    "e2_reusable_measures",
    ["total_vendidos", "activaciones", "tasa_activacion", "ingresos", "ticket_promedio"],
    ["region"],
    _sales_sql("region", f"sum(kits)::bigint as total_vendidos, sum(activos)::bigint as activaciones, {ratio('sum(activos)', 'sum(kits)')} as tasa_activacion, sum(ingresos)::decimal(38,2) as ingresos, {ratio('sum(ingresos)', 'sum(kits)')} as ticket_promedio"),
)


@query(
    "e1_schema_override",
    "select 'marts' as esquema, oficina_id, count(*) as filas from ventas group by all union all select 'staging', oficina_id, count(*) from recepciones group by all",
)
def e1(m):
    """Two models stored below their schema, one with a name of its own; rows as read back from there."""
    root = scratch_path(m.land().spark, "schemas")
    parts = []
    for custom, model in ((" marts ", "ventas"), (None, "recepciones")):
        schema = resolve_schema(custom, "staging")
        as_table(m.raw(model), model_path(root, schema, model))
        rows = published(m.spark, f"{root}/{schema}/{model}").groupBy("oficina_id").agg(F.count("*").alias("filas"))
        parts.append(rows.select(F.lit(schema).alias("esquema"), "oficina_id", "filas"))
    return parts[0].unionByName(parts[1])


# ---- KPIs -------------------------------------------------------------------------

_K1 = f"select oficina_id, fecha_mes, ifnull(a, 0) as kits_activos, ifnull(kits_recibidos, 0) as kits_recibidos, {pct('ifnull(a, 0)', 'ifnull(kits_recibidos, 0)')} as tasa_activacion_pct from (select oficina_id, fecha_mes, sum(activos)::bigint as a from sales group by 1, 2) full join fact_metas_pedidos using (oficina_id, fecha_mes)"


def _k1(m):
    return kpis.activation_of_received(sales_of(m.land()), m.fact_metas_pedidos)


query("k1_activation_of_received", _K1)(_k1)
query("k2_monthly_income", "select oficina_id, fecha_mes, sum(ingresos)::decimal(38,2) as ingresos from sales group by 1, 2")(
    lambda m: kpis.monthly_income(sales_of(m))
)
_K3 = f"select oficina_id, ingresos, {pct('ingresos * 100', 'todo * 100')} as contribucion_pct from (select oficina_id, sum(ingresos)::decimal(38,2) as ingresos, sum(sum(ingresos)) over () as todo from sales group by 1)"
query("k3_contribution", _K3)(lambda m: kpis.contribution(sales_of(m)))
_AGE = f"date_diff('day', fecha_recepcion, date '{AS_OF}')"
_K4 = f"select oficina_id, count(*) filter ({_AGE} > 90 and estado_recepcion <> 'VENDIDO') as kits_riesgo, count(*) as kits, {pct(f'count(*) filter ({_AGE} > 90 and estado_recepcion <> $$VENDIDO$$)', 'count(*)')} as riesgo_pct from recepciones group by 1"
query("k4_kits_at_risk", _K4)(lambda m: kpis.kits_at_risk(m.raw("recepciones"), AS_OF, ["oficina_id"]))
_K5 = f"select oficina_id, avg({_AGE}) as dias_inactivo_prom from recepciones where estado_recepcion <> 'VENDIDO' group by 1"
query("k5_mean_idle_days", _K5)(lambda m: kpis.mean_idle_days(m.raw("recepciones"), AS_OF, ["oficina_id"]))


def _points(days: str, levels: str) -> str:
    n = levels.count(",") + 1
    return f"{levels}, count(*) as kits, avg({days}) as dias_promedio, quantile_cont({days}, 0.5) as dias_mediana, quantile_cont({days}, 0.9) as dias_p90, ({n} - bit_count(grouping({levels})))::integer as nivel"


@query(
    "k5_idle_day_drill",
    f"select {_points('edad', 'region, departamento, nom_oficina')} from (select region, departamento, nom_oficina, {_AGE} as edad from recepciones join oficinas using (oficina_id) where estado_recepcion <> 'VENDIDO') where edad is not null group by rollup (region, departamento, nom_oficina)",
)
def k5_drill(m):
    """Idle days of unsold kits at every level of the geography, from one histogram per office."""
    idle = m.raw("recepciones").filter(F.col("estado_recepcion") != kpis.SOLD)
    by_office = histograms.day_histogram(idle, [F.col("oficina_id")], days_since(F.col("fecha_recepcion"), AS_OF))
    places = m.raw("oficinas").select("oficina_id", "region", "departamento", "nom_oficina")
    return histograms.day_drill(by_office.join(places, "oficina_id"), ["region", "departamento", "nom_oficina"])


@query(
    "k6_rotation_day_drill",
    f"select {_points('dias', 'anio, mes, oficina_id')} from (select year(fecha_recepcion)::integer as anio, month(fecha_recepcion)::integer as mes, r.oficina_id, date_diff('day', fecha_recepcion, fecha_venta) as dias from recepciones r join (select recepcion_id, fecha_venta from enriched where es_activacion = 1) using (recepcion_id)) group by rollup (anio, mes, oficina_id)",
)
def k6_drill(m):
    """Days from receipt to sale of active kits by year, month and office; the months come as two loads."""
    joined = m.raw("recepciones").select("recepcion_id", "fecha_recepcion", "oficina_id").join(_active_sales(m), "recepcion_id")
    day = F.col("fecha_recepcion")
    by = [F.year(day).alias("anio"), F.month(day).alias("mes"), F.col("oficina_id")]
    gap = day_gap(F.col("fecha_venta"), day)
    loads = [histograms.day_histogram(joined.filter(part), by, gap, F.col("pesos")) for part in (F.col("recepcion_id") % 2 == 0, F.col("recepcion_id") % 2 != 0)]
    return histograms.day_drill(histograms.added(loads), ["anio", "mes", "oficina_id"])


def _active_sales(m):
    rows = layered.weighted_sales(m.stg("ventas"), m.stg("activaciones"))
    return rows.filter("_active > 0 and recepcion_id is not null").select(
        "recepcion_id", "fecha_venta", F.col("_active").alias("pesos")
    )


_K6 = "select date_trunc('month', fecha_recepcion)::date as fecha_mes, sum(date_diff('day', fecha_recepcion, fecha_venta))::double / count(*) as rotacion_prom from recepciones join (select recepcion_id, fecha_venta from enriched where es_activacion = 1) using (recepcion_id) group by 1"


def _k6(m):
    month = F.trunc("fecha_recepcion", "month").alias("fecha_mes")
    return kpis.lot_rotation(m.raw("recepciones").select("recepcion_id", "fecha_recepcion"), _active_sales(m), [month])


query("k6_lot_rotation_by_month", _K6)(_k6)
query("k6_lot_rotation_by_lot", "select lote_serie, sum(date_diff('day', fecha_recepcion, fecha_venta))::double / count(*) as rotacion_prom from recepciones join series using (producto_id) join (select recepcion_id, fecha_venta from enriched where es_activacion = 1) using (recepcion_id) group by 1")(
    lambda m: kpis.lot_rotation(
        m.raw("recepciones").join(
            m.stg("productos").filter(layered.has_serie(F.col("serie"))).select("producto_id", layered.clean_serie(F.col("serie")).alias("lote_serie")),
            "producto_id",
        ).select("recepcion_id", "fecha_recepcion", "lote_serie"),
        _active_sales(m),
        [F.col("lote_serie")],
    )
)
_K7 = f"select region, fecha_mes, ifnull(sum(kits) filter (canal_venta = 'DIRECTO'), 0)::bigint as kits_directo, ifnull(sum(kits) filter (canal_venta = 'PDV'), 0)::bigint as kits_pdv, sum(kits)::bigint as kits, {pct('ifnull(sum(kits) filter (canal_venta = $$PDV$$), 0)', 'sum(kits)')} as mix_pdv_pct, {pct('ifnull(sum(kits) filter (canal_venta = $$DIRECTO$$), 0)', 'sum(kits)')} as mix_directo_pct from sales group by 1, 2"
query("k7_channel_mix", _K7)(lambda m: kpis.channel_mix(sales_of(m), ["region", "fecha_mes"]))
_K8 = f"select oficina_id, fecha_mes, a as kits_activos, ifnull(meta_activacion, 0) as meta, {pct('a', 'meta_activacion')} as cumplimiento_meta_pct from (select oficina_id, fecha_mes, sum(activos)::bigint as a from sales group by 1, 2) left join goal_months using (oficina_id, fecha_mes)"
query("k8_goal_attainment", _K8)(lambda m: kpis.goal_attainment(sales_of(m.land()), m.fact_metas_pedidos))
query("k9_seller_kits", f"select vendedor_id, asesor_pdv_id, sum(kits_por_asesor)::bigint as kits, sum(kits_inactivos_asesor)::bigint as kits_inactivos, {pct('sum(kits_inactivos_asesor)', 'sum(kits_por_asesor)')} as inactivos_pct from seller_months group by 1, 2")(
    lambda m: kpis.seller_kits(layered.seller_months(m.stg("ventas"), m.stg("activaciones")))
)


def _band_sql(inner: str, keys: str, value: str, cases: str) -> str:
    return f"select {keys}, {value}, case when {value} is null then null {cases} end as banda from ({inner})"


query("k10_activation_band", _band_sql(_K1, "oficina_id, fecha_mes", "tasa_activacion_pct", "when tasa_activacion_pct < 80 then 'bajo' when tasa_activacion_pct < 90 then 'esperado' else 'alto'"))(
    lambda m: _k1(m).select("oficina_id", "fecha_mes", "tasa_activacion_pct", kpis.band("tasa_activacion", F.col("tasa_activacion_pct")).alias("banda"))
)
query("k10_contribution_band", _band_sql(_K3, "oficina_id", "contribucion_pct", "when contribucion_pct < 5 then 'bajo' when contribucion_pct <= 15 then 'esperado' else 'alto'"))(
    lambda m: kpis.contribution(sales_of(m)).select("oficina_id", "contribucion_pct", kpis.band("contribucion", F.col("contribucion_pct")).alias("banda"))
)
query("k10_risk_band", _band_sql(_K4, "oficina_id", "riesgo_pct", "when riesgo_pct > 15 then 'bajo' when riesgo_pct >= 5 then 'esperado' else 'alto'"))(
    lambda m: kpis.kits_at_risk(m.raw("recepciones"), AS_OF, ["oficina_id"]).select("oficina_id", "riesgo_pct", kpis.band("riesgo_pct", F.col("riesgo_pct")).alias("banda"))
)
query("k10_idle_band", _band_sql(_K5, "oficina_id", "dias_inactivo_prom", "when dias_inactivo_prom > 60 then 'bajo' when dias_inactivo_prom >= 30 then 'esperado' else 'alto'"))(
    lambda m: kpis.mean_idle_days(m.raw("recepciones"), AS_OF, ["oficina_id"]).select("oficina_id", "dias_inactivo_prom", kpis.band("dias_inactivo", F.col("dias_inactivo_prom")).alias("banda"))
)
query("k10_rotation_band", _band_sql(_K6, "fecha_mes", "rotacion_prom", "when rotacion_prom > 45 then 'bajo' when rotacion_prom >= 30 then 'esperado' else 'alto'"))(
    lambda m: _k6(m).select("fecha_mes", "rotacion_prom", kpis.band("rotacion", F.col("rotacion_prom")).alias("banda"))
)
query("k10_mix_band", f"select region, fecha_mes, case when greatest(mix_pdv_pct, mix_directo_pct) > 90 then 'critico' else 'esperado' end as banda from ({_K7})")(
    lambda m: kpis.channel_mix(sales_of(m), ["region", "fecha_mes"]).select("region", "fecha_mes", kpis.band("canal_unico", F.greatest("mix_pdv_pct", "mix_directo_pct")).alias("banda"))
)
query("k10_goal_band", _band_sql(_K8, "oficina_id, fecha_mes", "cumplimiento_meta_pct", "when cumplimiento_meta_pct < 80 then 'bajo' when cumplimiento_meta_pct < 100 then 'esperado' else 'alto'"))(
    lambda m: kpis.goal_attainment(sales_of(m.land()), m.fact_metas_pedidos).select("oficina_id", "fecha_mes", "cumplimiento_meta_pct", kpis.band("cumplimiento_meta", F.col("cumplimiento_meta_pct")).alias("banda"))
)


@query("k10_income_band", _band_sql(f"select oficina_id, {pct('sum(monto_calculado) * 100', 'sum(monto_original) * 100')} as logro_pct from enriched group by 1", "oficina_id", "logro_pct", "when logro_pct < 80 then 'bajo' when logro_pct < 100 then 'esperado' else 'alto'"))
def k10_income(m):
    """Income against a budget; the recorded amounts stand in for the budget."""
    sums = m.enriched.groupBy("oficina_id").agg(
        percent(F.sum("monto_calculado") * 100, F.sum("monto_original") * 100).alias("logro_pct")
    )
    return sums.withColumn("banda", kpis.band("ingresos_presupuesto", F.col("logro_pct")))


# ---- checks -----------------------------------------------------------------------


@query("q1_unique", "select venta_id, count(*) as n from fact_ventas group by 1 having count(*) > 1")
def q1(m):
    return quality.duplicates(m.fact_ventas, "venta_id")


@query("q2_not_null", "select venta_id, serie from fact_ventas where dest_id is null")
def q2(m):
    return quality.missing(m.fact_ventas, "dest_id").select("venta_id", "serie")


@query("q3_relationships", "select venta_id, oficina_id from ventas where oficina_id not in (select oficina_id from oficinas where region <> 'ASIA')")
def q3(m):
    """Sales whose office is missing from an incomplete office list."""
    offices = m.raw("oficinas").filter("region <> 'ASIA'")
    return quality.orphans(m.raw("ventas"), "oficina_id", offices, "oficina_id").select("venta_id", "oficina_id")


@query(
    "q5_amount_reconciliation",
    "select fecha_mes, a::decimal(22,2) as monto_a, b::decimal(22,2) as monto_b, (a - b)::decimal(23,2) as diferencia, a = b as cuadra from (select date_trunc('month', fecha_venta)::date as fecha_mes, sum(monto_calculado) as a from stg_ventas group by 1) join (select date_trunc('month', fecha_venta)::date as fecha_mes, sum(monto_calculado) as b from enriched group by 1) using (fecha_mes)",
)
def q5(m):
    """Sales once per sale against the fanned-out fact: months with repeats do not agree."""
    month = F.trunc("fecha_venta", "month").alias("fecha_mes")
    left = m.stg("ventas").select(month, "monto_calculado")
    right = m.enriched.select(month, "monto_calculado")
    report = quality.reconcile_amounts(left, right, ["fecha_mes"], "monto_calculado")
    return report.select(
        "fecha_mes",
        F.col("monto_a").cast("decimal(22,2)").alias("monto_a"),
        F.col("monto_b").cast("decimal(22,2)").alias("monto_b"),
        F.col("diferencia").cast("decimal(23,2)").alias("diferencia"),
        "cuadra",
    )


_ORACLE_MODEL = {"stg_oficinas": "oficinas", "stg_productos": "productos"}


def _checks_sql() -> str:
    parts = []
    for model, (unique, present) in quality.CHECKS.items():
        table = _ORACLE_MODEL.get(model, model)
        for c in unique:
            parts.append(f"select '{model}' as model, 'unique' as test, '{c}' as \"column\", count(*) as failures from (select {c} from {table} where {c} is not null group by 1 having count(*) > 1)")
        for c in present:
            parts.append(f"select '{model}' as model, 'not_null' as test, '{c}' as \"column\", count(*) as failures from {table} where {c} is null")
    return " union all ".join(parts)


@query("q6_run_all_checks", _checks_sql())
def q6(m):
    """One pass over each model, reading the checked columns only."""
    m.land()
    models = {}
    for name in quality.CHECKS:
        df = m.stg(name.removeprefix("stg_")) if name.startswith("stg_") else getattr(m, name)
        models[name] = df.select(*quality.checked_columns(name))
    return quality.run_checks(models)


# ---- report pages -------------------------------------------------------------------

query("x13_comparison_matrix", _both("nom_oficina", "asesor as ventas_asesor, pdv as ventas_pdv, activos as activaciones, meta, " + LIGHT.format(r=ratio("activos", "meta")) + " as semaforo"))(
    lambda m: reports.comparison_matrix(sales_of(m.land()), goals_of(m))
)
query(
    "x14_region_sellers",
    "select region, dases_id, tipo_canal, nom_cliente_pdv, sum(kits_por_asesor)::bigint as kits, sum(kits_activos_asesor)::bigint as kits_activos from sold_by join oficinas using (oficina_id) join dim_asesor_pdv using (dases_id) group by all",
)(
    lambda m: reports.region_sellers(layered.seller_months(m.stg("ventas"), m.stg("activaciones")), m.stg("oficinas"), m.dim_asesor_pdv)
)
query("x15_annual", "select anio, sum(kits)::bigint as kits, sum(ingresos)::decimal(38,2) as ingresos from sales group by 1")(
    lambda m: reports.yearly(sales_of(m), ["anio"])
)
query("x15_year_month", "select anio, mes, sum(kits)::bigint as kits, sum(ingresos)::decimal(38,2) as ingresos from sales group by 1, 2")(
    lambda m: reports.yearly(sales_of(m), ["anio", "mes"])
)
_register("x16_income_by_channel", ["ingresos", "activaciones"], ["canal_venta"], _sales_sql("canal_venta", "sum(ingresos)::decimal(38,2) as ingresos, sum(activos)::bigint as activaciones"))
_register("x16_income_by_office", ["ingresos", "activaciones"], ["nom_oficina"], _sales_sql("nom_oficina", "sum(ingresos)::decimal(38,2) as ingresos, sum(activos)::bigint as activaciones"))
_register("x16_activation_calendar", ["activaciones", "tasa_activacion"], ["anio", "trimestre", "mes", "dia"], _sales_sql("anio, trimestre, mes, dia", f"sum(activos)::bigint as activaciones, {ratio('sum(activos)', 'sum(kits)')} as tasa_activacion"))
_register("x16_goal_and_rate", ["meta", "tasa_activacion"], ["nom_oficina"], _both("nom_oficina", f"meta, {ratio('activos', 'kits')} as tasa_activacion"))
query("x16_risk_by_office", "select oficina_id, nom_oficina, region, count(*) as kits_riesgo from stg_recepciones join oficinas using (oficina_id) where flag_riesgo_90d group by all")(
    lambda m: reports.risk_by_office(m.stg("recepciones"), m.stg("oficinas"))
)
query(
    "x16_risk_detail",
    r"select recepcion_id, serie, regexp_replace(upper(serie), '\s+', '', 'g') as lote_serie, year(fecha_recepcion)::integer as anio, month(fecha_recepcion)::integer as mes, dias_inactivo from stg_recepciones left join productos using (producto_id) where flag_riesgo_90d",
)(lambda m: reports.risk_detail(m.stg("recepciones"), m.stg("productos")))

