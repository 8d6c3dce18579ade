"""Projections, predicates and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import dates, numeric, rules, text
from ..functions.cells import CellRules, same_cell
from ..operators.compare.rows import row_diff
from ..operators.joins import lookup
from ..plans import scripted
from ..plans.layered import receipts_with_sale, resolve_seller, seller_months
from ..plans.staging import latest_sale_per_serie
from .changes import diff_pair
from .oracle import RISK, date_key, month_of, pct, ratio
from .registry import query

AS_OF = dt.date(1998, 12, 31)

# ---- projections ----------------------------------------------------------------

query("p1_pass_through", "select producto_id, serie, descripcion, precio_base, activo from productos")(
    lambda m: m.stg("productos")
)


@query(
    "p2_rename",
    "select vendedor_id as origen_id, nom_vendedor as nom_cliente_pdv from vendedores",
)
def rename(m):
    return m.raw("vendedores").select(
        F.col("vendedor_id").alias("origen_id"), F.col("nom_vendedor").alias("nom_cliente_pdv")
    )


@query("p3_channel_tariff", "select venta_id, canal_venta, monto_original, monto_calculado from stg_ventas")
def channel_tariff(m):
    return m.stg("ventas").select("venta_id", "canal_venta", "monto_original", "monto_calculado")


@query(
    "p4_channel_tariff_or_zero",
    "select venta_id, cast(case canal_venta when 'DIRECTO' then 220 when 'PDV' then 160 else 0 end as decimal(5,2)) as monto_ingreso from ventas",
)
def channel_tariff_or_zero(m):
    """The documents call the direct channel `Asesor`."""
    label = F.when(F.col("canal_venta") == rules.DIRECT, rules.ADVISOR).otherwise(F.col("canal_venta"))
    return m.raw("ventas").select("venta_id", rules.channel_amount_or_zero(label).alias("monto_ingreso"))


@query("p5_stock_risk_flag", f"select recepcion_id, estado_recepcion, {RISK} as en_riesgo, {RISK}::integer as riesgo_01 from recepciones")
def stock_risk_flag(m):
    risk = rules.stock_at_risk(F.col("dias_inactivo"), F.col("estado_recepcion"))
    return m.raw("recepciones").select(
        "recepcion_id", "estado_recepcion", risk.alias("en_riesgo"), numeric.flag(risk).alias("riesgo_01")
    )


@query("p6_late_sale_flag", "select venta_id, es_riesgo, dias_rotacion from vw_received")
def late_sale_flag(m):
    view = scripted.vw_ventas_received(m.raw("ventas"), m.raw("recepciones"), m.raw("activaciones"))
    return view.select("venta_id", "es_riesgo", "dias_rotacion")


@query(
    "p7_boolean_to_int",
    "select activacion_id, ifnull(flag, false)::integer as sin_nulos, flag::integer as con_nulos from (select activacion_id, if(activacion_id % 6 = 0, null, flag_activo) as flag from activaciones)",
)
def boolean_to_int(m):
    known = F.when(F.col("activacion_id") % 6 != 0, F.col("flag_activo"))
    return m.raw("activaciones").select(
        "activacion_id", numeric.flag(known).alias("sin_nulos"), known.cast("int").alias("con_nulos")
    )


@query("p8_null_default", "select recepcion_id, ifnull(dias_inactivo, 0) as dias_inactivo from recepciones")
def null_default(m):
    return m.raw("recepciones").select("recepcion_id", F.coalesce("dias_inactivo", F.lit(0)).alias("dias_inactivo"))


@query("p9_constant_columns", "select asesor_pdv_id, nom_asesor_pdv, 'PDV' as tipo_canal, 160::decimal(5,2) as monto_asociado, 1 as kits_vendidos from asesores")
def constant_columns(m):
    return m.stg("asesores").withColumn("kits_vendidos", F.lit(1))


@query("p10_row_rate", "select venta_id, (es_activacion * 100)::decimal(16,2) as tasa_activacion_pct from enriched")
def row_rate(m):
    return m.enriched.select("venta_id", rules.activation_pct(F.col("es_activacion")).alias("tasa_activacion_pct"))


@query("p11_not_null_filter", "select recepcion_id, dias_inactivo from recepciones where dias_inactivo is not null")
def not_null_filter(m):
    return m.raw("recepciones").filter(F.col("dias_inactivo").isNotNull()).select("recepcion_id", "dias_inactivo")


@query("p12_non_blank_filter", "select producto_id, lote_serie from series")
def non_blank_filter(m):
    rows = m.raw("productos").filter(text.has_serie(F.col("serie")))
    return rows.select("producto_id", text.clean_serie(F.col("serie")).alias("lote_serie"))


@query("p13_first_known_key", "select fecha_mes, oficina_id, vendedor_id, asesor_pdv_id, dases_id from sold_by")
def first_known_key(m):
    months = seller_months(m.stg("ventas"), m.stg("activaciones"))
    rows = resolve_seller(months, m.dim_asesor_pdv)
    return rows.select("fecha_mes", "oficina_id", "vendedor_id", "asesor_pdv_id", "dases_id")


@query("p14_fallback_smart_key", f"select distinct {date_key('fecha_mes')} as dtiem_id, fecha_mes from canal_mes")
def fallback_smart_key(m):
    months = m.stg("ventas").select(dates.month_start(F.col("fecha_venta")).alias("fecha_mes")).distinct()
    key = dates.date_key(F.col("fecha_mes"))
    rows = lookup(months, m.dim_tiempo.select("dtiem_id"), key == F.col("dtiem_id"))
    return rows.select(F.coalesce("dtiem_id", key).alias("dtiem_id"), "fecha_mes")


@query(
    "p15_conditional_measure",
    "select recepcion_id, fecha_venta, date_diff('day', fecha_recepcion, fecha_venta)::integer as rotation_lote from recepciones left join (select recepcion_id, fecha_venta from ventas) v using (recepcion_id)",
)
def conditional_measure(m):
    rows = receipts_with_sale(m.stg("recepciones"), m.stg("ventas"), m.stg("productos").select("producto_id", "serie"))
    return rows.select("recepcion_id", "fecha_venta", "rotation_lote")


_SALES_BY_SERIE = (
    "select venta_id as id_venta, serie as lote_serie, monto_venta as monto, canal_venta as canal, "
    "fecha_venta, oficina_id as id_oficina, vendedor_id as id_vendedor from ventas left join productos using (producto_id)"
)
_LETTERS = "regexp_replace(upper({0}), '[^A-Z]', '')"


def _documented_sales(m):
    sales = m.raw("ventas").join(m.raw("productos").select("producto_id", "serie"), "producto_id", "left")
    return sales.select(
        F.col("venta_id").alias("id_venta"),
        F.col("serie").alias("lote_serie"),
        F.col("monto_venta").alias("monto"),
        F.col("canal_venta").alias("canal"),
        "fecha_venta",
        F.col("oficina_id").alias("id_oficina"),
        F.col("vendedor_id").alias("id_vendedor"),
    )


_LATEST = (
    f"select id_venta, ifnull(lote_serie, 'SIN_SERIE') as lote_serie, ifnull(monto, 0)::decimal(12,2) as monto_venta, "
    f"{_LETTERS.format('canal')} as canal_venta, fecha_venta::timestamp as fecha_venta, id_oficina, id_vendedor from ({_SALES_BY_SERIE}) "
    "qualify row_number() over (partition by lote_serie order by fecha_venta desc, id_venta) = 1"
)
query("p16_dedup_staging", _LATEST)(lambda m: latest_sale_per_serie(_documented_sales(m)))
query("w3_keep_latest", f"select lote_serie, id_venta, fecha_venta from ({_LATEST})")(
    lambda m: latest_sale_per_serie(_documented_sales(m)).select("lote_serie", "id_venta", "fecha_venta")
)


@query("p17_fixed_filter", "select oficina_id, count(*) filter (canal_venta = 'PDV') as kits_pdv, count(*) filter (canal_venta = 'PDV' and es_activacion = 1) as activos_pdv from enriched group by 1")
def fixed_filter(m):
    pdv = F.col("canal_venta") == rules.RETAIL
    return m.enriched.groupBy("oficina_id").agg(
        F.count_if(pdv).alias("kits_pdv"), F.count_if(pdv & (F.col("es_activacion") == 1)).alias("activos_pdv")
    )


@query(
    "p18_ignore_columns",
    "select case when a.c_custkey is null then '+++' when b.c_custkey is null then '---' else '->' end as action, ifnull(a.c_custkey, b.c_custkey) as c_custkey "
    "from diff_a a full join diff_b b on a.c_custkey = b.c_custkey where a.c_custkey is null or b.c_custkey is null or a.c_mktsegment is distinct from b.c_mktsegment",
)
def ignore_columns(m):
    diff = row_diff(*diff_pair(m), ["c_custkey"], CellRules(ignore_columns=("c_acctbal",)), unique_keys=True)
    return diff.select("action", "c_custkey")


@query("p19_action_filter", "select '---' as action, c_custkey from diff_a where c_custkey not in (select c_custkey from diff_b) union all select '+++', c_custkey from diff_b where c_custkey not in (select c_custkey from diff_a)")
def action_filter(m):
    diff = row_diff(*diff_pair(m), ["c_custkey"], actions=["+++", "---"], unique_keys=True)
    return diff.select("action", "c_custkey")


# ---- scalar functions -----------------------------------------------------------


@query("f1_date_key", f"select venta_id, {date_key('fecha_venta')} as clave from ventas")
def f_date_key(m):
    return m.raw("ventas").select("venta_id", dates.date_key(F.col("fecha_venta")).alias("clave"))


@query(
    "f2_date_parts",
    "select venta_id, day(fecha_venta)::integer as dia, month(fecha_venta)::integer as mes, quarter(fecha_venta)::integer as trimestre, year(fecha_venta)::integer as anio from ventas",
)
def f_date_parts(m):
    return m.raw("ventas").select(
        "venta_id",
        F.dayofmonth("fecha_venta").alias("dia"),
        F.month("fecha_venta").alias("mes"),
        F.quarter("fecha_venta").alias("trimestre"),
        F.year("fecha_venta").alias("anio"),
    )


@query("f3_iso_week", "select venta_id, weekofyear(fecha_venta)::integer as semana, year(fecha_venta)::integer as anio from ventas")
def f_iso_week(m):
    return m.raw("ventas").select("venta_id", dates.iso_week(F.col("fecha_venta")).alias("semana"), F.year("fecha_venta").alias("anio"))


@query("f4_month_name", "select recepcion_id, monthname(fecha_recepcion) as nombre_mes from recepciones")
def f_month_name(m):
    return m.raw("recepciones").select("recepcion_id", dates.month_name(F.col("fecha_recepcion")).alias("nombre_mes"))


@query("f5_month_start", f"select recepcion_id, {month_of('fecha_recepcion')} as fecha_mes from recepciones")
def f_month_start(m):
    return m.raw("recepciones").select("recepcion_id", dates.month_start(F.col("fecha_recepcion")).alias("fecha_mes"))


@query(
    "f6_month_start_of_parts",
    "select oficina_id, anio, mes, if(mes between 1 and 12, make_date(anio, mes, 1), null) as fecha_mes from (select oficina_id, anio, mes_num + meta_kits % 4 as mes from metas)",
)
def f_month_start_of_parts(m):
    """Months past 12 give NULL instead of an error."""
    rows = m.raw("metas").withColumn("mes", F.col("mes_num") + F.col("meta_kits") % 4)
    return rows.select("oficina_id", "anio", "mes", dates.month_start_of(F.col("anio"), F.col("mes")).alias("fecha_mes"))


@query("f7_day_gap", "select venta_id, dias_lead_time from vw_enriched")
def f_day_gap(m):
    rows = scripted.vw_ventas_enriched(*[m.raw(t) for t in ("ventas", "recepciones", "activaciones", "productos")])
    return rows.select("venta_id", "dias_lead_time")


@query("f8_days_since", f"select recepcion_id, date_diff('day', fecha_recepcion, date '{AS_OF}')::integer as dias from recepciones")
def f_days_since(m):
    return m.raw("recepciones").select("recepcion_id", dates.days_since(F.col("fecha_recepcion"), AS_OF).alias("dias"))


@query("f9_year_month", "select venta_id, extract(year from fecha_venta)::integer as anio, extract(month from fecha_venta)::integer as mes_num from ventas")
def f_year_month(m):
    return m.raw("ventas").select("venta_id", F.year("fecha_venta").alias("anio"), F.month("fecha_venta").alias("mes_num"))


@query("f10_upper", "select producto_id, upper(serie) as serie from productos")
def f_upper(m):
    return m.raw("productos").select("producto_id", F.upper("serie").alias("serie"))


@query(
    "f11_squeeze_blanks",
    r"select doc_id, regexp_replace(text, '\s+', '', 'g') as texto from documents",
)
def f_squeeze_blanks(m):
    return m.sources.base("documents").select("doc_id", text.squeeze_blanks(F.col("text")).alias("texto"))


@query("f12_drop_first_other", f"select l_orderkey, l_linenumber, {_LETTERS.format('t')} as limpio from (select l_orderkey, l_linenumber, concat('a-', l_returnflag, '_', l_linestatus, ' ', l_linenumber::varchar) as t from lineitem)")
def f_drop_first_other(m):
    raw = F.concat(F.lit("a-"), "l_returnflag", F.lit("_"), "l_linestatus", F.lit(" "), F.col("l_linenumber").cast("string"))
    return m.sources.base("lineitem").select("l_orderkey", "l_linenumber", text.letters_without_first_other(raw).alias("limpio"))


@query("f13_pad", "select oficina_id, anio, mes_num, lpad(mes_num::varchar, 2, '0') as mes2 from metas")
def f_pad(m):
    return m.raw("metas").select("oficina_id", "anio", "mes_num", text.pad2(F.col("mes_num")).alias("mes2"))


@query("f14_concat", "select oficina_id, anio, mes_num, anio::varchar || '-' || lpad(mes_num::varchar, 2, '0') || '-01' as texto from metas")
def f_concat(m):
    return m.raw("metas").select("oficina_id", "anio", "mes_num", dates.month_start_text(F.col("anio"), F.col("mes_num")).alias("texto"))


@query(
    "f15_casts",
    "select venta_id, venta_id::varchar as texto, fecha_venta::timestamp as momento, monto_venta::decimal(20,4) as exacto, cast(month(fecha_venta) as smallint) as corto, try_cast(canal_venta as integer) as nulo from ventas",
)
def f_casts(m):
    return m.raw("ventas").select(
        "venta_id",
        F.col("venta_id").cast("string").alias("texto"),
        F.col("fecha_venta").cast("timestamp_ntz").alias("momento"),
        F.col("monto_venta").cast("decimal(20,4)").alias("exacto"),
        F.month("fecha_venta").cast("short").alias("corto"),
        F.col("canal_venta").try_cast("int").alias("nulo"),
    )


@query("f16_round", f"select oficina_id, anio, mes_num, {pct('mes_num', 'meta_kits')} as pct from metas")
def f_round(m):
    return m.raw("metas").select("oficina_id", "anio", "mes_num", numeric.percent(F.col("mes_num"), F.col("meta_kits")).alias("pct"))


@query("f17_nullif", "select oficina_id, anio, mes_num, nullif(meta_kits, 0) as meta from metas")
def f_nullif(m):
    return m.raw("metas").select("oficina_id", "anio", "mes_num", F.nullif("meta_kits", F.lit(0)).alias("meta"))


@query("f18_coalesce", "select venta_id, coalesce(vendedor_id, asesor_pdv_id, -1) as vendedor from ventas")
def f_coalesce(m):
    return m.raw("ventas").select("venta_id", F.coalesce("vendedor_id", "asesor_pdv_id", F.lit(-1)).alias("vendedor"))


@query("f19_case_if", "select recepcion_id, case when dias_inactivo > 90 then 'viejo' when dias_inactivo > 30 then 'medio' else 'nuevo' end as edad from recepciones")
def f_case_if(m):
    idle = F.col("dias_inactivo")
    return m.raw("recepciones").select(
        "recepcion_id", F.when(idle > 90, "viejo").when(idle > 30, "medio").otherwise("nuevo").alias("edad")
    )


@query("f20_divide_or_zero", f"select oficina_id, anio, mes_num, {ratio('mes_num', 'meta_kits')} as razon from metas")
def f_divide_or_zero(m):
    return m.raw("metas").select("oficina_id", "anio", "mes_num", numeric.divide(F.col("mes_num"), F.col("meta_kits")).alias("razon"))


@query("f21_clamp", "select oficina_id, anio, mes_num, greatest(meta_kits - mes_num * 3, 0) as brecha from metas")
def f_clamp(m):
    return m.raw("metas").select("oficina_id", "anio", "mes_num", numeric.positive_part(F.col("meta_kits") - F.col("mes_num") * 3).alias("brecha"))


@query(
    "f22_first_match",
    f"select oficina_id, anio, mes_num, case when r >= 1 then 'Meta Cumplida' when r >= 0.8 then 'En Riesgo' else 'Critico' end as luz from (select *, {ratio('mes_num * 3', 'meta_kits')} as r from metas)",
)
def f_first_match(m):
    r = numeric.divide(F.col("mes_num") * 3, F.col("meta_kits"))
    return m.raw("metas").select("oficina_id", "anio", "mes_num", rules.goal_light(r).alias("luz"))


_CELL_PAIR = "select a.c_custkey, a.c_mktsegment as x, b.c_mktsegment as y, a.c_acctbal as p, b.c_acctbal as q from diff_a a join diff_b b using (c_custkey)"


def _cell_pair(m):
    a, b = diff_pair(m)
    b = b.select("c_custkey", F.col("c_mktsegment").alias("y"), F.col("c_acctbal").alias("q"))
    return a.select("c_custkey", F.col("c_mktsegment").alias("x"), F.col("c_acctbal").alias("p")).join(b, "c_custkey")


@query("f23_comparable_cell", f"select c_custkey, x is not distinct from y as exacta, trim(lower(x)) is not distinct from trim(lower(y)) as suelta from ({_CELL_PAIR})")
def f_comparable_cell(m):
    loose = CellRules(ignore_whitespace=True, ignore_case=True)
    return _cell_pair(m).select(
        "c_custkey",
        same_cell(F.col("x"), F.col("y")).alias("exacta"),
        same_cell(F.col("x"), F.col("y"), loose).alias("suelta"),
    )


@query("f24_epsilon_equal", f"select c_custkey, ifnull(abs(p - q) < 0.01e0, false) or p is not distinct from q as igual from ({_CELL_PAIR})")
def f_epsilon_equal(m):
    return _cell_pair(m).select("c_custkey", same_cell(F.col("p"), F.col("q"), CellRules(epsilon=0.01)).alias("igual"))


@query(
    "f25_composite_key_text",
    "select venta_id, concat(ifnull(vendedor_id::varchar, ''), ' // ', canal_venta, ' // ', ifnull(recepcion_id::varchar, '')) as clave from ventas",
)
def f_composite_key_text(m):
    key = text.key_text(F.col("vendedor_id"), F.col("canal_venta"), F.col("recepcion_id"))
    return m.raw("ventas").select("venta_id", key.alias("clave"))


@query(
    "f26_null_quoting",
    "select producto_id, case when v is null then 'NULL' when regexp_full_match(v, '_*NULL') then '_' || v else v end as escrito, v as leido from (select producto_id, case when producto_id % 6 = 0 then 'NULL' when producto_id % 6 = 1 then '__NULL' else serie end as v from productos)",
)
def f_null_quoting(m):
    number = F.col("producto_id") % 6
    v = F.when(number == 0, "NULL").when(number == 1, "__NULL").otherwise(F.col("serie"))
    quoted = text.null_as_text(v)
    return m.raw("productos").select("producto_id", quoted.alias("escrito"), text.text_as_null(quoted).alias("leido"))


@query("f27_zone_to_utc", "select event_id, ts + interval 5 hour as ts_utc from events")
def f_zone_to_utc(m):
    """Lima keeps UTC-5 the whole year on these dates."""
    return m.sources.base("events").select("event_id", dates.local_to_utc(F.col("ts")).alias("ts_utc"))
