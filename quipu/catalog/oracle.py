"""Reference SQL: the raw tables, models and change fixtures as named subqueries.

Only the order tables exist on the checking side, so each check carries the
definitions it needs. Percentages are rounded in integers, half up, to be exact.
"""

from __future__ import annotations

import re


def pct(part: str, whole: str) -> str:
    """part / whole * 100 at two decimals from whole numbers; NULL over zero."""
    base = f"nullif(({whole})::hugeint, 0)"
    return f"cast(cast(((({part})::hugeint) * 20000 + {base}) // (2 * {base}) as decimal(30,0)) / 100 as decimal(20,2))"


def money_pct(part: str, whole: str) -> str:
    return pct(f"({part}) * 100", f"({whole}) * 100")


def ratio(part: str, whole: str) -> str:
    return f"coalesce(cast({part} as double) / nullif(cast({whole} as double), 0), 0)"


def date_key(day: str) -> str:
    return f"cast(strftime({day}, '%Y%m%d') as integer)"


def month_of(day: str) -> str:
    return f"cast(date_trunc('month', {day}) as date)"


FOLD = "lower(rtrim({0}))"
RISK = "coalesce(dias_inactivo > 90 and estado_recepcion <> 'VENDIDO', false)"
KITS = "kits_por_asesor, kits_activos_asesor, kits_inactivos_asesor"

TABLES: dict[str, str] = {
    # raw tables
    "la": "select l_orderkey, min(l_partkey) as pk, min(l_suppkey) as sk from lineitem group by l_orderkey",
    "oficinas": "select n_nationkey as oficina_id, n_name as nom_oficina, concat(r_name,'-D',cast(n_nationkey % 2 as string)) as departamento, r_name as region, concat('ZONA_',cast(n_nationkey % 4 as string)) as zona from nation join region on n_regionkey=r_regionkey",
    "productos": "select p_partkey as producto_id, case when p_partkey % 97 = 0 then null when p_partkey % 89 = 0 then '  ' when p_partkey % 7 = 0 then concat(' ',lower(p_brand),'-',cast(p_partkey as string),' ') else concat(p_brand,'-',cast(p_partkey as string)) end as serie, p_name as descripcion, cast(p_retailprice as decimal(10,2)) as precio_base, p_size > 5 as activo from part",
    "vendedores": "select s_suppkey as vendedor_id, s_name as nom_vendedor from supplier where s_suppkey % 2 = 0",
    "asesores": "select s_suppkey as asesor_pdv_id, s_name as nom_asesor_pdv from supplier where s_suppkey % 2 = 1",
    "ventas": "select o_orderkey as venta_id, c_nationkey as oficina_id, pk as producto_id, case when o_orderkey % 11 <> 0 and sk % 2 = 0 then sk end as vendedor_id, case when o_orderkey % 11 <> 0 and sk % 2 = 1 then sk end as asesor_pdv_id, case when o_orderkey % 11 = 0 or sk is null then 'ONLINE' when sk % 2 = 0 then 'DIRECTO' else 'PDV' end as canal_venta, cast(o_orderdate as date) as fecha_venta, case when o_orderkey % 13 <> 0 then o_orderkey end as recepcion_id, cast(o_totalprice as decimal(12,2)) as monto_venta from orders join customer on o_custkey=c_custkey left join la on l_orderkey=o_orderkey where o_orderstatus <> 'P'",
    "recepciones": "select o_orderkey as recepcion_id, c_nationkey as oficina_id, pk as producto_id, cast(cast(o_orderdate as date) - cast(o_orderkey % 150 as int) as date) as fecha_recepcion, case o_orderstatus when 'F' then 'VENDIDO' when 'O' then 'EN_TRANSITO' else 'DISPONIBLE' end as estado_recepcion, case when o_orderkey % 17 <> 0 then cast(o_orderkey % 150 as int) end as dias_inactivo from orders join customer on o_custkey=c_custkey left join la on l_orderkey=o_orderkey",
    "activaciones": "select o_orderkey as activacion_id, o_orderkey as venta_id, cast(cast(o_orderdate as date) + cast(o_orderkey % 30 as int) as date) as fecha_activacion, o_orderkey % 4 <> 0 as flag_activo from orders where o_orderstatus <> 'P' and o_orderkey % 5 <> 0 union all select -o_orderkey, o_orderkey, cast(o_orderdate as date), true from orders where o_orderstatus <> 'P' and o_orderkey % 5 <> 0 and o_orderkey % 101 = 0",
    "metas": "select distinct oficina_id, cast(year(fecha_venta) as int) as anio, cast(month(fecha_venta) as int) as mes_num, cast((oficina_id*7+year(fecha_venta)*12+month(fecha_venta)) % 40 as int) as meta_kits from ventas where (oficina_id + month(fecha_venta)) % 9 <> 0",
    # staging
    "stg_ventas": "select * exclude (monto_venta), monto_venta as monto_original, cast(if(canal_venta = 'DIRECTO', 220, if(canal_venta = 'PDV', 160, monto_venta)) as decimal(12,2)) as monto_calculado from ventas",
    "stg_recepciones": f"select * replace (ifnull(dias_inactivo, 0) as dias_inactivo), {RISK} as flag_riesgo_90d from recepciones",
    "stg_activaciones": "select * replace (cast(flag_activo is true as integer) as flag_activo) from activaciones",
    "stg_metas": "select *, if(mes_num between 1 and 12, make_date(anio, mes_num, 1), null) as fecha_mes from metas",
    "stg_vendedores": "select *, 'DIRECTO' as tipo_canal, cast(220 as decimal(5,2)) as monto_asociado from vendedores",
    "stg_asesores": "select *, 'PDV' as tipo_canal, cast(160 as decimal(5,2)) as monto_asociado from asesores",
    # dimensions
    "fechas": "select fecha_venta as fecha from ventas union select fecha_recepcion from recepciones union select fecha_mes from stg_metas",
    "dim_tiempo": f"select {date_key('fecha')} as dtiem_id, fecha, day(fecha)::smallint as dia, weekofyear(fecha)::smallint as semana, month(fecha)::smallint as mes, monthname(fecha) as nombre_mes, quarter(fecha)::smallint as trimestre, year(fecha)::smallint as anio from fechas where fecha is not null",
    "dim_oficina": "select row_number() over (order by oficina_id) as dofic_id, * from oficinas",
    "sellers": "select vendedor_id as origen_id, nom_vendedor as nom_cliente_pdv, tipo_canal, monto_asociado from stg_vendedores union all select * from stg_asesores",
    "dim_asesor_pdv": "select row_number() over (order by tipo_canal, origen_id) as dases_id, * from sellers",
    "series": r"select producto_id, regexp_replace(upper(serie), '\s+', '', 'g') as lote_serie from productos where regexp_replace(serie, '\s+', '', 'g') <> ''",
    "states": "select estado_recepcion as estado, dias_inactivo as dias_desde_recepcion, flag_riesgo_90d, lote_serie from stg_recepciones join series using (producto_id)",
    "master_states": "select * from states qualify row_number() over (partition by lote_serie order by dias_desde_recepcion, estado desc, flag_riesgo_90d) = 1",
    "dim_estado": "select row_number() over (order by estado, lote_serie) as dest_id, *, 'SI, SOY LA TABLA LIMPIA' as tabla_viva_dbt from master_states",
    # enriched sales and facts
    "enriched": "select s.*, ifnull(a.flag_activo, 0) as es_activacion, p.serie as serie_producto from stg_ventas s left join stg_activaciones a using (venta_id) left join productos p using (producto_id)",
    "office_income": "select oficina_id, sum(monto_calculado) as ing, sum(sum(monto_calculado)) over () as todo from enriched group by oficina_id",
    "fact_ventas": f"select t.dtiem_id, dofic_id, dest_id, venta_id, canal_venta, serie_producto as serie, 1 as kits_vendidos, es_activacion as kits_activos, cast(es_activacion * 100 as decimal(16,2)) as tasa_activacion_pct, monto_calculado as ingresos_s, {money_pct('ing', 'todo')} as contribucion_pct from enriched v left join dim_tiempo t on t.fecha = v.fecha_venta left join dim_oficina using (oficina_id) left join dim_estado e on e.lote_serie = v.serie_producto left join office_income using (oficina_id)",
    "fact_inventario": "select t.dtiem_id, dofic_id, dest_id, p.serie, dias_inactivo, r.flag_riesgo_90d::integer as kits_riesgo_90d, date_diff('day', fecha_recepcion, fecha_venta)::integer as rotation_lote from stg_recepciones r left join productos p using (producto_id) left join (select recepcion_id, fecha_venta from ventas) v using (recepcion_id) left join dim_tiempo t on t.fecha = r.fecha_recepcion left join dim_oficina using (oficina_id) left join dim_estado e on e.lote_serie = p.serie",
    "canal_mes": f"select {month_of('fecha_venta')} as fecha_mes, oficina_id, count(*) filter (canal_venta = 'DIRECTO') as kits_canal_directo, count(*) filter (canal_venta = 'PDV') as kits_canal_pdv, cast(ifnull(sum(monto_calculado) filter (canal_venta = 'DIRECTO'), 0) as decimal(22,2)) as ingresos_directo, cast(ifnull(sum(monto_calculado) filter (canal_venta = 'PDV'), 0) as decimal(22,2)) as ingresos_pdv, count(*) as total_kits from enriched group by all",
    "fact_canal": f"select {date_key('fecha_mes')} as dtiem_id, dofic_id, kits_canal_directo, kits_canal_pdv, ingresos_directo, ingresos_pdv, {pct('kits_canal_pdv', 'total_kits')} as mix_canal_pct from canal_mes left join dim_oficina using (oficina_id)",
    "seller_months": f"select {month_of('fecha_venta')} as fecha_mes, year(fecha_venta)::integer as anio, month(fecha_venta)::integer as mes_num, oficina_id, vendedor_id, asesor_pdv_id, count(*) as kits_por_asesor, sum(es_activacion)::bigint as kits_activos_asesor, sum(1 - es_activacion)::bigint as kits_inactivos_asesor from enriched group by all",
    "sold_by": "select s.*, coalesce(d.dases_id, p.dases_id) as dases_id from seller_months s left join dim_asesor_pdv d on d.origen_id = s.vendedor_id and d.tipo_canal = 'DIRECTO' left join dim_asesor_pdv p on p.origen_id = s.asesor_pdv_id and p.tipo_canal = 'PDV'",
    "fact_desempeno": f"select dtiem_id, dofic_id, dases_id, {KITS}, ifnull(meta_kits, 0) as meta_kits_mes, {pct('kits_activos_asesor', 'meta_kits')} as cumplimiento_meta_pct, {pct('kits_inactivos_asesor', 'kits_por_asesor')} as kits_inactivos_pct from sold_by s left join metas using (oficina_id, anio, mes_num) left join dim_tiempo t on t.fecha = s.fecha_mes left join dim_oficina using (oficina_id)",
    "received_months": f"select {month_of('fecha_recepcion')} as fecha_mes, oficina_id, count(*) as kits_recibidos from recepciones group by all",
    "goal_months": "select fecha_mes, oficina_id, sum(meta_kits)::bigint as meta_activacion from stg_metas group by all",
    "fact_metas_pedidos": "select fecha_mes, oficina_id, ifnull(kits_recibidos, 0) as kits_recibidos, ifnull(meta_activacion, 0) as meta_activacion from received_months full join goal_months using (fecha_mes, oficina_id)",
    # scripted mart
    "vw_enriched": f"select venta_id, v.oficina_id, v.producto_id, vendedor_id, asesor_pdv_id, canal_venta, fecha_venta, r.recepcion_id, fecha_recepcion, estado_recepcion, dias_inactivo, cast(if(canal_venta = 'DIRECTO', 220, if(canal_venta = 'PDV', 160, monto_venta)) as decimal(12,2)) as monto_calculado, date_diff('day', fecha_recepcion, fecha_venta)::integer as dias_lead_time, {RISK}::integer as flag_riesgo_90d, ifnull(flag_activo, false)::integer as es_activacion, serie as serie_producto from ventas v left join recepciones r on r.recepcion_id = v.recepcion_id left join activaciones using (venta_id) left join productos p on p.producto_id = v.producto_id",
    "vw_received": "select venta_id, v.oficina_id, fecha_venta, fecha_recepcion, cast(if(canal_venta = 'DIRECTO', 220, if(canal_venta = 'PDV', 160, monto_venta)) as decimal(12,2)) as monto_calculado, date_diff('day', fecha_recepcion, fecha_venta)::integer as dias_rotacion, if(date_diff('day', fecha_recepcion, fecha_venta) > 90, 1, 0) as es_riesgo, ifnull(flag_activo, false)::integer as es_activacion, vendedor_id, asesor_pdv_id, canal_venta from ventas v join recepciones r using (recepcion_id) left join activaciones using (venta_id)",
    "a_dim_tiempo": f"select {date_key('fecha')} as dtiem_id, fecha, day(fecha)::integer as dia, weekofyear(fecha)::integer as semana, month(fecha)::integer as mes, monthname(fecha) as nombre_mes, quarter(fecha)::integer as trimestre, year(fecha)::integer as anio, if(not sold and received, fecha, null) as fecha_recepcion, if(sold, fecha, null) as fecha_venta from (select fecha, fecha in (select fecha_venta from ventas) as sold, fecha in (select fecha_recepcion from recepciones) as received from fechas where fecha is not null)",
    "a_states": f"select min(estado_recepcion) as estado, dias_inactivo as dias_desde_recepcion, {RISK}::integer as flag_riesgo_90d, min(serie) as lote_serie from recepciones left join productos using (producto_id) group by {FOLD.format('estado_recepcion')}, dias_inactivo, {RISK}, {FOLD.format('serie')}",
    "a_dim_estado": "select row_number() over (order by estado, lote_serie nulls last, dias_desde_recepcion nulls last, flag_riesgo_90d) as dest_id, * from a_states",
    "a_dim_oficina": "select row_number() over (order by oficina_id) as dofic_id, * from oficinas",
    "a_dim_asesor": "select row_number() over (order by tipo_canal, origen_id) as dases_id, origen_id::bigint as origen_id, nom_cliente_pdv, tipo_canal, monto_asociado::decimal(10,2) as monto_asociado from sellers",
    "a_status": f"select {FOLD.format('lote_serie')} as f, min(dest_id) as dest_id, count(*) as n from a_dim_estado where lote_serie is not null group by 1",
    "a_loaded": f"select {date_key('fecha_venta')} as dtiem_id, dofic_id, dest_id, ifnull(n, 0) as n_estados, 1 as kits_vendidos, es_activacion as kits_activos, (es_activacion * 100)::decimal(5,2) as tasa_activacion_pct, monto_calculado::decimal(38,2) as ingresos_s, venta_id, serie_producto as serie, canal_venta from vw_enriched v join a_dim_oficina using (oficina_id) left join a_status on f = {FOLD.format('v.serie_producto')}",
    "a_income": "select dofic_id, sum(ingresos_s * greatest(n_estados, 1)) as ing, sum(sum(ingresos_s * greatest(n_estados, 1))) over () as todo from a_loaded group by dofic_id",
    "hecho_ventas": f"select a_loaded.*, {money_pct('ing', 'todo')}::decimal(5,2) as contribucion_pct from a_loaded join a_income using (dofic_id)",
    "hecho_inventario": f"select {date_key('fecha_recepcion')} as dtiem_id, dofic_id, dest_id, ifnull(n, 0) as n_estados, ifnull(dias_inactivo, 0) as dias_inactivo, {RISK}::integer as kits_riesgo_90d, date_diff('day', fecha_recepcion, fecha_venta)::decimal(8,2) as rotation_lote, p.serie from recepciones r join productos p using (producto_id) join a_dim_oficina using (oficina_id) left join (select recepcion_id, fecha_venta from ventas) v using (recepcion_id) left join a_status on f = {FOLD.format('p.serie')}",
    "hecho_canal": f"select {date_key('fecha_mes')} as dtiem_id, dofic_id, kits_canal_directo, kits_canal_pdv, ingresos_directo::decimal(38,2) as ingresos_directo, ingresos_pdv::decimal(38,2) as ingresos_pdv, {pct('kits_canal_pdv', 'total_kits')}::decimal(5,2) as mix_canal_pct from canal_mes join a_dim_oficina using (oficina_id)",
    "goal_sums": "select oficina_id, anio, mes_num, sum(meta_kits)::bigint as meta from metas group by all",
    "hecho_desempeno": f"select {date_key('fecha_mes')} as dtiem_id, dofic_id, dases_id::bigint as dases_id, {KITS}, ifnull(meta, 0) as meta_kits_mes, {pct('kits_activos_asesor', 'meta')}::decimal(12,2) as cumplimiento_meta_pct, {pct('kits_inactivos_asesor', 'kits_por_asesor')}::decimal(5,2) as kits_inactivos_pct from sold_by join a_dim_oficina using (oficina_id) left join goal_sums using (oficina_id, anio, mes_num)",
    # measures
    "sales_cube": "select oficina_id, fecha_venta, canal_venta, count(*) as kits, sum(es_activacion)::bigint as activos, sum(monto_calculado)::decimal(30,2) as ingresos from enriched group by all",
    "sales": f"select c.*, year(fecha_venta)::integer as anio, quarter(fecha_venta)::integer as trimestre, month(fecha_venta)::integer as mes, day(fecha_venta)::integer as dia, {month_of('fecha_venta')} as fecha_mes, nom_oficina, departamento, region, zona from sales_cube c left join oficinas using (oficina_id)",
    "goals": "select f.*, year(fecha_mes)::integer as anio, quarter(fecha_mes)::integer as trimestre, month(fecha_mes)::integer as mes, nom_oficina, departamento, region, zona from fact_metas_pedidos f left join oficinas using (oficina_id)",
    # change fixtures
    "diff_a": "select * from customer",
    "diff_b": "select c_custkey, c_name, c_nationkey, case when c_custkey % 20 = 1 then c_acctbal + 1 when c_custkey % 20 = 3 then c_acctbal + 0.001e0 else c_acctbal end as c_acctbal, if(c_custkey % 20 = 2, concat(' ', lower(c_mktsegment), ' '), c_mktsegment) as c_mktsegment from customer where c_custkey % 50 <> 0 union all select c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment from customer where c_custkey % 70 = 0",
    "three_p": "select c_custkey, c_name, c_nationkey, cast(c_acctbal * 100 as bigint) as cents from customer",
    "three_l": "select c_custkey, c_name, c_nationkey, if(c_custkey % 20 in (1, 4, 6), cents + 10, cents) as cents from three_p where c_custkey % 50 <> 7 union all select c_custkey + 20000000, c_name, c_nationkey, cents from three_p where c_custkey % 70 = 0 union all select c_custkey + 40000000, c_name, c_nationkey, cents from three_p where c_custkey % 90 = 0",
    "three_r": "select c_custkey, c_name, if(c_custkey % 20 = 8, c_nationkey + 1, c_nationkey) as c_nationkey, case when c_custkey % 20 in (1, 5) then cents + 20 when c_custkey % 20 = 6 then cents + 10 else cents end as cents from three_p where c_custkey % 50 <> 9 union all select c_custkey + 30000000, c_name, c_nationkey, cents from three_p where c_custkey % 70 = 0 union all select c_custkey + 40000000, c_name, c_nationkey, cents + 5 from three_p where c_custkey % 90 = 0",
    "three": "select coalesce(p.c_custkey, l.c_custkey, r.c_custkey) as c_custkey, p.c_custkey is not null as in_p, l.c_custkey is not null as in_l, r.c_custkey is not null as in_r, p.c_name as p_name, l.c_name as l_name, r.c_name as r_name, p.c_nationkey as p_nation, l.c_nationkey as l_nation, r.c_nationkey as r_nation, p.cents as p_cents, l.cents as l_cents, r.cents as r_cents from three_p p full join three_l l on p.c_custkey = l.c_custkey full join three_r r on r.c_custkey = coalesce(p.c_custkey, l.c_custkey)",
    "part_new": "select p_partkey, p_name, p_brand, p_type as p_kind, p_retailprice, if(p_partkey % 3 = 0, 'A', if(p_partkey % 3 = 1, '', null)) as p_tier from part where p_partkey % 40 <> 0",
}

_WORD = re.compile(r"[a-z_]+[a-z0-9_]*")


#: the facts over sales of which some were deleted and others changed their channel
CORRECTED = ("ventas", "stg_ventas", "enriched", "canal_mes", "fact_canal", "seller_months", "sold_by", "fact_desempeno")
_OF_SALES = re.compile(rf"\b({'|'.join(CORRECTED)})\b")
TABLES["corr_ventas"] = "select * replace (if(venta_id % 17 = 0, 'PDV', canal_venta) as canal_venta) from ventas where venta_id % 23 <> 0"
TABLES |= {f"corr_{name}": _OF_SALES.sub(r"corr_\1", TABLES[name]) for name in CORRECTED[1:]}


def with_tables(sql: str) -> str:
    """Put the definitions a statement uses, and those they use, in front of it."""
    wanted: set[str] = set()
    pending = [sql]
    while pending:
        for word in set(_WORD.findall(pending.pop())) & TABLES.keys() - wanted:
            wanted.add(word)
            pending.append(TABLES[word])
    if not wanted:
        return sql
    parts = [f"{name} as ({TABLES[name]})" for name in TABLES if name in wanted]
    if sql.startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + sql.removeprefix("with ")
    return "with " + ",\n".join(parts) + "\n" + sql
