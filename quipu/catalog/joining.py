"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..operators.compare.rows import collate_versions, deletes, inserts, link_unique, updates
from ..operators.joins import left_join_unique, lookup, null_safe
from ..plans import layered, scripted
from ..session import written
from .changes import diff_pair, three_versions
from .registry import query

RAW4 = ("ventas", "recepciones", "activaciones", "productos")


@query("j1_sales_enrichment", "select venta_id, oficina_id, canal_venta, fecha_venta, monto_calculado, es_activacion, serie_producto from enriched")
def j1(m):
    return m.enriched.select(
        "venta_id", "oficina_id", "canal_venta", "fecha_venta", "monto_calculado", "es_activacion", "serie_producto"
    )


@query("j2_sales_three_left_joins", "select venta_id, recepcion_id, estado_recepcion, dias_inactivo, es_activacion, serie_producto from vw_enriched")
def j2(m):
    view = scripted.vw_ventas_enriched(*[m.raw(t) for t in RAW4])
    return view.select("venta_id", "recepcion_id", "estado_recepcion", "dias_inactivo", "es_activacion", "serie_producto")


@query("j3_inner_and_left", "select venta_id, fecha_recepcion, es_activacion from vw_received")
def j3(m):
    view = scripted.vw_ventas_received(m.raw("ventas"), m.raw("recepciones"), m.raw("activaciones"))
    return view.select("venta_id", "fecha_recepcion", "es_activacion")


@query(
    "j4_receipt_to_sale",
    "select recepcion_id, serie, fecha_venta from recepciones left join productos using (producto_id) left join (select recepcion_id, fecha_venta from ventas) v using (recepcion_id)",
)
def j4(m):
    m.land()
    rows = layered.receipts_with_sale(m.stg("recepciones"), m.stg("ventas"), m.stg("productos").select("producto_id", "serie"))
    return rows.select("recepcion_id", "serie", "fecha_venta")


@query(
    "j5_star_lookup",
    "select venta_id, dtiem_id, dofic_id, dest_id from stg_ventas v left join productos using (producto_id) left join dim_tiempo t on t.fecha = v.fecha_venta left join dim_oficina using (oficina_id) left join dim_estado e on e.lote_serie = serie",
)
def j5(m):
    m.land()
    status = layered.product_status(m.stg("productos"), m.dim_estado)
    rows = left_join_unique(m.stg("ventas"), status, "producto_id", ["venta_id"])
    rows = lookup(rows, m.dim_tiempo.select("dtiem_id"), date_key(F.col("fecha_venta")) == F.col("dtiem_id"))
    offices = m.dim_oficina.select("dofic_id", F.col("oficina_id").alias("_of"))
    rows = lookup(rows, offices, F.col("oficina_id") == F.col("_of"))
    return rows.select("venta_id", "dtiem_id", "dofic_id", "dest_id")


@query("j6_goal_three_keys", "select venta_id, meta_kits from ventas v left join metas g on g.oficina_id = v.oficina_id and g.anio = year(fecha_venta) and g.mes_num = month(fecha_venta)")
def j6(m):
    sales = m.stg("ventas").withColumns({"anio": F.year("fecha_venta"), "mes_num": F.month("fecha_venta")})
    # stored, so its bytes are known and the sales need not be dealt by a few offices and months
    goals = written(m.stg("metas").select("oficina_id", "anio", "mes_num", "meta_kits"), "goals")
    return sales.join(goals, ["oficina_id", "anio", "mes_num"], "left").select("venta_id", "meta_kits")


@query(
    "j7_role_playing",
    "select venta_id, d.dases_id as directo, p.dases_id as pdv from ventas v left join dim_asesor_pdv d on d.origen_id = v.vendedor_id and d.tipo_canal = 'DIRECTO' left join dim_asesor_pdv p on p.origen_id = v.asesor_pdv_id and p.tipo_canal = 'PDV'",
)
def j7(m):
    rows = layered.resolve_seller(m.stg("ventas"), m.dim_asesor_pdv)
    return rows.select("venta_id", F.col("_direct").alias("directo"), F.col("_retail").alias("pdv"))


@query("j8_one_row_total", "select oficina_id, sum(monto_calculado)::decimal(22,2) as ingresos, (select sum(monto_calculado) from stg_ventas)::decimal(32,2) as ingresos_total from stg_ventas group by 1")
def j8(m):
    """The one-row total is a scalar subquery over the office sums, not a product of tables."""
    offices = m.stg("ventas").groupBy("oficina_id").agg(F.sum("monto_calculado").alias("ingresos"))
    return offices.withColumn("ingresos_total", offices.agg(F.sum("ingresos")).scalar())


@query("j9_goal_subquery", "select oficina_id, anio, mes_num, ifnull(meta, 0) as meta_kits_mes from (select distinct oficina_id, year(fecha_venta)::integer as anio, month(fecha_venta)::integer as mes_num from ventas) left join goal_sums using (oficina_id, anio, mes_num)")
def j9(m):
    months = m.stg("ventas").select("oficina_id", F.year("fecha_venta").alias("anio"), F.month("fecha_venta").alias("mes_num")).distinct()
    rows = months.join(scripted.summed_goals(m.raw("metas")), ["oficina_id", "anio", "mes_num"], "left")
    return rows.select("oficina_id", "anio", "mes_num", F.coalesce("_goal", F.lit(0)).alias("meta_kits_mes"))


@query("j10_join_own_aggregate", "select venta_id, ing::decimal(22,2) as ingresos_oficina from enriched join office_income using (oficina_id)")
def j10(m):
    m.land()
    sales = written(m.enriched.select("venta_id", "oficina_id", "monto_calculado"), "enriched")
    offices = sales.groupBy(F.col("oficina_id").alias("_of")).agg(F.sum("monto_calculado").alias("ingresos_oficina"))
    rows = sales.join(written(offices, "offices"), F.col("oficina_id") == F.col("_of"))
    return rows.select("venta_id", "ingresos_oficina")


@query("j11_left_turned_inner", "select recepcion_id, serie from recepciones join productos using (producto_id) where serie is not null")
def j11(m):
    """Written as a left join; the later filter lets Catalyst make it inner."""
    rows = m.raw("recepciones").join(m.raw("productos"), "producto_id", "left")
    return rows.filter(F.col("serie").isNotNull()).select("recepcion_id", "serie")


@query("j12_fan_out_only", "select oficina_id, count(*) as filas from ventas left join activaciones using (venta_id) group by 1")
def j12(m):
    """Only the row count of the join matters, so counts per sale replace its rows."""
    rows = layered.weighted_sales(m.stg("ventas"), m.stg("activaciones"))
    return rows.groupBy("oficina_id").agg(F.sum("_rows").alias("filas"))


def _null_keyed(m):
    sales = m.raw("ventas").groupBy("vendedor_id", "asesor_pdv_id").agg(F.count("*").alias("ventas"))
    active = (
        m.raw("ventas").filter("venta_id % 2 = 0").groupBy("vendedor_id", "asesor_pdv_id").agg(F.count("*").alias("pares"))
    )
    return sales, active


@query(
    "j13_null_safe_match",
    "select a.vendedor_id, a.asesor_pdv_id, ventas, pares from (select vendedor_id, asesor_pdv_id, count(*) as ventas from ventas group by all) a "
    "join (select vendedor_id, asesor_pdv_id, count(*) as pares from ventas where venta_id % 2 = 0 group by all) b "
    "on a.vendedor_id is not distinct from b.vendedor_id and a.asesor_pdv_id is not distinct from b.asesor_pdv_id",
)
def j13(m):
    sales, active = _null_keyed(m)
    keys = ["vendedor_id", "asesor_pdv_id"]
    return null_safe(sales, active, keys, "inner").select(*keys, "ventas", "pares")


@query("j14_inserts", "select * from diff_b where c_custkey not in (select c_custkey from diff_a)")
def j14(m):
    return inserts(*diff_pair(m), ["c_custkey"])


@query("j15_deletes", "select * from diff_a where c_custkey not in (select c_custkey from diff_b)")
def j15(m):
    return deletes(*diff_pair(m), ["c_custkey"])


@query(
    "j16_updates",
    "select c_custkey, a.c_acctbal as antes, b.c_acctbal as despues, a.c_mktsegment as segmento_antes, b.c_mktsegment as segmento_despues from diff_a a join diff_b b using (c_custkey) "
    "where a.c_acctbal is distinct from b.c_acctbal or a.c_mktsegment is distinct from b.c_mktsegment",
)
def j16(m):
    rows = updates(*diff_pair(m), ["c_custkey"])
    return rows.select(
        "c_custkey",
        F.col("c_acctbal.before").alias("antes"),
        F.col("c_acctbal.after").alias("despues"),
        F.col("c_mktsegment.before").alias("segmento_antes"),
        F.col("c_mktsegment.after").alias("segmento_despues"),
    )


@query(
    "j17_three_way_match",
    "select c_custkey, in_p, in_l, in_r, p_cents, l_cents, r_cents from three "
    "union all select c_custkey + 50000000, false, true, true, null, null, cents from three_p where c_custkey % 110 = 0 "
    "union all select c_custkey + 60000000, false, false, true, null, null, null from three_p where c_custkey % 130 = 0",
)
def j17(m):
    p, l, r = three_versions(m)
    rows = collate_versions({"p": p, "l": l, "r": r}, ["c_custkey"])
    return rows.select(
        "c_custkey",
        *[(F.col(f"n_{s}") > 0).alias(f"in_{s}") for s in "plr"],
        *[F.col(s)["cents"].alias(f"{s}_cents") for s in "plr"],
    )


@query(
    "j18_unique_on_both_sides",
    "select a.fecha_venta as fecha, a.oficina_id, a.venta_id as izquierda, b.recepcion_id as derecha from "
    "(select *, count(*) over (partition by fecha_venta, oficina_id) as n from ventas) a join (select *, count(*) over (partition by fecha_recepcion, oficina_id) as n from recepciones) b "
    "on a.fecha_venta = b.fecha_recepcion and a.oficina_id = b.oficina_id where a.n = 1 and b.n = 1",
)
def j18(m):
    m.land()
    a = m.raw("ventas").select(F.col("fecha_venta").alias("fecha"), "oficina_id", "venta_id")
    b = m.raw("recepciones").select(F.col("fecha_recepcion").alias("fecha"), "oficina_id", "recepcion_id")
    rows = link_unique(a, b, ["fecha", "oficina_id"])
    return rows.select(
        "fecha", "oficina_id", F.col("l.venta_id").alias("izquierda"), F.col("r.recepcion_id").alias("derecha")
    )
